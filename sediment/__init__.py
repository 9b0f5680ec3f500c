"""Audited, layered data lake for daily transaction extracts, built on Spark DataFrames."""

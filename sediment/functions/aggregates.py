"""Conditional aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sediment.functions.money import as_total


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sum_where(condition: Column, value: Column) -> Column:
    """Sum over matching rows; null when none match."""
    return as_total(F.sum(F.when(condition, value)))


def sum_where_or_zero(condition: Column, value: Column) -> Column:
    return F.coalesce(sum_where(condition, value), as_total(F.lit(0)))


def mean_where(condition: Column, value: Column) -> Column:
    """Mean over matching rows as a double; null when none match."""
    chosen = F.when(condition, value)
    return F.sum(chosen).cast("double") / F.nullif(F.count(chosen), F.lit(0))


def duplicate_count(key: str) -> Column:
    """Rows minus distinct keys: zero exactly when the key is unique and never null."""
    return F.count(F.lit(1)) - F.count_distinct(F.col(key))

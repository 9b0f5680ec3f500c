"""Connected components of an edge table, by joins and grouped minima in a few rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.base import staged


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(``node``, ``label``) for the nodes of (``a``, ``b``) edges; the label is the smallest node joined to it.

    Alternates two steps until no edge changes: every node's larger neighbours are tied to its
    smallest neighbour, then its smaller neighbours are. Edges stay as many as there were (one per
    node at the end), a node's neighbours are only ever reduced to their minimum by a grouped
    aggregate, and each round starts from a written table.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = staged(edges.distinct())
    for _ in range(most_rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = small.union(small_least.select("a", F.col("m").alias("b"))).distinct()
        after = staged(small)
        same = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        now = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = after
        if same == now:
            break
    else:
        raise RuntimeError(f"components: not settled after {most_rounds} rounds")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())

"""Joins against reference and dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def known_accounts(accepted_deltas: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """One row per account with the first day it is known, in ``known_from``.

    ``stored`` holds accounts promoted by earlier runs; those count as known from the start.
    """
    known = accepted_deltas.select("account_id", F.col("date").alias("known_from"))
    if stored is not None:
        known = known.unionByName(
            stored.select("account_id", F.lit("0001-01-01").cast("date").alias("known_from"))
        )
    return known.groupBy("account_id").agg(F.min("known_from").alias("known_from"))


def resolve_accounts(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Flag each row by whether its account was known on the row's ``date``.

    An equality join plus a comparison on the result, so no range join. The dimension grows with
    the data, and the files of a million accounts can be small enough for Spark to broadcast them
    through the driver unmeasured, so both sides are shuffled and sorted; adaptive execution splits
    the partitions of hot accounts. It can split only where
    both inputs come straight from a shuffle; ``known`` comes from a grouping by the same key,
    whose shuffle the join would reuse. The second key changes no result but makes the join
    shuffle the (comparatively small) dimension anew.
    """
    extra = F.length("account_id").alias("_length")
    return (
        rows.select("*", extra)
        .join(known.select("*", extra).hint("merge"), ["account_id", "_length"], "left")
        .withColumn(
            "_is_resolvable", F.coalesce(F.col("known_from") <= F.col("date"), F.lit(False))
        )
        .drop("known_from", "_length")
    )

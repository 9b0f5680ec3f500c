"""Comparing two frames that should agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_digest(columns: list[Column | str]) -> list[Column]:
    """Two independent 64-bit hashes of a row's values. A null is told from every value.

    Equal rows have equal digests if their columns have the same types; different rows share both
    hashes with a chance of 1 in 2**128.
    """
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    marked = [part for v in values for part in (v.isNull(), v)]
    return [F.xxhash64(F.lit(seed), *marked) for seed in (1, 2)]


def differing_groups(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Values of ``key`` whose rows are not the same in both frames, copies counted.

    Told by the number of rows and two sums of row hashes, which no order changes: the map tasks reduce
    each group to one row before the shuffle, however many rows or columns it has. A value that is
    not named has equal rows but for a chance of about 1 in 2**128.
    """
    sides = left.select(*columns, F.lit(1).alias("_side")).unionByName(right.select(*columns, F.lit(-1).alias("_side")))
    hashed = sides.select(key, "_side", F.array(*row_digest([c for c in columns if c != key])).alias("_hash"))
    gaps = [F.sum("_side").alias("_rows")]
    for i in range(2):
        signed = F.col("_hash")[i].cast("decimal(20,0)") * F.col("_side")
        gaps.append(F.sum(signed).alias(f"_sum{i}"))
    return hashed.groupBy(key).agg(*gaps).where("_rows != 0 OR _sum0 != 0 OR _sum1 != 0").select(key)


def row_surplus(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Per distinct row, how often it occurs in ``left`` minus ``right`` (``surplus``), if not 0.

    Covers the multiset difference both ways with one pre-aggregated shuffle.
    """
    sides = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    return (
        sides.groupBy(*columns).agg(F.sum("_side").alias("surplus")).where(F.col("surplus") != 0)
    )


def count_by(df: DataFrame, name: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def side_by_side(key: str, **layers: DataFrame) -> DataFrame:
    """Row counts of several frames per ``key``, zero where a frame has none.

    One union and one pre-aggregated grouping instead of a chain of outer joins.
    """
    names = list(layers)
    stacked = None
    for name, df in layers.items():
        part = df.select(key, *[F.lit(int(n == name)).cast("long").alias(n) for n in names])
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(key).agg(*[F.sum(n).alias(n) for n in names])

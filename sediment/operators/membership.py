"""Which groups of stored ids can hold any of some new ids, told from small sketches of the groups.

A sketch is a Bloom filter: for every id ``HASHES`` bits are set in an array of about ``BITS`` bits an
id. If one of its bits is not set the id is not in the group; if all are, it may be (one in some
hundred thousand ids that are not there passes). Sketches are built by grouped aggregation, so a hot
id collapses in the map tasks, and asked by a semi join that stops at a group's first hit. Everything
is built-in expressions. Ids are never broadcast: files of many of them can be small enough for Spark to
do so. Only the sizes of the sketches, one row a group, go to all tasks.

Null ids set no bits and are never found. A group without ids has no sketch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, HASHES = 24, 8
#: So many words of a sketch are made in one go.
CHUNK = 4096


def _places(key: Column, size: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), key), size) for i in range(HASHES)]


def sketches(ids: DataFrame, per: str, within: str, key: str) -> DataFrame:
    """(``per``, ``within``, ``size``, ``bits``): a sketch of the keys of each group.

    All groups of one ``per`` have sketches of the same size, that of the largest one. A sketch is
    as large as its group has distinct ids, so the groups should be those that files are made of.
    """
    group = [per, within]
    ids = ids.where(F.col(key).isNotNull()).select(*group, key)
    counts = ids.distinct().groupBy(*group).agg(F.count("*").alias("n"))
    sizes = counts.groupBy(per).agg((F.ceil(F.max("n") * BITS / 64) * 64).alias("size"))
    sized = counts.join(sizes, per).select(*group, "size")
    # A few rows become as many as there are words: they are dealt out before, in chunks.
    chunks = sized.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (size div 64 - 1) div {CHUNK})")))
    tasks = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.expr(f"least((chunk + 1) * {CHUNK}, size div 64) - 1")
    words = chunks.repartition(tasks, *group, "chunk").withColumn("word", F.explode(F.sequence(F.col("chunk") * CHUNK, last)))
    empty = words.select(*group, "size", "word", F.lit(0).cast("long").alias("bit"))
    # Copies of an id set the same bits, so ids need not be distinct here.
    place = ids.join(F.broadcast(sized), group)
    place = place.select(*group, "size", F.explode(F.array(*_places(F.col(key), F.col("size")))).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    set_bits = place.select(*group, "size", F.expr("place div 64").alias("word"), bit.alias("bit"))
    merged = empty.unionByName(set_bits).groupBy(*group, "size", "word").agg(F.bit_or("bit").alias("bit"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bit")))
    return merged.groupBy(*group, "size").agg(F.transform(ordered, lambda w: w["bit"]).alias("bits"))


def may_hold(bits: Column, size: Column, key: Column) -> Column:
    """Whether a sketch has all bits of a key."""

    def has(place: Column) -> Column:
        word = F.get(bits, F.shiftright(place, 6).cast("int"))
        return F.call_function("shiftright", word, place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return reduce(Column.__and__, map(has, _places(key, size)))


def groups_that_may_hold(sketched: DataFrame, wanted: DataFrame, per: str, within: str, key: str) -> DataFrame:
    """(``per``, ``within``) of the sketches that may hold any of the ``wanted`` (``within``, ``key``)."""
    asked = wanted.select(F.col(within).alias("_within"), F.col(key).alias("_key")).distinct().hint("merge")
    hit = may_hold(F.col("bits"), F.col("size"), F.col("_key"))
    return sketched.join(asked, (F.col(within) == F.col("_within")) & hit, "left_semi").select(per, within)

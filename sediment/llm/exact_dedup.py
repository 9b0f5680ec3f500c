"""Exact duplicates by content sort.

Sampled splitters range-partition the normalised texts, the external sort of each partition places
equal texts next to each other, and neighbouring rows are compared in full (a window over the text
in an order that the range partitioning already gives, so nothing is shuffled twice).

* The splitters are drawn from the first ``PREFIX`` characters and a hash of the rest, so what the
  driver gets for them is small however long the texts are, and a common heading does not
  unbalance the partitions.
* A text that holds more rows than a partition should is dealt over several partitions by a salt.
  Each part yields one row that stands for it, and only these are compared again, in full.

Null texts count as empty. Rows equal in text and id are copies too: one of them stays, and which
of two indistinguishable rows has no effect. The null id is smaller than any other. An empty table
gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.base import identifier, partitions, restored, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX = 48


def normalised(text: str) -> Column:
    """Lower-case A-Z only; null is empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep`` is ``smallest`` or ``largest``: which id of a group stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    spark = docs.sparkSession
    best = F.max if keep == "largest" else F.min
    first = F.col("_id").desc() if keep == "largest" else F.col("_id").asc()
    rows = docs.select(identifier(id_col).alias("_id"), normalised(text_col).alias("_text")).withColumn(
        "_hash", F.xxhash64("_text")
    )
    parts = partitions(spark)
    # Texts that hold more than half of a partition's fair share of rows: fewer than 2 x parts.
    counts = rows.groupBy("_hash").agg(F.count("*").alias("_n"))
    fair = F.greatest(F.lit(2), F.ceil(F.lit(docs.count() / parts / 2)))
    hot = counts.filter(F.col("_n") > fair).select("_hash", F.ceil(F.col("_n") / fair).alias("_salts"))
    dealt = rows.join(F.broadcast(hot), "_hash", "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_salts")), F.lit(-1))
    )
    key = ["_prefix", "_hash", "_salt"]
    ranged = dealt.select(
        "_id", "_text", F.substring("_text", 1, PREFIX).alias("_prefix"), "_hash", "_salt"
    ).repartitionByRange(parts, *key)
    # Equal texts are neighbours in this order; a new text begins where a full comparison differs.
    equal = Window.partitionBy(*key, "_text").orderBy(first)
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = ranged.select(
        "_id",
        F.first("_id").over(whole).alias("_best"),
        F.count("*").over(whole).alias("_size"),
        F.row_number().over(equal).alias("_place"),
        F.sha2("_text", 256).alias("text_sha256"),
        # One text for each part of a split group, to compare the parts.
        F.when((F.col("_salt") >= 0) & (F.row_number().over(equal) == 1), F.col("_text")).alias("_part"),
    )
    compared = staged(compared)
    merged = (
        compared.filter("_part is not null")
        .groupBy("_part")
        .agg(
            best("_best").alias("_all_best"),
            F.sum("_size").alias("_all_size"),
            F.first("text_sha256").alias("text_sha256"),
        )
        .drop("_part")
    )
    result = compared.join(F.broadcast(merged), "text_sha256", "left")
    keep_id = F.coalesce("_all_best", "_best")
    # The row that stays is the first of its part; of a repeated id, one part has it, as ids choose the salt.
    return result.select(
        restored("_id").alias(id_col),
        F.when(keep_id != F.lit(-(2**63)), keep_id).alias("keep_id"),
        F.coalesce("_all_size", "_size").alias("group_size"),
        ((F.col("_id") == keep_id) & (F.col("_place") == 1)).alias("kept"),
        "text_sha256",
    )

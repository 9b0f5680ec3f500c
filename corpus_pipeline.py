"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read back
as the docs of the next one. All but the last return the columns of documents; other columns pass
through. Rows that share an id (or have none) stay or go together, but equal rows become one when
exact duplicates go. Null and empty texts have no language and go in the first stage; without any
document every stage gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import exact_dedup, language, near_dedup, packing, pseudonyms
from sediment.llm.base import identifier, prepare, staged, table

#: A real run passes a secret of its own.
PSEUDONYM_KEY = b"corpus pipeline"


def only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is one of those of ``chosen``; the null id is an id."""
    name = unused(docs, "_chosen_id")
    ids = chosen.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids[name]), "left_semi")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    prepare(spark)
    judged = language.languages_of(docs, F.col("lang"), F.col("source"), F.lit(None))
    return only(docs, judged.filter("kept"))


def unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until ``docs`` has no column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, that with the largest id stays."""
    prepare(spark)
    judged = exact_dedup.exact_duplicates(docs).filter("kept")
    key = [unused(docs, "_chosen_id"), unused(docs, "_chosen_text")]
    chosen = judged.select(identifier("doc_id").alias(key[0]), F.col("text_sha256").alias(key[1]))
    text = F.sha2(exact_dedup.normalised("text"), 256)
    keyed = docs.withColumns({key[0]: identifier("doc_id"), key[1]: text})
    return keyed.join(chosen, key, "left_semi").dropDuplicates(key).drop(*key)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by a similarity of 0.8 or more, that with the smallest id stays."""
    prepare(spark)
    judged = near_dedup.near_duplicates(docs, threshold=0.8)
    return only(docs, judged.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))))


def replace_personal_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Validated personal values become pseudonyms of the same format."""
    prepare(spark)
    changed = pseudonyms.pseudonymised(docs, PSEUDONYM_KEY)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, with the ids of every piece."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("language", identify_language),
    ("exact_duplicates", drop_exact_duplicates),
    ("near_duplicates", drop_near_duplicates),
    ("personal_values", replace_personal_values),
    ("packing", pack),
]
#: Language models, similarity and packing are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs

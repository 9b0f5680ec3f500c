"""The registered queries of the operators: whole tables, production parameters, digests of results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import byte_bpe, centroids, compression_quality, exact_dedup, language, line_quality, main_text, near_dedup, packing, prefix_trie, pseudonyms, substring_dedup, toxicity
from sediment.llm.base import table

#: Only for the registered queries; a real run passes a secret of its own.
QUERY_KEY = b"registered queries"

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over documents: the source is the host, the language column the declaration; there is no suffix."""
    docs = table(spark, sf_dir, "documents")
    return language.languages_of(docs, F.col("lang"), F.col("source"), F.lit(None))


@register
def language_id_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over pages, with all three kinds of evidence."""
    pages = table(spark, sf_dir, "pages")
    pages = pages.select("page_id", language.page_text("html").alias("text"), language.host_of("url").alias("host"), language.markup_language("html").alias("declared"))
    return language.languages_of(pages, F.col("declared"), F.col("host"), language.suffix_of(F.col("host")), "page_id")


@register
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@register
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"), window=20)
    return judged.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("features")


@register
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8)


@register
def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.personal_values(table(spark, sf_dir, "documents"), QUERY_KEY)


@register
def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_quality.line_quality(table(spark, sf_dir, "documents"))
    return judged.drop("kept_text")


@register
def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, end_id=0, capacity=2048, with_ids=False)


@register
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64)


def rebuilt_conversations(conversations: DataFrame) -> DataFrame:
    """Each conversation opens with up to five turns of the one whose id is the hundred at or below its own."""
    lender = F.col("conv") - F.col("conv") % 100
    length = (F.crc32(F.col("conv").cast("string").cast("binary")) % 6).cast("int")
    return prefix_trie.with_openings(prefix_trie.numbered(conversations), lender, length, most=5)


@register
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(rebuilt_conversations(table(spark, sf_dir, "conversations")))


@register
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(table(spark, sf_dir, "pages"))

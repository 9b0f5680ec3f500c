"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing columns, and no rows."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sediment.llm import (
    byte_bpe,
    compression_quality,
    exact_dedup,
    language,
    line_quality,
    near_dedup,
    packing,
    pseudonyms,
    substring_dedup,
    toxicity,
)
from sediment.llm.base import prepare

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept boolean, score double, ids string, _id string, _text string, label int, piece int"
)
EXTRA = (True, 0.5, "x", "y", "z", 1, 2)
ROWS = [
    (1, None, None, None, None, *EXTRA),
    (2, "", "en", "a", 0, *EXTRA),
    (3, " \n\t ", "en", "a", 4, *EXTRA),
    (4, "one two three", "en", "a", 13, *EXTRA),
    (4, "one two three", "en", "a", 13, *EXTRA),
    (5, "One TWO three", None, "b", 13, *EXTRA),
    (6, LONG, "en", "a", len(LONG), *EXTRA),
    (None, "a text that has no id at all, mail joe.1@example.com", "en", None, 50, *EXTRA),
    (None, None, "de", "b", None, *EXTRA),
    (7, "x" * 100_000, "de", "b", 100_000, *EXTRA),
    (8, "é日本😀   <|endoftext|>", "de", "b", 20, *EXTRA),
]
LABELS = [(4, 1, 0), (5, 0, 1), (6, 1, 0), (7, 0, 1), (None, 1, 1), (8, None, None), (4, 1, 0)]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def labels(docs):
    rows = LABELS if not docs.isEmpty() else []
    return docs.sparkSession.createDataFrame(rows, "doc_id long, quality int, toxic int")


OPERATORS = {
    "language": lambda d: language.languages_of(d, F.col("lang"), F.col("source"), F.lit(None)),
    "exact": exact_dedup.exact_duplicates,
    "substring": substring_dedup.repeated_passages,
    "toxicity": lambda d: toxicity.toxicity_scores(d, labels(d)),
    "near": near_dedup.near_duplicates,
    "personal": lambda d: pseudonyms.personal_values(d, b"key"),
    "lines": line_quality.line_quality,
    "pack": lambda d: packing.pack(d, JSON),
    "quality": lambda d: compression_quality.quality_scores(d, labels(d)),
    "bpe": lambda d: byte_bpe.decode(byte_bpe.encode(d, RANKS, public_tokenizers.PATTERN), RANKS),
}


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def by_id(df):
    out = {}
    for row in df.collect():
        out.setdefault(row["doc_id"], []).append(row)
    return out


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, name):
    prepare(spark)
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "pack"])
def test_one_result_for_each_row(odd, name):
    ids = sorted((r["doc_id"] for r in OPERATORS[name](odd).collect()), key=str)
    assert ids == sorted((r[0] for r in ROWS), key=str)


def test_language(odd):
    found = by_id(OPERATORS["language"](odd))
    assert all(not r["kept"] for i in (1, 2, 3) for r in found[i])
    assert all(r["language"] is None for r in found[1])
    assert found[4][0] == found[4][1]


def test_exact(odd):
    found = by_id(OPERATORS["exact"](odd))
    assert {(r["keep_id"], r["group_size"]) for i in (4, 5) for r in found[i]} == {(5, 3)}
    assert [r["kept"] for r in found[5]] == [True] and not any(r["kept"] for r in found[4])
    assert {(r["keep_id"], r["group_size"]) for i in (1, 2) for r in found[i]} == {(2, 3)}
    smallest = by_id(exact_dedup.exact_duplicates(odd, keep="smallest"))
    assert sorted(r["kept"] for r in smallest[4]) == [False, True]
    assert sorted(r["keep_id"] is None for r in smallest[None]) == [True, True]


def test_substring(odd):
    found = by_id(OPERATORS["substring"](odd))
    assert all((r["n_words"], r["n_removed"], r["kept_text"]) == (0, 0, "") for i in (1, 2, 3) for r in found[i])
    assert found[4][0] == found[4][1] and found[4][0]["n_removed"] == 0
    assert found[6][0]["n_words"] == 30_000


def test_scores(odd):
    for name in ("toxicity", "quality"):
        found = by_id(OPERATORS[name](odd))
        assert all(0 <= r["score"] <= 1 for rows in found.values() for r in rows)
        assert found[1][0]["score"] == found[2][0]["score"]
        assert found[4][0] == found[4][1]


def test_near(odd):
    found = by_id(OPERATORS["near"](odd))
    assert {(r["class_id"], r["n_links"], r["n_text_links"]) for i in (4, 5) for r in found[i]} == {(4, 2, 0)}
    assert all((r["class_id"], r["n_links"]) == (i, 0) for i in (1, 2, 3, 6, 7, 8) for r in found[i])


def test_personal(odd):
    found = by_id(OPERATORS["personal"](odd))
    assert found[1][0]["text"] is None and found[2][0]["text"] == ""
    assert found[6][0]["text"] == LONG
    assert sorted(r["n_values"] for r in found[None]) == [0, 1]


def test_lines(odd):
    found = by_id(OPERATORS["lines"](odd))
    assert all(r["base_failed"] and not r["kept"] and r["n_words"] == 0 for i in (1, 2, 3) for r in found[i])
    assert found[6][0]["n_words"] == 30_000 and found[7][0]["word_chars"] == 100_000


def test_pack(odd):
    found = by_id(OPERATORS["pack"](odd))
    assert [(r["length"], r["ids"]) for r in found[1]] == [(1, [0])]
    assert len(found[4]) == 2 and len({(r["sequence_id"], r["offset"]) for r in found[4]}) == 2
    assert [r["length"] for r in sorted(found[6], key=lambda r: r["piece"])][1:] == [2048] * (len(found[6]) - 1)
    none = by_id(packing.pack(odd, JSON, end_id=None, with_ids=False))
    assert 1 not in none and 4 in none


def test_bpe(odd):
    texts = {(r[0], r[1]) for r in ROWS}
    for i, rows in by_id(OPERATORS["bpe"](odd)).items():
        for row in rows:
            text = bytes(row["decoded"]).decode()
            assert (i, text) in texts or (not text and (i, None) in texts)


def test_pipeline(spark, odd, tmp_path):
    folder = str(tmp_path)
    odd.write.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in out} >= {5, 6} and not {1, 2, 3, 4} & {r["doc_id"] for r in out}
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").collect() == []
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns

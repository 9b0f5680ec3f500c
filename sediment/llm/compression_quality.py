"""Quality by compression: texts are compressed with a zstandard dictionary built from good labelled
text and with one built from bad labelled text; the normalised difference of the two sizes, put
through a logistic curve, is the score. The curve also has the compressed size itself, per byte: text
that only repeats itself compresses well with either dictionary.

The dictionaries come from a bounded sample: of at most ``FIT_ROWS`` labelled rows, four fifths give
the dictionaries and one fifth the curve. Of a label with more than ``DICTIONARY_TEXT`` bytes the
dictionary is trained on blocks chosen by a hash from all its texts, so that a text gives its share
only. Whole texts are scored, in blocks, so that a dictionary helps alike everywhere in a long text.

Null and empty texts compress to nothing: their score is the curve at no difference. Repeated rows
score alike; an empty table gives an empty result; without rows to learn from every score is 0.5.
Labels, language, source and id are no inputs of a score. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.base import identifier, restored
from sediment.llm.training import labelled, logistic, remainder

FIT_ROWS = 4000
DICTIONARY_TEXT = 4 << 20
DICTIONARY_BYTES = 110 << 10
BLOCK = 2048
LEVEL = 3


def blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


def chosen_blocks(fit: DataFrame) -> dict[int, list[bytes]]:
    """By label the blocks to train on: all, or as many as ``DICTIONARY_TEXT`` has room for, by a hash.

    The share is known from the bytes of each label, so that blocks are chosen where the texts are.
    """
    sizes = fit.groupBy("_label").agg(F.sum(F.octet_length("_text")).alias("n")).collect()  # two labels
    shares = {r["_label"]: min(1.0, DICTIONARY_TEXT / max(r["n"], 1)) for r in sizes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, id_, text in zip(*(batch.column(c).to_pylist() for c in ("_label", "_id", "_text")), strict=True):
                rows = [
                    (label, id_, place, block)
                    for place, block in enumerate(blocks(text.encode()))
                    if shares[label] == 1 or zlib.crc32(block, zlib.crc32(f"{id_}/{place}".encode())) < shares[label] * (1 << 32)
                ]
                if rows:
                    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.record_batch(columns, ["label", "id", "place", "block"])

    found = fit.select("_label", "_id", "_text").mapInArrow(run, "label int, id long, place long, block binary")
    rows = sorted(map(tuple, found.collect()), key=lambda r: (zlib.crc32(f"{r[1]}".encode()), *r))  # about DICTIONARY_TEXT
    return {label: [bytes(r[3]) for r in rows if r[0] == label] for label in (0, 1)}


def dictionary(parts: list[bytes]) -> bytes:
    """A trained dictionary; too little text for training is one as it stands."""
    size = min(DICTIONARY_BYTES, sum(map(len, parts)) // 8)
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(parts)[-DICTIONARY_BYTES:]


@cache
def compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def measures(text: bytes, good: bytes, bad: bytes) -> tuple[float, float]:
    """Per byte of text: how much smaller it gets with the good dictionary, and its size with that one."""
    parts = blocks(text)
    with_good = sum(len(compressor(good).compress(b)) for b in parts)
    with_bad = sum(len(compressor(bad).compress(b)) for b in parts)
    return (with_bad - with_good) / max(len(text), 1), with_good / max(len(text), 1)


def measured(rows: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """``rows`` with the two measures in the place of ``_text``."""
    both: Broadcast = rows.sparkSession.sparkContext.broadcast((good, bad))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [measures((t or "").encode(), *both.value) for t in batch.column("_text").to_pylist()]
            batch = batch.drop_columns(["_text"])
            for k, name in enumerate(("size_difference", "size_with_good")):
                batch = batch.append_column(name, pa.array([v[k] for v in values], pa.float64()))
            yield batch

    kept = rows.drop("_text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    return rows.select(*kept.columns, "_text").mapInArrow(
        run, schema + ", size_difference double, size_with_good double"
    )


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    modulus: int = 4,
    held_out: int = 2,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score``, ``predicted`` and the two measures."""
    rows = docs.select(identifier(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    sample = labelled(labels, label_col, modulus, held_out, FIT_ROWS, id_col)
    known = rows.join(F.broadcast(sample), "_id")
    parts = chosen_blocks(known.filter("_fold > 0"))
    good, bad = dictionary(parts[1]), dictionary(parts[0])
    curve = measured(known.filter("_fold = 0").select("_label", "_text"), good, bad).collect()  # at most FIT_ROWS
    features = np.array([[r.size_difference, r.size_with_good] for r in curve]).reshape(-1, 2)
    weights = [float(w) for w in logistic(features, np.array([r._label for r in curve], float))]
    scored = measured(rows, good, bad)
    sum_ = F.col("size_difference") * weights[0] + F.col("size_with_good") * weights[1] + weights[2]
    scored = scored.select(
        restored("_id").alias(id_col),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-sum_))).alias("score"),
        "size_difference",
        "size_with_good",
    )
    return scored.select(
        id_col,
        (remainder(id_col, modulus) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "size_difference",
        "size_with_good",
    )

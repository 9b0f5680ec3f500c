"""Toxicity by two Kneser-Ney language models, one of toxic and one of ordinary labelled text.

Each class has bigrams that back off to the class's words by the number of different words they
follow, and these to counts shared by both classes. What a context leaves to the backoff, and what is
known of its pairs where a class has few, is shared as well: an expression that a class has hardly
seen speaks for neither, however often copies of a document repeat it. A text's evidence is the difference of the two log-likelihoods, normalised by
length: over the whole text and over the most toxic stretch of a few lengths, so that a short
passage shows in a long text. A logistic curve, fitted to labelled rows that the models have not
seen, turns them into a score.

Words are A-Z lower-cased, without ASCII marks. The models are fitted on a sample of the labelled rows
that may be learnt from: at most about ``FIT_ROWS`` of them, chosen by a hash, and of these, if they
have more than ``FIT_BYTES`` of text, stretches of ``FIT_STRETCH`` words chosen by a hash over all of
them. The counts of the sample are tables keyed by the whole word and by the whole pair (64-bit hashes
of words): every word and pair has an entry of its own, also one seen once. An entry takes 12 bytes, so
the sample bounds what every task gets: under ``FIT_BYTES`` / 2 entries, as every word is at least one
byte and a space. Texts are scored where they are read; they are neither staged nor shuffled.

Null and empty texts have no evidence: their score is the curve at zero. Repeated rows score alike;
an empty table gives an empty result; without rows to learn from all scores are equal. Labels,
language, source and id are no inputs of a score. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.base import identifier, map_batches, restored, staged
from sediment.llm.training import labelled, logistic, remainder
from sediment.llm.words import BASE, Words, mix, raw, slices, words

FIT_ROWS, FIT_BYTES, FIT_STRETCH = 10_000, 32 << 20, 256
#: In the place of the word before: at the start of a text, and for a word alone.
BEGIN, ALONE = np.uint64(BASE >> 1), np.uint64(0)
DISCOUNT = 0.75
#: A toxic text that is missed counts as so many ordinary ones that are not: the curve is moved by its logarithm.
MISSED = 2.5
#: Each pair counts as seen so often more, by the classes' shares in its context.
SHARED_PAIRS = 2.0
STRETCHES = (1, 4, 16, 64)
#: Pairs counted together in a task before they are sent.
HELD = 1 << 20
MARKS = np.zeros(256, bool)
MARKS[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def plain_words(column: pa.Array) -> Words:
    """The words of the texts without marks at or between them; words of marks alone are left out."""
    data, offsets = raw(column)
    plain = np.where(MARKS[data], np.uint8(32), data)
    text = pa.Array.from_buffers(
        pa.large_string(), len(column), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(plain.tobytes())]
    )
    return words(text, lower=True)


def words_before(text: Words) -> np.ndarray:
    """For each word the word before it; ``BEGIN`` at the start of a text."""
    before = np.empty_like(text.hashes)
    before[1:] = text.hashes[:-1]
    before[text.bounds[:-1][text.counts > 0]] = BEGIN
    return before


def keys_of(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of the entry of a pair; of a word alone with ``ALONE`` before it."""
    return mix(before * np.uint64(BASE) + word)


def chosen(text: Words, ids: np.ndarray, share: float) -> np.ndarray:
    """Which words lie in a stretch of their text that is chosen by a hash, about ``share`` of all."""
    if share >= 1:
        return np.ones(len(text.hashes), bool)
    of = text.texts()
    stretch = (np.arange(len(of)) - text.bounds[:-1][of]) // FIT_STRETCH
    return mix(mix(ids[of].view(np.uint64)) + stretch.astype(np.uint64)) < np.uint64(int(share * 2**64))


def counted_pairs(rows: DataFrame, share: float = 1.0) -> DataFrame:
    """(``before``, ``word``, ``n0``, ``n1``): how often each pair occurs in ordinary and in toxic rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def send() -> pa.RecordBatch:
            before, word, label = map(np.concatenate, zip(*held, strict=True))
            _, first, which = np.unique(keys_of(before, word), return_index=True, return_inverse=True)
            toxic = np.bincount(which, weights=label).astype(np.int64)
            columns = [before[first].view(np.int64), word[first].view(np.int64), np.bincount(which) - toxic, toxic]
            return pa.record_batch(list(map(pa.array, columns)), ["before", "word", "n0", "n1"])

        for batch in batches:
            labels, ids = batch.column("_label").to_numpy(), batch.column("_id").to_numpy()
            for begin, part in slices(batch.column("_text")):
                text = plain_words(part)
                there = chosen(text, ids[begin : begin + len(part)], share)
                label = labels[begin : begin + len(part)][text.texts()]
                held.append((words_before(text)[there], text.hashes[there], label[there]))
                size += int(there.sum())
                if size >= HELD:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    sent = rows.select("_id", "_label", "_text").mapInArrow(run, "before long, word long, n0 long, n1 long")
    return sent.groupBy("before", "word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


@dataclass
class Models:
    """The evidence of words and pairs: log P(word | before, toxic) - log P(word | before, ordinary)."""

    entries: DataFrame  # (before, word, evidence); a word's own has ALONE before it and holds for pairs without entry
    size: int
    unseen: float  # that of a word without entry


def fit_models(rows: DataFrame) -> Models:
    """The two models of labelled rows (``_id``, ``_label``, ``_text``).

    One job measures their text, one counts the pairs. From them come per word what it follows and per context what it
    precedes, and from these the evidence. What a context leaves to the words is the same for both
    classes, so that it cancels out where a pair has no entry: the word's own evidence is left.
    """
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    pair = staged(counted_pairs(rows, FIT_BYTES / size if size > FIT_BYTES else 1.0))
    both = F.col("n0") + F.col("n1")
    own = [F.col(n) * (1 - DISCOUNT / both) for n in ("n0", "n1")]
    follows = [F.sum((F.col(n) > 0).cast("long")).alias(a) for n, a in (("n0", "a0"), ("n1", "a1"))]
    word = staged(pair.groupBy("word").agg(*follows, F.count("*").alias("a")))
    contexts = pair.groupBy("before").agg(
        F.sum(own[0]).alias("u0"), F.sum(own[1]).alias("u1"), F.count("*").alias("types"), F.sum(both).alias("times")
    )
    contexts = staged(contexts)
    sums = [F.sum(c).alias(c) for c in ("a0", "a1", "a")]
    used = [F.sum((F.col(a) > 0).cast("long")).alias(p) for a, p in (("a0", "p0"), ("a1", "p1"))]
    total = word.agg(*sums, *used, F.count("*").alias("words")).first()
    total = {k: v or 0 for k, v in total.asDict().items()}
    # Shared counts: what a word follows in either class; one word stands for all without entry.
    shared = (F.col("a") + 0.5) / (total["a"] + 0.5 * (total["words"] + 1))
    left = [(DISCOUNT * total[f"p{c}"] + 1) / (total[f"a{c}"] + 1) for c in (0, 1)]
    alone = [F.greatest(F.col(f"a{c}") - DISCOUNT, F.lit(0.0)) / (total[f"a{c}"] + 1) + left[c] * shared for c in (0, 1)]
    rest = DISCOUNT * F.col("types") / F.col("times")
    share = [SHARED_PAIRS * (F.col(u) + 0.5) / (F.col("u0") + F.col("u1") + 1) for u in ("u0", "u1")]
    seen = [(1 - rest) * (own[c] + share[c]) / (F.col(f"u{c}") + share[c] * F.col("types")) for c in (0, 1)]

    def evidence(ordinary: Column, toxic: Column) -> Column:
        return (F.log(toxic) - F.log(ordinary)).cast("float").alias("evidence")

    words_alone = word.select(F.lit(int(ALONE)).cast("long").alias("before"), "word", evidence(*alone))
    joined = pair.join(contexts, "before").join(word, "word")
    pairs = joined.select("before", "word", evidence(*(seen[c] + rest * alone[c] for c in (0, 1))))
    unseen = float(np.log(left[1]) - np.log(left[0]))
    return Models(words_alone.unionByName(pairs), total["words"] + total["a"], unseen)


def table_of(models: Models) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and the evidence of each: as many as the bounded sample has words and pairs."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        before, word = (batch.column(c).to_numpy().view(np.uint64) for c in ("before", "word"))
        return pa.record_batch([pa.array(keys_of(before, word).view(np.int64)), batch.column("evidence")], ["key", "evidence"])

    entries = map_batches(models.entries, run, "key long, evidence float").toArrow()
    keys, values = entries["key"].to_numpy().view(np.uint64), entries["evidence"].to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of the wanted keys is, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def features(keys: np.ndarray, values: np.ndarray, unseen: float, column: pa.Array) -> np.ndarray:
    """Per text: mean evidence per word, and the largest mean over stretches of each length.

    A text shorter than a stretch counts as if filled with words without evidence.
    """
    text = plain_words(column)
    out = np.zeros((len(column), 1 + len(STRETCHES)))
    some = np.flatnonzero(text.counts > 0)
    if not len(some):
        return out
    evidence = np.full(len(text.hashes), unseen)
    at, there = found(keys, keys_of(words_before(text), text.hashes))
    evidence[there] = values[at[there]]
    others = np.flatnonzero(~there)
    at, there = found(keys, keys_of(np.full(len(others), ALONE), text.hashes[others]))
    evidence[others[there]] = values[at[there]]
    total = np.concatenate([[0.0], np.cumsum(evidence)])
    begin, end = text.bounds[:-1], text.bounds[1:]
    out[some, 0] = (total[end] - total[begin])[some] / text.counts[some]
    place, ends = np.arange(len(evidence)), text.ends()
    for k, width in enumerate(STRETCHES):
        best = (total[np.minimum(place + width, ends)] - total[place]) / width
        out[some, 1 + k] = np.maximum.reduceat(best, begin[some])
    return out


def with_features(rows: DataFrame, models: Models) -> DataFrame:
    """``features`` of the rows (``_id``, ``_text``) by ``_id``, where the texts are read."""
    table, unseen = rows.sparkSession.sparkContext.broadcast(table_of(models)), models.unseen

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [features(*table.value, unseen, part) for _, part in slices(batch.column("_text"))]
        values = np.vstack([np.zeros((0, 1 + len(STRETCHES))), *parts])
        return pa.record_batch([batch.column("_id"), pa.array(list(values), pa.list_(pa.float64()))], ["_id", "features"])

    return map_batches(rows.select("_id", "_text"), run, "_id long, features array<double>")


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    modulus: int = 5,
    held_out: int = 0,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score``, ``predicted`` and ``features``."""
    rows = docs.select(identifier(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    sample = labelled(labels, label_col, modulus, held_out, FIT_ROWS, id_col)
    models = fit_models(rows.join(F.broadcast(sample.filter("_fold > 0")), "_id"))
    described = staged(with_features(rows, models))
    curve = described.join(F.broadcast(sample.filter("_fold = 0")), "_id").toArrow()  # a fifth of FIT_ROWS
    fitted = np.array(curve["features"].to_pylist()).reshape(-1, 1 + len(STRETCHES))
    weights = [float(w) for w in logistic(fitted, curve["_label"].to_numpy().astype(float))]
    sum_ = F.lit(weights[-1] + float(np.log(MISSED)))
    for k, w in enumerate(weights[:-1]):
        sum_ = sum_ + F.get("features", F.lit(k)) * w
    scored = described.select(
        restored("_id").alias(id_col), (F.lit(1.0) / (F.lit(1.0) + F.exp(-sum_))).alias("score"), "features"
    )
    return scored.select(
        id_col,
        (remainder(id_col, modulus) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "features",
    )

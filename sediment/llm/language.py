"""Language by Bayesian evidence: the text's likelihood, the declared markup language, and a prior of
the host that is smoothed towards its address suffix, and that towards all hosts.

1. Likelihoods. Per language a distribution over hashed byte trigrams without digits, counted over all documents by
   their declared language (grouped sums of partial counts). "No language" is the uniform one, so
   noise that is unlike every language is not forced into one.
2. First opinion. Likelihood times a flat prior gives each document shares of the languages.
3. Evidence tables, by grouped aggregation of these shares over host, suffix and declared language:
   how reliably a declaration names a language, and the prior of each host.
4. Posterior. The three are multiplied; the best language is kept if it is probable enough.

Every declared language has a model and is an outcome, however rare it is. A declaration is a language
tag: its first subtag counts (``en`` of ``en-US`` and ``EN_gb``) if it has two letters or is one of ``LONG_CODES``;
anything else declares nothing. So there are at most 676 languages and those, whatever the rows hold, and
a model takes 256 KB in a task. Ties between languages go to the alphabetically first.

The trigrams of a text are not independent; beyond ``MOST_OBSERVATIONS`` more of them add nothing to what the
text says as a whole, so that a very long text in two languages can still be decided by its host.

Null and empty texts, and texts without letters, have no language and are rejected. A null or
unlisted declaration, host or suffix is no evidence (a null host has its suffix's prior). Repeated
rows are judged alike; rows that share an id but not the text are judged each for itself. An empty
table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.base import staged
from sediment.llm.words import LOWER, mix, raw, slices

BUCKET_BITS = 16
#: Trigrams overlap: so many count as one independent observation, and at most so many of these count.
OVERLAP = 3.0
MOST_OBSERVATIONS = 200.0
#: Weight of the level above, in documents, in a host's or suffix's prior.
SMOOTHING = 20.0
#: Prior share of documents without language.
NO_LANGUAGE = 0.001
#: Codes in use of languages that have none of two letters.
LONG_CODES = (
    "als", "arz", "ast", "azb", "bar", "bho", "ceb", "ckb", "dsb", "fil", "haw", "hmn", "hsb", "kab", "lmo", "mai",
    "min", "mzn", "nap", "nds", "new", "pms", "pnb", "sah", "scn", "szl", "tyv", "vec", "war", "wuu", "yue",
)
LETTER = re.compile(r"[^\W\d_]")


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams without digits of the lower-cased texts, and the bounds of each text's."""
    data, offsets = raw(column)
    low = LOWER[data].astype(np.uint64)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(len(column) + 1, np.int64)
    grams = low[:-2] | low[1:-1] << np.uint64(8) | low[2:] << np.uint64(16)
    digit = (low >= 48) & (low <= 57)
    inside = ~(digit[:-2] | digit[1:-1] | digit[2:])
    for back in (1, 2):
        cuts = offsets[1:-1] - back
        inside[cuts[(cuts >= 0) & (cuts < len(grams))]] = False
    buckets = (mix(grams) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(inside)])
    return buckets[inside], bounds[np.minimum(offsets, len(grams))]


def counted_trigrams(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """Counts by language and bucket over the rows (``_declared``, ``_text``)."""
    place = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            declared = np.array([place[d] for d in batch.column("_declared").to_pylist()], np.int64)
            for begin, part in slices(batch.column("_text")):
                buckets, bounds = trigrams(part)
                present, owner = np.unique(declared[begin : begin + len(part)], return_inverse=True)
                owner = np.repeat(owner, np.diff(bounds))
                size = len(present) << BUCKET_BITS
                some = np.bincount(owner << BUCKET_BITS | buckets, minlength=size).reshape(len(present), -1)
                for language, n in zip(present.tolist(), some, strict=True):
                    counts[language] = counts[language] + n if language in counts else n.copy()
        for language, n in counts.items():
            bucket = n.nonzero()[0]
            columns = [np.full_like(bucket, language), bucket, n[bucket]]
            yield pa.record_batch(list(map(pa.array, columns)), ["language", "bucket", "n"])

    sent = rows.filter(F.col("_declared").isin(languages)).select("_declared", "_text")
    sent = sent.mapInArrow(run, "language long, bucket long, n long")
    table = sent.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages x buckets
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    counts[table["language"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    return counts


def log_likelihoods(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """``rows`` with ``_text`` replaced by ``_likelihood``: per language, and for none at the end.

    The logarithms are of an average trigram times the number of observations; null without letters.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[float] | None] = []
            for _, part in slices(batch.column("_text")):
                buckets, bounds = trigrams(part)
                n = np.diff(bounds)
                logs = np.zeros((len(part), len(shared.value)))
                some = np.flatnonzero(n)
                if len(some):
                    for k, table in enumerate(shared.value):
                        logs[some, k] = np.add.reduceat(table[buckets], bounds[:-1][some])
                observed = np.minimum(n / OVERLAP, MOST_OBSERVATIONS)
                logs *= (observed / np.maximum(n, 1))[:, None]
                texts = part.to_pylist()
                out += [row if t and LETTER.search(t) else None for row, t in zip(logs.tolist(), texts, strict=True)]
            yield batch.drop_columns(["_text"]).append_column("_likelihood", pa.array(out, pa.list_(pa.float64())))

    kept = rows.drop("_text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema) + ", _likelihood array<double>"
    return rows.select(*kept.columns, "_text").mapInArrow(run, schema)


def softmax(logs: Column) -> Column:
    """Probabilities from logarithms; the largest is taken off first."""
    shifted = F.transform(F.array(logs), lambda x: F.transform(x, lambda y: F.exp(y - F.array_max(x))))[0]
    return F.transform(F.array(shifted), lambda x: F.transform(x, lambda y: y / sum_of(x)))[0]


def sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def smoothed(counts: list[str], total: Column, above: list[Column]) -> list[Column]:
    """Shares of the counts, as if ``SMOOTHING`` documents more had those of the level above."""
    return [(F.col(c) + SMOOTHING * a) / (total + SMOOTHING) for c, a in zip(counts, above, strict=True)]


def languages_of(
    docs: DataFrame,
    declared: Column,
    host: Column,
    suffix: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_probability: float = 0.5,
    long_codes: tuple[str, ...] = LONG_CODES,
) -> DataFrame:
    """One row per document: id, ``language``, ``probability``, ``kept`` and ``text_language``.

    ``declared``, ``host`` and ``suffix`` are expressions over ``docs``. ``language`` is null where no
    language is the most probable outcome; ``text_language`` is what the text alone says. Kept is a
    document whose language has at least ``least_probability``.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        language_code(declared, long_codes).alias("_declared"),
        host.cast("string").alias("_host"),
        suffix.cast("string").alias("_suffix"),
    )
    named = rows.filter("_declared is not null").select("_declared").distinct()
    languages = sorted(r[0] for r in named.collect())  # at most 676 and the long codes
    counts = counted_trigrams(rows, languages)
    size = 1 << BUCKET_BITS
    # Smoothed towards all languages together, and that towards the uniform distribution.
    all_ = (counts.sum(axis=0) + 1) / (counts.sum() + size)
    shares_of = (counts + 1000 * all_) / (counts.sum(axis=1, keepdims=True) + 1000)
    model = np.log(np.vstack([shares_of, np.full((1, size), 1 / size)])).astype(np.float32)
    described = log_likelihoods(rows, model)
    outcomes = len(languages) + 1
    flat = [float(np.log((1 - NO_LANGUAGE) / max(len(languages), 1)))] * len(languages) + [float(np.log(NO_LANGUAGE))]
    first = softmax(F.zip_with("_likelihood", F.array(*map(F.lit, flat)), lambda a, b: a + b))
    described = staged(described.withColumn("_first", first))

    # Expected numbers of documents of each outcome, by host, suffix and declaration.
    shares = [f"s{k}" for k in range(outcomes)]
    sums = [F.sum(F.coalesce(F.get("_first", F.lit(k)), F.lit(0.0))).alias(s) for k, s in enumerate(shares)]
    again = [F.sum(s).alias(s) for s in shares]
    table = staged(described.groupBy("_host", "_suffix", "_declared").agg(*sums))
    known = F.when(F.col("_declared").isin(languages), F.col("_declared"))
    # Reliability of declarations: languages x languages, with the diagonal favoured.
    reliable = {r["_d"]: r for r in table.groupBy(known.alias("_d")).agg(*again).collect() if r["_d"] is not None}
    per_language = [sum(reliable[d][s] for d in reliable) for s in shares]

    def says_of(declared: str, k: int) -> float:
        agrees = k < len(languages) and languages[k] == declared
        return float(np.log((reliable[declared][shares[k]] + 1 + 9 * agrees) / (per_language[k] + 9 + len(languages))))

    declaration = [(d, [says_of(d, k) for k in range(outcomes)]) for d in reliable]
    declaration = docs.sparkSession.createDataFrame(declaration, "_declared string, _says array<double>")
    whole = table.agg(*again).first()
    everything = sum(x or 0 for x in whole) or 1.0
    overall = [F.lit(float(((whole[k] or 0) + 1) / (everything + outcomes))) for k in range(outcomes)]
    total_of = sum((F.col(s) for s in shares[1:]), F.col(shares[0]))
    suffixes = table.filter("_suffix is not null").groupBy("_suffix").agg(*again)
    suffixes = suffixes.select("_suffix", F.array(*smoothed(shares, total_of, overall)).alias("_suffix_prior"))
    hosts = table.filter("_host is not null").groupBy("_host", "_suffix").agg(*again)
    hosts = hosts.join(suffixes, "_suffix", "left")
    above = [F.coalesce(F.get("_suffix_prior", F.lit(k)), o) for k, o in enumerate(overall)]
    hosts = hosts.select("_host", "_suffix", F.array(*smoothed(shares, total_of, above)).alias("_host_prior"))
    same = (F.col("d._host") == F.col("h._host")) & F.col("d._suffix").eqNullSafe(F.col("h._suffix"))
    joined = described.alias("d").join(hosts.alias("h"), same, "left").select("d.*", "_host_prior")
    joined = joined.join(suffixes, "_suffix", "left").join(F.broadcast(declaration), "_declared", "left")
    prior = F.coalesce("_host_prior", "_suffix_prior", F.array(*overall))
    nothing = F.array(*[F.lit(0.0)] * outcomes)
    evidence = F.zip_with(
        F.zip_with("_likelihood", prior, lambda a, p: a + F.log(p)), F.coalesce("_says", nothing), lambda a, b: a + b
    )
    result = joined.select("_id", "_first", softmax(evidence).alias("_posterior"))
    names = F.array(*[F.lit(x) for x in languages], F.lit(None).cast("string"))
    best, probability = F.array_position("_posterior", F.array_max("_posterior")), F.array_max("_posterior")
    result = result.select(
        F.col("_id").alias(id_col),
        F.get(names, (best - 1).cast("int")).alias("language"),
        probability.alias("probability"),
        F.get(names, (F.array_position("_first", F.array_max("_first")) - 1).cast("int")).alias("text_language"),
    )
    kept = F.col("language").isNotNull() & (F.col("probability") >= least_probability)
    return result.withColumn("kept", F.coalesce(kept, F.lit(False)))


def language_code(declared: Column, long_codes: tuple[str, ...] = LONG_CODES) -> Column:
    """The first subtag of a language tag, lower-cased; null if it is no language code."""
    first = F.lower(F.regexp_extract(F.trim(declared.cast("string")), "^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when((F.length(first) == 2) | first.isin(list(long_codes)), first)


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]+)$", 1)


def markup_language(html: str) -> Column:
    """The primary tag of the page's lang attribute; null if it has none."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    return F.when(found != "", F.lower(found))


def page_text(html: str) -> Column:
    """The text between the tags; scripts, styles and comments are left out."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"\s+", " "))

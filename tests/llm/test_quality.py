"""What the dictionaries of op9 are trained on."""

from __future__ import annotations

import random

from sediment.llm import compression_quality
from sediment.llm.base import prepare


def test_a_long_text_displaces_no_other(spark, monkeypatch):
    prepare(spark)
    seen, train = [], compression_quality.dictionary
    monkeypatch.setattr(compression_quality, "DICTIONARY_TEXT", 60_000)
    monkeypatch.setattr(compression_quality, "dictionary", lambda parts: seen.append(parts) or train(parts))
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(200):
        # One text in fifty is longer than the bound on its own.
        words = [f"d{i}w{rng.randrange(1000)}" for _ in range(20_000 if i % 50 < 2 else 150)]
        docs.append((i, " ".join(words)))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    assert compression_quality.quality_scores(docs, labels).count() == 200
    assert len(seen) == 2
    for parts in seen:
        assert 30_000 < sum(map(len, parts)) < 90_000
        names = {word[: word.index(b"w")] for part in parts for word in part.split()[1:-1] if b"w" in word}
        assert len(names) >= 5

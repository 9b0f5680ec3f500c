"""The Kneser-Ney models of op4 against plain Python: no word and no pair shares its place with another."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest

from sediment.llm import toxicity
from sediment.llm.base import prepare

D, SHARED = toxicity.DISCOUNT, toxicity.SHARED_PAIRS


def plain_evidence(rows):
    """(word | before) -> evidence, from dictionaries over all words and pairs."""
    n = collections.defaultdict(lambda: [0, 0])
    for label, text in rows:
        before = None
        for w in text.split():
            n[before, w][label] += 1
            before = w
    follows, contexts = collections.defaultdict(lambda: [0, 0, 0]), collections.defaultdict(lambda: [0, 0, 0, 0])
    for (v, w), both in n.items():
        follows[w][2] += 1
        contexts[v][2] += 1
        contexts[v][3] += sum(both)
        for c in (0, 1):
            follows[w][c] += both[c] > 0
            contexts[v][c] += both[c] * (1 - D / sum(both))
    total = [sum(f[k] for f in follows.values()) for k in range(3)]
    left = [(D * sum(f[c] > 0 for f in follows.values()) + 1) / (total[c] + 1) for c in (0, 1)]

    def alone(c, w):
        shared = (follows[w][2] + 0.5 if w in follows else 0.5) / (total[2] + 0.5 * (len(follows) + 1))
        return (max(follows[w][c] - D, 0) if w in follows else 0) / (total[c] + 1) + left[c] * shared

    def evidence(v, w):
        if (v, w) not in n:
            return math.log(alone(1, w)) - math.log(alone(0, w))
        used, types, times = contexts[v][:2], contexts[v][2], contexts[v][3]
        rest, p = D * types / times, []
        for c in (0, 1):
            share = SHARED * (used[c] + 0.5) / (sum(used) + 1)
            own = n[v, w][c] * (1 - D / sum(n[v, w]))
            p.append((1 - rest) * (own + share) / (used[c] + share * types) + rest * alone(c, w))
        return math.log(p[1]) - math.log(p[0])

    return evidence


@pytest.mark.parametrize("held", [1 << 20, 2000])
def test_every_word_and_pair_counts(spark, monkeypatch, held):
    prepare(spark)
    monkeypatch.setattr(toxicity, "HELD", held)
    rng = random.Random(8)
    # Far more rare words than 2**18 cells can hold apart, each in a single row.
    rows = [(i % 2, f"common {'bad' if i % 2 else 'good'} start " + " ".join(f"r{i}x{k}" for k in range(400))) for i in range(400)]
    asked = [(i, " ".join(rng.choice([f"r{i}x{rng.randrange(400)}", f"r{i}x7 r{i}x8", "common bad", f"new{i}"]) for _ in range(60))) for i in range(400)]
    asked += [(900, ""), (901, "start")]
    learnt = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_id long, _label int, _text string").repartition(3)
    models = toxicity.fit_models(learnt)
    assert models.size == models.entries.count()
    found = toxicity.with_features(spark.createDataFrame(asked, "_id long, _text string").repartition(3), models)
    found = {r["_id"]: r["features"] for r in found.collect()}
    evidence = plain_evidence(rows)
    assert found.keys() == {i for i, _ in asked}
    for i, text in asked:
        words = text.split()
        each = [evidence(v, w) for v, w in zip([None, *words], words)]
        wanted = [sum(each) / len(each) if each else 0]
        for width in toxicity.STRETCHES:
            wanted.append(max((sum(each[k : k + width]) / width for k in range(len(each))), default=0))
        assert np.allclose(found[i], wanted, rtol=1e-4, atol=1e-5)


def test_stretches_are_chosen_over_all_text(spark, monkeypatch):
    """A sample with too much text gives stretches of all its rows; long ones push none out."""
    prepare(spark)
    monkeypatch.setattr(toxicity, "FIT_BYTES", 200_000)
    rows = [(i, i % 2, " ".join(f"w{i}x{k}" for k in range(20_000 if i == 7 else 600))) for i in range(100)]
    learnt = spark.createDataFrame(rows, "_id long, _label int, _text string").repartition(3)
    models = toxicity.fit_models(learnt)
    words = models.entries.filter(f"before = {int(toxicity.ALONE)}").count()
    total = sum(len(r[2].split()) for r in rows)
    share = 200_000 / sum(len(r[2]) for r in rows)
    assert 0.6 * share * total < words < 1.4 * share * total
    assert words == models.entries.count() - words  # every pair once, as every word

"""The signature bytes by which op5 drops candidates."""

from __future__ import annotations

import random

import pyarrow as pa

from sediment.llm import near_dedup


def test_unrelated_long_texts_do_not_agree():
    texts = [" ".join(f"t{t}w{i}" for i in range(3000)) for t in range(20)]
    texts.append(texts[0].replace("w1500", "changed"))
    seen = []
    for batch in run_describe(pa.array(texts)):
        seen += [list(b) for b in batch.column("_brief").to_pylist()]
    share = [[sum(x == y for x, y in zip(a, b, strict=True)) / len(a) for b in seen] for a in seen]
    assert all(share[i][j] < 0.2 for i in range(20) for j in range(i))
    assert share[0][20] > 0.8


def run_describe(texts):
    """``describe`` over one batch, without Spark."""

    class Rows:
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run(iter([pa.record_batch([pa.array(range(len(texts))), texts], ["_id", "_text"])]))

    return near_dedup.describe(Rows(), 3)


def test_rows_without_id_and_with_shared_ids_link(spark):
    """Near copies link whatever their ids are; class and set are named by the smallest id in them."""
    rng = random.Random(4)
    pairs = []
    for k in range(40):
        words = [f"p{k}w{rng.randrange(10**6)}" for _ in range(80)]
        pairs.append((" ".join(words), " ".join([*words[:-1], "other"])))
    texts = [t for pair in pairs for t in pair]
    for ids in ([None] * 80, [7] * 80, [i // 3 for i in range(80)], [i if i % 2 else None for i in range(80)]):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
        rows = near_dedup.near_duplicates(df).collect()
        assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in rows) == sorted((i is not None, i or 0) for i in ids)
        assert [(r["n_links"], r["n_text_links"]) for r in rows] == [(1, 1)] * 80
        least = [min((i is not None, i or 0) for i in ids[k : k + 2]) for k in range(0, 80, 2) for _ in (0, 1)]
        assert sorted((r["class_id"] is not None, r["class_id"] or 0) for r in rows) == sorted(least)


def test_many_rows_without_id_and_copies(spark):
    texts = [f"text number {k} of many that have no id and no copy {k * k}" for k in range(2000)] + ["the same words in every row of this group"] * 500
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(4)
    links = [r["n_links"] for r in near_dedup.near_duplicates(df).collect()]
    assert sorted(links)[-500:] == [499] * 500 and sum(links) < 500 * 499 + 2000

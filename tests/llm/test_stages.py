"""The pipeline stage by stage against plain Python."""

from __future__ import annotations

import random

import public_tokenizers

import corpus_pipeline
from sediment.llm import byte_bpe, pseudonyms
from sediment.llm.base import prepare, staged
from test_results import shingles

WORDS = "the house garden people were with this thing under which summer water reading paper window table".split()


def test_pipeline_against_plain_python(spark):
    prepare(spark)
    rng = random.Random(9)
    texts = {i: " ".join(rng.choice(WORDS) for _ in range(60)) for i in range(40)}
    texts |= {40 + i: texts[i] for i in range(5)}  # exact copies
    texts |= {50 + i: texts[10 + i] + " changed" for i in range(5)}  # near copies
    texts |= {60 + i: f"{texts[i][::-1]} mail joe.{i}@example.com, card 4111 1111 1111 1111 05" for i in range(3)}
    texts |= {70: None, 71: "", 72: "12 34"}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    wanted = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    stages = dict(corpus_pipeline.STAGES)

    def check(name):
        nonlocal docs
        docs = staged(stages[name](spark, docs, ""))
        found = docs.collect()
        assert len(found) == len(wanted) and {r["doc_id"]: r["text"] for r in found} == wanted, name

    check("language")
    last = {t: i for i, t in sorted(wanted.items())}
    wanted = {i: t for t, i in last.items()}
    check("exact_duplicates")
    sets, label = {i: shingles(t) for i, t in wanted.items()}, {i: i for i in wanted}
    for _ in sets:
        for i, a in sets.items():
            label[i] = min(label[j] for j, b in sets.items() if len(a & b) >= 0.8 * len(a | b))
    wanted = {i: t for i, t in wanted.items() if label[i] == i}
    assert len(wanted) == 43
    check("near_duplicates")
    wanted = {i: pseudonyms.replaced(t, corpus_pipeline.PSEUDONYM_KEY)[0] for i, t in wanted.items()}
    check("personal_values")
    pieces = stages["packing"](spark, docs, "").collect()
    tokenizer = byte_bpe.encoder_of_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in wanted.items()}
    assert len(pieces) == len(ids) and {r["doc_id"]: list(r["ids"]) for r in pieces} == ids

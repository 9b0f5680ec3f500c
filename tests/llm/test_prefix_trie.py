"""The trie of conversations against plain Python, with pieces and shards small enough to be cut everywhere."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sediment.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, conv string, pos int, step string"


def ordered(rows):
    """{conv: [(role, text)]} by turn, then by the digest of role and text."""

    def place(row):
        digest = hashlib.sha256(f"{len(row[2])}:{row[2]}{row[3]}".encode()).digest()[:16]
        return (row[1] is not None, row[1] or 0, digest)

    rows = [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    return {c: [r[2:] for r in sorted((r for r in rows if r[0] == c), key=place)] for c in {r[0] for r in rows}}


def rebuilt(convs):
    found = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c / 100) * 100 if abs(c) < 2**50 else c - c % 100
        found[c] = convs.get(base, [])[:h] + turns[h:]
    return found


def plain(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for path in sorted(members, key=len, reverse=True):
        saved[path] = saved.get(path, 0) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        leaves[path] = leaves.get(path, 0) or 1
        if path:
            up = path[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[path]
            saved[up] = saved.get(up, 0) + saved[path]
    rows = []
    for path, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        hashed = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(found), len(path), parent, len(found), kids.get(path, 0), leaves[path], saved[path], hashed))
    return sorted(rows, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "b") for r in rows], SCHEMA).repartition(3)


def conversations(seed, n, depth):
    """Conversations that share openings of all lengths, whole copies and repeated turns among them."""
    rng = random.Random(seed)
    rows, past = [], [[]]
    for c in rng.sample(range(-150, 450), n):
        known = rng.choice(past)
        turns = known[: rng.randint(0, len(known))] + [(rng.choice("ua"), rng.choice(["x", "yy", "é", ""])) for _ in range(rng.randint(0, depth))]
        turns = (known if rng.random() < 0.3 else turns) or [("u", "x")]
        past.append(turns)
        rows += [(c, t, *x) for t, x in enumerate(turns)]
    return rows


@pytest.mark.parametrize("piece, shards, seed", [(64, 1, 1), (64, 5, 2), (2, 1, 3), (1, 3, 4), (3, 8, 5), (2, 8, 6)])
def test_against_plain(spark, monkeypatch, piece, shards, seed):
    monkeypatch.setattr(prefix_trie, "SHARDS", shards)
    monkeypatch.setattr(prefix_trie, "SLAB", 4)
    monkeypatch.setattr(prefix_trie, "ENDS", 2)
    rows = conversations(seed, 60, 9)
    steps = prefix_trie.rooted(prefix_trie.numbered(frame(spark, rows)))
    assert sorted(map(tuple, prefix_trie.prefix_trie(steps, piece).collect()), key=str) == plain(ordered(rows))


def test_copies_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARDS", 6)
    monkeypatch.setattr(prefix_trie, "ENDS", 3)
    rows = [(c, t, "u", "x" * t) for c in range(200) for t in range(3 + (c % 50 == 0))]
    steps = prefix_trie.rooted(prefix_trie.numbered(frame(spark, rows)))
    for piece in (3, 64):
        assert sorted(map(tuple, prefix_trie.prefix_trie(steps, piece).collect()), key=str) == plain(ordered(rows))


def test_rebuilt(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLAB", 4)
    rows = conversations(9, 200, 12)
    found = queries.rebuilt_conversations(frame(spark, rows))
    got = {}
    for r in found.filter("pos > 0").collect():
        got.setdefault(r["conv"], {})[r["pos"]] = bytes(r["step"])
    wanted = rebuilt(ordered(rows))
    assert {r["conv"] for r in found.filter("pos = 0").collect()} == wanted.keys()
    for c, turns in wanted.items():
        digests = [hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()[:16] for r, x in turns]
        assert got.get(c, {}) == {i + 1: d for i, d in enumerate(digests)}
    assert sorted(map(tuple, prefix_trie.prefix_trie(found, 3).collect()), key=str) == plain(wanted)


def test_odd_rows(spark):
    rows = [(None, 1, "u", "x"), (1, None, None, None), (1, None, "", ""), (1, 0, "u", None), (1, 0, "u", "z"), (1, 0, "u", "z")]
    rows += [(2, 5, None, ""), (2, 7, "", "L" * 100_000), (2**40, 0, "u", "1"), (-3, 0, "u1", ":"), (-4, 0, "u", "1:")]
    steps = prefix_trie.rooted(prefix_trie.numbered(frame(spark, rows)))
    assert sorted(map(tuple, prefix_trie.prefix_trie(steps).collect()), key=str) == plain(ordered(rows))


def test_no_rows(spark):
    for rows in ([], [(None, 1, "u", "x")]):
        steps = queries.rebuilt_conversations(frame(spark, rows))
        found = prefix_trie.prefix_trie(steps)
        assert found.collect() == [] and found.columns[0] == "conv_id"


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLAB", 64)
    rows = [(7, t, "u", "x") for t in range(700)] + [(c, t, "u", "x") for c in range(20, 30) for t in range(c)]
    steps = prefix_trie.rooted(prefix_trie.numbered(frame(spark, rows)))
    assert steps.agg(F.max("pos")).first()[0] == 700
    assert sorted(map(tuple, prefix_trie.prefix_trie(steps, 16).collect()), key=str) == plain(ordered(rows))

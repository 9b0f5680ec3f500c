"""Repeated passages by anchored window hashes, in the place of prefix-partitioned suffix trees.

No suffix is sorted and no tree is built. Of all equal windows the first in document order stays and
the words of the others go; touching or overlapping windows join to the maximal repeats. The windows
are dealt in two steps:

1. Anchors. Of the ``ANCHOR``-word phrases inside a window, the one with the smallest hash is
   the window's anchor, so equal windows have equal anchors whatever surrounds them. Anchors are an
   eighth of all phrases; the blocks of documents send each different one once. An anchor that
   occurs once in the corpus starts no shared passage, and its windows are not sent.
2. Windows. Only windows below a shared anchor are sent on, again once per block and window,
   with the smallest document that has it. A group of them is sorted, and equal windows are
   neighbours. Each block is told which of its windows are first somewhere else.

A passage in a third of all documents is so one message per block, never one per document; what a
task holds is one block of about ``BLOCK_BYTES`` of text or one group of messages. Words are compared
by 64-bit hashes, windows by 128-bit hashes of their words, also when a block is answered.

Null and empty texts have no words and lose none. Rows that share an id are judged as one document
(copies of a row get the same result); the null id precedes all others. An empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.base import identifier, partitions, restored
from sediment.llm.words import BASE, Words, slices, words

ANCHOR = 6
BLOCK_BYTES = 8 << 20
#: Text whose messages make up one group.
GROUP_BYTES = 256 << 20
TOP = np.uint64(2**64 - 1)
MESSAGE = "_group int, _block long, _h1 binary, _h2 binary, _doc binary"


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each run of ``width`` values; shorter at the end."""
    out, done = values.copy(), 1
    while done < width:
        step = min(done, width - done)
        out[:-step] = pick(out[:-step], out[step:])
        done += step
    return out


def anchors(text: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchor of the window from each word on, whether there is one, and which words begin an anchor."""
    phrase = min(ANCHOR, window)
    grams, inside = text.ngrams(phrase)
    grams[~inside] = TOP
    width = window - phrase + 1
    smallest = sliding(grams, width, np.minimum)
    whole = np.arange(len(grams)) + window <= text.ends()
    # A phrase is an anchor if it is the smallest of some whole window that holds it.
    largest = sliding(np.where(whole, smallest, np.uint64(0))[::-1], width, np.maximum)[::-1]
    return smallest, whole, inside & (largest == grams)


def window_hashes(text: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    first, _ = text.ngrams(window)
    second = Words(text.hashes ^ np.uint64(BASE), text.bounds).ngrams(window, seed=7)[0]
    return first, second


def hashed(column: pa.Array) -> Words:
    """The words of all texts of a block."""
    parts = [words(part) for _, part in slices(column)]
    bounds, at = [np.zeros(1, np.int64)], 0
    for part in parts:
        bounds.append(part.bounds[1:] + at)
        at += len(part.hashes)
    hashes = np.concatenate([p.hashes for p in parts]) if parts else np.zeros(0, np.uint64)
    return Words(hashes, np.concatenate(bounds))


def messages(block: int, groups: int, h1: np.ndarray, h2: np.ndarray, docs: np.ndarray) -> pa.Table:
    """One row per group: the block's values whose hash falls into it."""
    group = (h1 >> np.uint64(32)) % np.uint64(groups)
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(groups + 1, dtype=np.uint64))
    filled = [g for g in range(groups) if cuts[g] < cuts[g + 1]]
    picks = [order[cuts[g] : cuts[g + 1]] for g in filled]
    columns = [
        pa.array(filled, pa.int32()),
        pa.array([block] * len(filled), pa.int64()),
        *(pa.array([values[p].tobytes() if len(values) else b"" for p in picks], pa.binary()) for values in (h1, h2, docs)),
    ]
    return pa.table(columns, names=["_group", "_block", "_h1", "_h2", "_doc"])


def sent(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all messages one after the other, and the number of the message each is from."""
    blobs = column.to_pylist()
    numbers = np.repeat(np.arange(len(blobs)), [len(b) // 8 for b in blobs])
    return np.frombuffer(b"".join(blobs), kind), numbers


def distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order by the columns (the first counts most), and where in it a new value begins."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    return order, new


def repeated_passages(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``spans`` and ``kept_text``.

    A window is ``window`` consecutive words of one document. Removed is each word covered by a
    window whose words also start earlier (in a smaller id, or earlier in the same document), judged
    on the input. ``spans`` are the removed runs of words, [start, end); ``kept_text`` is the other
    words, joined by one space.
    """
    if window < 1:
        raise ValueError("window: at least one word")
    spark = docs.sparkSession
    rows = docs.select(identifier(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(size // BLOCK_BYTES + 1, partitions(spark))
    groups = max(size // GROUP_BYTES + 1, partitions(spark))
    blocked = rows.withColumn("_block", F.pmod(F.xxhash64("_id"), F.lit(blocks)))
    by_block = blocked.groupBy("_block")

    def send_anchors(table: pa.Table) -> pa.Table:
        text = hashed(table["_text"].combine_chunks() if table.num_rows else pa.array([], pa.string()))
        grams, _ = text.ngrams(min(ANCHOR, window))
        _, _, chosen = anchors(text, window)
        values, counts = np.unique(grams[chosen], return_counts=True)
        # The number of times only matters up to two.
        return messages(table["_block"][0].as_py(), groups, values, np.minimum(counts, 2).astype(np.uint64), values[:0])

    def shared_anchors(table: pa.Table) -> pa.Table:
        values, source = sent(table["_h1"], np.uint64)
        counts, _ = sent(table["_h2"], np.uint64)
        order, new = distinct(values)
        number = np.cumsum(new) - 1
        total = np.bincount(number, weights=counts[order].astype(float)) if len(order) else np.zeros(0)
        again = order[total[number] > 1] if len(order) else order
        return answers(table, values[again], values[:0], source[again])

    def answers(table: pa.Table, first: np.ndarray, second: np.ndarray, source: np.ndarray) -> pa.Table:
        order = np.argsort(source, kind="stable")
        cuts = np.searchsorted(source[order], np.arange(table.num_rows + 1))
        picks = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        found = [pa.array([v[p].tobytes() if len(v) else b"" for p in picks], pa.binary()) for v in (first, second)]
        told = pa.table([table["_block"].combine_chunks(), *found], names=["_block", "_h1", "_h2"])
        return told.filter(pa.array([len(p) > 0 for p in picks], pa.bool_()))

    def send_windows(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows or not told.num_rows:
            return messages(0, groups, *[np.zeros(0, np.uint64)] * 2, np.zeros(0, np.int64))
        text = hashed(table["_text"].combine_chunks())
        smallest, whole, _ = anchors(text, window)
        shared = np.unique(sent(told["_h1"], np.uint64)[0])
        at = np.minimum(np.searchsorted(shared, smallest), len(shared) - 1)
        below = np.flatnonzero(whole & (shared[at] == smallest))
        h1, h2 = (h[below] for h in window_hashes(text, window))
        owner = table["_id"].to_numpy()[text.texts()[below]]
        order, new = distinct(h1, h2, owner)
        # Sorted by owner within a window, the first is the smallest.
        order = order[new]
        _, first = distinct(h1[order], h2[order])
        keep = order[first]
        return messages(table["_block"][0].as_py(), groups, h1[keep], h2[keep], owner[keep])

    def first_elsewhere(table: pa.Table) -> pa.Table:
        h1, source = sent(table["_h1"], np.uint64)
        h2 = sent(table["_h2"], np.uint64)[0]
        owner, _ = sent(table["_doc"], np.int64)
        order = np.lexsort((owner, h2, h1))
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        later = order[~new]
        return answers(table, h1[later], h2[later], source[later])

    def remove(table: pa.Table, told: pa.Table) -> pa.Table:
        names = ["_id", "n_words", "n_removed", "spans", "kept_text"]
        schema = pa.schema(
            zip(names, [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string()], strict=True)
        )
        if not table.num_rows:
            return schema.empty_table()
        column = table["_text"].combine_chunks()
        text = hashed(column)
        owners = table["_id"].to_numpy()
        h1, h2 = window_hashes(text, window)
        starts = np.flatnonzero(np.arange(len(h1)) + window <= text.ends())
        places = starts - text.bounds[:-1][text.texts()[starts]]
        a, b, owner = h1[starts], h2[starts], owners[text.texts()[starts]]
        # Not the first here: an equal window precedes it in document order. Copies of a row stand at the same place.
        gone = np.zeros(len(starts), bool)
        order = np.lexsort((places, owner, b, a))
        same = np.zeros(len(order), bool)
        if len(order):
            same[1:] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
            group = np.cumsum(~same) - 1
            lead = order[~same][group]
            gone[order] = same & ((owner[order] != owner[lead]) | (places[order] != places[lead]))
        if told.num_rows:
            first, second = (sent(told[name], np.uint64)[0] for name in ("_h1", "_h2"))
            order = np.argsort(first)
            first, second = np.append(first[order], TOP), np.append(second[order], TOP)
            at = np.searchsorted(first[:-1], a)
            # More than one step only where windows share the first half of their hash.
            left = np.flatnonzero((at < len(order)) & (first[at] == a))
            while len(left):
                gone[left] |= second[at[left]] == b[left]
                at[left] += 1
                left = left[(at[left] < len(order)) & (first[at[left]] == a[left])]
        cover = np.zeros(len(text.hashes) + 1, np.int64)
        np.add.at(cover, starts[gone], 1)
        np.add.at(cover, starts[gone] + window, -1)
        dead = np.cumsum(cover[:-1]) > 0
        removed = np.concatenate([[0], np.cumsum(dead)])
        spans, kept = [], []
        for i, one in enumerate(column.to_pylist()):
            begin, end = int(text.bounds[i]), int(text.bounds[i + 1])
            pieces = one.encode().split()
            if removed[end] == removed[begin]:
                spans.append([])
            else:
                mask = dead[begin:end]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                spans.append(edges.reshape(-1, 2).tolist())
                pieces = [pieces[j] for j in np.flatnonzero(~mask)]
            kept.append(b" ".join(pieces).decode())
        columns = [
            table["_id"].combine_chunks(),
            pa.array(text.counts),
            pa.array(removed[text.bounds[1:]] - removed[text.bounds[:-1]]),
            pa.array(spans, schema.field("spans").type),
            pa.array(kept, pa.string()),
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    told = "_block long, _h1 binary, _h2 binary"
    anchors_sent = by_block.applyInArrow(send_anchors, MESSAGE)
    anchors_told = anchors_sent.groupBy("_group").applyInArrow(shared_anchors, told)
    windows_sent = by_block.cogroup(anchors_told.groupBy("_block")).applyInArrow(send_windows, MESSAGE)
    windows_told = windows_sent.groupBy("_group").applyInArrow(first_elsewhere, told)
    result = by_block.cogroup(windows_told.groupBy("_block")).applyInArrow(
        remove, "_id long, n_words long, n_removed long, spans array<array<long>>, kept_text string"
    )
    return result.select(restored("_id").alias(id_col), "n_words", "n_removed", "spans", "kept_text")

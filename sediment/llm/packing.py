"""Packing token sequences by linear grouping, then best fit.

Where each piece goes depends only on how many pieces there are of each length, so the plan is made
from that histogram (at most ``capacity`` numbers) and is as large for ten documents as for 10**12:

1. Large lengths (over ``capacity / small_part``) are sorted and cut into groups of equal cardinality;
   in each group the lengths count as the largest of the group.
2. Configurations of these few sizes that fill a sequence are built one after the other, each the
   fullest that the remaining pieces allow (a knapsack over at most ``GROUPS`` sizes), and used as
   often as the pieces last.
3. The actual pieces are put in place of the rounded ones. A piece is a rank among the pieces of its
   length, so a run of equal sequences is one entry of the plan.
4. Small pieces go, largest first, where they leave the least room; what fits nowhere opens sequences.

Documents are then dealt their rank within a length by a count per part of the data, never by
bringing the pieces of one length together.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.base import identifier, restored, staged
from sediment.llm.byte_bpe import part_encoder

GROUPS = 256
#: Lengths over the capacity divided by one of these count as large; the plan with the fewest sequences is used.
SMALL_PARTS = (2, 3, 4)


def length_groups(histogram: np.ndarray, least: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of about equal cardinality of the lengths from ``least`` on, longest first.

    Each is its rounded size and its (length, count) runs; a length can be in several groups.
    """
    lengths = [n for n in range(len(histogram) - 1, least - 1, -1) if histogram[n]]
    total = int(sum(histogram[n] for n in lengths))
    groups: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length in lengths:
        left = int(histogram[length])
        while left:
            if not room:
                room = -(-total // GROUPS)
                groups.append((length, []))
            used = min(left, room)
            groups[-1][1].append((length, used))
            left, room = left - used, room - used
    return groups


def fullest(sizes: list[int], counts: list[int], capacity: int) -> list[int]:
    """How many of each size, at most ``counts``, fill a sequence best; with the largest size left."""
    first = next(i for i, n in enumerate(counts) if n)
    chosen: dict[int, tuple[int, ...]] = {sizes[first]: ()}
    used = {sizes[first]: {first: 1}}
    for i in range(first, len(sizes)):
        for filled in sorted(chosen, reverse=True):
            taken = used[filled]
            for k in range(1, counts[i] - taken.get(i, 0) + 1):
                now = filled + k * sizes[i]
                if now > capacity:
                    break
                if now not in chosen:
                    chosen[now] = ()
                    used[now] = taken | {i: taken.get(i, 0) + k}
    best = used[max(used)]
    return [best.get(i, 0) for i in range(len(sizes))]


class Plan:
    """Entries (length, first rank, count, first sequence, offset): the piece of rank ``first + i``
    lies at ``offset`` in sequence ``first sequence + i``."""

    def __init__(self, histogram: np.ndarray, small_part: int) -> None:
        self.capacity = len(histogram) - 1
        self.entries: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.given = [0] * len(histogram)
        self.room: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []
        least = self.capacity // small_part + 1
        self._large(length_groups(histogram, least))
        for length in range(min(least - 1, self.capacity), 0, -1):
            self._small(length, int(histogram[length]))

    def _open(self, room: int, first: int, count: int) -> None:
        if room not in self.room:
            self.room[room] = []
            bisect.insort(self.rooms, room)
        self.room[room].append((first, count))

    def _put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.entries.append((length, self.given[length], count, sequence, offset))
        self.given[length] += count

    def _large(self, groups: list[tuple[int, list[tuple[int, int]]]]) -> None:
        sizes = [size for size, _ in groups]
        runs = [list(reversed(run)) for _, run in groups]
        counts = [sum(n for _, n in run) for _, run in groups]
        while any(counts):
            pattern = fullest(sizes, counts, self.capacity)
            times = min(n // p for n, p in zip(counts, pattern, strict=True) if p)
            counts = [n - p * times for n, p in zip(counts, pattern, strict=True)]
            # The actual pieces: as many equal sequences at a time as the runs of equal lengths allow.
            while times:
                actual: list[int] = []
                most = times
                for run, p in zip(runs, pattern, strict=True):
                    wanted: dict[int, int] = {}
                    at, left = len(run) - 1, run[-1][1] if run and p else 0
                    for _ in range(p):
                        if not left:
                            at -= 1
                            left = run[at][1]
                        actual.append(run[at][0])
                        wanted[at] = wanted.get(at, 0) + 1
                        left -= 1
                    for at, n in wanted.items():
                        most = min(most, run[at][1] // n)
                offset = 0
                for length in actual:
                    self._put(length, most, self.sequences, offset)
                    offset += length
                for run, p in zip(runs, pattern, strict=True):
                    self._take(run, p, most)
                self._open(self.capacity - offset, self.sequences, most)
                self.sequences += most
                times -= most

    @staticmethod
    def _take(run: list[tuple[int, int]], each: int, times: int) -> None:
        """Remove from a run what ``times`` sequences took, ``each`` by each, as they chose it."""
        chosen: dict[int, int] = {}
        at, left = len(run) - 1, run[-1][1] if run and each else 0
        for _ in range(each):
            if not left:
                at -= 1
                left = run[at][1]
            chosen[at] = chosen.get(at, 0) + 1
            left -= 1
        for at, n in chosen.items():
            run[at] = (run[at][0], run[at][1] - n * times)
        run[:] = [x for x in run if x[1]]

    def _small(self, length: int, count: int) -> None:
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                new = -(-count // (self.capacity // length))
                self._open(self.capacity, self.sequences, new)
                self.sequences += new
                continue
            room = self.rooms[at]
            first, bins = self.room[room].pop()
            if not self.room[room]:
                del self.room[room]
                self.rooms.pop(at)
            each = min(room // length, -(-count // bins))
            if count < bins:
                self._open(room, first + count, bins - count)
                bins = count
            elif each * bins > count:
                each = count // bins
            for i in range(each):
                self._put(length, bins, first, self.capacity - room + i * length)
            count -= each * bins
            self._open(room - each * length, first, bins)

    def arrays(self) -> dict[int, np.ndarray]:
        """By length the entries' first ranks, first sequences and offsets, by rank."""
        by_length: dict[int, list[tuple[int, int, int]]] = {}
        for length, rank, _, sequence, offset in self.entries:
            by_length.setdefault(length, []).append((rank, sequence, offset))
        return {length: np.array(entries, np.int64) for length, entries in by_length.items()}


def best_plan(histogram: np.ndarray) -> Plan:
    return min((Plan(histogram, part) for part in SMALL_PARTS), key=lambda plan: plan.sequences)


def pieces_of(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first of several may be shorter."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, first), *((start, capacity) for start in range(first, n_tokens, capacity))] if n_tokens else []


def tokenized(
    docs: DataFrame, tokenizer_path: str, end_id: int | None, capacity: int, id_col: str, text_col: str, with_ids: bool
) -> DataFrame:
    """The pieces of all documents, with their rank among those of their length in the same task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = part_encoder(tokenizer_path, None)
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            blobs = []
            for doc, encoded in zip(ids, encoder.encode_column(batch.column(1)), strict=True):
                encoded += end
                for number, (start, length) in enumerate(pieces_of(len(encoded) // 4, capacity)):
                    part = encoded[4 * start : 4 * (start + length)]
                    rows.append((doc, number, start, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
                    if with_ids:
                        blobs.append(np.frombuffer(part, "<i4"))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 7)]
            names = ["_id", "piece", "start", "length", "ids_crc32", "_task", "_local"]
            if with_ids:
                columns.append(pa.array(blobs, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names)

    schema = "_id long, piece long, start long, length long, ids_crc32 long, _task long, _local long"
    rows = docs.select(identifier(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int | None = 0,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``
    and, with ``with_ids``, ``ids``.

    A document is its token ids followed by ``end_id`` (no token more if that is None). Longer ones
    are cut into pieces of ``capacity``; the first piece is what remains. Null texts count as empty:
    with an end id they are a piece of one token, else they have no piece. Repeated rows are packed
    as separate documents; of equal lengths any order is allowed. An empty table gives no rows.
    Other columns of the input are not read.
    """
    spark = docs.sparkSession
    pieces = staged(tokenized(docs, tokenizer_path, end_id, capacity, id_col, text_col, with_ids))
    counts = pieces.groupBy("_task", "length").agg(F.count("*").alias("_n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # one row per length
        histogram[row.length] = row.n
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    places = spark.sparkContext.broadcast(best_plan(histogram).arrays())

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = batch.column("length").to_numpy()
        ranks = batch.column("_rank").to_numpy()
        sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            entries, mine = places.value[int(length)], lengths == length
            at = np.searchsorted(entries[:, 0], ranks[mine], "right") - 1
            sequences[mine] = entries[at, 1] + ranks[mine] - entries[at, 0]
            offsets[mine] = entries[at, 2]
        kept = batch.drop_columns(["_rank"])
        return kept.append_column("sequence_id", pa.array(sequences)).append_column("offset", pa.array(offsets))

    ranked = pieces.join(bases, ["_task", "length"]).select(
        "_id",
        F.col("piece").cast("int"),
        "start",
        "length",
        "ids_crc32",
        *(["ids"] if with_ids else []),
        (F.col("_base") + F.col("_local")).alias("_rank"),
    )
    schema = "_id long, piece int, start long, length long, ids_crc32 long"
    placed = ranked.mapInArrow(
        lambda batches: map(place, batches),
        schema + (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long",
    )
    return placed.select(restored("_id").alias(id_col), *placed.columns[1:])

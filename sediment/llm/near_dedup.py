"""Documents whose sets of five-word shingles have a Jaccard similarity of at least a threshold.

MinHash banding in the place of an LSH forest: a signature is dealt to ``TREES`` trees of at most
``DEPTH`` values. The depth at which documents meet follows from threshold and recall and is the same
for all; documents below the same node of that depth are candidates. Every link is verified on the
whole shingle sets.

No step brings a group's pairs out of a task, and none holds an unbounded group:

* Documents with the same set are one class and take part once, with their number.
* A node with more than ``CELL`` documents is dealt into parts, and each pair of parts is a cell of
  its own. Inside a cell candidates whose signatures agree too little are dropped (below
  ``threshold`` by six standard errors), the others leave as a spanning forest.
* The components of these forests are clusters. A cluster's sets meet in cells as above, where all
  its pairs are counted exactly; a cell yields counts per document and again a spanning forest.

Words are runs of other bytes than white space, A-Z lower-cased; shingles are compared by 64-bit
hashes. A text of fewer words than a shingle is one shingle; null and empty texts have none, link
to nothing and are classes of their own. Rows that share an id, or have none, are documents of their
own and link for themselves: where there are such rows, all get numbers for the time of the work, which
writes the texts once more. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.base import identifier, restored, sorted_runs, staged
from sediment.llm.components import components
from sediment.llm.words import BASE, mix, slices, words

SHINGLE = 5
TREES = 16
DEPTH = 4
CELL = 2048
#: Shingles in a part of a cluster, and those indexed at once while a cell's pairs are counted.
PART_VALUES = 8 << 20
TILE_VALUES = 4 << 20
SEEDS = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


def matched_depth(threshold: float, recall: float) -> int:
    """The longest prefix at which documents at the threshold meet with the recall; 1 if none does."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - threshold**depth) ** TREES < recall:
        depth -= 1
    return depth


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one after the other, and their bounds."""
    text = words(column, lower=True)
    grams, inside = text.ngrams(SHINGLE)
    short = np.flatnonzero((text.counts > 0) & (text.counts < SHINGLE))
    for i in short:
        begin, end = text.bounds[i], text.bounds[i + 1]
        whole = np.uint64(end - begin)
        for h in text.hashes[begin:end]:
            whole = np.uint64((int(whole) * BASE + int(h)) % (1 << 64))
        grams[begin], inside[begin] = whole, True
    bounds = np.searchsorted(np.flatnonzero(inside), text.bounds)
    values = grams[inside]
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        values[begin:end].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return values[new], kept[bounds]


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each set the smallest value under each of the signature's permutations."""
    out = np.zeros((len(bounds) - 1, len(SEEDS)), np.uint64)
    filled = np.diff(bounds) > 0
    if len(values):
        for k, seed in enumerate(SEEDS):
            out[filled, k] = np.minimum.reduceat(values * seed, bounds[:-1][filled])
    return out


def briefs(signature: np.ndarray) -> np.ndarray:
    """One byte per signature value; mixed first, since a minimum over many shingles has a small top byte."""
    return (mix(signature) >> np.uint64(56)).astype(np.uint8)


def tree_nodes(signature: np.ndarray, depth: int) -> np.ndarray:
    """The node of each document in each tree: a hash of the tree and the prefix."""
    node = np.tile(mix(np.arange(TREES, dtype=np.uint64) + np.uint64(99)), (len(signature), 1))
    for k in range(depth):
        node = mix(node * np.uint64(BASE) + signature[:, k::DEPTH][:, :TREES])
    return node


def describe(docs: DataFrame, depth: int) -> DataFrame:
    """Per document: the size and digest of its set, its nodes and one byte per signature value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in slices(batch.column(1)):
                values, bounds = shingle_sets(part)
                sums = [np.concatenate([[0], np.cumsum(mix(values ^ np.uint64(s)))]).astype(np.uint64) for s in (1, 2)]
                digests = [(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums]
                signature = signatures(values, bounds)
                nodes = tree_nodes(signature, depth).view(np.int64)
                brief = briefs(signature)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(begin, len(part)),
                        pa.array(np.diff(bounds)),
                        *map(pa.array, digests),
                        pa.FixedSizeListArray.from_arrays(pa.array(nodes.ravel()), TREES).cast(pa.list_(pa.int64())),
                        pa.array([row.tobytes() for row in brief], pa.binary()),
                    ],
                    ["_id", "_n", "_d1", "_d2", "_nodes", "_brief"],
                )

    rows = docs.select("_id", "_text")
    return rows.mapInArrow(run, "_id long, _n long, _d1 long, _d2 long, _nodes array<long>, _brief binary")


def in_cells(rows: DataFrame, group: str, member: str, sizes: DataFrame) -> DataFrame:
    """``rows`` of groups of at least two, each in every cell its part takes part in.

    ``sizes`` has the group, its ``_size`` and its number of shingles to be held (``_values``). Adds
    ``_cell``, ``_part`` and whether the cell pairs a part with itself (``_own``). A group of p parts
    has p (p + 1) / 2 cells; a part is in p of them.
    """
    parts = F.greatest(F.ceil(F.col("_size") / CELL), F.ceil(F.col("_values") / PART_VALUES)).cast("int")
    part = F.pmod(F.xxhash64(member), parts).cast("int")
    dealt = rows.join(sizes.filter("_size > 1"), group).withColumn("_parts", parts).withColumn("_part", part)
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    pair = F.struct(F.least("_part", "_other"), F.greatest("_part", "_other"))
    dealt = dealt.withColumn("_cell", F.xxhash64(group, pair)).withColumn("_own", F.col("_part") == F.col("_other"))
    return dealt.drop("_size", "_values", "_parts", "_other")


class Forest:
    """Spanning forest of the links seen, for numbers below ``size``."""

    def __init__(self, size: int) -> None:
        self.label = np.arange(size)
        self.edges: list[tuple[int, int]] = []

    def link(self, x: int, others: np.ndarray) -> None:
        """Link ``x`` to each of ``others``; at most ``size - 1`` calls in all change anything."""
        apart = others[self.label[others] != self.label[x]]
        while len(apart):
            self.edges.append((x, int(apart[0])))
            self.label[self.label == self.label[apart[0]]] = self.label[x]
            apart = apart[self.label[apart] != self.label[x]]


def alike(brief: np.ndarray, least: float, forest: Forest, left: np.ndarray, right: np.ndarray) -> None:
    """Link those of ``left`` and ``right`` whose signatures agree in at least a share ``least``."""
    step = max(1, (1 << 22) // max(1, len(right) * brief.shape[1]))
    for begin in range(0, len(left), step):
        rows = left[begin : begin + step]
        agreed = (brief[rows][:, None, :] == brief[right][None, :, :]).mean(axis=2) >= least
        for i, linked in zip(rows, agreed, strict=True):
            forest.link(int(i), right[linked])


def candidate_edges(cells: DataFrame, least: float) -> DataFrame:
    """A spanning forest of the candidates of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for table in sorted_runs(batches, "_cell"):
            if table.num_rows < 2:
                continue
            ids, part = table["_id"].to_pylist(), table["_part"].to_numpy()
            brief = np.frombuffer(b"".join(table["_brief"].to_pylist()), np.uint8).reshape(len(ids), -1)
            forest = Forest(len(ids))
            own = table["_own"][0].as_py()
            left = np.arange(len(ids)) if own else np.flatnonzero(part == part.min())
            right = left if own else np.flatnonzero(part != part.min())
            alike(brief, least, forest, left, right)
            out += [(ids[x], ids[y]) for x, y in forest.edges]
            if len(out) > 10_000:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])
                out = []
        if out:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    ordered = cells.select("_cell", "_own", "_part", "_id", "_brief").repartition("_cell").sortWithinPartitions("_cell")
    return ordered.mapInArrow(run, "a long, b long")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each of ``left`` how many shingles it shares with each of ``right``.

    ``right`` is indexed once: its shingles in order, each with its owner, so one of ``left`` looks
    its own up and counts the owners.
    """
    values = np.concatenate([sets[j] for j in right])
    owners = np.repeat(np.arange(len(right)), [len(sets[j]) for j in right])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    for i in left:
        begin = np.searchsorted(values, sets[i], "left")
        count = np.searchsorted(values, sets[i], "right") - begin
        some = count > 0
        begin, count = begin[some], count[some]
        ends = np.cumsum(count)
        places = np.repeat(begin - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        yield int(i), np.bincount(owners[places], minlength=len(right))


def verified(cells: DataFrame, threshold: float) -> DataFrame:
    """From the sets of each cluster's cells: links per document, and a spanning forest of them.

    A row is (``a``, null, number of linked documents, number of linked sets) or an edge (``a``, ``b``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_runs(batches, "_cell"):
            if table.num_rows < 2:
                continue
            ids, part = table["_id"].to_pylist(), table["_part"].to_numpy()
            copies = table["_copies"].to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in table["_set"].to_pylist()]
            sizes = np.array([len(s) for s in sets])
            own = table["_own"][0].as_py()
            left = np.arange(len(ids)) if own else np.flatnonzero(part == part.min())
            right = left if own else np.flatnonzero(part != part.min())
            if not len(left) or not len(right):
                continue
            documents, texts, forest = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), Forest(len(ids))
            # The right side in tiles of bounded size.
            tile = np.cumsum(sizes[right]) // TILE_VALUES
            for number in np.unique(tile):
                some = right[tile == number]
                for i, shared in overlaps(sets, left, some):
                    linked = shared >= threshold * (sizes[i] + sizes[some] - shared) - 1e-9
                    linked &= some != i
                    documents[i] += copies[some[linked]].sum()
                    texts[i] += linked.sum()
                    if not own:
                        documents[some[linked]] += copies[i]
                        texts[some[linked]] += 1
                    forest.link(i, some[linked])
            linked = np.flatnonzero(texts)
            rows = [(ids[i], None, int(documents[i]), int(texts[i])) for i in linked]
            rows += [(ids[x], ids[y], 0, 0) for x, y in forest.edges]
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.record_batch(columns, ["a", "b", "n_documents", "n_texts"])

    ordered = cells.select("_cell", "_own", "_part", "_id", "_copies", "_set")
    ordered = ordered.repartition("_cell").sortWithinPartitions("_cell")
    return ordered.mapInArrow(run, "a long, b long, n_documents long, n_texts long")


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``class_id``, ``set_id``, ``n_links``, ``n_text_links``.

    ``class_id`` is the smallest id of the documents that links join, ``set_id`` the smallest id with
    the same shingle set, ``n_links`` the number of other documents at or above the threshold (copies
    included) and ``n_text_links`` the number of different sets among them, its own left out.
    """
    rows = docs.select(identifier(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    if rows.groupBy("_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        found = linked(rows, threshold, recall)
    else:
        numbered = staged(rows.select(F.monotonically_increasing_id().alias("_row"), "_id", "_text"))
        found = staged(linked(numbered.select(F.col("_row").alias("_id"), "_text"), threshold, recall))
        found = found.withColumnRenamed("_id", "_row").join(numbered.select("_row", "_id"), "_row")
        for group in ("_class", "_set"):
            least = found.groupBy(group).agg(F.min("_id").alias("_least"))
            found = found.join(least, group).withColumn(group, F.col("_least")).drop("_least")
    return found.select(
        restored("_id").alias(id_col),
        restored("_class").alias("class_id"),
        restored("_set").alias("set_id"),
        "n_links",
        "n_text_links",
    )


def linked(rows: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(``_id``, ``_class``, ``_set``, ``n_links``, ``n_text_links``) of rows (``_id``, ``_text``) with different ids."""
    depth = matched_depth(threshold, recall)
    described = staged(describe(rows, depth))
    key = ["_d1", "_d2", "_n"]
    filled = described.filter("_n > 0")
    classes = staged(
        filled.groupBy(*key).agg(
            F.min("_id").alias("_set_id"),
            F.count("*").alias("_copies"),
            F.first("_nodes").alias("_nodes"),
            F.first("_brief").alias("_brief"),
        )
    )
    # Narrow rows first: only documents that share a node carry their signatures on.
    nodes = classes.select(F.col("_set_id").alias("_id"), F.explode("_nodes").alias("_node"))
    sizes = nodes.groupBy("_node").agg(F.count("*").alias("_size"), F.lit(0).alias("_values"))
    shared = in_cells(nodes, "_node", "_id", sizes)
    shared = shared.join(classes.select(F.col("_set_id").alias("_id"), "_brief"), "_id")
    error = (threshold * (1 - threshold) / (TREES * DEPTH)) ** 0.5
    edges = staged(candidate_edges(shared, threshold - 6 * error))
    clusters = staged(components(edges).withColumnRenamed("node", "_id"))
    members = clusters.join(classes.select(F.col("_set_id").alias("_id"), "_copies", "_n"), "_id")
    cluster_sizes = members.groupBy("label").agg(F.count("*").alias("_size"), F.sum("_n").alias("_values"))

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in slices(batch.column("_text")):
                values, bounds = shingle_sets(part)
                sets = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                chosen = batch.slice(begin, len(part)).drop_columns(["_text"])
                yield chosen.append_column("_set", pa.array(sets, pa.binary()))

    # One row per set.
    texts = rows.join(members.dropDuplicates(["_id"]), "_id")
    sets = texts.select("_id", "label", "_copies", "_text").mapInArrow(
        with_sets, "_id long, label long, _copies long, _set binary"
    )
    found = staged(verified(in_cells(sets, "label", "_id", cluster_sizes), threshold))
    links = found.filter("b is null").groupBy(F.col("a").alias("_set_id")).agg(
        F.sum("n_documents").alias("_documents"), F.sum("n_texts").alias("_texts")
    )
    labels = components(found.filter("b is not null").select("a", "b"))
    joined = classes.select(*key, "_set_id", "_copies").join(links, "_set_id", "left")
    joined = joined.join(labels.select(F.col("node").alias("_set_id"), "label"), "_set_id", "left")
    result = described.select("_id", *key).join(joined, key, "left")
    own = F.coalesce("_set_id", "_id")
    return result.select(
        "_id",
        F.coalesce("label", own).alias("_class"),
        own.alias("_set"),
        (F.coalesce("_documents", F.lit(0)) + F.coalesce(F.col("_copies") - 1, F.lit(0))).alias("n_links"),
        F.coalesce("_texts", F.lit(0)).alias("n_text_links"),
    )

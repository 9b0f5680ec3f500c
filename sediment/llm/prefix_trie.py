"""The trie of what conversations have in common from their first turn on, over range-partitioned paths.

A turn becomes a 16-byte digest of role and text, and a conversation the path of its digests. Paths
are cut into pieces of ``PIECE`` turns, so that no row grows with a conversation; pieces under the same
earlier turns form a trie of their own, and the tries hang together by hashes of those turns.

Pieces are range-partitioned by sampled splitters. The splitters' paths are broadcast: the nodes on
them, the skeleton, are all that can reach into a second shard. Each shard is sorted and finishes every
other node by itself while it reads the rows once, with the open path as its only state. Of skeleton
nodes a shard gives partial counts and sums, and a grouped aggregate adds them up. What must count
once (a node as such, as a child, as a leaf) is counted by the last shard a node reaches into, which
the splitters next to a shard tell. What lies under the end of a piece is carried into it as a sum of
each conversation, so the number of jobs does not depend on the longest conversation.

Turns are ordered by turn number (null first), equal numbers by the digest of role and text. Null role
or text is empty. Rows without conversation id belong to none and are left out. Repeated rows are
repeated turns. Empty texts are turns like others. An empty table gives no node, not even the root.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.base import partitions, prepare, staged

#: Turns in a piece of a path, bytes of a turn's digest, and ids in one row of a list of ends.
PIECE = 64
STEP = 16
ENDS = 4096
#: Rows of a conversation that are handled together where its rows must meet something of the conversation.
SLAB = 1 << 16
#: Shards of each shuffle partition, and rows sampled of each shard to place the splitters.
SHARDS, SAMPLED = 4, 16


def numbered(conversations: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(``conv``, ``pos``, ``step``, ``chars``): the turns with their place, 1 and up, digest and length.

    A conversation may be longer than a task can take: rows are dealt by ranges of (conversation,
    turn), numbered within each range, and moved on by what earlier ranges hold of the conversation.
    """
    prepare(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.substring(F.unhex(digest), 1, STEP).alias("step"),
        F.length(text).alias("chars"),
        F.rand(11).alias("tie"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("step")]
    dealt = turns.repartitionByRange(partitions(turns.sparkSession), "conv", *order, "tie")
    dealt = staged(dealt.select("conv", "turn", "step", "chars", F.spark_partition_id().alias("range")))
    local = F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order))
    counts = dealt.groupBy("conv", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # Of each range only the first conversation can have begun before it: one row a range at most.
    begun = counts.withColumn("before", F.sum("n").over(earlier)).filter("before > 0").select("conv", "range", "before")
    placed = dealt.withColumn("local", local).join(F.broadcast(begun), ["conv", "range"], "left")
    return placed.select("conv", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "step", "chars")


def with_openings(steps: DataFrame, lender: Column, length: Column, most: int) -> DataFrame:
    """``steps`` whose first turns are replaced by those of another conversation, for ``rooted``.

    ``lender`` and ``length`` are columns of ``conv``: whose first turns, and how many (``most`` at
    most; all if there are fewer, none if there is no such conversation). Of its own turns each
    conversation keeps those after as many. Every conversation has a row at place 0.
    """
    steps = staged(steps)
    head = F.array_sort(F.collect_list(F.struct("pos", "step", "chars")))
    heads = steps.filter(F.col("pos") <= most).groupBy(F.col("conv").alias("lender")).agg(head.alias("head"))
    convs = steps.groupBy("conv").agg(F.count("*").alias("n")).withColumn("lender", lender).withColumn("own", length)
    convs = convs.join(heads, "lender", "left")
    convs = convs.withColumn("head", F.when(F.col("own") > 0, F.slice("head", 1, F.greatest("own", F.lit(1)))))
    none = F.expr("cast(array() as array<struct<pos:bigint,step:binary,chars:int>>)")
    convs = staged(convs.withColumn("head", F.coalesce("head", none)))
    lent = convs.select("conv", F.explode("head").alias("h")).select("conv", "h.pos", "h.step", "h.chars")
    slabs = convs.select("conv", "own", F.size("head").alias("lent"), F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n div {SLAB}"))).alias("slab"))
    kept = steps.withColumn("slab", F.expr(f"pos div {SLAB}")).join(slabs, ["conv", "slab"]).filter("pos > own")
    kept = kept.select("conv", (F.col("pos") - F.col("own") + F.col("lent")).alias("pos"), "step", "chars")
    return lent.unionByName(kept).unionByName(_roots(convs))


def rooted(steps: DataFrame) -> DataFrame:
    """``steps`` with a row at place 0 for every conversation, for ``prefix_trie``."""
    return steps.unionByName(_roots(steps.select("conv").distinct()))


def _roots(convs: DataFrame) -> DataFrame:
    return convs.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("step"), F.lit(0).alias("chars"))


def running(df: DataFrame, key: str, order: Column, columns: list[str], total, both, slab: int) -> DataFrame:
    """``columns`` replaced by what ``total`` (an aggregate that ``both`` carries on) makes of the key's earlier rows.

    First by slabs of the order, then within each slab: no window holds a long key's rows together.
    """
    df = df.withColumn("_order", order).withColumn("_slab", F.floor(F.col("_order") / slab))
    sums = df.groupBy(key, "_slab").agg(*[total(c).alias(f"_{c}") for c in columns])
    before = Window.partitionBy(key).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(key, "_slab", *[F.coalesce(total(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in columns])
    within = Window.partitionBy(key, "_slab").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({c: F.coalesce(total(c).over(within), F.lit(0)) for c in columns})
    joined = local.join(sums, [key, "_slab"])
    return joined.withColumns({c: both(F.col(c), F.col(f"_{c}")) for c in columns}).drop("_order", "_slab", *[f"_{c}" for c in columns])


def pieces(steps: DataFrame, piece: int) -> DataFrame:
    """(``piece``, ``up``, ``path``, ``more``, ``conv``, ``chars``, ``down``): the paths, cut; ``more`` turns follow or not.

    ``up`` and ``down`` are hashes of all turns before and through a full piece; empty before the first
    one, and where no conversation is longer than a piece.
    """
    at = F.expr(f"CASE WHEN pos = 0 THEN 0L ELSE (pos - 1) div {piece} END")
    # The first turn of a piece also tells the piece before it that it is there.
    begins = F.array(at, at - 1)
    dealt = steps.withColumn("piece", F.explode(F.when((at > 0) & ((F.col("pos") - 1) % piece == 0), begins).otherwise(F.array(at))))
    beyond = F.col("pos") > (F.col("piece") + 1) * piece
    rows = dealt.groupBy("conv", "piece").agg(
        F.array_sort(F.collect_list(F.when(~beyond & (F.col("pos") > 0), F.struct("pos", "step", "chars")))).alias("turns"),
        F.max(beyond).alias("more"),
    )
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["step"])), ""))
    rows = rows.select("conv", "piece", path.alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars"), "more")
    rows = staged(rows)
    flat = rows.withColumns({"up": F.lit(b""), "down": F.lit(b"")})
    if not rows.filter("more").isEmpty():
        hashes = {f"h{i}": F.xxhash64("path", "piece", F.lit(i)) for i in (1, 2)}
        names = list(hashes)
        hashed = running(
            rows.withColumns(hashes).withColumns({f"own{i}": F.col(n) for i, n in enumerate(names)}),
            "conv", F.col("piece"), names, F.bit_xor, lambda a, b: a.bitwiseXOR(b), SLAB // piece + 1,
        )
        wide = lambda *cols: F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in cols]))
        up = F.when(F.col("piece") > 0, wide(*[F.col(n) for n in names])).otherwise(F.lit(b""))
        down = wide(*[F.col(n).bitwiseXOR(F.col(f"own{i}")) for i, n in enumerate(names)])
        flat = hashed.withColumns({"up": up, "down": F.when(F.size("chars") == piece, down).otherwise(F.lit(b""))})
    return flat.select("piece", "up", "path", "more", "conv", "chars", "down")


@dataclass
class Node:
    """An open node: what a shard has seen of it."""

    depth: int
    low: bool
    high: bool
    chars: int
    n: int = 0
    conv: int | None = None
    kids: int = 0
    any_kid: bool = False
    more: bool = False
    leaves: int = 0
    saved: int = 0
    key: bytes = b""
    ends: list[int] = field(default_factory=list)
    hashed: object = None
    waiting: list[dict] = field(default_factory=list)


OUT = (
    "key binary, parent_key binary, parent_conv long, conv long, depth long, piece long, n long, kids long, leaves long, "
    "saved long, own_leaf long, own_saved long, ends string, at long, chunk string"
)
NAMES = [c.split()[0] for c in OUT.split(", ")]
ARROW = pa.schema([(n, {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[t]) for n, t in (c.split() for c in OUT.split(", "))])
EMPTY = hashlib.sha256(b"").hexdigest()


def common(a: bytes, b: bytes) -> int:
    """Turns that two paths share."""
    n = min(len(a), len(b)) // STEP
    for i in range(n):
        if a[i * STEP : (i + 1) * STEP] != b[i * STEP : (i + 1) * STEP]:
            return i
    return n


class Shard:
    """Reads the sorted pieces of one shard; ``out`` fills with finished nodes and parts of skeleton nodes."""

    def __init__(self, low: tuple | None, high: tuple | None, piece: int, out: list[dict]):
        self.low, self.high, self.piece, self.out = low, high, piece, out
        self.group: tuple | None = None
        self.path = b""
        self.open: list[Node] = []

    def _shared(self, splitter: tuple | None, path: bytes) -> int:
        return common(splitter[2], path) if splitter is not None and splitter[:2] == self.group else -1

    def take(self, row: dict) -> None:
        group, path = (row["piece"], row["up"]), row["path"]
        if group != self.group:
            self.close(0)
            self.group, self.path = group, b""
        low, high = self._shared(self.low, path), self._shared(self.high, path)
        self.close(common(self.path, path) + 1)
        for depth in range(len(self.open), len(path) // STEP + 1):
            if self.open:
                self.open[-1].any_kid = True
            self.open.append(Node(depth, depth <= low, depth <= high, row["chars"][depth - 1] if depth else 0))
        self.path = path
        node, conv = self.open[-1], row["conv"]
        node.n += 1
        node.conv = conv if node.conv is None else min(node.conv, conv)
        node.key = row["down"]
        if row["more"]:
            node.more = True
            node.leaves += row["tail_leaves"]
            node.saved += row["tail_saved"]
            return
        node.ends.append(conv)
        if len(node.ends) == ENDS:
            self._ended(node)

    def _key(self, node: Node) -> bytes:
        piece, up = self.group
        if node.key:
            return node.key
        if node.depth == 0 and piece:
            return up
        head = piece.to_bytes(8, "big") + up + b"|" + self.path[: node.depth * STEP]
        return hashlib.blake2b(head, digest_size=STEP, person=b"node").digest()

    def _ended(self, node: Node) -> None:
        """The ids that end at ``node`` so far: into its hash, or out if other shards have some too."""
        text = ",".join(map(str, node.ends))
        if self._partial(node):
            self.out.append({"key": self._key(node), "at": node.ends[0], "chunk": text})
        elif node.hashed is None:
            node.hashed = hashlib.sha256(text.encode())
        else:
            node.hashed.update(b"," + text.encode())
        node.ends = []

    def _partial(self, node: Node) -> bool:
        return node.low or node.high or bool(node.depth == 0 and self.group[0])

    def close(self, depth: int) -> None:
        """Closes the open nodes from ``depth`` on, the deepest first."""
        while len(self.open) > depth:
            self._close()

    def _close(self) -> None:
        # Keys are made of the open path, which still reaches to the node that closes.
        node = self.open[-1]
        if node.ends:
            self._ended(node)
        self.open.pop()
        parent = self.open[-1] if self.open else None
        last = not node.high
        deeper = node.depth == 0 and self.group[0] > 0
        leaf = int(last and not node.any_kid and not node.more)
        own = node.n * node.chars - (node.chars if last else 0)
        node.leaves += leaf
        node.saved += own
        row = {"key": None, "parent_key": None, "parent_conv": None, "conv": node.conv, "depth": self.group[0] * self.piece + node.depth, "piece": self.group[0]}
        row |= {"n": node.n, "kids": node.kids, "leaves": node.leaves, "saved": node.saved, "own_leaf": leaf, "own_saved": own}
        if self._partial(node) or node.more:
            row["key"] = self._key(node)
        if not self._partial(node):
            row["ends"] = node.hashed.hexdigest() if node.hashed else EMPTY
        for child in node.waiting:
            child["parent_conv"] = node.conv
            self.out.append(child)
        if deeper:  # the end of the piece above: only its children are new
            self.out.append({"key": row["key"], "kids": node.kids})
            return
        if parent is None:
            self.out.append(row)
            return
        parent.n += node.n
        parent.conv = node.conv if parent.conv is None else min(parent.conv, node.conv)
        parent.kids += last
        parent.leaves += node.leaves
        parent.saved += node.saved
        if self._partial(parent):
            row["parent_key"] = self._key(parent)
            self.out.append(row)
        else:
            parent.waiting.append(row)


def shards_of(cut: DataFrame, most: int) -> list[tuple]:
    """Splitters: sorted keys of sampled rows, at most ``most`` - 1 of them, none longer than a piece."""
    order = ["piece", "up", "path", "more", "conv"]
    share = min(1.0, most * SAMPLED / max(cut.count(), 1))
    chance = F.pmod(F.xxhash64(F.lit("splitter"), "conv", "piece"), F.lit(1 << 30))
    rows = cut.filter(chance < F.lit(int(share * (1 << 30)) + 1)).select(order).collect()
    keys = sorted((r["piece"], bytes(r["up"]), bytes(r["path"]), r["more"], r["conv"]) for r in rows)
    places = sorted({len(keys) * i // most for i in range(1, most)} - {0})
    return [keys[i] for i in places if i < len(keys)]


def grown(cut: DataFrame, piece: int) -> tuple[DataFrame, DataFrame]:
    """Finished nodes, and the sums of the parts of the others by ``key``, of ``pieces`` with ``tail_*`` sums."""
    spark = cut.sparkSession
    order = ["piece", "up", "path", "more", "conv"]
    splitters = spark.sparkContext.broadcast(shards_of(cut, SHARDS * partitions(spark)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*[batch[c].to_pylist() for c in order])
            numbers = pa.array([bisect_right(splitters.value, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([numbers, *batch.columns], ["shard", *batch.schema.names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, at, shard = [], None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != at:
                    if shard:
                        shard.close(0)
                    at, edges = row["shard"], splitters.value
                    shard = Shard(edges[at - 1] if at else None, edges[at] if at < len(edges) else None, piece, found)
                shard.take(row)
                if len(found) >= 4096:
                    yield pa.RecordBatch.from_pylist(found, ARROW)
                    found.clear()
        if shard:
            shard.close(0)
        yield pa.RecordBatch.from_pylist(found, ARROW)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    by_shard = cut.mapInArrow(dealt, f"shard int, {schema}").repartition(partitions(spark), "shard")
    rows = staged(by_shard.sortWithinPartitions("shard", *order).mapInArrow(read, OUT))

    def joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hashed, done = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] != at:
                    if at is not None:
                        done.append({"key": at, "joined": hashed.hexdigest()})
                    at, hashed = row["key"], hashlib.sha256(row["chunk"].encode())
                else:
                    hashed.update(b"," + row["chunk"].encode())
        if at is not None:
            done.append({"key": at, "joined": hashed.hexdigest()})
        yield pa.RecordBatch.from_pylist(done, pa.schema([("key", pa.binary()), ("joined", pa.string())]))

    unfinished = rows.filter("key IS NOT NULL")
    chunks = unfinished.filter("chunk IS NOT NULL").select("key", "at", "chunk").repartition(partitions(spark), "key")
    ends = chunks.sortWithinPartitions("key", "at").mapInArrow(joined_ends, "key binary, joined string")
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("n", "kids", "leaves", "saved", "own_leaf", "own_saved")]
    same = [F.max(c).alias(c) for c in ("parent_key", "parent_conv", "depth", "piece", "ends")]
    parts = unfinished.filter("chunk IS NULL").groupBy("key").agg(F.min("conv").alias("conv"), *same, *sums).join(ends, "key", "left")
    parts = staged(parts.withColumn("ends", F.coalesce("ends", "joined", F.lit(EMPTY))).drop("joined"))
    return rows.filter("key IS NULL"), parts.filter("n > 0")


def prefix_trie(steps: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row a node: (``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``).

    ``steps`` has a row at place 0 for every conversation, and one for each turn (``rooted``,
    ``with_openings``).
    """
    cut = staged(pieces(steps, piece))
    none = {"tail_leaves": F.lit(0).cast("long"), "tail_saved": F.lit(0).cast("long")}
    own = ["own_leaf", "own_saved"]
    below = cut.filter("piece > 0")
    if not below.isEmpty():
        # What a conversation is the smallest of, by pieces, then all of it below each of its pieces.
        finished, parts = grown(below.withColumns(none), piece)
        held = finished.select("conv", "piece", *own).unionByName(parts.select("conv", "piece", *own))
        held = held.groupBy("conv", "piece").agg(*[F.sum(c).alias(c) for c in own])
        long = cut.join(below.select("conv").distinct(), "conv", "left_semi").select("conv", "piece")
        held = long.join(held, ["conv", "piece"], "left").na.fill(0, own)
        held = running(held, "conv", -F.col("piece"), own, F.sum, lambda a, b: a + b, SLAB // piece + 1)
        held = held.withColumnsRenamed({"own_leaf": "tail_leaves", "own_saved": "tail_saved"})
        cut = staged(cut.join(held, ["conv", "piece"], "left").na.fill(0, list(none)))
        cut = cut.select("piece", "up", "path", "more", "conv", "chars", "down", *none)
    else:
        cut = cut.withColumns(none)
    finished, parts = grown(cut, piece)
    nodes = finished.unionByName(parts.select(*NAMES[:13], F.lit(None).cast("long").alias("at"), F.lit(None).cast("string").alias("chunk")))
    # Few have a parent in another row: those below skeleton nodes and below the ends of pieces.
    smallest = parts.select(F.col("key").alias("parent_key"), F.col("conv").alias("_parent"))
    apart = nodes.filter("parent_key IS NOT NULL").join(smallest, "parent_key", "left").withColumn("parent_conv", F.col("_parent"))
    nodes = nodes.filter("parent_key IS NULL").unionByName(apart.drop("_parent"))
    return nodes.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )

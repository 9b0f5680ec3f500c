"""Clustering by nearest centroid in exact integers; n-simplex bounds rule most centroids out.

The squared distances of a vector to a few pivots are worked out once and kept. They place the vector
as the apex of a simplex over the pivots: its coordinates in their span, and its altitude above it.
Of two vectors, the Euclidean distance of their apexes is a lower bound of the true distance, and with
one altitude turned to the other side an upper bound. A centroid is compared exactly only if its
lower bound is not above the least upper bound of all centroids (widened by the rounding of floats,
so that no nearest centroid is lost).

Vectors are never shuffled: every round is one pass over the written table, in which a task sums its
own vectors by cluster. Only centroids (as many as asked for) reach the driver and the tasks.

Vectors without exactly the given number of components, or with a null or non-finite one, have no
cluster and no row. Equal distances go to the centroid with the smaller number. Repeated rows count
and come out as often as they are there; of equal ids the smaller vector is the earlier start. Null
ids start last. With fewer vectors than centroids each vector starts one; an empty table gives no
rows. Other columns are not read. A scaled component of 2**26 or more stops the job with an error,
since distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.base import prepare, staged

LARGEST = 1 << 26
#: Share of the squared lengths that float rounding may take from a bound (doubles err by some 1e-13).
ROUNDING = 1e-8
#: Exact comparisons held at once.
PAIRS = 1 << 15


@dataclass
class Simplex:
    """Pivots in general position, and the triangle that turns squared distances into coordinates."""

    pivots: np.ndarray
    inverse: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, candidates: np.ndarray, most: int) -> Simplex:
        """The first candidates that each stand clear of the span of those before them."""
        simplex = cls(candidates[:1], np.zeros((0, 0)), np.zeros(0))
        for candidate in candidates[1:]:
            if len(simplex.pivots) == most:
                break
            apex = simplex.apexes(candidate[None])[0]
            length = float((apex**2).sum())
            if apex[-1] ** 2 <= 1e-4 * length:
                continue
            old = simplex.inverse
            row = np.append(-(apex[:-1] @ old) / apex[-1], 1 / apex[-1])
            inverse = np.vstack([np.hstack([old, np.zeros((len(old), 1))]), row])
            simplex = cls(np.vstack([simplex.pivots, candidate]), inverse, np.append(simplex.lengths, length))
        return simplex

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates over the pivots' span, the altitude last, from squared distances to the pivots alone."""
        squares = ((vectors[:, None, :] - self.pivots[None]) ** 2).sum(axis=2).astype(np.float64)
        sides = (self.lengths + squares[:, :1] - squares[:, 1:]) / 2
        flat = sides @ self.inverse.T
        return np.hstack([flat, np.sqrt(np.maximum(squares[:, :1] - (flat**2).sum(axis=1, keepdims=True), 0))])


def candidates(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids can be nearest, by the bounds: (vectors, centroids), at least one of each vector."""
    lengths = (apexes**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1)[None]
    lower = lengths - 2 * apexes @ centroids.T
    upper = lower + 4 * apexes[:, -1:] * centroids[:, -1][None]
    slack = ROUNDING * (lengths + 1)
    return lower - slack <= (upper + slack).min(axis=1, keepdims=True)


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and exact squared distance of the nearest centroid; the smaller number of equals."""
    rows, numbers = np.nonzero(candidates(apexes, tops))
    squares = np.empty(len(rows), np.int64)
    for i in range(0, len(rows), PAIRS):
        part = slice(i, i + PAIRS)
        squares[part] = ((vectors[rows[part]] - centroids[numbers[part]]) ** 2).sum(axis=1)
    begins = np.searchsorted(rows, np.arange(len(vectors)))
    least = np.minimum.reduceat(squares, begins) if len(rows) else squares
    hits = np.flatnonzero(squares == least[rows])
    first = hits[np.searchsorted(rows[hits], np.arange(len(vectors)))]
    return numbers[first], least


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def scaled_vectors(embeddings: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(``vec_id``, ``v``): the vectors with whole components, each floor(scale * x)."""
    sound = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("x"))
    kept = kept.filter(F.col("x").isNotNull() & (F.size("x") == dims) & sound)
    large = F.exists("x", lambda x: F.abs(x.cast("double") * scale) >= LARGEST)
    whole = F.transform("x", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    error = F.raise_error(F.lit(f"a component is {LARGEST} or more after scaling"))
    return kept.select("vec_id", F.when(large, error.cast("array<int>")).otherwise(whole).alias("v"))


def clusters(
    embeddings: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    pivots: int = 8,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``) of each vector.

    Starts from the ``k`` vectors whose ids hash lowest; ``k`` vectors of ``dims`` components are what
    a task and the driver hold besides a batch.
    """
    spark = embeddings.sparkSession
    prepare(spark)
    kept = scaled_vectors(embeddings, id_col, vector_col, dims, scale)
    order = F.coalesce(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256), F.lit("null"))
    starts = kept.select(order.alias("_order"), "v").orderBy("_order", "v").limit(k).collect()
    if not starts:
        empty = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, {empty}")
    centroids = np.array([row["v"] for row in starts], np.int64)
    simplex = Simplex.of(centroids, pivots)

    def with_apex(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apexes = simplex.apexes(_matrix(batch["v"], np.int64))
            bounds = np.arange(len(apexes) + 1, dtype=np.int32) * apexes.shape[1]
            column = pa.ListArray.from_arrays(bounds, apexes.ravel())
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], column], ["vec_id", "v", "apex"])

    id_type = kept.schema["vec_id"].dataType.simpleString()
    placed = staged(kept.mapInArrow(with_apex, f"vec_id {id_type}, v array<int>, apex array<double>"))

    for _ in range(rounds):
        sums = placed.mapInArrow(_summing(centroids, simplex), "cluster int, n long, sums array<long>")
        total = [F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(dims)]
        moved = centroids.copy()
        for row in sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*total).alias("sums")).collect():
            moved[row["cluster"]] = [int(x) // row["n"] for x in row["sums"]]
        centroids = moved

    tops = simplex.apexes(centroids)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, squares = nearest(_matrix(batch["v"], np.int64), _matrix(batch["apex"], np.float64), centroids, tops)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(numbers, pa.int32()), pa.array(squares)], ["vec_id", "cluster", "distance"]
            )

    result = staged(placed.mapInArrow(assigned, f"vec_id {id_type}, cluster int, distance long"))
    inertias = {row["cluster"]: int(row["s"]) for row in result.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    facts = [
        (number, inertia, sum(inertias.values()), hashlib.sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest())
        for number, inertia in inertias.items()
    ]
    described = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = result.join(F.broadcast(described), "cluster")  # one row per centroid
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _summing(centroids: np.ndarray, simplex: Simplex):
    """Count and componentwise sum by cluster, of all batches of a task together."""
    tops = simplex.apexes(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            vectors = _matrix(batch["v"], np.int64)
            numbers, _ = nearest(vectors, _matrix(batch["apex"], np.float64), centroids, tops)
            counts += np.bincount(numbers, minlength=len(centroids))
            np.add.at(sums, numbers, vectors)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(counts[found]), pa.array(sums[found].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    return run

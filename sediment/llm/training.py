"""Labelled rows to fit a model on, and a logistic curve through scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.base import identifier


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; of a null id 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(0))


def labelled(
    labels: DataFrame, label_col: str, modulus: int, held_out: int, most: int, id_col: str = "doc_id"
) -> DataFrame:
    """(``_id``, ``_label``, ``_fold``) of the rows to learn from: at most about ``most``, chosen by a hash.

    Rows held out (by ``remainder``) and rows without id or label are left out; of several labels for
    an id the largest counts. ``_fold`` is 0 to 4, by another hash. The result is small enough to
    broadcast.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.filter(remainder(id_col, modulus) != held_out)
    known = known.groupBy(identifier(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("_label"))
    share = min(1.0, most / max(known.count(), 1))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    return chosen.withColumn("_fold", F.pmod(F.xxhash64(F.lit("fold"), "_id"), F.lit(5)).cast("int"))


def logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (the last is the constant) of a logistic regression, by Newton's method.

    Features are scaled inside. With one label only, the constant says how sure that is.
    """
    if not len(labels):
        return np.zeros(features.shape[1] + 1)
    middle, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.hstack([(features - middle) / scale, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (labels - p) - ridge * len(labels) * np.append(w[:-1], 0)
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(labels) * np.eye(len(w)) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return np.append(weights, w[-1] - weights @ middle)


def probability(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights[:-1] + weights[-1], -30, 30)))

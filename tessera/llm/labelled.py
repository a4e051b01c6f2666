"""Bounded, reproducible samples of labelled rows for fitting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


def lowest_hashes(rows: DataFrame, id_col: str, n: int, count: int) -> DataFrame:
    """The ``n`` rows of the least id hashes.  Of many rows only about twice as many as wanted are
    sorted, so what meets in one place is bounded however many partitions there are."""
    h = F.xxhash64(id_col)
    if count > 2 * n + 1000:
        rows = rows.where(h <= -(1 << 63) + (1 << 64) * (2 * n + 1000) // count)
    return rows.orderBy(h, id_col).limit(n)


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: dict[int, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, y) of at most ``rows[y]`` documents for each class y, by a hash of the id.

    Labels of rows outside ``train`` are never read further; of several labels of one id the
    largest counts.  The sample of ids is small by its bound, so it is broadcast.
    """
    known = labels.where(train & F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label).alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect() if r["y"] in rows}
    parts = [lowest_hashes(known.where(F.col("y") == y), id_col, n, sizes.get(y, 0)) for y, n in rows.items()]
    ids = parts[0]
    for part in parts[1:]:
        ids = ids.unionByName(part)
    return docs.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(ids), id_col).select(F.col(id_col).alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.col("y").cast("int"))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (the constant last) of a ridge-penalised logistic regression, by Newton steps;
    the classes weigh as they occur.  Without rows of both classes the constant is the smoothed rate."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        return w
    penalty = np.full(x.shape[1], ridge * len(y))
    penalty[-1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w

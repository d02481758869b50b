"""Bounded samples of labelled documents, and the calibration of a score."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int, seed: str,
                    id_col: str = "doc_id") -> DataFrame:
    """``_id, _y, _u``: about ``bound`` labelled ids of each class at most (all of them
    when a class has fewer), chosen by hash; ``_u`` in [0, 1) is a second,
    independent hash.  Only ids move: the rows are ids of ``docs`` that
    ``labels`` marks 0 or 1 and for which ``learn`` (an expression over the id
    column ``_id``) holds.  An id with both labels counts as 1; null ids and
    null labels are left out."""
    ids = docs.select(F.col(id_col).alias("_id")).distinct()
    marked = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).filter(
        F.col("_y").isin(0, 1) & learn).groupBy("_id").agg(F.max("_y").alias("_y")).join(ids, "_id", "left_semi")
    unit = lambda s: (F.xxhash64(F.lit(seed + s), "_id").cast("double") / 2.0 ** 64) + 0.5
    marked = marked.select("_id", "_y", unit("a").alias("_p"), unit("b").alias("_u"))
    sizes = {r["_y"]: r["count"] for r in marked.groupBy("_y").count().collect()}
    keep = F.lit(False)
    for y, n in sizes.items():
        keep = keep | ((F.col("_y") == y) & (F.col("_p") < F.lit(min(1.0, bound / n))))
    return marked.filter(keep).select("_id", "_y", "_u")


def class_sizes(labels: DataFrame, label: str, learn: Column) -> dict:
    """Rows of each class among the labels that may be learned from."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).filter(
        F.col("_y").isin(0, 1) & learn)
    return {0: 0, 1: 0} | {r["_y"]: r["count"] for r in marked.groupBy("_y").count().collect()}


class Calibration:
    """Logistic regression on a few columns, by Newton's method with a small
    ridge; with one class or no rows it returns the smoothed base rate."""

    def __init__(self, x: np.ndarray, y: np.ndarray, base: float | None = None):
        n = len(y)
        self.base = (y.sum() + 1.0) / (n + 2.0) if base is None else base
        self.w = None
        if n < 10 or y.min() == y.max():
            return
        self.mean, self.sd = x.mean(0), x.std(0) + 1e-9
        g = self._design(x)
        ridge = np.full(g.shape[1], 0.5)
        ridge[0] = 1e-6
        w = np.zeros(g.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(g @ w, -30, 30)))
            step = np.linalg.solve((g.T * (p * (1 - p) + 1e-9)) @ g + np.diag(ridge), g.T @ (y - p) - ridge * w)
            w = w + step
            if np.abs(step).max() < 1e-9:
                break
        self.w = w

    def _design(self, x):
        return np.c_[np.ones(len(x)), np.clip((x - self.mean) / self.sd, -50, 50)]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-np.clip(self._design(x) @ self.w, -30, 30)))

    def for_odds(self, sizes: dict, y: np.ndarray) -> Calibration:
        """A sample takes each class up to one bound: move the intercept from
        the sample's odds to the odds of all labelled rows."""
        if self.w is not None and sizes[0] and sizes[1]:
            self.w[0] += np.log((sizes[1] / sizes[0]) / (y.sum() / (1 - y).sum()))
        return self

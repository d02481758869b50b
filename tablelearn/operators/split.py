"""Train/test splitting.

``hash_split`` is the main operator: a row's side depends only on a hash of
its key and the seed, so it is identical on every cluster size, after any
re-partitioning, and when lost tasks are re-run.  ``random_split`` is there
for parity with ``df.randomSplit``; its result changes with partitioning.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.functions.columns import hash32

SPAN = 2 ** 32


def _bounds(weights):
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    return [round(c / total * SPAN) for c in accumulate(weights)]


def hash_split(df: DataFrame, key_cols, weights, seed: int, split_col: str = "split") -> DataFrame:
    """Add ``split`` = index of the weight interval that the key's 32-bit
    hash falls in, so a side with a share of one in a billion still gets its
    rows.  Narrow: no shuffle."""
    b = hash32(key_cols, seed)
    bounds = _bounds(weights)
    expr = F.lit(len(bounds) - 1)
    for i in reversed(range(len(bounds) - 1)):
        expr = F.when(b < bounds[i], F.lit(i)).otherwise(expr)
    return df.withColumn(split_col, expr.cast("int"))


def hash_split_frames(df: DataFrame, key_cols, weights, seed: int):
    """The sides of ``hash_split`` as separate DataFrames (each a filter of
    the same lazy plan; persist ``df`` first if it is expensive)."""
    tagged = hash_split(df, key_cols, weights, seed, "_split")
    return [tagged.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def random_split(df: DataFrame, weights, seed: int, split_col: str = "split") -> DataFrame:
    """Each row's side from one random number, in one narrow pass.  The
    sides depend on the partitioning, like those of ``df.randomSplit``."""
    shares = [c / SPAN for c in _bounds(weights)]
    out = F.lit(len(shares) - 1)
    for i in reversed(range(len(shares) - 1)):
        out = F.when(F.col("_random") < shares[i], F.lit(i)).otherwise(out)
    return df.withColumn("_random", F.rand(seed)).withColumn(split_col, out.cast("int")).drop("_random")

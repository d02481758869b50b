"""Operators: DataFrame in, DataFrame out (models where a fit is needed)."""

from tablelearn.operators import filters, hands, id3, metrics, mllib, naive_bayes, split, stats

__all__ = ["filters", "hands", "id3", "metrics", "mllib", "naive_bayes", "split", "stats"]

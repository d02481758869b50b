"""Row filters and the keyed prediction join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.functions.columns import all_not_null, trunc_int


def filter_complete_rows(df: DataFrame, cols=None) -> DataFrame:
    """Drop rows with a null in any of ``cols`` (default: all columns).
    NaN is a value, not a null, so it is kept (``na.drop`` would drop it)."""
    return df.filter(all_not_null(cols or df.columns))


def class_partition(df: DataFrame, label: str, cls: int) -> DataFrame:
    """Rows whose label truncated to int equals ``cls``."""
    return df.filter(trunc_int(label) == cls)


def split_by_value(df: DataFrame, attribute: str, value) -> DataFrame:
    """Rows where ``attribute`` equals ``value``; null matches null."""
    return df.filter(F.col(attribute).eqNullSafe(F.lit(value)))


def attach_predictions(rows: DataFrame, predictions: DataFrame, key) -> DataFrame:
    """Attach a separately computed prediction table to rows on a real key
    (an equi-join Catalyst plans as broadcast or sort-merge by size)."""
    return rows.join(predictions, key, "inner")

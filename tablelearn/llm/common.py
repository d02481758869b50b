"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelearn.plans.shaping import cut_lineage

#: a word: a run of characters other than the six ASCII white-space ones
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)


def words_of(text: Column) -> Column:
    """The words of a text (null: no words)."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def fold(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


#: numbers (8 bytes each) in a side that may be broadcast; a larger side is joined by shuffling
BROADCAST_NUMBERS = 4_000_000


def checked(side: DataFrame, lists: str | None = None) -> DataFrame:
    """``side`` (a written table of a few numbers a row, with perhaps one
    column of lists), marked for broadcast if its counted size allows it."""
    n = F.count(F.lit(1)) * len(side.columns)
    if lists:
        n = n + F.coalesce(F.sum(F.size(lists)), F.lit(0))
    return F.broadcast(side) if side.agg(n).first()[0] <= BROADCAST_NUMBERS else side


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranked(df: DataFrame, order, column: str, name: str = "ranked") -> DataFrame:
    """Add a 0-based rank in the total order ``order`` without a window over
    all rows: the rows are range-sorted and written once, and a row's rank is
    its place in its partition plus the rows of the partitions before (one
    number per partition)."""
    sorted_ = cut_lineage(df.orderBy(*order).select("*", F.monotonically_increasing_id().alias("_row")), name)
    part = F.shiftright("_row", 33)
    sizes = sorted_.groupBy(part.alias("p")).count().orderBy("p").collect()
    before, total = [], 0
    for r in sizes:
        before.append((r["p"], total))
        total += r["count"]
    spark = df.sparkSession
    starts = spark.createDataFrame(before, "_p long, _before long")
    place = F.col("_row") - F.shiftleft(F.col("_p"), 33)
    # one row per partition of the sort: a bounded side
    return sorted_.join(F.broadcast(starts), part == F.col("_p")).select(
        *df.columns, (place + F.col("_before")).alias(column))

"""Poker-hand scoring as column expressions over ``s1..s5, r1..r5, class``.

A hand has exactly five cards, so every rule is unrolled into plain column
arithmetic over the five rank/suit columns (plus one codegen'd
``array_sort(array_distinct(...))``): no explode, no shuffle, no UDF.

total = class_score + rank_points * class_score * 0.002 + flush_bonus
        + 4 * longest_run

``compat=True`` gives what the reference executes: the flush bonus is always
0 (its suit list is read from an exhausted iterator) and the run length
follows its first-index rule, null where the reference throws.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUITS = tuple(f"s{i}" for i in range(1, 6))
RANKS = tuple(f"r{i}" for i in range(1, 6))

# Class -> base score (class 1..9 -> 2000..10000, anything
# else 1000), ace (rank 1) -> 14 rank points, other ranks -> 14 - rank,
# bonus 25 for exactly four cards of one suit, 4 points per run card,
# rank points weighted by 0.002 * class score.
ACE_POINTS = 14
FLUSH_BONUS = 25
RUN_WEIGHT = 4
POINTS_WEIGHT = 0.002


def _sum(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def hand_class_score(cls="class") -> Column:
    c = F.col(cls) if isinstance(cls, str) else cls
    return F.when(c.between(1, 9), (c + 1) * 1000.0).otherwise(F.lit(1000.0))


def hand_rank_points(ranks=RANKS) -> Column:
    return _sum([F.when(F.col(r) == 1, F.lit(ACE_POINTS)).otherwise(F.lit(ACE_POINTS) - F.col(r)) for r in ranks])


def hand_flush_bonus(suits=SUITS, compat: bool = False) -> Column:
    if compat:
        return F.lit(0)
    counts = [_sum([(F.col(t) == F.col(s)).cast("int") for t in suits]) for s in suits]
    return F.when(reduce(lambda a, b: a | b, [c == 4 for c in counts]), F.lit(FLUSH_BONUS)).otherwise(F.lit(0))


def _runs(vals, mult, compat: bool) -> Column:
    runs = []
    prev = None
    for j, v in enumerate(vals):
        if j == 0:
            cur = F.when(v.isNotNull(), F.lit(1))
        else:
            start = (v - 1) != vals[j - 1]
            step = mult[j] if compat else F.lit(1)
            cur = F.when(v.isNull(), F.lit(None)).when(start, F.lit(1)).otherwise(prev + step)
        runs.append(cur)
        prev = cur
    longest = F.greatest(*runs)
    if compat:
        return F.when(mult[0] > 1, F.lit(None).cast("int")).otherwise(longest).cast("int")
    return longest.cast("int")


def _distinct_sorted(ranks) -> Column:
    # sort_array (not array_sort, a lambda function) keeps this in codegen
    return F.sort_array(F.array_distinct(F.array(*[F.col(r) for r in ranks])))


def hand_longest_run(ranks=RANKS, compat: bool = False) -> Column:
    """Longest run of consecutive ranks (ace low only).

    Default: longest island of consecutive *distinct* ranks.
    Compat: an island counts 1 for its lowest rank plus every card (with
    multiplicity) of its higher ranks; null when the hand's lowest rank is
    duplicated (the reference indexes position -1 there)."""
    d = _distinct_sorted(ranks)
    vals = [F.get(d, j) for j in range(len(ranks))]
    mult = [_sum([(F.col(r) == v).cast("int") for r in ranks]) for v in vals]
    return _runs(vals, mult, compat)


def with_rank_profile(df: DataFrame, ranks=RANKS) -> DataFrame:
    """Add ``_v0.._v4`` (distinct ranks ascending, null past the end) and
    ``_m0.._m4`` (their multiplicities) as columns, in two projections so
    the sorted array is computed once per row."""
    n = len(ranks)
    staged = df.withColumn("_d", _distinct_sorted(ranks))
    staged = staged.withColumns({f"_v{j}": F.get(F.col("_d"), j) for j in range(n)}).drop("_d")
    return staged.withColumns({
        f"_m{j}": _sum([(F.col(r) == F.col(f"_v{j}")).cast("int") for r in ranks]) for j in range(n)})


def with_runs(df: DataFrame, ranks=RANKS) -> DataFrame:
    """Add ``longest_run`` and ``longest_run_compat``.  The run length at
    each distinct-rank position is its own column (one small projection per
    position, each referencing the previous one), so no position is
    recomputed inside later ones."""
    n = len(ranks)
    out = with_rank_profile(df, ranks)
    for kind, compat in (("d", False), ("c", True)):
        for j in range(n):
            v = F.col(f"_v{j}")
            if j == 0:
                cur = F.when(v.isNotNull(), F.lit(1))
            else:
                start = (v - 1) != F.col(f"_v{j - 1}")
                step = F.col(f"_m{j}") if compat else F.lit(1)
                cur = F.when(v.isNull(), F.lit(None)).when(start, F.lit(1)).otherwise(F.col(f"_{kind}{j - 1}") + step)
            out = out.withColumn(f"_{kind}{j}", cur)
    longest = F.greatest(*[F.col(f"_d{j}") for j in range(n)]).cast("int")
    compat_longest = F.when(F.col("_m0") > 1, F.lit(None)).otherwise(
        F.greatest(*[F.col(f"_c{j}") for j in range(n)])).cast("int")
    tmp = [f"_{k}{j}" for k in ("v", "m", "d", "c") for j in range(n)]
    return out.withColumns({"longest_run": longest, "longest_run_compat": compat_longest}).drop(*tmp)


def hand_total(cls="class", ranks=RANKS, suits=SUITS, compat: bool = False) -> Column:
    """Total score as one column expression (handy in a select).  Over a
    whole table prefer ``score_hands``, which stages the run lengths as
    columns instead of re-deriving them inside one big expression."""
    cs = hand_class_score(cls)
    pts = hand_rank_points(ranks)
    return cs + pts * cs * POINTS_WEIGHT + hand_flush_bonus(suits, compat) + hand_longest_run(ranks, compat) * RUN_WEIGHT


def score_hands(df: DataFrame, keep=("hand_id",)) -> DataFrame:
    """All parts of the score, default and compat, as columns (staged
    projections: rank profile, then parts, then totals)."""
    runs = with_runs(df.select(*keep, "class", *RANKS, *SUITS))
    parts = runs.select(
        *keep,
        F.col("class"),
        hand_class_score().alias("class_score"),
        hand_rank_points().alias("rank_points"),
        hand_flush_bonus().alias("flush_bonus"),
        hand_flush_bonus(compat=True).alias("flush_bonus_compat"),
        "longest_run",
        "longest_run_compat",
    )
    cs, pts = F.col("class_score"), F.col("rank_points")

    def total(bonus, run):
        return cs + pts * cs * POINTS_WEIGHT + F.col(bonus) + F.col(run) * RUN_WEIGHT

    return parts.withColumns({
        "total_score": total("flush_bonus", "longest_run"),
        "total_score_compat": total("flush_bonus_compat", "longest_run_compat"),
    })

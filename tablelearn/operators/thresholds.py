"""Threshold gain of continuous features from mergeable quantile sketches.

A continuous feature has about one value per row, so an exact value table is as
long as the input.  Here every feature is summarised by a KLL sketch (a few
thousand numbers at any number of rows; sketches of parts of the data merge
into that of the whole), whose quantiles are the candidate cut points.  One pass
counts rows per ``(feature, bin, label)``, and prefix sums over a feature's
bins give the information gain of every test ``value < cut``.

What is shuffled: one sketch per task and feature, and at most
``bins x classes`` counters per task and feature, whatever the number of
distinct values.  What reaches the driver: ``bins - 1`` cut points a feature.

Null and NaN values take no side: a feature's gain is that over the rows
which have a value.  Null is a label of its own.  A feature with one value, or
without values, has no cut and no row in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tablelearn.functions.columns import LN2, ratio, xlogx
from tablelearn.operators.stats import equal_width_edges, feature_positions

#: size parameter of a sketch: its ranks are off by about 2.3 / SKETCH of the rows (99 % confidence)
SKETCH = 4096
BINS = 32


def _numbers(df: DataFrame, features) -> list[str]:
    out = [f for f in features if isinstance(df.schema[f].dataType, NumericType)]
    if len(out) < len(features):
        raise ValueError("thresholds need numeric features")
    return out


def _value(feature: str) -> Column:
    x = F.col(feature).cast("double")
    return F.when(~F.isnan(x), x)


def feature_sketches(df: DataFrame, features, by=(), size: int = SKETCH) -> DataFrame:
    """``by.., one sketch column per feature``: a group of rows in a few
    thousand numbers each."""
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(_value(f), size).alias(f) for f in _numbers(df, features)])


def merge_sketches(sketches: DataFrame, features) -> DataFrame:
    """One row: the sketches of several groups of rows as that of all."""
    return sketches.agg(*[F.kll_merge_agg_double(f).alias(f) for f in features])


def cut_points(sketches: DataFrame, features, bins: int = BINS) -> dict:
    """``{feature: [cut, ...]}``: the sketch's i/bins quantiles, repeated ones
    and the least value left out (no row is below it)."""
    ranks = F.array(*[F.lit(i / bins) for i in range(bins)])
    quantiles = [F.when(F.kll_sketch_get_n_double(f) > 0, F.kll_sketch_get_quantile_double(F.col(f), ranks)).alias(f)
                 for f in features]
    row = sketches.select(*quantiles).first()
    return {f: sorted(set(row[f]) - {min(row[f])}) if row is not None and row[f] else [] for f in features}


def width_cuts(df: DataFrame, features, bins: int = BINS) -> dict:
    """``{feature: [cut, ...]}`` of equal width."""
    out = {}
    for f, (lo, hi) in equal_width_edges(df, features).items():
        out[f] = [] if lo is None or hi == lo else [lo + (hi - lo) / bins * i for i in range(1, bins)]
    return out


def _bin(x: Column, cuts: list[float]) -> Column:
    """Number of cuts <= x, by halving."""
    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x < F.lit(float(cuts[mid])), among(lo, mid)).otherwise(among(mid + 1, hi))
    return F.when(x.isNotNull(), among(0, len(cuts)))


def threshold_report(df: DataFrame, features, label: str, cuts: dict) -> DataFrame:
    """Per feature and cut: ``feature, feature_pos, threshold, n, n_below,
    gain`` (bits) of the test ``value < threshold``."""
    features = [f for f in features if cuts.get(f)]
    spark = df.sparkSession
    steps = spark.createDataFrame([(f, i, float(c)) for f in features for i, c in enumerate(cuts[f])],
                                  "feature string, bin int, threshold double")
    if not features:
        return steps.select("feature", F.lit(0).alias("feature_pos"), "threshold", F.lit(0).cast("long").alias("n"),
                            F.lit(0).cast("long").alias("n_below"), F.lit(0.0).alias("gain"))
    rows = df.select(F.col(label).alias("_y"), *[_bin(_value(f), cuts[f]).alias(f) for f in features])
    cells = rows.unpivot("_y", features, "feature", "bin").filter(F.col("bin").isNotNull()).groupBy(
        "feature", "bin", "_y").agg(F.count(F.lit(1)).alias("n"))
    # from here on bounded: bins x classes rows a feature; every class gets every bin, so that sums have no gaps
    last = F.create_map(*[x for f in features for x in (F.lit(f), F.lit(len(cuts[f]) - 1))])
    per_class = cells.groupBy("feature", "_y").agg(
        F.sum("n").alias("_all"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_by"))
    grid = per_class.select("feature", "_y", "_all", "_by", F.explode(F.sequence(F.lit(0), last[F.col("feature")])).alias("bin"))
    own = F.coalesce(F.col("_by")[F.col("bin")], F.lit(0))
    upto = Window.partitionBy("feature", "_y").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    below = grid.select("feature", "bin", "_all", F.sum(own).over(upto).alias("_below"))
    per_cut = below.withColumn("_above", F.col("_all") - F.col("_below")).groupBy("feature", "bin").agg(
        F.sum("_all").alias("n"), F.sum("_below").alias("n_below"), F.sum(xlogx("_all")).alias("_s"),
        F.sum(xlogx("_below")).alias("_l"), F.sum(xlogx("_above")).alias("_r"))
    n, left = F.col("n"), F.col("n_below")
    spread = xlogx(n) - F.col("_s") - (xlogx(left) - F.col("_l")) - (xlogx(n - left) - F.col("_r"))
    gain = F.greatest(F.lit(0.0), ratio(spread, n.cast("double")) / LN2)
    out = per_cut.join(F.broadcast(steps), ["feature", "bin"])      # bins - 1 rows a feature
    return out.withColumn("feature_pos", feature_positions(features)).select(
        "feature", "feature_pos", "threshold", n.cast("long").alias("n"), left.cast("long").alias("n_below"), gain.alias("gain"))


def best_thresholds(report: DataFrame, digits: int = 12) -> DataFrame:
    """The best cut of each feature (ties to the least): ``feature,
    feature_pos, threshold, n, n_below, gain``."""
    key = F.struct(F.round("gain", digits), -F.col("threshold"))
    columns = ["threshold", "n", "n_below", "gain"]
    return report.groupBy("feature", "feature_pos").agg(F.max_by(F.struct(*columns), key).alias("_b")).select(
        "feature", "feature_pos", *[F.col(f"_b.{c}").alias(c) for c in columns])


def sketched_thresholds(df: DataFrame, features, label: str, bins: int = BINS, size: int = SKETCH) -> DataFrame:
    """``threshold_report`` at the sketches' quantiles."""
    features = list(features)
    return threshold_report(df, features, label, cut_points(feature_sketches(df, features, size=size), features, bins))

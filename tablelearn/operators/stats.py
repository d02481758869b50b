"""Class statistics, entropy and information gain.

Shape of the work (the reference recomputed each of these per feature with
driver loops and single-partition windows):

* every statistic is an aggregate with map-side partial aggregation, so a
  class or value holding a third of all rows is combined inside each map
  task before the shuffle;
* all features are scored from ONE table ``(by.., feature, value) -> a count
  per class`` made by unpivoting the features (one scan, one wide exchange);
* entropies are rewritten as sums of ``n ln n`` terms, so no step needs the
  grand total next to each row:

      H(Y)      = ln N - (sum_l n_l ln n_l) / N
      H(Y | X)  = (sum_v n_v ln n_v - sum_{v,l} n_vl ln n_vl) / N
      H(X)      = ln N - (sum_v n_v ln n_v) / N          (nats, "compat")

  (divide by ln 2 for bits).  The label counts ride in the same histogram as
  a constant pseudo-feature (``ROWS``), so the chain has no branch and no
  join.  The only windows run over per-class rows (bounded by the number of
  classes) or over the features + 1 rows of one group (bounded by the
  number of features);
* numeric feature values are grouped as typed keys, not formatted as text,
  and continuous features can be binned first (``bins``) so the histogram
  stays bounded instead of growing with the distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tablelearn.functions.columns import LN2, as_key_string, ratio, trunc_int, typed_key, xlogx

FEATURE = "feature"
VALUE = "value"
# Pseudo-feature with one constant value: its histogram cells are the
# (by.., label) counts, so label statistics ride along in the same pass.
ROWS = "__rows__"
WIDE_CLASSES = 64       # classes that get a counter of their own in ``value_terms``


def _cnt() -> Column:
    return F.count(F.lit(1))


# --------------------------------------------------------------------------
# counts, probabilities, priors


def class_counts(df: DataFrame, label: str, by=()) -> DataFrame:
    """Rows per class (null is a class of its own): ``by.., label, n``."""
    return df.groupBy(*by, label).agg(_cnt().alias("n"))


def class_probability(df: DataFrame, label: str) -> DataFrame:
    """Share of each class in the whole table, ordered by class:
    ``label, n, probability``.  The window runs over the per-class rows
    only (bounded by the number of classes)."""
    counts = class_counts(df, label)
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(label, "n", ratio(F.col("n"), total).alias("probability")).orderBy(label)


def class_priors(df: DataFrame, label: str, classes=(0, 1)) -> DataFrame:
    """Priors n_c / sum(n) over the given classes of ``trunc(label)``;
    rows of other classes are excluded: ``label, n, prior``."""
    cls = trunc_int(label)
    counts = (df.select(cls.alias(label)).filter(F.col(label).isin(*classes))
              .groupBy(label).agg(_cnt().alias("n")))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(label, "n", ratio(F.col("n"), total).alias("prior"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column (null included)."""
    return df.select(column).distinct()


# --------------------------------------------------------------------------
# histogram and value statistics


def feature_positions(features) -> Column:
    """0-based position of ``feature`` in the given list (tie-break key)."""
    return (F.array_position(F.array(*[F.lit(f) for f in features]), F.col(FEATURE)) - 1).cast("int")


def long_values(df: DataFrame, features, ids=(), typed: bool = False) -> DataFrame:
    """Unpivot ``features`` into ``(ids.., feature, value)``.  Narrow: no
    shuffle.  ``value`` is a string key (-0.0 folded into 0.0), or with
    ``typed=True`` a ``typed_key`` struct, which skips number formatting
    where the value is only grouped, never shown."""
    features = list(features)
    schema = {f.name: f.dataType for f in df.schema.fields}
    key = typed_key if typed else as_key_string
    cols = [key(F.col(f), schema[f]).alias(f) for f in features]
    base = df.select(*ids, *cols)
    return base.unpivot(list(ids), features, FEATURE, VALUE)


def histogram(df: DataFrame, features, label: str, by=(), typed: bool = False) -> DataFrame:
    """``(by.., feature, value, label) -> n``: the one pass over the data
    that gain, purity and split statistics are read from.  Includes the
    ``ROWS`` pseudo-feature (the label counts per group).  ``typed``: see
    ``long_values``."""
    ids = list(by) + [label]
    long = long_values(df.withColumn(ROWS, F.lit("")), [*features, ROWS], ids, typed)
    return long.groupBy(*by, FEATURE, VALUE, label).agg(_cnt().alias("n"))


def value_terms(df: DataFrame, features, label: str, by=()) -> DataFrame:
    """Per ``(by.., feature, value)``: ``_nv`` rows and ``_av`` = the sum of
    ``n ln n`` over its classes; one wide exchange.

    One small aggregate first gives the classes (null is one), and the rows
    are then counted per value with a counter per class, combined map-side.
    With more than ``WIDE_CLASSES`` classes the class becomes part of the
    grouping key instead, at the cost of a second exchange."""
    classes = [r[0] for r in df.select(label).distinct().limit(WIDE_CLASSES + 1).collect()]
    if len(classes) > WIDE_CLASSES:
        return histogram(df, features, label, by, typed=True).groupBy(*by, FEATURE, VALUE).agg(
            F.sum("n").alias("_nv"), F.sum(xlogx("n")).alias("_av"))
    kind = df.schema[label].dataType
    long = long_values(df.withColumn(ROWS, F.lit("")), [*features, ROWS], [*by, label], typed=True)
    counts = long.groupBy(*by, FEATURE, VALUE).agg(
        _cnt().alias("_nv"),
        *[F.count_if(F.col(label).eqNullSafe(F.lit(c).cast(kind))).alias(f"_n{i}") for i, c in enumerate(classes)])
    terms = F.lit(0.0)
    for i in range(len(classes)):
        terms = terms + xlogx(f"_n{i}")
    return counts.select(*by, FEATURE, VALUE, "_nv", terms.alias("_av"))


def feature_value_counts(df: DataFrame, features, by=()) -> DataFrame:
    """``(by.., feature, value) -> n`` for all features at once."""
    return long_values(df, features, by).groupBy(*by, FEATURE, VALUE).agg(_cnt().alias("n"))


def value_probability(df: DataFrame, features, by=()) -> DataFrame:
    """Per feature value: ``n``, ``probability = n / rows`` and the
    ``entropy_term = -p ln p`` (nats).  Totals come from a per-feature
    aggregate joined on the feature name, not from a global window."""
    counts = feature_value_counts(df, features, by)
    totals = counts.groupBy(*by, FEATURE).agg(F.sum("n").alias("_total"))
    p = ratio(F.col("n"), F.col("_total"))
    if not by:      # one row per feature: a proven bound
        totals = F.broadcast(totals)
    return counts.join(totals, [*by, FEATURE]).select(
        *by, FEATURE, VALUE, "n", p.alias("probability"), (-p * F.ln(p)).alias("entropy_term"))


# --------------------------------------------------------------------------
# entropy and gain


def _bits_from_sums(n: Column, s: Column) -> Column:
    """ln N - S/N in bits, 0 for empty input, never below 0."""
    h = (F.ln(n.cast("double")) - ratio(s, n)) / LN2
    return F.greatest(F.lit(0.0), F.coalesce(h, F.lit(0.0)))


def entropy(df: DataFrame, label: str, by=()) -> DataFrame:
    """Label entropy in bits per group: ``by.., n, entropy``.  Empty input
    gives one row with n = 0 and entropy 0.0 (when ``by`` is empty)."""
    counts = class_counts(df, label, by)
    agg = counts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(xlogx("n")).alias("_s"))
    return agg.select(*by, F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
                      _bits_from_sums(F.col("n"), F.col("_s")).alias("entropy"))


def gain_table(per_value: DataFrame, by=(), features=None) -> DataFrame:
    """Per ``(by.., feature)`` from ``value_terms`` (with its ``ROWS`` cells):
    ``n``, ``label_entropy`` (bits), ``conditional_entropy`` (bits),
    ``feature_entropy`` (nats), ``gain`` (textbook) and ``gain_compat``
    (label entropy in bits minus the feature's own entropy in nats, as the
    reference executes it).  One linear chain of aggregates: no branch, so
    the value counts (and the scan under them) are computed once."""
    keys = [*by, FEATURE]
    per_feature = per_value.groupBy(*keys).agg(
        F.sum("_nv").alias("n"), F.sum(xlogx("_nv")).alias("_b"), F.sum("_av").alias("_a"))
    # sum_l n_l ln n_l of the group = the "_a" of the ROWS pseudo-feature.
    # The window holds (features + 1) rows per group: a bounded partition.
    w = Window.partitionBy(*by)
    t = (per_feature.withColumn("_c", F.max(F.when(F.col(FEATURE) == ROWS, F.col("_a"))).over(w))
         .filter(F.col(FEATURE) != ROWS))
    n = F.col("n").cast("double")
    h_label = _bits_from_sums(F.col("n"), F.col("_c"))
    h_cond = F.greatest(F.lit(0.0), ratio(F.col("_b") - F.col("_a"), n) / LN2)
    h_feat = F.greatest(F.lit(0.0), F.ln(n) - ratio(F.col("_b"), n))
    out = t.select(
        *keys,
        F.col("n").cast("bigint").alias("n"),
        h_label.alias("label_entropy"),
        h_cond.alias("conditional_entropy"),
        h_feat.alias("feature_entropy"),
    ).withColumn("gain", F.col("label_entropy") - F.col("conditional_entropy")) \
     .withColumn("gain_compat", F.col("label_entropy") - F.col("feature_entropy"))
    if features is not None:
        out = out.withColumn("feature_pos", feature_positions(features))
    return out


def equal_width_edges(df: DataFrame, features) -> dict:
    """``{feature: (min, max)}`` for the numeric features (NaN ignored),
    from one aggregate job returning two numbers per feature."""
    numbers = [f for f in features if isinstance(df.schema[f].dataType, NumericType)]
    if not numbers:
        return {}
    aggs = []
    for f in numbers:
        x = F.col(f).cast("double")
        ok = F.when(~F.isnan(x), x)
        aggs += [F.min(ok).alias(f"lo_{f}"), F.max(ok).alias(f"hi_{f}")]
    row = df.agg(*aggs).first()
    return {f: (row[f"lo_{f}"], row[f"hi_{f}"]) for f in numbers}


def quantile_edges(df: DataFrame, features, bins: int) -> dict:
    """``{feature: [cut, ...]}`` for the numeric features: the approximate i/bins quantiles (NaN ignored, duplicates dropped), from one
    aggregate job returning bins - 1 numbers per feature."""
    numbers = [f for f in features if isinstance(df.schema[f].dataType, NumericType)]
    if not numbers or bins < 2:
        return {f: [] for f in numbers}
    probs = [i / bins for i in range(1, bins)]
    as_double = {f: F.col(f).cast("double") for f in numbers}
    aggs = [F.percentile_approx(F.when(~F.isnan(x), x), probs, 10000).alias(f"q_{f}") for f, x in as_double.items()]
    row = df.agg(*aggs).first()
    return {f: sorted({float(c) for c in (row[f"q_{f}"] or [])}) for f in numbers}


def bin_edges(df: DataFrame, features, bins: int, binning: str = "width") -> dict:
    """Edges for ``with_bins``: ``"width"`` (min, max) or ``"quantile"`` cuts."""
    if binning == "width":
        return equal_width_edges(df, features)
    if binning == "quantile":
        return quantile_edges(df, features, bins)
    raise ValueError("binning must be 'width' or 'quantile'")


def bin_column(x, edge, bins: int) -> Column:
    """Bin index (int; null for null or NaN).  ``edge = (min, max)``:
    equal width, ``floor((x - min) / ((max - min) / bins))`` clamped to
    [0, bins - 1].  ``edge = [cuts]``: number of cuts <= x (quantile bins;
    unrolled comparisons, no lambda)."""
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    valid = x.isNotNull() & ~F.isnan(x)
    if isinstance(edge, list):
        idx = F.lit(0)
        for c in edge:
            idx = idx + (x >= F.lit(c)).cast("int")
        return F.when(valid, idx).cast("int")
    lo, hi = edge
    if lo is None:
        b = F.lit(None)
    elif hi == lo:
        b = F.when(valid, F.lit(0))
    else:
        width = (hi - lo) / bins
        raw = F.floor((x - F.lit(float(lo))) / F.lit(width))
        b = F.when(valid, F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)))
    return b.cast("int")


def with_bins(df: DataFrame, edges: dict, bins: int) -> DataFrame:
    """Replace each feature in ``edges`` by its bin index (``bin_column``)."""
    cols = {f: bin_column(f, e, bins) for f, e in edges.items()}
    return df.withColumns(cols) if cols else df


def gain_report(df: DataFrame, features, label: str, by=(), bins: int | None = None,
                binning: str = "width") -> DataFrame:
    """All features scored from one histogram (one scan of ``df``).

    ``bins``: replace numeric features by equal-width bins first (one
    extra small job for their min/max), or quantile bins with
    ``binning="quantile"`` (one small job for bins - 1 cut points each).  A continuous feature otherwise has
    about one histogram cell per row; binned, the histogram is bounded by
    ``bins x classes`` cells per feature.  Default: exact values, as the
    reference."""
    if bins:
        df = with_bins(df, bin_edges(df, features, bins, binning), bins)
    return gain_table(value_terms(df, features, label, by), by, features)


def information_gain(df: DataFrame, feature: str, label: str, compat: bool = False) -> DataFrame:
    """Gain of one feature: one row ``feature, gain``."""
    rep = gain_report(df, [feature], label)
    return rep.select(FEATURE, F.col("gain_compat" if compat else "gain").alias("gain"))


def best_attribute(report: DataFrame, by=(), compat: bool = False, digits: int = 12) -> DataFrame:
    """Arg-max of gain per group; ties (gains equal to ``digits`` decimals,
    so float summation order cannot decide) go to the first listed
    feature: ``by.., best_attribute, gain``."""
    g = F.col("gain_compat" if compat else "gain")
    ranked = report.select(*by, FEATURE, "feature_pos", g.alias("_g"))
    key = F.struct(F.round("_g", digits), -F.col("feature_pos"))
    return ranked.groupBy(*by).agg(
        F.max_by(FEATURE, key).alias("best_attribute"), F.max_by("_g", key).alias("gain"))


# --------------------------------------------------------------------------
# class-conditional moments (naive Bayes statistics)


def class_means(df: DataFrame, features, label: str, truncate=()) -> DataFrame:
    """Per class: ``label, n, mean_<f>``; features in ``truncate`` get their
    mean truncated toward zero (the reference's ``toInt``)."""
    aggs = [_cnt().alias("n")]
    for f in features:
        m = F.avg(f)
        if f in truncate:
            m = trunc_int(m).cast("double")
        aggs.append(m.alias(f"mean_{f}"))
    return df.groupBy(label).agg(*aggs)


def class_deviation(df: DataFrame, features, label: str, truncate=()) -> DataFrame:
    """Per class: ``label, n, sd_<f>`` = sqrt(sum (x - c)^2 / n) about the
    centre c used by ``class_means`` (the mean, or its truncation).  One
    pass: sum (x-c)^2 / n = var_pop + (mean - c)^2."""
    aggs = [_cnt().alias("n")]
    for f in features:
        m = F.avg(f)
        spread = F.var_pop(f)
        if f in truncate:
            spread = spread + F.pow(m - trunc_int(m).cast("double"), 2)
        aggs.append(F.sqrt(spread).alias(f"sd_{f}"))
    return df.groupBy(label).agg(*aggs)


# --------------------------------------------------------------------------
# purity and leaf values (per group of rows, e.g. per tree node)


def is_pure(df: DataFrame, label: str, by=()) -> DataFrame:
    """``by.., n, is_pure`` with is_pure = 1 when the group holds exactly
    one label value (null counts as a value).  min/max/count only, so it
    aggregates map-side; no distinct aggregation."""
    nulls = F.count_if(F.col(label).isNull())
    n = _cnt()
    pure = ((nulls == 0) & (F.min(label) == F.max(label))) | ((nulls == n) & (n > 0))
    return df.groupBy(*by).agg(n.alias("n"), F.coalesce(pure, F.lit(False)).cast("int").alias("is_pure"))


def leaf_values(df: DataFrame, label: str, by=(), first_column: str | None = None) -> DataFrame:
    """Per group: ``n``, ``majority`` (most frequent label, ties to the
    smallest; in the label's own type), ``mean_label`` (null where the label is no number) and ``mean_first_column`` (the value the
    reference actually stores in its leaves).  One pass over the rows."""
    first = first_column or df.columns[0]
    number = F.col(label).try_cast("double")
    cells = df.groupBy(*by, label).agg(_cnt().alias("_n"), F.sum(F.col(first).try_cast("double")).alias("_f"))
    return cells.groupBy(*by).agg(
        F.sum("_n").alias("n"),
        F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias("majority"),
        ratio(F.sum(number * F.col("_n")), F.sum(F.when(number.isNotNull(), F.col("_n")))).alias("mean_label"),
        ratio(F.sum("_f"), F.sum("_n")).alias("mean_first_column"),
    )

"""Evaluation metrics.

Everything multi-class is read from one confusion aggregate
``(label, prediction) -> n`` (at most classes^2 rows, combined map-side), so
accuracy, weighted precision/recall/F1 cost one pass over the scored rows
instead of one job per metric.  Per-class totals are formed without a join:
each confusion cell contributes once under its label and once under its
prediction, and one aggregate sums them by class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.types import BooleanType, NumericType

from tablelearn.functions.columns import ratio


def _comparable(df: DataFrame, *columns: str):
    """The columns as doubles if all are numbers, else as text: classes may
    be of any type."""
    number = all(isinstance(df.schema[c].dataType, (NumericType, BooleanType)) for c in columns)
    return [F.col(c).cast("double" if number else "string") for c in columns]


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n``."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``class, n_label, n_pred, tp, precision, recall, f1`` per class."""
    conf = confusion(df, label, prediction)
    lab, pred = _comparable(df, label, prediction)
    hit = F.coalesce(lab == pred, F.lit(False))
    zero = F.lit(0).cast("bigint")
    cells = conf.select(F.explode(F.array(
        F.struct(lab.alias("cls"), F.col("n").alias("n_label"), zero.alias("n_pred"),
                 F.when(hit, F.col("n")).otherwise(zero).alias("tp")),
        F.struct(pred.alias("cls"), zero.alias("n_label"), F.col("n").alias("n_pred"), zero.alias("tp")),
    )).alias("c")).select("c.*")
    pc = cells.groupBy("cls").agg(F.sum("n_label").alias("n_label"), F.sum("n_pred").alias("n_pred"),
                                  F.sum("tp").alias("tp"))
    p = F.coalesce(ratio("tp", "n_pred"), F.lit(0.0))
    r = F.coalesce(ratio("tp", "n_label"), F.lit(0.0))
    f1 = F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return pc.select(F.col("cls").alias("class"), "n_label", "n_pred", "tp",
                     p.alias("precision"), r.alias("recall"), f1.alias("f1"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``n, accuracy, weighted_precision, weighted_recall,
    weighted_f1`` (fractions; weights = label share; null on empty input)."""
    pc = per_class(df, label, prediction)
    n = F.sum("n_label")
    return pc.agg(
        n.cast("bigint").alias("n"),
        ratio(F.sum("tp"), n).alias("accuracy"),
        ratio(F.sum(F.col("precision") * F.col("n_label")), n).alias("weighted_precision"),
        ratio(F.sum(F.col("recall") * F.col("n_label")), n).alias("weighted_recall"),
        ratio(F.sum(F.col("f1") * F.col("n_label")), n).alias("weighted_f1"),
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Fraction of rows with prediction == label: one row ``accuracy``."""
    a, b = _comparable(df, label, prediction)
    hit = F.coalesce(a == b, F.lit(False))
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"))


def accuracy_pct(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy in percent: one row ``accuracy_pct``."""
    return accuracy(df, label, prediction).select((F.col("accuracy") * 100.0).alias("accuracy_pct"))


def precision_pct(df: DataFrame, label: str = "label", prediction: str = "prediction",
                  positive: float = 1.0) -> DataFrame:
    """Positive-class precision in percent; 0.0 when nothing is predicted
    positive: one row ``precision_pct``."""
    pp = F.col(prediction).cast("double") == positive
    tp = pp & (F.col(label).cast("double") == positive)
    agg = df.agg(F.count_if(tp).alias("_tp"), F.count_if(pp).alias("_pp"))
    return agg.select(F.when(F.col("_pp") == 0, F.lit(0.0))
                      .otherwise(ratio("_tp", "_pp") * 100.0).alias("precision_pct"))


def area_under_roc(df: DataFrame, label: str = "label", score: str = "score",
                   buckets: int | None = None) -> DataFrame:
    """Exact area under ROC (ties count one half), i.e. the Mann-Whitney
    statistic over distinct scores.  One row: ``area_under_roc, n_pos,
    n_neg``.  Rows with a null score or label are ignored.

    Infinite scores are ordinary scores; NaN scores rank above all others
    and tie with each other.

    Scale: scores are aggregated to ``score -> (pos, neg)`` and sorted into
    ranges (``buckets`` of them, by default as many as the session shuffles
    to).  A running count inside each range gives the pairs decided there; a
    positive also beats all negatives of lower ranges, for which three
    numbers a range are enough.  One chain of exchanges: nothing runs or is
    written while the result is built, and no window holds all rows.
    """
    pos = F.col(label).cast("double") == 1.0
    rows = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    per_score = rows.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count_if(pos).alias("pos"), F.count_if(~pos).alias("neg"))
    ranges = (per_score.repartitionByRange(buckets, "_s") if buckets else per_score.repartitionByRange("_s"))
    ranges = ranges.withColumn("_range", F.spark_partition_id())
    lower = Window.partitionBy("_range").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("pos") * (F.coalesce(F.sum("neg").over(lower), F.lit(0)) + F.col("neg") * 0.5)
    per_range = ranges.select("_range", "pos", "neg", won.alias("_won")).groupBy("_range").agg(
        F.sum("_won").alias("_won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # one row a range: bounded by the number of partitions
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    agg = per_range.withColumn("_before", F.coalesce(F.sum("neg").over(before), F.lit(0))).agg(
        F.sum(F.col("_won") + F.col("pos") * F.col("_before")).alias("_u"), F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"))
    return agg.select(
        ratio(F.col("_u"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("area_under_roc"),
        F.coalesce(F.col("n_pos"), F.lit(0)).cast("bigint").alias("n_pos"),
        F.coalesce(F.col("n_neg"), F.lit(0)).cast("bigint").alias("n_neg"),
    )

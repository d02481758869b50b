"""Gaussian naive Bayes.

``fit`` is one ``groupBy(class).agg(...)`` over the training rows (count,
mean and spread of every feature at once, combined map-side).  The model it
returns has classes x features numbers, independent of the data size, so it
is brought to the driver and ``predict`` inlines the parameters as literals:
scoring is a narrow projection inside whole-stage codegen, with no join.

``compat=True`` reproduces what the reference executes: centres of the
``truncate`` features are truncated to int, the spread about the centre is
the standard deviation and it is used where the density expects a variance,
log(0) is -inf and a NaN score predicts class 0.  The default mode uses the
mean, the population variance (floored at ``var_floor``) and the analytic
log density, which cannot underflow.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.functions.columns import (
    gaussian_log_density,
    gaussian_log_density_compat,
    ratio,
    trunc_int,
)
from tablelearn.operators.split import hash_split
from tablelearn.plans.shaping import cut_lineage

import math


def gaussian_nb_table(df: DataFrame, features, label: str, classes=(0, 1), compat: bool = False,
                      truncate=()) -> DataFrame:
    """Model table, one row per present class: ``label, n, prior,
    mean_<f>, var_<f>`` (default) or ``label, n, prior, mean_<f>, sd_<f>``
    (compat; ``truncate`` features get truncated centres)."""
    base = df.select(trunc_int(label).alias("label"), *features).filter(F.col("label").isin(*classes))
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in features:
        m = F.avg(f)
        if compat and f in truncate:
            centre = trunc_int(m).cast("double")
            aggs.append(centre.alias(f"mean_{f}"))
            aggs.append(F.sqrt(F.var_pop(f) + F.pow(m - centre, 2)).alias(f"sd_{f}"))
        elif compat:
            aggs.append(m.alias(f"mean_{f}"))
            aggs.append(F.stddev_pop(f).alias(f"sd_{f}"))
        else:
            aggs.append(m.alias(f"mean_{f}"))
            aggs.append(F.var_pop(f).alias(f"var_{f}"))
    grouped = base.groupBy("label").agg(*aggs)
    # at most len(classes) rows: the global window is over a bounded table
    prior = ratio(F.col("n"), F.sum("n").over(Window.partitionBy()))
    spread = "sd" if compat else "var"
    cols = ["label", "n", prior.alias("prior")]
    for f in features:
        cols += [f"mean_{f}", f"{spread}_{f}"]
    return grouped.select(*cols)


@dataclass
class GaussianNBModel:
    features: list
    compat: bool
    var_floor: float
    params: dict = field(default_factory=dict)   # class -> (prior, [mean], [spread])
    counts: dict = field(default_factory=dict)   # class -> training rows
    table: DataFrame | None = None

    @property
    def classes(self):
        return sorted(self.params)

    def class_score(self, c) -> Column:
        prior, means, spreads = self.params[c]
        total = F.lit(math.log(prior) if prior > 0 else float("-inf"))
        for f, m, s in zip(self.features, means, spreads):
            if self.compat:
                term = gaussian_log_density_compat(F.col(f).cast("double"), F.lit(m), F.lit(s))
            else:
                v = max(s if s is not None else 0.0, self.var_floor)
                term = gaussian_log_density(F.col(f).cast("double"), F.lit(m), F.lit(v))
            total = total + term
        return total


def gaussian_nb_fit(df: DataFrame, features, label: str, classes=(0, 1), compat: bool = False,
                    truncate=(), var_floor: float = 1e-9) -> GaussianNBModel:
    """Fit (one aggregation job); the returned model keeps its table too."""
    features = list(features)
    table = gaussian_nb_table(df, features, label, classes, compat, truncate)
    spread = "sd" if compat else "var"
    params, counts = {}, {}
    for r in table.collect():   # one row per class
        counts[int(r["label"])] = int(r["n"])
        params[int(r["label"])] = (
            float(r["prior"]),
            [float(r[f"mean_{f}"]) if r[f"mean_{f}"] is not None else float("nan") for f in features],
            [float(r[f"{spread}_{f}"]) if r[f"{spread}_{f}"] is not None else 0.0 for f in features],
        )
    return GaussianNBModel(features, compat, var_floor, params, counts, table)


def _jvm_greater(a: Column, b: Column) -> Column:
    # JVM '>' is false when either side is NaN; Spark orders NaN above all.
    return ~F.isnan(a) & ~F.isnan(b) & F.coalesce(a > b, F.lit(False))


def gaussian_nb_predict(model: GaussianNBModel, df: DataFrame, keep_scores: bool = True) -> DataFrame:
    """Append ``score_<class>`` (log prior + sum of log densities) and
    ``prediction`` (double).  Classes are visited in ascending order and a
    later class wins only with a strictly greater score, so ties and NaN go
    to the lowest class, as in the reference's binary rule."""
    classes = model.classes
    if not classes:
        return df.withColumn("prediction", F.lit(None).cast("double"))
    scores = {c: model.class_score(c) for c in classes}
    out = df.select("*", *[scores[c].alias(f"score_{c}") for c in classes])
    best_c = F.lit(float(classes[0]))
    best_s = F.col(f"score_{classes[0]}")
    for c in classes[1:]:
        s = F.col(f"score_{c}")
        win = _jvm_greater(s, best_s)
        best_c = F.when(win, F.lit(float(c))).otherwise(best_c)
        best_s = F.when(win, s).otherwise(best_s)
    out = out.withColumn("prediction", best_c)
    if not keep_scores:
        out = out.drop(*[f"score_{c}" for c in classes])
    return out


def gaussian_nb_end_to_end(df: DataFrame, features, label: str, key_cols, weights=(0.9, 0.1), seed: int = 6151,
                         compat: bool = False, truncate=(), var_floor: float = 1e-9) -> DataFrame:
    """Split by key hash -> fit on side 0 -> score side 1 -> one report row:
    ``n_train, n_test, accuracy_pct, precision_pct``.

    The input is read once: its key, features and label (not the wide
    source columns, e.g. document text) are written to the checkpoint
    directory, and the fit and the scoring both read that table."""
    cols = list(dict.fromkeys([*key_cols, *features, label]))
    tagged = cut_lineage(hash_split(df.select(*cols), key_cols, weights, seed), "nb-input")
    model = gaussian_nb_fit(tagged.filter(F.col("split") == 0), features, label, compat=compat,
                            truncate=truncate, var_floor=var_floor)
    scored = gaussian_nb_predict(model, tagged.filter(F.col("split") == 1), keep_scores=False)
    y = F.col(label).cast("double")
    p = F.col("prediction")
    hit = F.coalesce(p == y, F.lit(False))
    agg = scored.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg(hit.cast("double")).alias("_acc"),
        F.count_if((p == 1.0) & (y == 1.0)).alias("_tp"),
        F.count_if(p == 1.0).alias("_pp"),
    )
    n_train = sum(model.counts.values())
    return agg.select(
        F.lit(n_train).cast("bigint").alias("n_train"),
        "n_test",
        (F.col("_acc") * 100.0).alias("accuracy_pct"),
        F.when(F.col("_pp") == 0, F.lit(0.0)).otherwise(ratio("_tp", "_pp") * 100.0).alias("precision_pct"),
    )

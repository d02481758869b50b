"""Threshold gain from sketches against plain counting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tablelearn.operators import thresholds


def entropy(ys):
    n = len(ys)
    return -sum(c / n * math.log2(c / n) for c in (ys.count(y) for y in set(ys))) if n else 0.0


def gain(rows, cut):
    low, high = [y for x, y in rows if x < cut], [y for x, y in rows if x >= cut]
    n = len(rows)
    return entropy([y for _, y in rows]) - len(low) / n * entropy(low) - len(high) / n * entropy(high)


@pytest.fixture(scope="module")
def noisy():
    rng = random.Random(8)
    rows = []
    for _ in range(20000):
        x = rng.lognormvariate(0, 1.5)
        rows.append((x, int(x > 1.7) if rng.random() < 0.8 else rng.randint(0, 2)))
    return rows


def test_every_cut_counts_like_brute_force(spark, noisy):
    rows = noisy[:1500]
    df = spark.createDataFrame([(x, float("nan") if k % 50 == 0 else x, None, y) for k, (x, y) in enumerate(rows)],
                               "a double, b double, c double, y int")
    cuts = thresholds.cut_points(thresholds.feature_sketches(df, ["a", "b", "c"]), ["a", "b", "c"], 16)
    assert cuts["c"] == [] and 10 <= len(cuts["a"]) <= 15
    got = thresholds.threshold_report(df, ["a", "b", "c"], "y", cuts).collect()
    assert {r["feature"] for r in got} == {"a", "b"} and len(got) == len(cuts["a"]) + len(cuts["b"])
    for r in got:
        data = [(x, y) for k, (x, y) in enumerate(rows) if r["feature"] == "a" or k % 50]
        assert r["n"] == len(data) and r["n_below"] == sum(x < r["threshold"] for x, _ in data)
        assert abs(r["gain"] - gain(data, r["threshold"])) < 1e-9


def test_the_best_cut_is_within_the_sketchs_error_of_the_exact_one(spark, noisy):
    bins = 64
    df = spark.createDataFrame(noisy, "x double, y int").repartition(7)
    best = thresholds.best_thresholds(thresholds.sketched_thresholds(df, ["x"], "y", bins)).first()
    xs = sorted(x for x, _ in noisy)
    exact = max((xs[k] for k in range(50, len(xs), 50)), key=lambda c: gain(noisy, c))
    # a cut is at most a bin and the sketch's error away from the best place
    rank = lambda c: sum(x < c for x in xs) / len(xs)
    assert abs(rank(best["threshold"]) - rank(exact)) <= 1 / bins + 2 * 2.3 / thresholds.SKETCH
    assert gain(noisy, exact) - best["gain"] < 0.02


def test_sketches_of_parts_merge(spark, noisy):
    df = spark.createDataFrame(noisy, "x double, y int")
    parts = thresholds.feature_sketches(df.withColumn("part", F.col("y") % 3), ["x"], ["part"])
    assert parts.count() == 3
    cuts = thresholds.cut_points(thresholds.merge_sketches(parts, ["x"]), ["x"], 10)["x"]
    xs = sorted(x for x, _ in noisy)
    assert all(abs(sum(x < c for x in xs) / len(xs) - (k + 1) / 10) < 2.3 / thresholds.SKETCH + 1e-4
               for k, c in enumerate(cuts))


def test_shuffled_rows_do_not_grow_with_distinct_values(spark):
    def shuffled(values):
        df = spark.range(0, 40000, 1, 4).select((F.col("id") * 7919 % values).cast("double").alias("x"),
                                                (F.col("id") % 2).cast("int").alias("y"))
        out = thresholds.sketched_thresholds(df, ["x"], "y")
        out.collect()
        plan, total = [out._jdf.queryExecution().executedPlan()], 0
        while plan:
            node = plan.pop()
            name = node.nodeName()
            if name.startswith("AdaptiveSparkPlan"):
                plan.append(node.executedPlan())
            elif "QueryStage" in name:
                plan.append(node.plan())
            else:
                if name == "Exchange":
                    total += node.metrics().apply("shuffleRecordsWritten").value()
                children = node.children()
                plan += [children.apply(i) for i in range(children.size())]
        return total

    few, many = shuffled(64), shuffled(40000)
    assert 0 < many <= few * 1.2 and many < 4 * 32 * 2 * 5


def test_empty_and_constant_features(spark):
    df = spark.createDataFrame([(1.0, None, 0), (1.0, None, 1)], "a double, b double, y int")
    assert thresholds.sketched_thresholds(df, ["a", "b"], "y").count() == 0
    assert thresholds.sketched_thresholds(df.limit(0), ["a", "b"], "y").count() == 0
    assert thresholds.width_cuts(df, ["a", "b"]) == {"a": [], "b": []}
    with pytest.raises(ValueError):
        thresholds.feature_sketches(df.withColumn("t", F.lit("x")), ["t"])

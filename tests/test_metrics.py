import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from tablelearn.operators import metrics
from tablelearn.sources import derived


def test_report_matches_mllib(spark):
    rows = derived.load_view(spark, "/root/testdata/sf0.01", "metrics")
    rep = metrics.classification_report(rows).collect()[0]
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for ours, name in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                       ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        assert rep[ours] == pytest.approx(ev.setMetricName(name).evaluate(rows), abs=1e-12)
    assert rep["weighted_recall"] == pytest.approx(rep["accuracy"])


def test_auc_matches_mllib_exact(spark):
    rows = derived.load_view(spark, "/root/testdata/sf0.01", "metrics")
    ours = metrics.area_under_roc(rows, buckets=7).collect()[0]["area_under_roc"]
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert ours == pytest.approx(ev.evaluate(rows), abs=1e-12)


def test_auc_bucket_count_does_not_matter(spark):
    rows = derived.load_view(spark, "/root/testdata/sf0.01", "metrics")
    vals = {round(metrics.area_under_roc(rows, buckets=b).collect()[0]["area_under_roc"], 12) for b in (1, 3, 16)}
    assert len(vals) == 1


def test_auc_all_tied(spark):  # B18
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5), (1.0, 0.5), (0.0, 0.5)], "label double, score double")
    assert metrics.area_under_roc(df).collect()[0]["area_under_roc"] == pytest.approx(0.5)


@pytest.mark.parametrize("buckets", [None, 1, 2, 3, 9])
def test_auc_of_extreme_scores(spark, buckets):
    inf, nan = float("inf"), float("nan")
    rows = [(1.0, inf), (0.0, -inf), (1.0, -inf), (0.0, 0.5), (1.0, 0.5), (0.0, inf), (1.0, nan), (0.0, 2.0)]
    rank = {-inf: 0, 0.5: 1, 2.0: 2, inf: 3}
    at = lambda s: 4 if s != s else rank[s]
    pairs = [(at(a), at(b)) for y, a in rows if y for z, b in rows if not z]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    df = spark.createDataFrame(rows, "label double, score double")
    assert metrics.area_under_roc(df, buckets=buckets).first()["area_under_roc"] == pytest.approx(want)


def test_report_of_text_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), (None, "a")], "label string, prediction string")
    assert metrics.classification_report(df).first()["accuracy"] == pytest.approx(0.5)


def test_precision_no_predicted_positive(spark):  # B14
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    assert metrics.precision_pct(df).collect()[0]["precision_pct"] == 0.0
    assert metrics.accuracy_pct(df).collect()[0]["accuracy_pct"] == pytest.approx(50.0)


def test_empty_metrics_are_null(spark):  # B8
    df = spark.createDataFrame([], "label double, prediction double")
    rep = metrics.classification_report(df).collect()[0]
    assert rep["accuracy"] is None and rep["weighted_f1"] is None


def test_nothing_runs_while_the_area_is_built(spark):
    df = spark.range(1000).selectExpr("cast(id % 2 as double) as label", "cast(id * 7 % 101 as double) as score")
    tracker, group = spark.sparkContext.statusTracker(), "area-under-roc-test"
    spark.sparkContext.setJobGroup(group, "test")
    try:
        out = metrics.area_under_roc(df, buckets=5)
        assert not tracker.getJobIdsForGroup(group)
        assert out.first()["n_pos"] == 500 and tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.clearJobGroup()

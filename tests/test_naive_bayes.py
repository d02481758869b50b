import math

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablelearn.operators import naive_bayes as nb
from tablelearn.sources import derived


def test_density_matches_formula(spark):
    from tablelearn.functions.columns import gaussian_density, gaussian_log_density
    df = spark.createDataFrame([(1.5,)], "x double")
    r = df.select(gaussian_density("x", F.lit(1.0), F.lit(2.0)).alias("d"),
                  gaussian_log_density("x", F.lit(1.0), F.lit(2.0)).alias("l")).collect()[0]
    exp = math.exp(-(0.5 ** 2) / 4) / math.sqrt(4 * math.pi)
    assert r["d"] == pytest.approx(exp)
    assert r["l"] == pytest.approx(math.log(exp))


def _toy(spark):
    rows = [(1.0, 10.0, 1), (2.0, 11.0, 1), (3.0, 12.0, 1), (10.0, 1.0, 0), (11.0, 2.0, 0), (12.0, 2.5, 0)]
    return spark.createDataFrame(rows, "a double, b double, y int")


def test_fit_predict_separable(spark):
    df = _toy(spark)
    m = nb.gaussian_nb_fit(df, ["a", "b"], "y")
    assert sorted(m.params) == [0, 1]
    assert m.params[1][0] == pytest.approx(0.5)
    out = nb.gaussian_nb_predict(m, df).collect()
    assert all(r["prediction"] == r["y"] for r in out)


def test_zero_variance(spark):  # B13
    rows = [(1.0, 5.0, 1), (2.0, 5.0, 1), (10.0, 5.0, 0), (11.0, 5.0, 0)]
    df = spark.createDataFrame(rows, "a double, c double, y int")
    compat = nb.gaussian_nb_fit(df, ["a", "c"], "y", compat=True)
    assert all(r["prediction"] == 0.0 for r in nb.gaussian_nb_predict(compat, df).collect())
    default = nb.gaussian_nb_fit(df, ["a", "c"], "y")
    out = nb.gaussian_nb_predict(default, df).collect()
    assert [r["prediction"] for r in out] == [1.0, 1.0, 0.0, 0.0]


def test_single_class_predicts_it(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "a double, y int")
    m = nb.gaussian_nb_fit(df, ["a"], "y")
    assert {r["prediction"] for r in nb.gaussian_nb_predict(m, df).collect()} == {1.0}


def test_means_and_variances_match_mllib(spark):
    docs = derived.load_view(spark, "/root/testdata/sf0.01", "doc_labels")
    feats = list(derived.DOC_FEATURES)
    table = {r["label"]: r for r in nb.gaussian_nb_table(docs, feats, "label").collect()}
    vec = VectorAssembler(inputCols=feats, outputCol="features").transform(docs.withColumn("label", F.col("label").cast("double")))
    model = NaiveBayes(modelType="gaussian", featuresCol="features", labelCol="label").fit(vec)
    theta = model.theta.toArray()
    sigma = model.sigma.toArray()
    # MLlib adds 1e-9 * (largest feature variance) to every variance
    boost = 1e-9 * max(max(table[c][f"var_{f}"] for f in feats) for c in (0, 1))
    for i, c in enumerate([0, 1]):
        for j, f in enumerate(feats):
            assert table[c][f"mean_{f}"] == pytest.approx(theta[i][j], rel=1e-9)
            assert table[c][f"var_{f}"] == pytest.approx(sigma[i][j], rel=1e-9, abs=2 * boost)


def test_end_to_end_report(spark):
    docs = derived.load_view(spark, "/root/testdata/sf0.01", "doc_labels")
    r = nb.gaussian_nb_end_to_end(docs, list(derived.DOC_FEATURES), "label", ["doc_id"]).collect()[0]
    assert r["n_train"] + r["n_test"] == docs.count()
    assert 0 <= r["accuracy_pct"] <= 100 and 0 <= r["precision_pct"] <= 100

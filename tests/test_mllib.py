from pyspark.sql import functions as F

from tablelearn.operators import mllib
from tablelearn.sources import derived, text


def test_named_debug_string_whole_numbers():
    names = [f"f{i}" for i in range(12)]
    s = "If (feature 1 <= 0.5)\n If (feature 10 <= 2.0)\n  Predict: 1.0"
    out = mllib.named_debug_string(s, names)
    assert "f1 <= 0.5" in out and "f10 <= 2.0" in out and "feature" not in out


def test_debug_tree_expression_reproduces_mllib(spark):
    view = derived.load_view(spark, "/root/testdata/sf0.01", "injury")
    feats = list(text.INJURY_FEATURES)
    model = mllib.tree_estimator(feats, text.INJURY_LABEL, seed=1).fit(view)
    tree = model.stages[-1]
    scored = model.transform(view).withColumn(
        "ours", mllib.tree_expression(mllib.parse_debug_tree(tree.toDebugString), feats))
    assert scored.filter(F.col("ours") != F.col("prediction")).count() == 0
    nodes = mllib.tree_nodes(model, spark)
    assert nodes.count() == tree.numNodes


def test_published_tree_parses():
    tree = mllib.parse_debug_tree(mllib.PUBLISHED_TREE)

    def leaves_splits(t):
        if t[0] == "leaf":
            return 1, 0
        l1, s1 = leaves_splits(t[4])
        l2, s2 = leaves_splits(t[5])
        return l1 + l2, s1 + s2 + 1

    assert leaves_splits(tree) == (27, 26)


def test_label_index_table_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    rows = [("b",), ("a",), ("c",), ("b",), ("a",), ("d",), ("d",), ("d",)]
    df = spark.createDataFrame(rows, "y string")
    ours = {r["label_value"]: r["label_index"] for r in mllib.label_index_table(df, "y").collect()}
    model = StringIndexer(inputCol="y", outputCol="i").fit(df)
    theirs = {v: float(i) for i, v in enumerate(model.labels)}
    assert ours == theirs == {"d": 0.0, "a": 1.0, "b": 2.0, "c": 3.0}


def test_paths_routes_and_statistics_of_a_fitted_tree(spark):
    import math
    rows = [(float(i % 17), float(i * 7 % 23), int((i % 17 > 8) != (i * 7 % 23 > 11))) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    model = mllib.tree_estimator(["a", "b"], "y", max_depth=3).fit(df)
    nodes = mllib.tree_nodes(model, spark)
    depth = model.stages[-1].depth
    paths = mllib.tree_paths(nodes, ["a", "b"], depth).collect()
    assert len(paths) == model.stages[-1].numNodes and all(len(r["path"]) == r["depth"] + 1 for r in paths)
    dump = mllib.dump_rules(mllib.named_debug_string(model.stages[-1].toDebugString, ["a", "b"]))
    assert sorted((r["rule"], r["prediction"]) for r in paths if r["is_leaf"]) == sorted(dump)
    scored = model.transform(df)
    routed = mllib.route(scored, nodes, ["a", "b"]).join(
        nodes.select(F.col("id").alias("node"), F.col("prediction").alias("of_node")), "node")
    assert routed.filter("prediction <> of_node").count() == 0 and routed.count() == 500
    stored = {r["id"]: r for r in nodes.collect()}
    for r in mllib.node_statistics(scored, nodes, ["a", "b"], "label", depth).collect():
        assert math.isclose(r["impurity"], stored[r["id"]]["impurity"], abs_tol=1e-9)
        assert r["gain"] is None or math.isclose(r["gain"], stored[r["id"]]["gain"], abs_tol=1e-9)

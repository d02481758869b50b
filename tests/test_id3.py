from pyspark.sql import functions as F

from tablelearn.operators import id3, stats


def test_unseen_value_falls_back(spark):  # B15
    train = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1), ("a", 1)], "f string, y int")
    model = id3.id3_build(train, ["f"], "y", max_depth=3)
    test = spark.createDataFrame([("a",), ("b",), ("c",)], "f string")
    pred = {r["f"]: r["prediction"] for r in id3.id3_predict(model, test).collect()}
    assert pred == {"a": 0.0, "b": 1.0, "c": 0.0}   # root majority for the unseen value


def test_pure_root_is_leaf(spark):
    train = spark.createDataFrame([("a", 1), ("b", 1)], "f string, y int")
    model = id3.id3_build(train, ["f"], "y", max_depth=5)
    nodes = model.node_table().collect()
    assert len(nodes) == 1 and nodes[0]["split_attribute"] is None and nodes[0]["is_pure"] == 1


def test_attribute_not_reused_and_no_features_left_is_leaf(spark):
    rows = [("x", "p", 0), ("x", "q", 1), ("y", "p", 1), ("y", "q", 0), ("x", "q", 0)]
    train = spark.createDataFrame(rows, "f string, g string, y int")
    model = id3.id3_build(train, ["f", "g"], "y", max_depth=7)
    nodes = model.node_table().collect()
    assert max(r["depth"] for r in nodes) == 2
    for r in nodes:
        if r["depth"] == 2:
            assert r["split_attribute"] is None
    rules = model.rules().collect()
    assert all(r["rule"].count(" AND ") <= 1 for r in rules)


def test_predict_invariant_to_partitioning(spark):
    rows = [(i % 4, (i * 3) % 5, (i * 7 % 11) % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, y int")
    model = id3.id3_build(df, ["a", "b"], "y", max_depth=2)
    p1 = id3.id3_predict(model, df.withColumn("id", F.monotonically_increasing_id()))
    base = p1.select("a", "b", "prediction").distinct()
    p2 = id3.id3_predict(model, df.repartition(5)).select("a", "b", "prediction").distinct()
    assert base.exceptAll(p2).count() == 0 and p2.exceptAll(base).count() == 0


def test_binned_tree_keeps_original_values(spark):
    rows = [(float(i), 0 if i < 50 else 1) for i in range(100)]
    train = spark.createDataFrame(rows, "x double, y int")
    model = id3.id3_build(train, ["x"], "y", max_depth=1, bins=2)
    assert model.edges == {"x": (0.0, 99.0)}
    nodes = model.node_table().collect()
    assert len(nodes) == 3                      # root + two bins, not one node per value
    test = spark.createDataFrame([(-5.0,), (10.0,), (60.0,), (500.0,)], "x double")
    out = {r["x"]: r["prediction"] for r in id3.id3_predict(model, test).collect()}
    assert out == {-5.0: 0.0, 10.0: 0.0, 60.0: 1.0, 500.0: 1.0}   # out-of-range values clamp to edge bins


def test_shuffle_join_path_equals_broadcast_path(spark):
    # one value holds a third of the rows: the hot node must not change results
    rows = [(i % 3 if i % 3 else 0, (i * 7) % 4, (i * 5 % 7) % 2) for i in range(600)]
    rows += [(9, 1, i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, y int")
    m1 = id3.id3_build(df, ["a", "b"], "y", max_depth=2)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        m2 = id3.id3_build(df.repartition(7), ["a", "b"], "y", max_depth=2)
        p2 = id3.id3_predict(m2, df).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    t1, t2 = m1.node_table(), m2.node_table()
    assert t1.exceptAll(t2).count() == 0 and t2.exceptAll(t1).count() == 0
    assert sorted(map(tuple, id3.id3_predict(m1, df).collect())) == sorted(map(tuple, p2))


def test_text_label(spark):
    train = spark.createDataFrame([("a", "yes"), ("a", "yes"), ("b", "no"), ("a", "no")], "f string, y string")
    model = id3.id3_build(train, ["f"], "y", max_depth=3)
    test = spark.createDataFrame([("a",), ("b",), ("c",)], "f string")
    assert [r["prediction"] for r in id3.id3_predict(model, test).orderBy("f").collect()] == ["yes", "no", "no"]


def test_empty_training_table(spark):
    train = spark.createDataFrame([], "f string, y int")
    model = id3.id3_build(train, ["f"], "y", max_depth=3)
    assert model.node_table().count() == 0
    assert id3.id3_predict(model, spark.createDataFrame([("a",)], "f string")).first()["prediction"] is None


def test_bins_bound_every_numeric_type(spark):
    df = spark.range(1000).selectExpr("cast(id as decimal(12,2)) as d", "cast(id as int) as i", "id % 2 as y")
    edges = stats.bin_edges(df, ["d", "i"], 4)
    binned = stats.with_bins(df, edges, 4)
    assert binned.select("d").distinct().count() == 4 and binned.select("i").distinct().count() == 4


def test_quantile_binned_tree(spark):
    rows = [(float(i * i), 0 if i < 200 else 1) for i in range(400)]
    train = spark.createDataFrame(rows, "x double, y int")
    model = id3.id3_build(train, ["x"], "y", max_depth=1, bins=2, binning="quantile")
    assert len(model.edges["x"]) == 1
    test = spark.createDataFrame([(0.0,), (150.0 ** 2,), (300.0 ** 2,)], "x double")
    out = [r["prediction"] for r in id3.id3_predict(model, test).orderBy("x").collect()]
    assert out == [0.0, 0.0, 1.0]


def test_many_classes_give_the_same_tree(spark, monkeypatch):
    rows = [(i % 4, (i * 3) % 5, "c%d" % ((i * 7 % 11) % 6) if i % 13 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, y string")
    wide = sorted(map(tuple, id3.id3_build(df, ["a", "b"], "y").node_table().collect()), key=str)
    monkeypatch.setattr(id3, "WIDE_CLASSES", 2)
    assert sorted(map(tuple, id3.id3_build(df, ["a", "b"], "y").node_table().collect()), key=str) == wide


def test_frontier_shrinks_and_a_level_has_one_join(spark, monkeypatch):
    rows = [((i * 5) % 2, (i * 3) % 7, i % 11, (i * 7 % 13) % 4 if i % 2 else 0) for i in range(900)]
    df = spark.createDataFrame(rows, "a int, b int, c int, y int")
    written, write = [], id3.cut_lineage

    def watched(frame, name):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        out = write(frame, name)
        written.append((name, sum(line.lstrip(" +-:").startswith("Join ") for line in plan.splitlines()), out.count()))
        return out

    monkeypatch.setattr(id3, "cut_lineage", watched)
    model = id3.id3_build(df, ["a", "b", "c"], "y")
    assert [n for name, n, _ in written if name == "id3-nodes"] == [0] * len(model.levels)
    assert [n for name, n, _ in written if name == "id3-cells"] == [0] + [1] * (len(model.levels) - 1)
    cells = [n for name, _, n in written if name == "id3-cells"]
    assert cells == sorted(cells, reverse=True) and cells[-1] < cells[0]


def test_rows_move_through_one_join(spark):
    df = spark.createDataFrame([(i % 3, i % 5, i % 2, "x" * 50) for i in range(200)], "a int, b int, y int, wide string")
    model = id3.id3_build(df, ["a", "b"], "y")
    out = id3.id3_predict(model, df)
    plan = out._jdf.queryExecution().optimizedPlan()

    def joins_with(node, column):
        below = node.children()
        found = [joins_with(below.apply(i), column) for i in range(below.size())]
        here = node.nodeName() == "Join" and any(
            a.name() == column for a in [node.output().apply(i) for i in range(node.output().size())])
        return here + sum(found)

    assert joins_with(plan, "wide") == 1


def test_null_and_text_values_are_different_tuples(spark):
    train = spark.createDataFrame([(None, "", 0), ("", None, 1), ("", "", 0), (None, None, 1)] * 3,
                                  "a string, b string, y int")
    model = id3.id3_build(train, ["a", "b"], "y")
    out = {(r["a"], r["b"]): r["prediction"] for r in id3.id3_predict(model, train).collect()}
    assert out == {(r["a"], r["b"]): float(r["y"]) for r in train.collect()}


def test_no_level_sorts_its_rows_to_aggregate_them(spark, monkeypatch):
    rows = [((i * 5) % 2, (i * 3) % 7, i % 11, (i * 7 % 13) % 4 if i % 2 else 0) for i in range(900)]
    df = spark.createDataFrame(rows, "a int, b int, c int, y int")
    plans, write = [], id3.cut_lineage

    def watched(frame, name):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(frame, name)

    monkeypatch.setattr(id3, "cut_lineage", watched)
    id3.id3_build(df, ["a", "b", "c"], "y")
    assert plans and not any("SortAggregate" in p for p in plans)


def test_nodes_of_every_size_give_the_same_tree(spark, monkeypatch):
    rows = [(f"a{i % 2}", (i * 3) % 7, i % 11, i % 90, (i * 7 % 13) % 4 if i % 5 else None) for i in range(900)]
    rows += [(None, i % 2, None, i, i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "a string, b int, c int, d int, y int")
    tree = lambda: sorted(map(tuple, id3.id3_build(df, ["a", "b", "c", "d"], "y", max_depth=3).node_table().collect()), key=str)
    whole = tree()
    for cells in (0, 12):           # all nodes are large, or some
        monkeypatch.setattr(id3, "NODE_CELLS", cells)
        monkeypatch.setattr(id3, "BROADCAST_NODES", 0)
        assert tree() == whole


def test_levels_of_few_nodes_do_not_move_the_tuples(spark):
    df = spark.createDataFrame([(i % 3, i % 5, i % 2) for i in range(200)], "a int, b int, y int")
    model = id3.id3_build(df, ["a", "b"], "y")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = id3.id3_predict(model, df)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("SortMergeJoin") == 1         # the rows meet their tuples
        assert sorted(r["prediction"] for r in out.collect())[:3] == [0.0] * 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)

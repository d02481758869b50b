"""MLlib model operators: label indexing, decision tree, logistic
regression, tree dumps, and scoring with a fixed (published) tree.

Fitting is MLlib's own distributed work; this module only assembles the
stages the reference used and turns model output into DataFrames.
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablelearn.functions.columns import LN2, xlogx
from tablelearn.session import scratch_path


# --------------------------------------------------------------------------
# label indexing


def label_index_table(df: DataFrame, column: str) -> DataFrame:
    """StringIndexer's ``frequencyDesc`` order as a table: the most
    frequent value gets index 0.0, ties by string order.  Nulls are not
    indexed.  ``label_value, n, label_index``.  The window runs over the
    per-value rows (bounded by the number of classes)."""
    counts = (df.select(F.col(column).cast("string").alias("label_value"))
              .filter(F.col("label_value").isNotNull())
              .groupBy("label_value").agg(F.count(F.lit(1)).alias("n")))
    w = Window.orderBy(F.col("n").desc(), F.col("label_value"))
    return counts.select("label_value", "n", (F.row_number().over(w) - 1).cast("double").alias("label_index"))


# --------------------------------------------------------------------------
# decision tree (entropy impurity) and logistic regression


def tree_estimator(features, label: str, max_depth: int = 5, max_bins: int = 32, seed: int | None = None,
                  handle_invalid: str = "error") -> Pipeline:
    """StringIndexer(label -> "label") + VectorAssembler + DecisionTree
    with entropy impurity; other parameters at MLlib defaults."""
    indexer = StringIndexer(inputCol=label, outputCol="label", handleInvalid=handle_invalid)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=handle_invalid)
    kw = {"seed": seed} if seed is not None else {}
    dt = DecisionTreeClassifier(labelCol="label", featuresCol="features", impurity="entropy",
                                maxDepth=max_depth, maxBins=max_bins, **kw)
    return Pipeline(stages=[indexer, assembler, dt])


def logistic_estimator(features, label: str, handle_invalid: str = "error") -> Pipeline:
    """VectorAssembler + LogisticRegression on the raw numeric label,
    MLlib defaults (maxIter 100, regParam 0, threshold 0.5)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=handle_invalid)
    lr = LogisticRegression(labelCol=label, featuresCol="features")
    return Pipeline(stages=[assembler, lr])


def tree_nodes(model: PipelineModel | object, spark: SparkSession | None = None) -> DataFrame:
    """The fitted tree as rows (one per node) by saving the model to the
    shared scratch folder and reading its node data back: ``id,
    prediction, impurity, gain, left_child, right_child, feature_index,
    threshold``."""
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    spark = spark or SparkSession.getActiveSession()
    path = scratch_path(spark, "tree")
    tree.write().overwrite().save(path)
    data = spark.read.parquet(path + "/data")
    return data.select(
        F.col("id").cast("int").alias("id"),
        "prediction", "impurity", "gain",
        F.col("leftChild").alias("left_child"),
        F.col("rightChild").alias("right_child"),
        F.col("split.featureIndex").alias("feature_index"),
        F.when(F.col("leftChild") >= 0, F.get(F.col("split.leftCategoriesOrThreshold"), 0)).alias("threshold"),
    )


_FEATURE_REF = re.compile(r"feature (\d+)\b")


def named_debug_string(debug: str, feature_names) -> str:
    """Replace ``feature i`` by the i-th name (whole numbers only, so
    ``feature 1`` never rewrites ``feature 10``)."""
    names = list(feature_names)
    return _FEATURE_REF.sub(lambda m: names[int(m.group(1))] if int(m.group(1)) < len(names) else m.group(0), debug)


def tree_rules(model, feature_names, spark: SparkSession | None = None) -> DataFrame:
    """The tree dump with feature names, one row per line: ``line_no,
    rule``.  Its size is bounded by the tree size, not the data."""
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    spark = spark or SparkSession.getActiveSession()
    text = named_debug_string(tree.toDebugString, feature_names)
    lines = [(i, ln) for i, ln in enumerate(text.splitlines()) if ln.strip()]
    return spark.createDataFrame(lines, "line_no int, rule string")


def tree_paths(nodes: DataFrame, feature_names, max_depth: int) -> DataFrame:
    """The root's way to every node, by joining the node table with the
    frontier once a level: ``id, path`` (ids from the root on), ``depth, rule,
    is_leaf, prediction``.  A rule is the conjunction of the tests on the way,
    in the words of the dump.  At most 2^(max_depth + 1) - 1 rows."""
    names = F.element_at(F.array(*[F.lit(f) for f in feature_names]), F.col("feature_index") + 1)
    node = nodes.select(
        "id", "prediction", (F.col("left_child") < 0).alias("is_leaf"), names.alias("_name"),
        F.col("threshold").cast("string").alias("_t"),
        F.array("left_child", "right_child").alias("_children"))
    frontier = node.filter("id = 0").select("*", F.array("id").alias("path"), F.lit(0).alias("depth"),
                                            F.lit("").alias("rule"))
    out = frontier
    for depth in range(1, max_depth + 1):
        sides = frontier.filter("not is_leaf").select(
            F.posexplode("_children").alias("_side", "_child"), F.col("path").alias("_way"), F.col("rule").alias("_rule"),
            F.concat(F.lit("("), "_name").alias("_test"), F.col("_t").alias("_edge"))
        test = F.concat("_test", F.when(F.col("_side") == 0, F.lit(" <= ")).otherwise(F.lit(" > ")), "_edge", F.lit(")"))
        rule = F.concat("_rule", F.when(F.col("_rule") == "", F.lit("")).otherwise(F.lit(" AND ")), test)
        frontier = node.join(sides, F.col("id") == F.col("_child")).select(
            *node.columns, F.concat("_way", F.array("id")).alias("path"), F.lit(depth).alias("depth"), rule.alias("rule"))
        out = out.unionByName(frontier)
    return out.select("id", "path", "depth", "rule", "is_leaf", "prediction")


def dump_rules(dump: str) -> list[tuple[str, float]]:
    """``(rule, prediction)`` of every leaf of a tree dump, read line by line:
    the tests that enclose a leaf are those of lesser indent."""
    out, open_ = [], []
    for line in dump.splitlines():
        indent, words = len(line) - len(line.lstrip()), line.strip()
        if words.startswith(("If ", "Else ", "Predict")):
            while open_ and open_[-1][0] >= indent:
                open_.pop()
            if words.startswith("Predict"):
                out.append((" AND ".join(t for _, t in open_), float(words.split(":")[1])))
            else:
                open_.append((indent, words.split(" ", 1)[1]))
    return out


def route(df: DataFrame, nodes: DataFrame, feature_names, output: str = "node") -> DataFrame:
    """Append the id of the leaf that each row reaches, as one expression made
    from the node table (its size is bounded by the tree's depth)."""
    table = {r["id"]: r for r in nodes.collect()}

    def at(i: int) -> Column:
        r = table[i]
        if r["left_child"] < 0:
            return F.lit(i)
        x = F.col(feature_names[r["feature_index"]]).cast("double")
        return F.when(x <= F.lit(r["threshold"]), at(r["left_child"])).otherwise(at(r["right_child"]))

    return df.withColumn(output, at(0)) if table else df.withColumn(output, F.lit(None).cast("int"))


def node_statistics(train: DataFrame, nodes: DataFrame, feature_names, label: str, max_depth: int) -> DataFrame:
    """The split statistics of every node, from the training rows themselves:
    ``id, n, impurity`` (bits), ``gain`` (null at a leaf), ``prediction``.

    Rows are counted once per (leaf, label); the counts are added along the
    leaf's path, so the rows are read once and every later table is bounded
    by the tree."""
    leaves = route(train, nodes, feature_names).groupBy("node", label).agg(F.count(F.lit(1)).alias("_n"))
    paths = tree_paths(nodes, feature_names, max_depth).filter("is_leaf").select("id", "path")
    counts = leaves.join(paths, F.col("node") == F.col("id")).select(
        F.explode("path").alias("id"), F.col(label).alias("_y"), "_n").groupBy("id", "_y").agg(F.sum("_n").alias("_n"))
    per_node = counts.groupBy("id").agg(
        F.sum("_n").alias("n"), F.sum(xlogx("_n")).alias("_s"),
        F.min_by("_y", F.struct(-F.col("_n"), F.col("_y"))).cast("double").alias("prediction"))
    rows = F.col("n").cast("double")
    own = per_node.select("id", "n", "prediction", F.greatest(
        F.lit(0.0), (F.ln(rows) - F.col("_s") / rows) / LN2).alias("impurity"))
    child = own.select(F.col("id").alias("_c"), (F.col("n") * F.col("impurity")).alias("_w"))
    sides = nodes.filter("left_child >= 0").select("id", F.explode(F.array("left_child", "right_child")).alias("_c"))
    below = sides.join(child, "_c").groupBy("id").agg(F.sum("_w").alias("_w"))
    return own.join(below, "id", "left").select(
        "id", "n", "impurity", (F.col("impurity") - F.col("_w") / F.col("n")).alias("gain"), "prediction")


def coefficient_rows(model) -> list[tuple[str, float]]:
    """``(term, coefficient)`` of a fitted logistic model, the intercept last."""
    lr = model.stages[-1] if isinstance(model, PipelineModel) else model
    names = model.stages[0].getInputCols()
    return [*((f, float(c)) for f, c in zip(names, lr.coefficients.toArray())), ("(intercept)", float(lr.intercept))]


def logistic_score(coefficients) -> Column:
    """The log odds of class 1 as a column made from coefficient rows."""
    out = F.lit(0.0)
    for term, c in coefficients:
        out = out + (F.lit(c) if term == "(intercept)" else F.lit(c) * F.col(term).cast("double"))
    return out


def probability_of(df: DataFrame, cls: int = 1, col: str = "probability") -> Column:
    return F.get(vector_to_array(F.col(col)), cls)


# --------------------------------------------------------------------------
# fixed tree in MLlib's debug-string format -> nested CASE expression

_IF = re.compile(r"^\s*If \(feature (\d+) (<=|>|in|not in) (.+)\)\s*$")
_ELSE = re.compile(r"^\s*Else \(feature (\d+) (<=|>|in|not in) (.+)\)\s*$")
_PREDICT = re.compile(r"^\s*Predict: ([-+0-9.eE]+)\s*$")


def parse_debug_tree(text: str):
    """Debug-string tree -> nested tuples ``("leaf", v)`` or
    ``("split", feature_index, op, operand, left, right)``."""
    lines = [ln for ln in text.splitlines() if ln.strip() and not ln.strip().startswith("DecisionTree")]
    pos = 0

    def node():
        nonlocal pos
        ln = lines[pos]
        m = _PREDICT.match(ln)
        if m:
            pos += 1
            return ("leaf", float(m.group(1)))
        m = _IF.match(ln)
        if not m:
            raise ValueError(f"unexpected tree line: {ln!r}")
        pos += 1
        left = node()
        if not _ELSE.match(lines[pos]):
            raise ValueError(f"expected Else at: {lines[pos]!r}")
        pos += 1
        right = node()
        op, operand = m.group(2), m.group(3)
        if op in ("in", "not in"):
            vals = tuple(float(v) for v in operand.strip("{} ").split(",") if v.strip())
            return ("split", int(m.group(1)), op, vals, left, right)
        return ("split", int(m.group(1)), op, float(operand), left, right)

    root = node()
    return root


def tree_expression(tree, feature_names) -> Column:
    """Nested ``when`` over named feature columns (JVM-side, codegen'd)."""
    if tree[0] == "leaf":
        return F.lit(tree[1])
    _, idx, op, operand, left, right = tree
    x = F.col(feature_names[idx]).cast("double")
    if op == "<=":
        cond = x <= F.lit(operand)
    elif op == ">":
        cond = x > F.lit(operand)
    elif op == "in":
        cond = x.isin(*operand)
    else:
        cond = ~x.isin(*operand)
    return F.when(cond, tree_expression(left, feature_names)).otherwise(tree_expression(right, feature_names))


def tree_sql(tree, feature_names) -> str:
    """The same tree as a SQL CASE expression (used by the DuckDB oracle)."""
    if tree[0] == "leaf":
        return f"CAST('{float(tree[1])!r}' AS DOUBLE)"
    _, idx, op, operand, left, right = tree
    x = f"CAST({feature_names[idx]} AS DOUBLE)"
    if op in ("<=", ">"):
        cond = f"{x} {op} CAST('{operand!r}' AS DOUBLE)"
    else:
        vals = ", ".join(f"CAST('{v!r}' AS DOUBLE)" for v in operand)
        cond = f"{x} {'IN' if op == 'in' else 'NOT IN'} ({vals})"
    return f"CASE WHEN {cond} THEN {tree_sql(left, feature_names)} ELSE {tree_sql(right, feature_names)} END"


# The decision tree published with the reference's results
# (MLlib, entropy impurity, depth 5, 26 splits / 27 leaves).  Features are,
# by index: 0 Player_Age, 1 Player_Weight, 2 Player_Height,
# 3 Previous_Injuries, 4 Training_Intensity, 5 Recovery_Time.  Leaf values
# are indexed labels.
PUBLISHED_TREE = """\
If (feature 4 <= 0.4428055261352174)
 If (feature 3 <= 0.5)
  If (feature 0 <= 20.5)
   If (feature 4 <= 0.08696018806092015)
    If (feature 1 <= 75.87258731060919)
     Predict: 0.0
    Else (feature 1 > 75.87258731060919)
     Predict: 1.0
   Else (feature 4 > 0.08696018806092015)
    If (feature 1 <= 78.98625347543621)
     Predict: 1.0
    Else (feature 1 > 78.98625347543621)
     Predict: 0.0
  Else (feature 0 > 20.5)
   If (feature 1 <= 85.89337423400617)
    Predict: 0.0
   Else (feature 1 > 85.89337423400617)
    If (feature 0 <= 35.5)
     Predict: 1.0
    Else (feature 0 > 35.5)
     Predict: 0.0
 Else (feature 3 > 0.5)
  If (feature 1 <= 64.62311127820573)
   If (feature 4 <= 0.2409178645324575)
    If (feature 2 <= 182.67273862371553)
     Predict: 1.0
    Else (feature 2 > 182.67273862371553)
     Predict: 0.0
   Else (feature 4 > 0.2409178645324575)
    Predict: 0.0
  Else (feature 1 > 64.62311127820573)
   If (feature 5 <= 1.5)
    If (feature 0 <= 25.5)
     Predict: 1.0
    Else (feature 0 > 25.5)
     Predict: 0.0
   Else (feature 5 > 1.5)
    If (feature 0 <= 25.5)
     Predict: 0.0
    Else (feature 0 > 25.5)
     Predict: 1.0
Else (feature 4 > 0.4428055261352174)
 If (feature 0 <= 24.5)
  If (feature 0 <= 23.5)
   If (feature 4 <= 0.7305597676528658)
    If (feature 2 <= 194.80550733510773)
     Predict: 0.0
    Else (feature 2 > 194.80550733510773)
     Predict: 1.0
   Else (feature 4 > 0.7305597676528658)
    If (feature 4 <= 0.8615552853602126)
     Predict: 1.0
    Else (feature 4 > 0.8615552853602126)
     Predict: 0.0
  Else (feature 0 > 23.5)
   If (feature 1 <= 72.55325606570747)
    Predict: 0.0
   Else (feature 1 > 72.55325606570747)
    If (feature 4 <= 0.5780834066838123)
     Predict: 1.0
    Else (feature 4 > 0.5780834066838123)
     Predict: 0.0
 Else (feature 0 > 24.5)
  If (feature 5 <= 5.5)
   If (feature 5 <= 1.5)
    Predict: 1.0
   Else (feature 5 > 1.5)
    If (feature 0 <= 33.5)
     Predict: 1.0
    Else (feature 0 > 33.5)
     Predict: 0.0
  Else (feature 5 > 5.5)
   If (feature 0 <= 30.5)
    If (feature 0 <= 26.5)
     Predict: 0.0
    Else (feature 0 > 26.5)
     Predict: 1.0
   Else (feature 0 > 30.5)
    Predict: 0.0
"""


def rule_tree_predict(df: DataFrame, feature_names, tree_text: str = PUBLISHED_TREE,
                      output: str = "prediction") -> DataFrame:
    """Score rows with a fixed tree given as a debug string."""
    tree = parse_debug_tree(tree_text)
    return df.withColumn(output, tree_expression(tree, list(feature_names)))

"""Named queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Every query reads whole tables (or views Spark derives from them).  Double
outputs are rounded to ``DIGITS`` decimals so the DuckDB oracle in
``plans/oracle.py`` compares equal despite float summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tablelearn.operators import filters, hands, id3, metrics, mllib, naive_bayes, split, stats, thresholds
from tablelearn.plans.shaping import cut_lineage
from tablelearn.session import scratch_path
from tablelearn.sources import derived, text
from tablelearn.sources.tables import read_table

DIGITS = 6

# Fixed parameters of the registered queries.
INJURY_FEATURES = list(text.INJURY_FEATURES)
INJURY_LABEL = text.INJURY_LABEL
INJURY_KEY = list(derived.LINEITEM_KEY)
INJURY_TRUNCATED = ["Player_Age", "Previous_Injuries", "Recovery_Time"]
CATEGORICAL_FEATURES = ["Player_Age", "Previous_Injuries", "Recovery_Time"]
DOC_FEATURES = list(derived.DOC_FEATURES)
SEED_90_10 = 6151
SEED_80_20 = 12345
SEED_70_30 = 42
ID3_DEPTH = 7
ID3_BINS = 4
DENSITY_MEAN, DENSITY_VAR = 70.0, 100.0


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (keeps names and order)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c, digits).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def _injury(spark, sf):
    return derived.load_view(spark, sf, "injury")


def _events(spark, sf):
    return derived.load_view(spark, sf, "events")


def _metric_rows(spark, sf):
    return derived.load_view(spark, sf, "metrics")


def _hands(spark, sf):
    return text.parse_hand_lines(derived.load_view(spark, sf, "hand_lines"), keep_cols=["hand_id"])


def _docs(spark, sf):
    return derived.load_view(spark, sf, "doc_labels")


# --------------------------------------------------------------------------
# sources


def _as_text_files(spark, lines: DataFrame, name: str) -> DataFrame:
    """The lines written as text files and read back by the text scan."""
    path = scratch_path(spark, name)
    lines.select("value").write.text(path)
    return text.read_text_lines(spark, path)


def q_parse_records(spark, sf):
    lines = derived.record_lines(_injury(spark, sf), text.INJURY_COLUMNS)
    return text.parse_records(_as_text_files(spark, lines, "record-lines"))


def q_parse_hands(spark, sf):
    lines = derived.hand_lines(read_table(spark, sf, "orders"), damaged=True)
    return text.parse_hand_lines(_as_text_files(spark, lines, "hand-lines"))


def _injury_csv(spark, sf, header: bool) -> str:
    path = scratch_path(spark, "injury-csv")
    _injury(spark, sf).select(*text.INJURY_COLUMNS).write.mode("overwrite").option("header", header).csv(path)
    return path


def q_scan_csv_schema(spark, sf):
    return rounded(text.read_csv_schema(spark, _injury_csv(spark, sf, header=False)))


def q_scan_csv_header(spark, sf):
    return rounded(text.read_csv_header(spark, _injury_csv(spark, sf, header=True)))


def q_scan_csv_positional(spark, sf):
    return rounded(text.read_csv_positional(spark, _injury_csv(spark, sf, header=False), text.INJURY_COLUMNS))


# --------------------------------------------------------------------------
# filters, joins, splits


def q_filter_complete_rows(spark, sf):
    return filters.filter_complete_rows(derived.events_with_gaps(read_table(spark, sf, "events")))


def q_class_partition(spark, sf):
    df = filters.class_partition(_injury(spark, sf), INJURY_LABEL, 1)
    return rounded(df.select(*INJURY_KEY, "Player_Age", "Player_Weight", INJURY_LABEL))


def q_split_by_value(spark, sf):
    df = filters.split_by_value(_injury(spark, sf), "Recovery_Time", 3)
    return df.select(*INJURY_KEY, "Player_Age", "Recovery_Time", INJURY_LABEL)


def q_attach_predictions(spark, sf):
    preds = _metric_rows(spark, sf).select("event_id", "prediction")
    rows = _events(spark, sf).select("event_id", "label")
    return filters.attach_predictions(rows, preds, "event_id")


def _split_query(weights, seed):
    def q(spark, sf):
        return split.hash_split(_events(spark, sf), ["event_id"], weights, seed).select("event_id", "split")
    return q


def q_random_split(spark, sf):
    return split.random_split(_events(spark, sf).select("event_id", "label"), [0.8, 0.2], SEED_80_20)


# --------------------------------------------------------------------------
# statistics


def q_class_counts(spark, sf):
    return stats.class_counts(read_table(spark, sf, "customer"), "c_mktsegment")


def q_class_probability(spark, sf):
    return rounded(stats.class_probability(_hands(spark, sf), "class"))


def q_class_priors(spark, sf):
    return rounded(stats.class_priors(_injury(spark, sf), INJURY_LABEL))


def q_feature_value_counts(spark, sf):
    return stats.feature_value_counts(_injury(spark, sf), CATEGORICAL_FEATURES + ["Training_Intensity"])


def q_value_probability(spark, sf):
    return rounded(stats.value_probability(_injury(spark, sf), CATEGORICAL_FEATURES))


def q_distinct_values(spark, sf):
    return stats.distinct_values(_injury(spark, sf), "Recovery_Time")


def q_label_entropy(spark, sf):
    return rounded(stats.entropy(_injury(spark, sf), INJURY_LABEL))


def q_information_gain(spark, sf):
    rep = stats.gain_report(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL)
    return rounded(rep.select("feature", "gain"))


def q_information_gain_compat(spark, sf):
    rep = stats.gain_report(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL)
    return rounded(rep.select("feature", F.col("gain_compat").alias("gain")))


def q_gain_report(spark, sf):
    return rounded(stats.gain_report(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL))


GAIN_BINS = 10


def q_gain_report_binned(spark, sf):
    return rounded(stats.gain_report(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL, bins=GAIN_BINS))


def q_gain_report_by_split(spark, sf):
    df = split.hash_split(_injury(spark, sf), INJURY_KEY, [0.7, 0.3], SEED_70_30)
    return rounded(stats.gain_report(df, INJURY_FEATURES, INJURY_LABEL, by=["split"]))


def q_best_attribute(spark, sf):
    rep = stats.gain_report(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL)
    return rounded(stats.best_attribute(rep))


def q_best_attribute_by_split(spark, sf):
    df = split.hash_split(_injury(spark, sf), INJURY_KEY, [0.7, 0.3], SEED_70_30)
    rep = stats.gain_report(df, INJURY_FEATURES, INJURY_LABEL, by=["split"])
    return rounded(stats.best_attribute(rep, by=["split"]))


def q_best_attribute_compat(spark, sf):
    rep = stats.gain_report(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL)
    return rounded(stats.best_attribute(rep, compat=True))


def q_last_column_label(spark, sf):
    """The table as it comes: its last column is the label."""
    df = _injury(spark, sf).select(*text.INJURY_COLUMNS)
    features, label = text.features_and_label(df)
    return rounded(stats.best_attribute(stats.gain_report(df, features, label)))


def q_threshold_gain_width(spark, sf):
    df = _injury(spark, sf)
    cuts = thresholds.width_cuts(df, INJURY_FEATURES)
    return rounded(thresholds.best_thresholds(thresholds.threshold_report(df, INJURY_FEATURES, INJURY_LABEL, cuts)))


def q_threshold_gain_sketch(spark, sf):
    report = thresholds.sketched_thresholds(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL)
    return rounded(thresholds.best_thresholds(report))


def q_threshold_gain_check(spark, sf):
    """Facts that hold for any sketch within its error: between two cuts lie
    no more rows than a bin's share and twice the error, and the best cuts'
    counts and gains are those of the rows themselves."""
    df, label = _injury(spark, sf), F.col(INJURY_LABEL)
    sketches = thresholds.feature_sketches(df, INJURY_FEATURES)
    cuts = thresholds.cut_points(sketches, INJURY_FEATURES)
    best = {r["feature"]: r for r in thresholds.best_thresholds(
        thresholds.threshold_report(df, INJURY_FEATURES, INJURY_LABEL, cuts)).collect()}
    share = 1 / thresholds.BINS + 2 * 2.3 / thresholds.SKETCH
    least = df.agg(*[F.min(F.col(f).cast("double")).alias(f) for f in INJURY_FEATURES]).first()
    out = None
    for f in INJURY_FEATURES:
        x = F.col(f).cast("double")
        on_cut = x.isin([least[f], *[float(c) for c in cuts[f]]])
        bins = df.filter(x.isNotNull()).select(thresholds._bin(x, cuts[f]).alias("bin"), on_cut.alias("at"),
                                               (x < best[f]["threshold"]).alias("below"), label.alias("y"))
        cells = bins.groupBy("bin", "at", "below", "y").agg(F.count(F.lit(1)).alias("k"))
        of = cells.groupBy("bin").agg(F.sum("k").alias("k"), F.sum(F.when(~F.col("at"), F.col("k"))).alias("inside"),
                                      F.sum(F.when(F.col("below"), F.col("k"))).alias("low"))
        one = of.agg(F.sum("k").alias("n"), F.collect_list("inside").alias("inside"), F.sum("low").alias("low"))
        one = one.select(F.lit(f).alias("feature"), "n",
                         F.size(F.filter("inside", lambda k: k > F.col("n") * share)).cast("long").alias("wide_bins"),
                         (F.col("low") != best[f]["n_below"]).cast("long").alias("miscounted"))
        out = one if out is None else out.unionByName(one)
    return out


def q_class_means(spark, sf):
    return rounded(stats.class_means(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL))


def q_class_means_compat(spark, sf):
    return rounded(stats.class_means(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL, truncate=INJURY_TRUNCATED))


def q_class_stddev(spark, sf):
    return rounded(stats.class_deviation(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL))


def q_class_stddev_compat(spark, sf):
    return rounded(stats.class_deviation(_injury(spark, sf), INJURY_FEATURES, INJURY_LABEL,
                                         truncate=INJURY_TRUNCATED))


def q_is_pure(spark, sf):
    return stats.is_pure(_events(spark, sf), "label", by=["user_id", "hour"])


def q_leaf_values_text(spark, sf):
    """A label that is text: the order status."""
    orders = read_table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus", "o_totalprice")
    return rounded(stats.leaf_values(orders, "o_orderstatus", by=["o_orderpriority"], first_column="o_totalprice"), 2)


def q_leaf_values(spark, sf):
    return rounded(stats.leaf_values(_events(spark, sf), "label", by=["user_id"], first_column="value"))


# --------------------------------------------------------------------------
# metrics


def q_accuracy(spark, sf):
    return rounded(metrics.accuracy(_metric_rows(spark, sf)))


def q_accuracy_pct(spark, sf):
    return rounded(metrics.accuracy_pct(_metric_rows(spark, sf)))


def q_precision_pct(spark, sf):
    return rounded(metrics.precision_pct(_metric_rows(spark, sf)))


def q_classification_report(spark, sf):
    return rounded(metrics.classification_report(_metric_rows(spark, sf)))


def _report_metric(name):
    def q(spark, sf):
        return rounded(metrics.classification_report(_metric_rows(spark, sf)).select(name))
    return q


def q_area_under_roc(spark, sf):
    return rounded(metrics.area_under_roc(_metric_rows(spark, sf)))


def q_area_under_roc_extremes(spark, sf):
    """Scores that include both infinities."""
    score = F.when(F.col("value") > 150, F.lit(float("inf"))).when(
        F.col("value") < 20, F.lit(float("-inf"))).otherwise(F.col("value"))
    rows = _events(spark, sf).select(score.alias("score"), F.col("label").cast("double").alias("label"))
    return rounded(metrics.area_under_roc(rows, buckets=8))


# --------------------------------------------------------------------------
# naive Bayes


def q_gaussian_density(spark, sf):
    from tablelearn.functions.columns import gaussian_density
    df = _injury(spark, sf)
    return rounded(df.select(*INJURY_KEY, gaussian_density(F.col("Player_Weight"), F.lit(DENSITY_MEAN),
                                                           F.lit(DENSITY_VAR)).alias("density")), 9)


def _doc_split(spark, sf):
    return split.hash_split(_docs(spark, sf), ["doc_id"], [0.9, 0.1], SEED_90_10)


def q_gaussian_nb_fit(spark, sf):
    train = _doc_split(spark, sf).filter(F.col("split") == 0)
    return rounded(naive_bayes.gaussian_nb_table(train, DOC_FEATURES, "label"))


def q_gaussian_nb_predict(spark, sf):
    # fit and scoring both read the split view: derive it from the documents
    # (text) once and read the small written table twice
    df = cut_lineage(_doc_split(spark, sf).select("doc_id", *DOC_FEATURES, "label", "split"), "nb-docs")
    model = naive_bayes.gaussian_nb_fit(df.filter(F.col("split") == 0), DOC_FEATURES, "label")
    scored = naive_bayes.gaussian_nb_predict(model, df.filter(F.col("split") == 1))
    return rounded(scored.select("doc_id", "label", "prediction", "score_0", "score_1"))


def q_gaussian_nb_predict_compat(spark, sf):
    # fit and scoring both read the split view: derive it once
    df = cut_lineage(split.hash_split(_injury(spark, sf), INJURY_KEY, [0.9, 0.1], SEED_90_10)
                     .select(*INJURY_KEY, *INJURY_FEATURES, INJURY_LABEL, "split"), "nb-injury")
    model = naive_bayes.gaussian_nb_fit(df.filter(F.col("split") == 0), INJURY_FEATURES, INJURY_LABEL,
                                        compat=True, truncate=INJURY_TRUNCATED)
    scored = naive_bayes.gaussian_nb_predict(model, df.filter(F.col("split") == 1), keep_scores=False)
    return scored.select(*INJURY_KEY, INJURY_LABEL, "prediction")


def q_gaussian_nb_end_to_end(spark, sf):
    return rounded(naive_bayes.gaussian_nb_end_to_end(_docs(spark, sf), DOC_FEATURES, "label", ["doc_id"],
                                                    [0.9, 0.1], SEED_90_10))


# --------------------------------------------------------------------------
# MLlib


def q_index_label(spark, sf):
    return mllib.label_index_table(_injury(spark, sf), INJURY_LABEL)


def _injury_split(spark, sf, weights, seed):
    return split.hash_split(_injury(spark, sf), INJURY_KEY, weights, seed)


def _written_split(spark, sf, weights, seed):
    """The split view as a narrow written table: fits read it many times."""
    return cut_lineage(_injury_split(spark, sf, weights, seed).select(
        *INJURY_KEY, *INJURY_FEATURES, INJURY_LABEL, "split"), "split-view")


def _tree_model(spark, sf):
    df = _written_split(spark, sf, [0.7, 0.3], SEED_70_30)
    model = mllib.tree_estimator(INJURY_FEATURES, INJURY_LABEL, seed=SEED_70_30).fit(df.filter(F.col("split") == 0))
    return df, model


def q_mllib_tree_fit(spark, sf):
    _, model = _tree_model(spark, sf)
    return mllib.tree_nodes(model, spark)


def q_mllib_tree_predict(spark, sf):
    df, model = _tree_model(spark, sf)
    pred = model.transform(df.filter(F.col("split") == 1))
    return pred.select(*INJURY_KEY, "label", "prediction")


def q_mllib_tree_check(spark, sf):
    """Facts about the fitted tree that hold for any fit: its predictions
    equal a walk of its dump by columns, and every test row gets one."""
    df, model = _tree_model(spark, sf)
    dump = mllib.rule_tree_predict(df, INJURY_FEATURES, model.stages[-1].toDebugString, "_walked")
    pred = model.transform(dump)
    return pred.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") != F.col("_walked")).alias("disagreements"),
        F.count_if(F.col("prediction").isNull()).alias("without_prediction"))


def q_mllib_tree_split_check(spark, sf):
    """Impurity, gain and prediction of every node, counted again from the
    training rows that reach it, against the fitted tree's own."""
    df, model = _tree_model(spark, sf)
    nodes = mllib.tree_nodes(model, spark)
    train = model.stages[0].transform(df.filter(F.col("split") == 0))
    again = mllib.node_statistics(train, nodes, INJURY_FEATURES, "label", model.stages[-1].depth)
    both = nodes.alias("t").join(again.alias("a"), "id", "left")
    off = lambda a, b: F.count_if(F.coalesce(F.abs(F.col(a) - F.col(b)) > 1e-9, F.lit(True)))
    inner = F.col("left_child") >= 0
    return both.agg(
        F.max(F.when(F.col("id") == 0, F.col("n"))).alias("n_root"),
        F.sum(F.when(~inner, F.col("n"))).alias("n_leaves"), off("t.impurity", "a.impurity").alias("impurity_off"),
        F.count_if(inner & F.coalesce(F.abs(F.col("t.gain") - F.col("a.gain")) > 1e-9, F.lit(True))).alias("gain_off"),
        off("t.prediction", "a.prediction").alias("prediction_off"))


WIDE_FEATURES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "month", "Player_Age", "Player_Weight",
                 "Player_Height", "l_tax", "Recovery_Time", "l_quantity", "l_discount"]


def q_mllib_tree_rules_check(spark, sf):
    """A tree over twelve features, the label made of the last two: its rules
    by joins over the node table against those read from the named dump."""
    rows = derived.injury_view(read_table(spark, sf, "lineitem"), (
        *derived.LINEITEM_KEY, "l_tax", "l_quantity", "l_discount", "l_shipdate"))
    rows = rows.withColumn("month", F.month("l_shipdate")).withColumn(
        "big", (F.col("l_quantity") * (1 - F.col("l_discount")) > 24).cast("int"))
    rows = cut_lineage(rows.select(*WIDE_FEATURES, "big"), "wide-features")
    model = mllib.tree_estimator(WIDE_FEATURES, "big", seed=SEED_70_30).fit(rows)
    nodes = mllib.tree_nodes(model, spark)
    walked = mllib.tree_paths(nodes, WIDE_FEATURES, model.stages[-1].depth).filter("is_leaf").select("rule", "prediction")
    named = mllib.named_debug_string(model.stages[-1].toDebugString, WIDE_FEATURES)
    read = spark.createDataFrame(mllib.dump_rules(named), "rule string, prediction double")
    both = walked.withColumn("side", F.lit(1)).unionByName(read.withColumn("side", F.lit(-1)))
    per_rule = both.groupBy("rule", "prediction").agg(F.sum("side").alias("side"), F.count_if(F.col("side") > 0).alias("k"))
    return per_rule.agg(
        F.count_if(F.col("side") != 0).alias("differences"),
        F.count_if(F.col("rule").rlike(r"\bfeature \d")).alias("unnamed"),
        (F.count_if(F.col("rule").contains("(l_quantity ")) > 0).alias("feature_10"),
        (F.count_if(F.col("rule").contains("(l_discount ")) > 0).alias("feature_11"))


def q_mllib_tree_rules(spark, sf):
    _, model = _tree_model(spark, sf)
    return mllib.tree_rules(model, INJURY_FEATURES, spark)


def q_mllib_tree_report(spark, sf):
    df, model = _tree_model(spark, sf)
    pred = model.transform(df.filter(F.col("split") == 1))
    return rounded(metrics.classification_report(pred, "label", "prediction"))


def _logistic(spark, sf):
    # rows with any null are dropped before assembling, as the logistic program does
    df = filters.filter_complete_rows(_written_split(spark, sf, [0.8, 0.2], SEED_80_20))
    model = mllib.logistic_estimator(INJURY_FEATURES, INJURY_LABEL).fit(df.filter(F.col("split") == 0))
    return df, model


def q_logistic_fit(spark, sf):
    _, model = _logistic(spark, sf)
    return spark.createDataFrame(mllib.coefficient_rows(model), "term string, coefficient double")


def q_logistic_check(spark, sf):
    """Facts that hold at the optimum: on the training rows the mean residual
    times every standardised feature, and the mean residual, are 0."""
    df, model = _logistic(spark, sf)
    train = model.transform(df.filter(F.col("split") == 0))
    rest = F.col(INJURY_LABEL) - mllib.probability_of(train, 1)
    t = train.select(rest.alias("_r"), *INJURY_FEATURES)
    means = [F.abs(F.corr("_r", f) * F.stddev_pop("_r")).alias(f) for f in INJURY_FEATURES]
    row = t.agg(F.count(F.lit(1)).alias("n_train"), F.abs(F.avg("_r")).alias("intercept"), *means)
    return row.select("n_train", *[(F.round(c, 3) + 0.0).alias(f"gradient_{c}") for c in ("intercept", *INJURY_FEATURES)])


def q_logistic_predict(spark, sf):
    df, model = _logistic(spark, sf)
    pred = model.transform(df.filter(F.col("split") == 1))
    return pred.select(*INJURY_KEY, INJURY_LABEL, "prediction",
                       mllib.probability_of(pred, 1).alias("probability_1"),
                       F.get(mllib.vector_to_array(F.col("rawPrediction")), 1).alias("score"))


def q_logistic_score_check(spark, sf):
    """Scores, probabilities and predictions of the test rows computed again
    from the coefficient rows, and the area under ROC from these scores (ranks
    summed by MLlib's evaluator) against the operator's from the model's."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df, model = _logistic(spark, sf)
    test = cut_lineage(model.transform(df.filter(F.col("split") == 1)).select(
        F.col(INJURY_LABEL).cast("double").alias("label"), "prediction", F.get(mllib.vector_to_array(F.col("probability")), 1).alias("p"),
        F.get(mllib.vector_to_array(F.col("rawPrediction")), 1).alias("score"),
        mllib.logistic_score(mllib.coefficient_rows(model)).alias("own")), "scored")
    off = lambda a, b: F.count_if(F.coalesce(F.abs(a - b) > 1e-9 * (1 + F.abs(b)), F.lit(True)))
    area = BinaryClassificationEvaluator(rawPredictionCol="own", labelCol="label", numBins=0).evaluate(test)
    facts = test.agg(
        F.count(F.lit(1)).alias("n_test"), off(F.col("own"), F.col("score")).alias("score_off"),
        off(1 / (1 + F.exp(-F.col("own"))), F.col("p")).alias("probability_off"),
        off((F.col("own") > 0).cast("double"), F.col("prediction")).alias("prediction_off"))
    return facts.join(metrics.area_under_roc(test).select(
        (F.abs(F.col("area_under_roc") - area) > 1e-9).cast("long").alias("area_off"), F.col("n_pos").alias("n_positive"),
        (F.col("n_pos") + F.col("n_neg")).alias("_n")), F.col("n_test") == F.col("_n"), "left").drop("_n")


def q_predicted_keys(spark, sf):
    """Keys and labels of the rows that both models score: the test sides."""
    tree, model = _tree_model(spark, sf)
    a = model.transform(tree.filter(F.col("split") == 1)).filter("prediction is not null").select(
        F.lit("tree").alias("model"), *INJURY_KEY, INJURY_LABEL)
    rows, model = _logistic(spark, sf)
    b = model.transform(rows.filter(F.col("split") == 1)).filter("prediction is not null").select(
        F.lit("logistic").alias("model"), *INJURY_KEY, INJURY_LABEL)
    return a.unionByName(b)


def q_random_split_check(spark, sf):
    """The sides of a random split together hold every event once."""
    df = split.random_split(_events(spark, sf).select("event_id", "label"), [0.8, 0.2], SEED_80_20)
    sides = df.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("split").alias("sides"))
    return sides.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max("sides").alias("sides"),
                     F.count(F.lit(1)).alias("keys"))


def q_logistic_auc(spark, sf):
    df, model = _logistic(spark, sf)
    pred = model.transform(df.filter(F.col("split") == 1))
    scored = pred.select(F.col(INJURY_LABEL).alias("label"),
                         F.get(mllib.vector_to_array(F.col("rawPrediction")), 1).alias("score"))
    return rounded(metrics.area_under_roc(scored))


def q_rule_tree_predict(spark, sf):
    df = mllib.rule_tree_predict(_injury(spark, sf), INJURY_FEATURES)
    return df.select(*INJURY_KEY, "prediction")


# --------------------------------------------------------------------------
# ID3: the reference's own run has six features and depth 7


def _id3(spark, sf, bins=ID3_BINS, **kw):
    df = _injury_split(spark, sf, [0.7, 0.3], SEED_70_30)
    model = id3.id3_build(df.filter(F.col("split") == 0), INJURY_FEATURES, INJURY_LABEL, max_depth=ID3_DEPTH,
                          bins=bins, **kw)
    return df.filter(F.col("split") == 1).select(*INJURY_KEY, *INJURY_FEATURES, INJURY_LABEL), model


def q_id3_build(spark, sf):
    return rounded(_id3(spark, sf)[1].node_table())


def q_id3_rules(spark, sf):
    return rounded(_id3(spark, sf)[1].rules())


def q_id3_predict(spark, sf):
    test, model = _id3(spark, sf)
    return id3.id3_predict(model, test).select(*INJURY_KEY, INJURY_LABEL, "prediction")


def q_id3_accuracy(spark, sf):
    test, model = _id3(spark, sf)
    return rounded(metrics.accuracy(id3.id3_predict(model, test), INJURY_LABEL, "prediction"))


def _id3_compat(spark, sf):
    """As executed: gain minus the feature's own entropy, leaves hold the
    mean of the first table column (Player_Age)."""
    return _id3(spark, sf, criterion="compat", leaf="mean_first_column", first_column="Player_Age")


def q_id3_build_compat(spark, sf):
    return rounded(_id3_compat(spark, sf)[1].node_table())


def q_id3_predict_compat(spark, sf):
    test, model = _id3_compat(spark, sf)
    return rounded(id3.id3_predict(model, test).select(*INJURY_KEY, INJURY_LABEL, "prediction"))


ID3_FEW_BINS = 2


def q_id3_build_binned(spark, sf):
    return rounded(_id3(spark, sf, bins=ID3_FEW_BINS)[1].node_table())


def q_id3_predict_binned(spark, sf):
    test, model = _id3(spark, sf, bins=ID3_FEW_BINS)
    return id3.id3_predict(model, test).select(*INJURY_KEY, INJURY_LABEL, "prediction")


def q_id3_build_deep(spark, sf):
    """Every distinct value a child, the continuous features too: most
    children are pure, and test rows meet values the training rows had not."""
    return rounded(_id3(spark, sf, bins=None)[1].node_table())


def q_id3_predict_deep(spark, sf):
    test, model = _id3(spark, sf, bins=None)
    return id3.id3_predict(model, test).select(*INJURY_KEY, INJURY_LABEL, "prediction")


def q_id3_build_text(spark, sf):
    """A label that is text."""
    orders = read_table(spark, sf, "orders").select(
        "o_totalprice", "o_orderpriority", "o_orderstatus", F.month("o_orderdate").alias("month"))
    model = id3.id3_build(orders, ["o_orderpriority", "month"], "o_orderstatus", max_depth=2,
                          first_column="o_totalprice")
    return rounded(model.node_table(), 2)


# --------------------------------------------------------------------------
# poker hands


def q_hand_class_score(spark, sf):
    return _hands(spark, sf).select("hand_id", "class", hands.hand_class_score().alias("class_score"))


def q_hand_rank_points(spark, sf):
    return _hands(spark, sf).select("hand_id", hands.hand_rank_points().alias("rank_points"))


def q_hand_longest_run(spark, sf):
    return hands.with_runs(_hands(spark, sf)).select("hand_id", "longest_run", "longest_run_compat")


def q_hand_flush_bonus(spark, sf):
    return _hands(spark, sf).select("hand_id", hands.hand_flush_bonus().alias("flush_bonus"),
                                    hands.hand_flush_bonus(compat=True).alias("flush_bonus_compat"))


def q_score_hands(spark, sf):
    return rounded(hands.score_hands(_hands(spark, sf)))


QUERIES = {
    # sources
    "parse_records": q_parse_records,
    "parse_hands": q_parse_hands,
    "scan_csv_schema": q_scan_csv_schema,
    "scan_csv_header": q_scan_csv_header,
    "scan_csv_positional": q_scan_csv_positional,
    # filters / joins / splits
    "filter_complete_rows": q_filter_complete_rows,
    "class_partition": q_class_partition,
    "split_by_value": q_split_by_value,
    "attach_predictions": q_attach_predictions,
    "split_90_10": _split_query([0.9, 0.1], SEED_90_10),
    "split_80_20": _split_query([0.8, 0.2], SEED_80_20),
    "split_70_30": _split_query([0.7, 0.3], SEED_70_30),
    "random_split": q_random_split,
    "random_split_check": q_random_split_check,
    # statistics
    "class_counts": q_class_counts,
    "class_probability": q_class_probability,
    "class_priors": q_class_priors,
    "feature_value_counts": q_feature_value_counts,
    "value_probability": q_value_probability,
    "distinct_values": q_distinct_values,
    "label_entropy": q_label_entropy,
    "information_gain": q_information_gain,
    "information_gain_compat": q_information_gain_compat,
    "gain_report": q_gain_report,
    "gain_report_by_split": q_gain_report_by_split,
    "gain_report_binned": q_gain_report_binned,
    "best_attribute": q_best_attribute,
    "best_attribute_compat": q_best_attribute_compat,
    "best_attribute_by_split": q_best_attribute_by_split,
    "last_column_label": q_last_column_label,
    "threshold_gain_width": q_threshold_gain_width,
    "threshold_gain_sketch": q_threshold_gain_sketch,
    "threshold_gain_check": q_threshold_gain_check,
    "class_means": q_class_means,
    "class_means_compat": q_class_means_compat,
    "class_stddev": q_class_stddev,
    "class_stddev_compat": q_class_stddev_compat,
    "is_pure": q_is_pure,
    "leaf_values": q_leaf_values,
    "leaf_values_text": q_leaf_values_text,
    # metrics
    "accuracy": q_accuracy,
    "accuracy_pct": q_accuracy_pct,
    "precision_pct": q_precision_pct,
    "weighted_precision": _report_metric("weighted_precision"),
    "weighted_recall": _report_metric("weighted_recall"),
    "weighted_f1": _report_metric("weighted_f1"),
    "classification_report": q_classification_report,
    "area_under_roc": q_area_under_roc,
    "area_under_roc_extremes": q_area_under_roc_extremes,
    # naive Bayes
    "gaussian_density": q_gaussian_density,
    "gaussian_nb_fit": q_gaussian_nb_fit,
    "gaussian_nb_predict": q_gaussian_nb_predict,
    "gaussian_nb_predict_compat": q_gaussian_nb_predict_compat,
    "gaussian_nb_end_to_end": q_gaussian_nb_end_to_end,
    # MLlib
    "index_label": q_index_label,
    "mllib_tree_fit": q_mllib_tree_fit,
    "mllib_tree_predict": q_mllib_tree_predict,
    "mllib_tree_check": q_mllib_tree_check,
    "mllib_tree_split_check": q_mllib_tree_split_check,
    "mllib_tree_rules_check": q_mllib_tree_rules_check,
    "mllib_tree_rules": q_mllib_tree_rules,
    "mllib_tree_report": q_mllib_tree_report,
    "logistic_fit": q_logistic_fit,
    "logistic_check": q_logistic_check,
    "logistic_predict": q_logistic_predict,
    "logistic_score_check": q_logistic_score_check,
    "predicted_keys": q_predicted_keys,
    "logistic_auc": q_logistic_auc,
    "rule_tree_predict": q_rule_tree_predict,
    # ID3
    "id3_build": q_id3_build,
    "id3_rules": q_id3_rules,
    "id3_predict": q_id3_predict,
    "id3_build_compat": q_id3_build_compat,
    "id3_predict_compat": q_id3_predict_compat,
    "id3_build_binned": q_id3_build_binned,
    "id3_predict_binned": q_id3_predict_binned,
    "id3_build_deep": q_id3_build_deep,
    "id3_predict_deep": q_id3_predict_deep,
    "id3_build_text": q_id3_build_text,
    "id3_accuracy": q_id3_accuracy,
    # poker hands
    "hand_class_score": q_hand_class_score,
    "hand_rank_points": q_hand_rank_points,
    "hand_longest_run": q_hand_longest_run,
    "hand_flush_bonus": q_hand_flush_bonus,
    "score_hands": q_score_hands,
}

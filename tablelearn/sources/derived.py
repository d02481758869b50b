"""Classification views derived from the driver tables.

Each view is a projection (plus at most one filter or one join) of a parquet
table, so Catalyst prunes the scan to the columns used and pushes the filter
into it.  The arithmetic below is fixed: the DuckDB oracles rebuild the same
views from the same parquet files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.sources.tables import read_table

LINEITEM_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
EVENT_FEATURES = ("value", "hour", "user_id", "k")
DOC_FEATURES = ("log_chars", "word_density", "digit_share")
DOC_CATEGORICAL = ("lang", "source")


def injury_view(lineitem: DataFrame, keys=LINEITEM_KEY) -> DataFrame:
    """Six-feature analogue of the injury table from ``lineitem``."""
    return lineitem.select(
        *keys,
        (F.lit(18) + F.col("l_quantity") % 22).cast("int").alias("Player_Age"),
        (F.lit(40.0) + F.col("l_extendedprice") / 1750).alias("Player_Weight"),
        (F.lit(145.0) + (F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729) % 60000 / 1000).alias("Player_Height"),
        (F.col("l_returnflag") == "R").cast("int").alias("Previous_Injuries"),
        (F.col("l_discount") * 10).alias("Training_Intensity"),
        F.col("l_linenumber").alias("Recovery_Time"),
        (F.col("l_linestatus") == "F").cast("int").alias("Likelihood_of_Injury"),
    )


def event_view(events: DataFrame) -> DataFrame:
    """Keyed binary table of all events, key ``event_id``; the label marks
    purchases."""
    return events.select(
        "event_id",
        "value",
        F.hour("ts").alias("hour"),
        "user_id",
        (F.get_json_object("props", "$.k")).try_cast("int").alias("k"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )


def metric_view(events: DataFrame) -> DataFrame:
    """Scored rows for the metric operators: prediction = value > 100,
    score = value, label = purchase."""
    return event_view(events).select(
        "event_id",
        (F.col("value") > 100).cast("double").alias("prediction"),
        F.col("value").alias("score"),
        F.col("label").cast("double").alias("label"),
    )


def hand_lines(orders: DataFrame, damaged: bool = False) -> DataFrame:
    """Poker-hand text lines generated from order keys by integer arithmetic:
    suit_i = (k*7 + d_i) % 4 + 1 with d_i = 0 for k % 5 = 0 (one suit five
    times), d_i = [i = 4] for k % 5 = 1 (four times), 5i otherwise;
    rank_i = (k*(2i+1) + 3i^2 + k div 13) % 13 + 1, class = k % 10.

    ``damaged``: lines with k % 17 = 0, 1, 2 lose their last field, get a word
    for their first, or become empty."""
    k = F.col("o_orderkey")
    fields = []
    for i in range(5):
        step = F.when(k % 5 == 0, 0).when(k % 5 == 1, int(i == 4)).otherwise(i * 5)
        fields.append((k * 7 + step) % 4 + 1)
        fields.append((k * (2 * i + 1) + 3 * i * i + F.expr("o_orderkey div 13")) % 13 + 1)
    fields.append(k % 10)
    texts = [f.cast("string") for f in fields]
    line = F.concat_ws(",", *texts)
    if damaged:
        line = (F.when(k % 17 == 0, F.concat_ws(",", *texts[:-1]))
                .when(k % 17 == 1, F.concat_ws(",", F.lit("ace"), *texts[1:]))
                .when(k % 17 == 2, F.lit("")).otherwise(line))
    return orders.select(k.alias("hand_id"), line.alias("value"))


def record_lines(injury: DataFrame, columns, key: str = "l_orderkey") -> DataFrame:
    """The records as text lines, some damaged by key arithmetic: without
    their last field (k % 13 = 0), with one too many (1), with a word instead
    of a number (2)."""
    k = F.col(key)
    texts = [F.col(c).cast("string") for c in columns]
    line = (F.when(k % 13 == 0, F.concat_ws(",", *texts[:-1]))
            .when(k % 13 == 1, F.concat_ws(",", *texts, F.lit("9")))
            .when(k % 13 == 2, F.concat_ws(",", F.lit("young"), *texts[1:]))
            .otherwise(F.concat_ws(",", *texts)))
    return injury.select(line.alias("value"))


def events_with_gaps(events: DataFrame) -> DataFrame:
    """Events with missing fields by key arithmetic: ``value`` is null for
    ids divisible by 7, ``props`` for ids that leave 3 modulo 11."""
    k = F.col("event_id")
    return events.select("event_id", "user_id", "event_type", F.when(k % 7 != 0, F.col("value")).alias("value"),
                         F.when(k % 11 != 3, F.col("props")).alias("props"))


def doc_label_view(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """``labels`` joined to ``documents`` on ``doc_id`` with three numeric
    text features and two categorical ones; label = ``quality``."""
    docs = documents.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit(" "), F.lit("")))).alias("_spaces"),
        (F.length("text") - F.length(F.translate("text", "0123456789", ""))).alias("_digits"),
    )
    joined = labels.select("doc_id", "quality").join(docs, "doc_id", "inner")
    return joined.select(
        "doc_id",
        F.when(F.col("n_chars") > 0, F.ln(F.col("n_chars").cast("double"))).alias("log_chars"),
        F.try_divide((F.col("_spaces") + 1).cast("double"), F.col("n_chars").cast("double")).alias("word_density"),
        F.try_divide(F.col("_digits").cast("double"), F.col("n_chars").cast("double")).alias("digit_share"),
        "lang",
        "source",
        F.col("quality").alias("label"),
    )


def load_view(spark, sf_dir: str, name: str) -> DataFrame:
    """Named view over the parquet tables at ``sf_dir``."""
    if name == "injury":
        return injury_view(read_table(spark, sf_dir, "lineitem"))
    if name == "events":
        return event_view(read_table(spark, sf_dir, "events"))
    if name == "metrics":
        return metric_view(read_table(spark, sf_dir, "events"))
    if name == "hand_lines":
        return hand_lines(read_table(spark, sf_dir, "orders"))
    if name == "doc_labels":
        return doc_label_view(read_table(spark, sf_dir, "labels"), read_table(spark, sf_dir, "documents"))
    raise KeyError(name)

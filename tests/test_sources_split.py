import math

from pyspark.sql import functions as F

from tablelearn.operators import filters, split
from tablelearn.session import scratch_path
from tablelearn.sources import derived, text


def test_parse_records_rejects(spark):  # B16
    lines = ["1,2,3,4,5,6,7", "1,2,3,4,5,6", "1,2,3,4,5,6,7,8", "1,2,x,4,5,6,7", "1, 2 ,3,4,5,6,7,,"]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    ok = text.parse_records(df).collect()
    assert len(ok) == 2 and ok[1]["Player_Weight"] == 2.0
    flagged = text.parse_records(df, keep_rejects=True).collect()
    assert sum(r["rejected"] for r in flagged) == 3


def test_complete_rows_keep_nan(spark):  # B17
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    out = filters.filter_complete_rows(df).collect()
    assert len(out) == 2 and any(math.isnan(r["x"]) for r in out)


def test_split_by_value_null_safe(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "a int")
    assert filters.split_by_value(df, "a", None).count() == 1


def test_csv_round_trips(spark):
    view = derived.load_view(spark, "/root/testdata/sf0.001", "injury").select(*text.INJURY_COLUMNS)
    p = scratch_path(spark, "t-csv")
    view.write.option("header", False).csv(p)
    a = text.read_csv_schema(spark, p)
    assert a.schema == text.INJURY_SCHEMA and a.count() == view.count()
    b = text.read_csv_positional(spark, p, text.INJURY_COLUMNS)
    assert b.columns == list(text.INJURY_COLUMNS)
    feats, label = text.features_and_label(b)
    assert label == "Likelihood_of_Injury" and len(feats) == 6


def test_hash_split_stable_under_repartition(spark):
    ev = derived.load_view(spark, "/root/testdata/sf0.01", "events")
    a = split.hash_split(ev, ["event_id"], [0.7, 0.3], 7).select("event_id", "split")
    b = split.hash_split(ev.repartition(13), ["event_id"], [0.7, 0.3], 7).select("event_id", "split")
    assert a.exceptAll(b).count() == 0
    frac = a.filter(F.col("split") == 1).count() / a.count()
    assert 0.25 < frac < 0.35


def test_hash_split_keeps_a_tiny_side(spark):
    df = split.hash_split(spark.range(1_000_000), ["id"], [0.99996, 0.00004], 11)
    assert 10 < df.filter("split = 1").count() < 90


def test_random_split_sides_are_disjoint_and_complete(spark):
    df = split.random_split(spark.range(5000), [0.8, 0.2], 3)
    assert df.select("id").distinct().count() == df.count() == 5000
    assert 800 < df.filter("split = 1").count() < 1200


def test_text_lines_are_read_from_files(spark):
    path = scratch_path(spark, "t-lines")
    spark.createDataFrame([("1,2,3,4,5,6,7",), ("1,2",), ("",)], "value string").write.text(path)
    lines = text.read_text_lines(spark, path)
    assert lines.columns == ["value"] and text.parse_records(lines).count() == 1


def test_hash_split_frames(spark):
    ev = derived.load_view(spark, "/root/testdata/sf0.01", "events")
    tr, te = split.hash_split_frames(ev, ["event_id"], [0.9, 0.1], 6151)
    assert tr.count() + te.count() == ev.count()

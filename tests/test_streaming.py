import os

import pytest
from pyspark.sql import functions as F

from tablelearn.operators import stats
from tablelearn.session import scratch_path
from tablelearn.sources import derived
from tablelearn.streaming import labelled_stream, start_class_statistics


def test_stream_matches_batch(spark):
    view = derived.load_view(spark, "/root/testdata/sf0.01", "injury")
    src = scratch_path(spark, "stream-src")
    view.repartition(4).write.parquet(src)          # 4 files -> several micro-batches
    out = scratch_path(spark, "stream-out")
    stream = labelled_stream(spark, src, view.schema, max_files_per_trigger=1)
    q = start_class_statistics(stream, "Likelihood_of_Injury", out, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    got = {r["Likelihood_of_Injury"]: r["n"] for r in spark.read.parquet(os.path.join(out, "counts")).collect()}
    want = {r["Likelihood_of_Injury"]: r["n"] for r in stats.class_counts(view, "Likelihood_of_Injury").collect()}
    assert got == want
    e_stream = spark.read.parquet(os.path.join(out, "entropy")).collect()[0]["entropy"]
    e_batch = stats.entropy(view, "Likelihood_of_Injury").collect()[0]["entropy"]
    assert e_stream == pytest.approx(e_batch, abs=1e-12)
    priors = spark.read.parquet(os.path.join(out, "priors")).agg(F.sum("prior")).first()[0]
    assert priors == pytest.approx(1.0)

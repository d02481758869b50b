import os

import pytest

from pyspark.sql import functions as F

from tablelearn.operators import id3
from tablelearn.plans.shaping import cut_lineage, drop_written
from tablelearn.session import ScratchScope, delete_scratch, ensure_checkpoint_dir, release_scratch, scratch_path


def _local(uri: str) -> str:
    return "/" + uri.replace("file:", "").lstrip("/")


def test_scratch_tables_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    p = scratch_path(spark, "t")
    assert p.startswith(base) and p != scratch_path(spark, "t")
    df = cut_lineage(spark.range(100).withColumn("y", F.col("id") % 3), "t")
    assert df.count() == 100
    files = df.inputFiles()
    assert files and all(_local(f).startswith(_local(base)) for f in files)
    drop_written(df)
    assert not os.path.exists(os.path.dirname(_local(files[0])))


def test_nothing_outside_the_scratch_folder_is_deleted(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError):
        drop_written(spark.read.parquet(path))
    with pytest.raises(ValueError):
        delete_scratch(spark, ensure_checkpoint_dir(spark))
    assert os.path.exists(path)


def test_release_empties_the_scratch_folder(spark):
    df = cut_lineage(spark.range(5), "t")
    files = df.inputFiles()
    release_scratch(spark)
    assert not any(os.path.exists(_local(f)) for f in files)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self): return None
        def getConf(self): return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_one_of_two_results_is_released(spark):
    release_scratch(spark)
    train = spark.createDataFrame([(i % 3, i % 5, i % 2) for i in range(60)], "a int, b int, y int")
    results = []
    for depth in (1, 2):
        with ScratchScope(spark) as scope:
            results.append((scope, id3.id3_predict(id3.id3_build(train, ["a", "b"], "y", max_depth=depth), train)))
    base = os.path.join(_local(ensure_checkpoint_dir(spark)), "tablelearn-scratch")
    (first, gone), (second, kept) = results
    assert gone.count() == 60 and len(os.listdir(base)) == 2
    first.release()
    assert kept.count() == 60 and len(os.listdir(base)) == 1
    with pytest.raises(Exception):
        gone.collect()
    second.release()
    assert not os.listdir(base)


def test_the_innermost_scope_takes_the_tables(spark):
    with ScratchScope(spark) as outer:
        a = cut_lineage(spark.range(3), "a")
        with ScratchScope(spark) as inner:
            b = cut_lineage(spark.range(4), "b")
        c = cut_lineage(spark.range(5), "c")
    inner.release()
    assert a.count() == 3 and c.count() == 5 and not any(os.path.exists(_local(f)) for f in b.inputFiles())
    outer.release()

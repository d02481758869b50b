"""Session helpers.

The library never creates a cluster configuration of its own: callers pass a
session.  ``get_session`` is a convenience for tests, scripts and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tablelearn", extra: dict | None = None) -> SparkSession:
    """Return (or build) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_LOCAL_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.  Where it is unset, a fresh
    temporary folder will do on a local master (one machine); on any other
    the executors would not see each other's files, and this raises."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tablelearn-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _scratch_base(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "tablelearn-scratch")


class ScratchScope:
    """The tables that one result leaves behind, to be released with it::

        with ScratchScope(spark) as scope:
            result = id3_predict(id3_build(train, ...), test)
        result.write.parquet(...)
        scope.release()

    Tables written inside the ``with`` block go to a folder of their own, so
    releasing them leaves those of other results alone.  Scopes nest; the
    innermost one takes the tables.  A lazy result is readable until its scope
    is released."""

    def __init__(self, spark: SparkSession):
        self.spark, self.name, self._token = spark, f"scope-{uuid.uuid4().hex}", None

    @property
    def path(self) -> str:
        return os.path.join(_scratch_base(self.spark), self.name)

    def __enter__(self) -> ScratchScope:
        self._token = _scope.set(self)
        return self

    def __exit__(self, *_) -> None:
        _scope.reset(self._token)

    def release(self) -> None:
        delete_scratch(self.spark, self.path)


_scope: ContextVar[ScratchScope | None] = ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint directory (in the
    innermost ``ScratchScope``), for tables written on purpose."""
    scope = _scope.get()
    return os.path.join(scope.path if scope else _scratch_base(spark), f"{name}-{uuid.uuid4().hex}")


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder below this session's scratch folder (the folder
    itself too); any other path is refused."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target, base = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, _scratch_base(spark)))
    fs = target.getFileSystem(conf)
    inner, outer = (fs.makeQualified(p).toString() for p in (target, base))
    if inner != outer and not inner.startswith(outer + "/"):
        raise ValueError(f"{path} is not below the scratch folder {outer}")
    fs.delete(target, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete every table this session wrote on the way to its results, in
    any scope.  Lazy results that still read one of them cannot be used
    afterwards; ``ScratchScope`` releases one result at a time."""
    delete_scratch(spark, _scratch_base(spark))

"""Plan-shaping helpers shared by operators.

* ``cut_lineage``: for iterative operators, write the intermediate table
  as parquet under the shared ``spark.checkpoint.dir`` and read it back.
  One computation (``Dataset.checkpoint`` computes the plan once for its
  eager count and again to write the files), columnar and compressed, and
  it survives lost executors.
* ``drop_written``: delete such a table; nothing outside the scratch folder
  can be deleted with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablelearn.session import delete_scratch, scratch_path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialize ``df`` as a parquet table in the shared checkpoint
    directory and return a fresh scan of it (lineage starts there)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files behind a table made by ``cut_lineage`` once nothing
    reads it any more.  Refuses any other table."""
    files = df.inputFiles()
    if files:
        delete_scratch(df.sparkSession, files[0].rsplit("/", 1)[0])

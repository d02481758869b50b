"""Class statistics maintained over a stream of labelled rows.

There is no streaming operator in the feature set; what streams is the
input.  The batch aggregate ``stats.class_counts`` runs unchanged on a
streaming DataFrame as a stateful aggregation (complete output mode: the
state is one row per class, bounded by the number of classes).  Each
micro-batch hands the full counts table to ``foreachBatch``, which derives
label entropy and priors from it with the same batch operators and
overwrites the result tables.  Checkpoints (offsets + state) live under the
shared ``spark.checkpoint.dir`` so the query resumes after a restart or a
lost executor.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablelearn.functions.columns import LN2, ratio, xlogx
from tablelearn.operators.stats import class_counts
from tablelearn.session import scratch_path


def labelled_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of a folder of files with a fixed schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def _entropy_and_priors(counts: DataFrame, label: str, by=()) -> tuple[DataFrame, DataFrame]:
    """From a class-counts table (bounded by groups x classes rows)."""
    agg = counts.groupBy(*by).agg(F.sum("n").alias("_n"), F.sum(xlogx("n")).alias("_s"))
    entropy = agg.select(*by, F.col("_n").cast("bigint").alias("n"),
                         F.greatest(F.lit(0.0), (F.ln(F.col("_n").cast("double")) - ratio("_s", "_n")) / LN2)
                         .alias("entropy"))
    total = F.sum("n").over(Window.partitionBy(*by))   # per-group class rows: bounded
    priors = counts.select(*by, label, "n", ratio(F.col("n"), total).alias("prior"))
    return entropy, priors


def start_class_statistics(stream: DataFrame, label: str, out_dir: str, by=(),
                           checkpoint: str | None = None, available_now: bool = False,
                           processing_time: str | None = None) -> StreamingQuery:
    """Start the query; tables ``counts``, ``entropy`` and ``priors`` under
    ``out_dir`` are overwritten after every micro-batch."""
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-class-stats")
    counts = class_counts(stream, label, by)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out_dir, "counts"))
        stored = batch.sparkSession.read.parquet(os.path.join(out_dir, "counts"))
        entropy, priors = _entropy_and_priors(stored, label, by)
        entropy.write.mode("overwrite").parquet(os.path.join(out_dir, "entropy"))
        priors.write.mode("overwrite").parquet(os.path.join(out_dir, "priors"))

    writer = (counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
              .foreachBatch(publish))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()

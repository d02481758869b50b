"""Parquet tables of the driver data set."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of one table; projections and filters applied
    later are pushed into this scan by Catalyst."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))

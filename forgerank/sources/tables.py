"""Parquet table scans. Column pruning and filters reach the scan through Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str, schema=None) -> DataFrame:
    """Scan one table, optionally with a declared schema."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

"""Key audit.

The reference lists key constraints from the database catalog; here the keys are
checked on the data itself: rows, duplicated keys and null keys per table, as one
grouped aggregate per table (partial, no collect).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def key_audit(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long").alias("extra_rows"),
        F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).cast("long").alias("null_key_rows"))


def check_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    parts = [key_audit(n, df, keys) for n, (df, keys) in tables.items()]
    return reduce(DataFrame.unionByName, parts)

"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lexiloom.session import scratch_path

# Shuffle files are of no use once the table that came out of them is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written below the shared folder and read again: no lineage, no shuffle files kept."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)

"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseweave.sources.shared import checkpointed

__all__ = ["bucket_count", "checkpointed", "read_table"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any store that Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket_count(spark: SparkSession) -> int:
    """Number of buckets of a shuffle that packs many values in a row: the cluster's shuffle partitions, 64 at least."""
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))

"""Layer namespaces and full-refresh tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold", "seeds", "snapshots")


def create_layers(spark: SparkSession, prefix: str = "", location: str | None = None) -> None:
    """One database per layer; ``prefix`` keeps several environments apart in one catalog."""
    for layer in LAYERS:
        where = f" LOCATION '{location}/{prefix}{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}{where}")


def with_lineage(df: DataFrame, column: str) -> DataFrame:
    """Adds the load time.  Kept out of the transformations so that those stay repeatable."""
    return df.withColumn(column, F.current_timestamp())


def write_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> int:
    """Replaces a table and returns the rows written, counted while writing.

    Partitioned writes are rebalanced on the partition columns: adaptive execution then splits a
    partition that is too large for one task and merges small ones, instead of every task
    writing a file into every partition.
    """
    rows = Observation()
    out = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    writer = out.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else out
    writer = writer.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return rows.get["rows"]

"""Landing of raw transaction files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE_COLUMNS, RAW_COLUMNS


def read_transactions_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False, *more: Column) -> DataFrame:
    """Raw rows with every column as text, named by the header, plus where and when they were read.

    Nothing is inferred: types are decided in the silver layer, the same way for every file.  All
    files must share one header order (a differing header raises).  A missing path raises
    ``PATH_NOT_FOUND``.  ``multi_line`` allows line breaks inside quoted fields, but such files
    cannot be split over several tasks.  ``more`` columns of a file's metadata go along.
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .csv(path)
    )
    # An empty field is a missing value, quoted or not.
    fields = [F.nullif(F.col("`" + c.replace("`", "``") + "`"), F.lit("")).alias(c) for c in raw.columns]
    return raw.select(
        *fields,
        F.col("_metadata.file_name").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
        *more,
    )


def to_bronze(raw: DataFrame) -> DataFrame:
    """The eight bronze columns, values unchanged, any further columns dropped."""
    return raw.select(*BRONZE_COLUMNS)


def ingest_transactions(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """CSV file(s) to bronze rows."""
    return to_bronze(read_transactions_csv(spark, path, multi_line))


def with_provenance(raw: DataFrame, source_file: str) -> DataFrame:
    """Bronze rows from a DataFrame that does not come from a landing file."""
    return raw.select(
        *RAW_COLUMNS,
        F.lit(source_file).alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )

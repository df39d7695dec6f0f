"""Silver from landing files as they arrive.

``to_silver`` keeps no state, so the same function serves a stream of files; the file sink writes each
file's rows exactly once.  ``availableNow`` makes it an incremental batch job: one run picks up what
is new since the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.silver import to_silver
from ..schemas import RAW_COLUMNS, RAW_SCHEMA


def stream_bronze(spark: SparkSession, folder: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Bronze rows of new CSV files.  A stream needs its columns up front: the six raw ones, in order."""
    raw = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(folder)
    )
    return raw.select(
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in RAW_COLUMNS],
        F.col("_metadata.file_name").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )


def stream_silver(spark: SparkSession, folder: str, output: str, checkpoint: str, **options) -> StreamingQuery:
    """Appends the silver rows of all new files to ``output`` and stops."""
    rows = to_silver(stream_bronze(spark, folder), **options)
    return (
        rows.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

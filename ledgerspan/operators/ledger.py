"""Landing with a ledger of files: what has landed already counts once, a file that has changed replaces its own rows."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE_COLUMNS
from ..session import staged
from ..sources.landing import read_transactions_csv
from .stored import Change, commit, create_partitioned, finish

#: What tells a file from others, and a changed one from what it was.
IDENTITY = ["_source_path", "_source_size", "_source_modified"]
RUN = "landing_run"


def ledger_of(table: str) -> str:
    """The table that lists the files landed in ``table``."""
    return f"{table}_files"


def found_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Path, size and time of change of the files below ``path``; no content is read."""
    files = spark.read.format("binaryFile").load(path)
    kinds = ("file_path", "file_size", "file_modification_time")
    return files.select(*(F.col(f"_metadata.{kind}").alias(name) for kind, name in zip(kinds, IDENTITY)))


def land_files(spark: SparkSession, path: str | list[str], table: str, run: str) -> dict[str, int]:
    """Lands the files below ``path`` that the ledger doesn't know, as rows of ``run``; returns how many landed, and replaced others.

    Bronze rows and ledger are partitioned by run and committed together.  A run adds its own partition; where a known path has
    another size or time, the runs that hold its old rows are rewritten without them.  A file that has gone keeps its rows.  Landing
    the same files again, or a run repeated after a loss, adds nothing.  ``run`` must be a plain word.
    """
    ledger = ledger_of(table)
    listed = staged(found_files(spark, path))
    if not spark.catalog.tableExists(ledger):
        rows = read_transactions_csv(spark, path, False, F.col("_metadata.file_path").alias("_source_path"))
        empty = rows.select(*BRONZE_COLUMNS, "_source_path", F.lit(run).alias(RUN)).where(F.lit(False))
        create_partitioned(empty, table, [RUN])
        create_partitioned(listed.withColumn(RUN, F.lit(run)).where(F.lit(False)), ledger, [RUN])
    finish(spark, table)
    known = spark.table(ledger)
    fresh = staged(listed.join(known, IDENTITY, "left_anti"))
    files = [unquote(r[0]) for r in fresh.select("_source_path").distinct().collect()]
    if not files:
        return {"landed": 0, "replaced": 0}
    paths = fresh.select("_source_path").distinct()
    replaced = staged(known.join(paths, "_source_path", "left_semi"))
    touched = {run} | {r[0] for r in replaced.select(RUN).distinct().collect()}
    rows = read_transactions_csv(spark, files, False, F.col("_metadata.file_path").alias("_source_path"))
    new_rows = rows.select(*BRONZE_COLUMNS, "_source_path", F.lit(run).alias(RUN))
    kept_rows, kept_files = (
        spark.table(name).where(F.col(RUN).isin(sorted(touched))).join(paths, "_source_path", "left_anti").select(*spark.table(name).columns)
        for name in (table, ledger)
    )
    commit(
        spark,
        [
            Change(table, kept_rows.unionByName(new_rows), {(r,) for r in touched}, (RUN,)),
            Change(ledger, kept_files.unionByName(fresh.withColumn(RUN, F.lit(run))), {(r,) for r in touched}, (RUN,)),
        ],
    )
    return {"landed": len(files), "replaced": replaced.select("_source_path").distinct().count()}

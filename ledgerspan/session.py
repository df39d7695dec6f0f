"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "ledgerspan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; anything passed in ``conf`` wins.

    Shuffle partition counts are left to adaptive execution, which coalesces and splits them by size.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_root(application_id: str) -> str:
    root = tempfile.mkdtemp(prefix="ledgerspan-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


#: Databases made for intermediate tables, by application.
_SCRATCH: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own, which goes when Python ends; on a cluster the executors
    would not see it, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def track_databases(spark: SparkSession, names: list[str]) -> None:
    """Databases that ``release`` drops."""
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).extend(names)


def scratch_database(spark: SparkSession) -> str:
    """A new database in the shared folder, for tables that ``release`` removes."""
    name = f"ledgerspan_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark, 'tables')}'")
    track_databases(spark, [name])
    return name


#: The database of ``staged`` tables, by application.
_STAGES: dict[str, str] = {}


def staged(df: DataFrame) -> DataFrame:
    """The rows written to a table in the shared folder once and read back: their size is known, and lost executors don't matter."""
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    if application not in _STAGES:
        _STAGES[application] = scratch_database(spark)
    name = f"{_STAGES[application]}.stage_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(name)
    return spark.table(name)


def release(spark: SparkSession) -> None:
    """Drops the intermediate tables of this session; call it when their results have been used."""
    _STAGES.pop(spark.sparkContext.applicationId, None)
    for name in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")

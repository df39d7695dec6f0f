"""Versioned history of transactions (check strategy) and point-in-time reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SNAPSHOT_COLUMNS
from ..session import staged

VALIDITY_COLUMNS = ["valid_from", "valid_to", "updated_at", "version_id"]
CHECK_COLUMNS = ["status", "premium_amount"]
#: Value of a stored history's ``snapshot_run`` for versions that are still open.
OPEN_RUN = "open"


def snapshot_input(silver: DataFrame) -> DataFrame:
    """The silver columns kept in history."""
    return silver.select(*[c for c in SNAPSHOT_COLUMNS if c in silver.columns])


def history_run(moment: Column) -> Column:
    """Name of the run that closes versions at ``moment``; sorts as the moments do."""
    return F.date_format(moment.cast("timestamp_ntz"), "yyyyMMdd'T'HHmmssSSS")


def _version_id(key: Column, as_of: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), as_of.cast("string")))


def _opened(current: DataFrame, as_of, key: str) -> DataFrame:
    at = F.lit(as_of).cast("timestamp_ntz")
    return current.select(
        "*",
        at.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        at.alias("updated_at"),
        _version_id(F.col(key), at).alias("version_id"),
    )


def initial_history(current: DataFrame, as_of, key: str = "transaction_id") -> DataFrame:
    """First snapshot: every row opens a version."""
    return _opened(current, as_of, key)


def require_later(open_versions: DataFrame, as_of) -> None:
    """Raises when a snapshot would be taken before the latest one."""
    at = F.lit(as_of).cast("timestamp_ntz")
    late = open_versions.where(F.col("valid_from") > at).agg(F.max("valid_from")).first()[0]
    if late is not None:
        raise ValueError(f"the history already holds a snapshot of {late}, after {as_of}")


def moved_keys(
    open_versions: DataFrame,
    current: DataFrame,
    key: str = "transaction_id",
    check_cols: Sequence[str] = CHECK_COLUMNS,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """Keys whose version closes or opens: ``key``, ``_close``, ``_open``.

    The join sees keys and checked columns only, so the scans read no others.  Keys must be unique on both sides; null keys
    never match and are left out here (they would all meet in one task).
    """
    side = lambda df, name: df.where(F.col(key).isNotNull()).select(key, F.struct(*check_cols).alias(name))
    both = side(open_versions, "_old").join(side(current, "_new"), key, "full")
    old, new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    close = old & F.when(new, ~same).otherwise(F.lit(invalidate_hard_deletes))
    opened = new & F.when(old, ~same).otherwise(F.lit(True))
    return both.select(key, close.alias("_close"), opened.alias("_open")).where(F.col("_close") | F.col("_open"))


def step_from(
    open_versions: DataFrame,
    current: DataFrame,
    moved: DataFrame,
    as_of,
    key: str = "transaction_id",
    check_cols: Sequence[str] = CHECK_COLUMNS,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """Open versions after a snapshot and the versions it closed, given the keys that move.

    Each side is read once and matched with the moved keys.  Rows without a key close and reopen with each run.
    A closed version keeps its ``updated_at``, the time its record was taken.
    """
    at = F.lit(as_of).cast("timestamp_ntz")
    keyless = F.col(key).isNull()
    held = open_versions.columns
    old = open_versions.join(moved.where("_close").select(key, F.lit(True).alias("_gone")), key, "left")
    gone = F.col("_gone") | (keyless & F.lit(invalidate_hard_deletes))
    ended = F.when(F.col("valid_from") > at, F.raise_error(F.lit("a snapshot may not be earlier than the history"))).otherwise(at)
    old = old.withColumn("valid_to", F.when(gone, ended).otherwise(F.col("valid_to"))).select(*held)
    new = current.join(moved.where("_open").select(key, F.lit(True).alias("_opened")), key, "left")
    new = new.where(F.col("_opened") | keyless).select(*current.columns)
    return old.unionByName(_opened(new, as_of, key))


def scd2_step(
    open_versions: DataFrame,
    current: DataFrame,
    as_of,
    key: str = "transaction_id",
    check_cols: Sequence[str] = CHECK_COLUMNS,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """Open versions after one snapshot, together with the versions it closed.

    The keys that move are written to the shared folder once; as Spark then knows their size, few of them are broadcast.
    """
    options = (key, check_cols, invalidate_hard_deletes)
    return step_from(open_versions, current, staged(moved_keys(open_versions, current, *options)), as_of, *options)


def scd2_merge(
    history: DataFrame,
    current: DataFrame,
    as_of,
    key: str = "transaction_id",
    check_cols: Sequence[str] = CHECK_COLUMNS,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """The whole history after one snapshot.  Versions closed earlier pass through without a shuffle."""
    past = history.where(F.col("valid_to").isNotNull())
    open_versions = history.where(F.col("valid_to").isNull())
    step = scd2_step(open_versions, current, as_of, key, check_cols, invalidate_hard_deletes)
    return past.unionByName(step)


def as_of_read(history: DataFrame, moment) -> DataFrame:
    """The rows as they stood at ``moment``; of a stored history, open versions and later runs are read only."""
    at = F.lit(moment).cast("timestamp_ntz")
    if "snapshot_run" in history.columns:
        run = F.col("snapshot_run")
        history = history.where((run == OPEN_RUN) | (run >= history_run(F.lit(moment))))
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def current_read(history: DataFrame) -> DataFrame:
    """The open versions."""
    if "snapshot_run" in history.columns:
        history = history.where(F.col("snapshot_run") == OPEN_RUN)
    return history.where(F.col("valid_to").isNull())

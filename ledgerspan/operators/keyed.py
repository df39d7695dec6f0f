"""Keyed replacement: delete+insert, retroactive contract changes, schema sync.

Everything here is a join on the keys, written as anti-joins so that duplicates in the batch do not
multiply rows and null keys never match.  The target is the large side.  Pass keys that were written to a table
(``session.staged``): Spark then knows their size and broadcasts few of them, so that the target stays where it
is; many are shuffled, and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import DateType

from ..functions import exact_sum, round_half_away
from .activity import customer_activity_daily


def sync_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """``target`` in the layout of ``batch``: new columns added as null, missing ones removed."""
    known = set(target.columns)
    return target.select(
        *[
            F.col(f.name).cast(f.dataType) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
            for f in batch.schema.fields
        ]
    )


#: Keys that are broadcast at most: some hundred bytes each in an executor.
BROADCAST_KEYS = 2_000_000


def few(keys: DataFrame) -> DataFrame:
    """Keys that were written to a table, broadcast while there are few, so that the rows they are looked up for don't move."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def day_of(df: DataFrame, keys: Sequence[str]) -> str | None:
    """The key column that is a date, if the others leave it to a calendar."""
    days = [c for c in keys if df.schema[c].dataType == DateType()]
    return days[0] if len(days) == 1 and len(keys) > 1 else None


def day_bit(day: str) -> Column:
    """A date's day in its month as a bit."""
    return F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)


def key_months(batch: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """The batch's keys with their days as bits of a month: a row where there are up to 31 keys."""
    others = [F.col(c).alias(f"_{c}") for c in keys if c != day]
    return batch.groupBy(*others, F.trunc(day, "month").alias("_month")).agg(F.bit_or(day_bit(day)).alias("_bits"))


def without_keys(target: DataFrame, months: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Target rows whose key isn't in ``key_months``; null keys never match."""
    same = (F.trunc(day, "month") == F.col("_month")) & (F.col("_bits").bitwiseAND(day_bit(day)) != 0)
    for c in keys:
        if c != day:
            same = same & (F.col(c) == F.col(f"_{c}"))
    return target.join(months, same, "left_anti")


def delete_insert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sync: bool = True,
    replaced: DataFrame | None = None,
) -> DataFrame:
    """Removes target rows whose key occurs in the batch, then adds the batch.

    ``replaced`` holds the batch's keys where they are at hand already.
    """
    keys = list(keys)
    replaced = batch.select(*keys).distinct() if replaced is None else replaced
    kept = target.join(replaced, keys, "left_anti").select(*target.columns)
    return (sync_columns(kept, batch) if sync else kept).unionByName(batch)


def truncate_entities_after(
    mart: DataFrame,
    changes: DataFrame,
    key: str = "user_id",
    new_end: str = "new_end",
) -> DataFrame:
    """Removes each changed entity's rows after its new end date."""
    cut = changes.select(F.col(key).alias("_key"), F.col(new_end).alias("_end"))
    later = (F.col(key) == F.col("_key")) & (F.col("activity_date") > F.col("_end"))
    return mart.join(cut, later, "left_anti")


def replace_entities(
    target: DataFrame,
    rebuilt: DataFrame,
    changed_ids: DataFrame,
    key: str = "user_id",
) -> DataFrame:
    """Replaces all rows of the changed entities by their rebuilt ones.

    Unlike ``delete_insert`` on (entity, day), this also removes the days a shortened window no longer covers.
    """
    kept = target.join(changed_ids.select(key), key, "left_anti").select(*target.columns)
    return sync_columns(kept, rebuilt).unionByName(rebuilt)


def changed_since(entities: DataFrame, watermark, column: str = "updated_at") -> DataFrame:
    """Entities updated after the previous run."""
    return entities.where(F.col(column) > watermark)


def next_watermark(entities: DataFrame, column: str = "updated_at") -> DataFrame:
    """The watermark to keep for the next run, as a one-row DataFrame."""
    return entities.agg(F.max(column).alias("watermark"))


def apply_contract_changes(
    customers: DataFrame, changes: DataFrame, key: str = "user_id", new_end: str = "new_end"
) -> DataFrame:
    """Contracts with the end dates of ``changes`` (unique by key) put in place."""
    cut = changes.select(F.col(key), F.col(new_end).alias("_end"), F.lit(True).alias("_hit"))
    joined = customers.join(cut, key, "left")
    end = F.when(F.col("_hit"), F.col("_end")).otherwise(F.col("churned_at"))
    return joined.withColumn("churned_at", end).select(*customers.columns)


def retroactive_churn(
    mart: DataFrame, customers: DataFrame, changes: DataFrame, as_of=None
) -> DataFrame:
    """The mart after retroactive end dates: changed customers rebuilt, all others untouched."""
    ids = changes.select("user_id").distinct()
    changed = apply_contract_changes(customers.join(ids, "user_id", "left_semi"), changes)
    return replace_entities(mart, customer_activity_daily(changed, as_of), ids)


def correction_impact(before: DataFrame, after: DataFrame, key: str = "user_id") -> DataFrame:
    """Rows and premium per entity before and after a correction, and what was removed.

    Pass both versions filtered to the changed entities; one aggregation covers the two.
    """
    none = F.lit(None).cast("double")
    sides = before.select(key, F.col("daily_premium").alias("old"), none.alias("new"), F.lit(1).alias("sign")).unionByName(
        after.select(key, none.alias("old"), F.col("daily_premium").alias("new"), F.lit(-1).alias("sign"))
    )
    sums = sides.groupBy(key).agg(
        F.count_if(F.col("sign") > 0).alias("rows_before"),
        F.count_if(F.col("sign") < 0).alias("rows_after"),
        F.coalesce(exact_sum(F.col("old"), 2), F.lit(0.0)).alias("amount_before"),
        F.coalesce(exact_sum(F.col("new"), 2), F.lit(0.0)).alias("amount_after"),
    )
    return sums.select(
        "*",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        round_half_away(F.col("amount_before") - F.col("amount_after"), 2).alias("amount_removed"),
    )

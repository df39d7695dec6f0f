"""Report datasets over the marts."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact_sum, round_half_away
from ..schemas import PARTIES, STATUSES
from ..session import staged

#: Report columns for values outside a fixed list, and for none.
OTHER, UNKNOWN = "other", "unknown"


def column_of(value: Column, known: Sequence[str]) -> Column:
    """The report column a value belongs to: itself, ``other`` for values outside the known ones, ``unknown`` for none."""
    return F.when(value.isNull(), UNKNOWN).when(value.isin(list(known)), value).otherwise(OTHER)


def written_pivot(monthly: DataFrame, parties: Sequence[str] = PARTIES) -> DataFrame:
    """Written premium, one row per month and one column per party; 0 where a party has none.

    Parties outside the list are summed in ``other``, rows without a party in ``unknown``, so that columns add up to the month.
    """
    columns = [*parties, OTHER, UNKNOWN]
    rows = monthly.select("month", column_of(F.col("party"), parties).alias("party"), "written_premium")
    wide = rows.groupBy("month").pivot("party", columns).agg(exact_sum(F.col("written_premium"), 2))
    return wide.fillna(0.0, columns)


def written_vs_earned(monthly: DataFrame) -> DataFrame:
    """Written and earned premium per month over all parties, and their difference."""
    sums = monthly.groupBy("month").agg(
        exact_sum(F.col("written_premium"), 2).alias("written_premium"),
        exact_sum(F.col("earned_premium"), 2).alias("earned_premium"),
    )
    return sums.withColumn(
        "unearned_premium", round_half_away(F.col("written_premium") - F.col("earned_premium"), 2)
    )


def finance_vs_accounting(reconciliation: DataFrame) -> DataFrame:
    """Both figures side by side; fine unless finance reports less by more than a cent."""
    return reconciliation.select(
        "party",
        "month",
        "finance_premium",
        "accounting_premium",
        "delta",
        (F.col("delta") >= -0.01).alias("is_ok"),
    )


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in ascending order for presentation, nulls last.  Stored tables carry no order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def numbered(df: DataFrame, *columns: str, descending: bool = False) -> DataFrame:
    """Rows of a report with their place in presentation order, ties by the remaining columns, so that it can be stored.

    Rows are dealt out by ranges of that order and written once; each range is numbered by a task of its own, from the sum of the
    sizes of the ranges before it.  Only those sizes, one a range, reach the driver.
    """
    order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in columns]
    order += [F.col(c).asc_nulls_last() for c in df.columns if c not in columns]
    ranged = staged(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect())
    before = F.lit(0).cast("bigint")
    if len(sizes) > 1:
        starts = [0, *itertools.accumulate(n for _, n in sizes)]
        places = F.map_from_arrays(*(F.array(*(F.lit(v).cast("bigint") for v in values)) for values in ([r for r, _ in sizes], starts[:-1])))
        before = F.element_at(places, F.col("_range").cast("bigint"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("row_number", (before + within).cast("int")).drop("_range")


def delta_series(reconciliation: DataFrame) -> DataFrame:
    """Deltas with their status in party and month order."""
    return in_order(reconciliation.select("party", "month", "delta", "reconciliation_status"), "party", "month")


def status_matrix(reconciliation: DataFrame, parties: Sequence[str] = PARTIES) -> DataFrame:
    """Reconciliation status, one row per month and one column per party.

    ``other`` and ``unknown`` show the worst status among parties outside the list and rows without a party.
    """
    worst_first = {s: i for i, s in enumerate(["DISCREPANCY", "NEAR_MATCH", "MATCH"])}
    status = F.col("reconciliation_status")
    rank = F.coalesce(*[F.when(status == s, i) for s, i in worst_first.items()])
    rows = reconciliation.select("month", column_of(F.col("party"), parties).alias("party"), rank.alias("_rank"), "reconciliation_status")
    wide = rows.groupBy("month").pivot("party", [*parties, OTHER, UNKNOWN])
    return wide.agg(F.min_by("reconciliation_status", "_rank"))


def status_totals(reconciliation: DataFrame) -> DataFrame:
    """Number of party-months per reconciliation status."""
    return reconciliation.groupBy("reconciliation_status").agg(F.count(F.lit(1)).alias("party_months"))


def _clean_by_status(silver: DataFrame, statuses: Sequence[str]):
    return silver.where(F.col("_is_clean")).select(
        "party",
        F.col("transaction_month").alias("month"),
        "premium_amount",
        column_of(F.col("status"), statuses).alias("_status"),
    )


def status_counts(silver: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Clean transactions by party and month, one column per status, and their total.

    Statuses outside the list count in ``other``, missing ones in ``unknown``: the columns add up to the total of all clean rows.
    """
    columns = [*statuses, OTHER, UNKNOWN]
    return (
        _clean_by_status(silver, statuses)
        .groupBy("party", "month")
        .agg(*[F.count_if(F.col("_status") == s).alias(s) for s in columns], F.count(F.lit(1)).alias("total"))
    )


def status_amounts(silver: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Clean premium amounts by party and month, one column per status; 0 where there are none.

    ``other`` and ``unknown`` as in ``status_counts``.
    """
    columns = [*statuses, OTHER, UNKNOWN]
    rows = _clean_by_status(silver, statuses).select(
        "party", "month", *[F.when(F.col("_status") == s, F.col("premium_amount")).alias(f"_{s}") for s in columns]
    )
    return rows.groupBy("party", "month").agg(
        *[F.coalesce(exact_sum(F.col(f"_{s}"), 2), F.lit(0.0)).alias(s) for s in columns]
    )


def party_totals(monthly: DataFrame) -> DataFrame:
    """Total written premium per party, largest first."""
    return (
        monthly.groupBy("party")
        .agg(exact_sum(F.col("written_premium"), 2).alias("total_written_premium"))
        .orderBy(F.col("total_written_premium").desc(), "party")
    )


def delta_percentages(reconciliation: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Delta percent against a threshold in percent."""
    return reconciliation.select(
        "party",
        "month",
        "delta_pct",
        "reconciliation_status",
        (F.col("delta_pct") >= threshold).alias("above_threshold"),
    )

"""Finance against the accounting close: comparison, status sweep and alerts.

No join here carries a broadcast hint.  Both sides are aggregates by (party, month); adaptive
execution broadcasts one when its measured size allows and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum, round_half_away
from ..schemas import STATUS_SCENARIOS
from .premiums import is_chargeable


def reconcile(
    accounting: DataFrame,
    monthly: DataFrame,
    abs_tol: float = 0.01,
    rel_tol: float = 0.01,
    use_abs_base: bool = False,
    include_unmatched: bool = False,
) -> DataFrame:
    """One row per accounting (party, month) with deltas and a three-way status.

    The relative test divides by the signed accounting figure, so a negative figure lands in
    NEAR_MATCH; ``use_abs_base`` divides by its magnitude instead.  Months known to finance only
    are left out unless ``include_unmatched``.
    """
    joined = accounting.select("party", "month", "accounting_premium").join(
        monthly.select("party", "month", "written_premium", "net_premium", "refunded_premium", "transaction_count"),
        ["party", "month"],
        "full" if include_unmatched else "left",
    )
    finance = F.coalesce(F.col("written_premium"), F.lit(0.0))
    net = F.coalesce(F.col("net_premium"), F.lit(0.0))
    account = F.coalesce(F.col("accounting_premium"), F.lit(0.0)) if include_unmatched else F.col("accounting_premium")
    base = F.nullif(F.abs(account) if use_abs_base else account, F.lit(0.0))
    gap = F.abs(finance - account)
    return joined.select(
        "party",
        "month",
        account.alias("accounting_premium"),
        finance.alias("finance_premium"),
        net.alias("net_premium"),
        F.coalesce(F.col("refunded_premium"), F.lit(0.0)).alias("refunded_premium"),
        round_half_away(net - account, 2).alias("net_delta"),
        F.coalesce(F.col("transaction_count"), F.lit(0)).cast("bigint").alias("transaction_count"),
        round_half_away(finance - account, 2).alias("delta"),
        round_half_away(gap / base * 100, 4).alias("delta_pct"),
        F.when(gap < abs_tol, "MATCH")
        .when(gap / base < rel_tol, "NEAR_MATCH")
        .otherwise("DISCREPANCY")
        .alias("reconciliation_status"),
        (gap < abs_tol).alias("is_reconciled"),
    )


def within_tolerance(delta: Column, tolerance: float = 0.01) -> Column:
    """Row marker of the sweep: a rounded delta of exactly the tolerance still passes."""
    return ~(F.abs(delta) > tolerance)


def status_sweep_detail(
    silver: DataFrame,
    accounting: DataFrame,
    scenarios: Mapping[str, Sequence[str]] = STATUS_SCENARIOS,
) -> DataFrame:
    """Finance premium and delta per accounting row under each status set.

    All scenarios share one scan and one aggregation: each is a conditional sum.
    """
    wanted = sorted({status for statuses in scenarios.values() for status in statuses})
    status = F.col("status")
    chosen = silver.where(is_chargeable() & status.isin(wanted)).select(
        "party",
        F.col("transaction_month").alias("month"),
        *[
            F.when(status.isin(list(statuses)), F.col("premium_amount")).alias(f"_amount_{rank}")
            for rank, statuses in enumerate(scenarios.values())
        ],
    )
    finance = chosen.groupBy("party", "month").agg(
        *[exact_sum(F.col(f"_amount_{rank}"), 2).alias(f"_finance_{rank}") for rank in range(len(scenarios))]
    )
    per_scenario = F.array(
        *[
            F.struct(
                F.lit(name).alias("scenario"),
                F.lit(rank).alias("scenario_rank"),
                F.coalesce(F.col(f"_finance_{rank}"), F.lit(0.0)).alias("finance_premium"),
            )
            for rank, name in enumerate(scenarios)
        ]
    )
    rows = accounting.join(finance, ["party", "month"], "left").select(
        "party", "month", "accounting_premium", F.inline(per_scenario)
    )
    delta = round_half_away(F.col("finance_premium") - F.col("accounting_premium"), 2)
    return rows.select(
        "scenario",
        "scenario_rank",
        "party",
        "month",
        "accounting_premium",
        "finance_premium",
        delta.alias("delta"),
        within_tolerance(delta).alias("within_tolerance"),
    )


def status_sweep_totals(detail: DataFrame) -> DataFrame:
    """Total absolute gap per scenario."""
    gaps = detail.select("scenario", "scenario_rank", F.abs(F.col("delta")).alias("gap"))
    return gaps.groupBy("scenario", "scenario_rank").agg(
        exact_sum(F.col("gap"), 2).alias("total_abs_delta"),
        F.count(F.lit(1)).alias("compared_rows"),
    )


def status_sweep_best(detail: DataFrame) -> DataFrame:
    """The scenario with the smallest gap; the one declared first wins a tie."""
    return status_sweep_totals(detail).orderBy("total_abs_delta", "scenario_rank").limit(1)


def reconciliation_alerts(reconciliation: DataFrame, max_abs_delta: float = 1.0) -> DataFrame:
    """Rows that need attention: a DISCREPANCY, or a delta beyond ``max_abs_delta``."""
    discrepancy = F.col("reconciliation_status") == "DISCREPANCY"
    large = F.abs(F.col("delta")) > max_abs_delta
    return reconciliation.where(discrepancy | large).select(
        "party",
        "month",
        "accounting_premium",
        "finance_premium",
        "delta",
        "delta_pct",
        "reconciliation_status",
        F.when(discrepancy & large, "discrepancy,large_delta")
        .when(discrepancy, "discrepancy")
        .otherwise("large_delta")
        .alias("alert_reason"),
    )


def gross_vs_net_gap(reconciliation: DataFrame) -> DataFrame:
    """Total gap of gross figures beside that of figures net of refunds."""
    gaps = reconciliation.select(F.abs(F.col("delta")).alias("gross"), F.abs(F.col("net_delta")).alias("net"))
    return gaps.agg(
        exact_sum(F.col("gross"), 2).alias("gross_abs_delta"), exact_sum(F.col("net"), 2).alias("net_abs_delta")
    ).withColumn("net_widens_gap", F.col("net_abs_delta") > F.col("gross_abs_delta"))

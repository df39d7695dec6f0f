"""Root-cause and data-quality reports over silver transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum, month_bucket


def refund_summary(silver: DataFrame) -> DataFrame:
    """Refund count and amount by (party, month), flagged rows included."""
    return (
        silver.where(F.col("status_raw") == "refunded")
        .groupBy("party", "transaction_month")
        .agg(
            F.count(F.lit(1)).alias("refund_count"),
            exact_sum(F.col("premium_amount"), 2).alias("refunded_amount"),
        )
    )


def status_breakdown(silver: DataFrame) -> DataFrame:
    """Count and amount of clean rows by (party, month, raw status)."""
    return (
        silver.where(F.col("_is_clean"))
        .groupBy("party", "transaction_month", "status_raw")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            exact_sum(F.col("premium_amount"), 2).alias("total_amount"),
        )
    )


def unparseable_count(silver: DataFrame) -> DataFrame:
    """Rows whose timestamp could not be read."""
    return silver.agg(F.count_if(F.col("created_at_ts").isNull()).alias("unparseable_timestamps"))


def dq_excluded_rows(silver: DataFrame) -> DataFrame:
    """Rows with at least one finding."""
    return silver.where(F.col("_dq_flags") != "").select(
        "transaction_id", "transaction_date", "premium_amount", "party", "status", "_dq_flags"
    )


def dq_flag_counts(silver: DataFrame) -> DataFrame:
    """Rows and amount held back per finding; a row with two findings counts in both."""
    return (
        silver.where(F.col("_dq_flags") != "")
        .select(F.explode(F.split("_dq_flags", ",")).alias("dq_flag"), "premium_amount")
        .groupBy("dq_flag")
        .agg(
            F.count(F.lit(1)).alias("flagged_rows"),
            exact_sum(F.col("premium_amount"), 2).alias("flagged_amount"),
        )
    )


def cutoff_month_counts(silver: DataFrame, booking_zone: str) -> DataFrame:
    """Rows per month under the UTC clock and under ``booking_zone``, in one pass."""
    moved = F.convert_timezone(F.lit("UTC"), F.lit(booking_zone), F.col("created_at_ts")).cast("date")
    clocks = F.array(
        F.struct(F.col("transaction_month"), F.lit(1).alias("utc"), F.lit(0).alias("zone")),
        F.struct(month_bucket(moved).alias("transaction_month"), F.lit(0).alias("utc"), F.lit(1).alias("zone")),
    )
    return (
        silver.where(F.col("created_at_ts").isNotNull())
        .select(F.inline(clocks))
        .groupBy("transaction_month")
        .agg(F.sum("utc").alias("utc_rows"), F.sum("zone").alias("zone_rows"))
    )


def boundary_transactions(
    silver: DataFrame, hours: int = 48, party: str | None = None, month: str | None = None
) -> DataFrame:
    """Rows within ``hours`` of the start or the end of their month, optionally of one party and month."""
    ts = F.col("created_at_ts")
    first = F.trunc(F.col("transaction_date"), "month")
    reach = F.expr(f"interval {int(hours)} hours")
    after_start = ts <= first.cast("timestamp_ntz") + reach
    before_end = ts >= F.add_months(first, 1).cast("timestamp_ntz") - reach
    rows = silver
    if party is not None:
        rows = rows.where(F.col("party") == party)
    if month is not None:
        rows = rows.where(F.col("transaction_month") == month)
    return rows.where(after_start | before_end).select(
        "transaction_id",
        "created_at_ts",
        "transaction_month",
        "party",
        "status",
        "premium_amount",
        F.when(after_start, "month_start").otherwise("month_end").alias("boundary"),
    )

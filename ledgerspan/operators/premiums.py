"""Monthly premium mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import days_in_month, days_left_in_month, exact_sum, round_half_away


def is_chargeable() -> Column:
    """Clean rows with a positive amount; zero amounts are clean but never counted."""
    return F.col("_is_clean") & (F.col("premium_amount") > 0)


def amount_days() -> Column:
    """Amount times the days left in its month, day of charge included: the numerator of the earned share.

    All charges of a month share its length as denominator, so the numerators are summed exactly and divided
    once.  Half cents are common here (half of an odd amount in a 30-day month), and a sum of quotients would decide
    them by chance.
    """
    return F.col("premium_amount") * days_left_in_month(F.col("transaction_date"))


def monthly_premiums(silver: DataFrame, include_unmatched: bool = False) -> DataFrame:
    """Written, earned, refunded and net premium by (party, month).

    Written and refunded rows are gathered in one scan and one shuffle of partial sums.  Months that hold
    refunds only are left out unless ``include_unmatched``; their written premium is then 0.
    """
    processed = F.col("status") == "processed"
    refunded = F.col("status_raw") == "refunded"
    date = F.col("transaction_date")
    rows = silver.where(is_chargeable() & (processed | refunded)).select(
        "party",
        F.col("transaction_month").alias("month"),
        F.when(processed, F.col("premium_amount")).alias("written"),
        F.when(processed, amount_days()).alias("written_days"),
        F.when(refunded, F.col("premium_amount")).alias("refunded"),
        F.when(processed, date).alias("written_on"),
        days_in_month(date).alias("month_days"),
    )
    sums = rows.groupBy("party", "month").agg(
        exact_sum(F.col("written"), 2).alias("written_premium"),
        exact_sum(F.col("written_days"), 2, divisor=F.max("month_days")).alias("earned_premium"),
        F.count("written").alias("transaction_count"),
        F.min("written_on").alias("first_transaction_date"),
        F.max("written_on").alias("last_transaction_date"),
        F.coalesce(exact_sum(F.col("refunded"), 2), F.lit(0.0)).alias("refunded_premium"),
        F.count("refunded").alias("refund_count"),
    )
    if include_unmatched:
        sums = sums.fillna(0.0, ["written_premium", "earned_premium"])
    else:
        sums = sums.where(F.col("transaction_count") > 0)
    net = round_half_away(F.col("written_premium") - F.col("refunded_premium"), 2)
    return sums.select(
        "party",
        "month",
        F.col("written_premium").alias("premium"),
        "written_premium",
        "refunded_premium",
        "refund_count",
        net.alias("net_premium"),
        "earned_premium",
        "transaction_count",
        "first_transaction_date",
        "last_transaction_date",
    )


def rounding_order(silver: DataFrame) -> DataFrame:
    """Sum-then-round against round-each-then-sum, by (party, month), over written premium rows."""
    amount, length = F.col("premium_amount"), days_in_month(F.col("transaction_date"))
    rows = silver.where(is_chargeable() & (F.col("status") == "processed")).select(
        "party",
        F.col("transaction_month").alias("month"),
        "premium_amount",
        round_half_away(amount, 2).alias("rounded"),
        amount_days().alias("amount_days"),
        round_half_away(amount_days() / length.cast("double"), 2).alias("rounded_share"),
        length.alias("month_days"),
    )
    sums = rows.groupBy("party", "month").agg(
        exact_sum(amount, 2).alias("written_sum_then_round"),
        exact_sum(F.col("rounded"), 2).alias("written_round_then_sum"),
        exact_sum(F.col("amount_days"), 2, divisor=F.max("month_days")).alias("earned_sum_then_round"),
        exact_sum(F.col("rounded_share"), 2).alias("earned_round_then_sum"),
    )
    return sums.select(
        "*",
        round_half_away(F.col("written_round_then_sum") - F.col("written_sum_then_round"), 2).alias(
            "written_difference"
        ),
        round_half_away(F.col("earned_round_then_sum") - F.col("earned_sum_then_round"), 2).alias(
            "earned_difference"
        ),
    )

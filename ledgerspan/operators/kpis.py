"""The three activity KPIs, over the stored mart or straight from contract dates.

The forms over the mart are plain filters and sums.  Their date predicate is repeated on
``activity_month``, because a partition filter is not derived from a filter on ``activity_date``.
The forms over contracts give the same figures without building the mart.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_date, days_between, days_in_month, exact_sum, month_text, round_half_away
from .activity import contract_months, contract_windows

DateValue = dt.date | str


def between_dates(mart: DataFrame, start: DateValue | None, end: DateValue | None) -> DataFrame:
    """Rows from ``start`` to ``end``, both included, with the matching partition filter."""
    if start is not None:
        mart = mart.where((F.col("activity_date") >= as_date(start)) & (F.col("activity_month") >= month_text(start)))
    if end is not None:
        mart = mart.where((F.col("activity_date") <= as_date(end)) & (F.col("activity_month") <= month_text(end)))
    return mart


def active_customers(
    mart: DataFrame, start: DateValue | None = None, end: DateValue | None = None, one_row_per_day: bool = True
) -> DataFrame:
    """KPI 1: active customers and their daily premium by day and product group.

    Counts rows, one exchange of days and groups: the grain (user_id, activity_date) is declared unique and checked
    (``ACTIVITY_CHECKS``).  Without that check ``one_row_per_day=False`` counts distinct customers, at the cost of a shuffle of
    the whole range.
    """
    customers = F.count(F.col("user_id")) if one_row_per_day else F.count_distinct("user_id")
    return (
        between_dates(mart, start, end)
        .groupBy("activity_date", "product_group")
        .agg(
            customers.alias("active_customers"),
            exact_sum(F.col("daily_premium"), 4).alias("daily_premium_total"),
        )
    )


def premium_collected(mart: DataFrame, start: DateValue, end: DateValue) -> DataFrame:
    """KPI 2: premium collected per product group in a date range."""
    return (
        between_dates(mart, start, end)
        .groupBy("product_group")
        .agg(exact_sum(F.col("daily_premium"), 2).alias("premium_collected"))
    )


def accumulated_premium(mart: DataFrame, until: DateValue, by_product: bool = True) -> DataFrame:
    """KPI 3: premium accumulated per customer up to a date."""
    rows = between_dates(mart, None, until)
    total = exact_sum(F.col("daily_premium"), 2).alias("accumulated_premium")
    if not by_product:
        return rows.groupBy("user_id").agg(total)
    return rows.groupBy("user_id", "product_group").agg(
        F.min("started_at").alias("started_at"), F.max("churned_at").alias("churned_at"), total
    )


def _month_amounts(customers: DataFrame, as_of, start, end) -> DataFrame:
    active_days = days_between(F.col("active_to"), F.col("active_from")) + 1
    return contract_months(customers, as_of, start, end).withColumn(
        # Whole millionths: a product of doubles would leave the six-decimal grid of the daily sums.
        "_amount", F.rint(F.col("daily_premium") * 1e6) * active_days / F.lit(1e6)
    )


def premium_collected_from_contracts(customers: DataFrame, start: DateValue, end: DateValue, as_of=None) -> DataFrame:
    """KPI 2 from contract months: active days times the daily premium of the month."""
    return (
        _month_amounts(customers, as_of, start, end)
        .groupBy("product_group")
        .agg(exact_sum(F.col("_amount"), 2).alias("premium_collected"))
    )


def accumulated_premium_from_contracts(customers: DataFrame, until: DateValue, as_of=None) -> DataFrame:
    """KPI 3 from contract months."""
    return (
        _month_amounts(customers, as_of, None, until)
        .groupBy("user_id", "product_group")
        .agg(
            F.min("started_at").alias("started_at"),
            F.max("churned_at").alias("churned_at"),
            exact_sum(F.col("_amount"), 2).alias("accumulated_premium"),
        )
    )


MONTH_LENGTHS = (28, 29, 30, 31)


def active_customers_from_contracts(
    customers: DataFrame, start: DateValue, end: DateValue, as_of=None
) -> DataFrame:
    """KPI 1 from contract starts and ends, without a daily row per customer.

    Every contract adds itself on its first day and removes itself after its last; running totals
    over the changes of a product group give the figures, and each lasts until the next change.  The
    window only sees one row per product group and day of change, so its size is
    bounded by the calendar, not by the customers.  Assumes one contract per customer, product group and day.
    The daily premium depends on the length of the month, hence one running total per length.
    """
    windows = contract_windows(customers, as_of, start, end)

    def micro(length: int) -> Column:
        # A missing premium counts as a customer and adds nothing.
        daily = round_half_away(F.col("monthly_premium").cast("double") / length, 6)
        return F.coalesce(F.rint(daily * 1e6).try_cast("bigint"), F.lit(0).cast("bigint"))

    changes = (
        windows.select(
            "product_group",
            F.inline(
                F.array(
                    F.struct(F.col("window_start").alias("day"), F.lit(1).alias("sign")),
                    F.struct(F.date_add("window_end", 1).alias("day"), F.lit(-1).alias("sign")),
                )
            ),
            *[micro(n).alias(f"_micro_{n}") for n in MONTH_LENGTHS],
        )
        .groupBy("product_group", "day")
        .agg(
            F.sum(F.col("sign").cast("bigint")).alias("customers"),
            *[F.sum(F.col("sign") * F.col(f"_micro_{n}")).alias(f"_micro_{n}") for n in MONTH_LENGTHS],
        )
    )
    by_day = Window.partitionBy("product_group").orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = changes.select(
        "product_group",
        "day",
        F.date_sub(F.lead("day").over(by_day), 1).alias("_last"),
        F.sum("customers").over(so_far).alias("active_customers"),
        *[F.sum(f"_micro_{n}").over(so_far).alias(f"_micro_{n}") for n in MONTH_LENGTHS],
    )
    # After its last change a group has no active customer left, so the open end needs no days.
    days = running.where((F.col("active_customers") > 0) & F.col("_last").isNotNull()).withColumn(
        "activity_date", F.explode(F.sequence(F.col("day"), F.col("_last"), F.expr("interval 1 day")))
    )
    length = days_in_month(F.col("activity_date"))
    total = F.coalesce(*[F.when(length == n, F.col(f"_micro_{n}")) for n in MONTH_LENGTHS])
    exact = total.cast("decimal(19,0)") * F.expr("0.000001BD")
    return days.select(
        "activity_date",
        "product_group",
        "active_customers",
        round_half_away(exact.cast("double"), 4).alias("daily_premium_total"),
    )

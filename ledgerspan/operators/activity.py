"""Daily activity mart: contract windows expanded to one row per customer and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    as_date,
    daily_series,
    days_between,
    days_in_month,
    month_bucket,
    month_series,
    round_half_away,
)

MART_COLUMNS = [
    "activity_date",
    "user_id",
    "product_group",
    "acquisition_date",
    "started_at",
    "churned_at",
    "daily_premium",
    "monthly_premium",
    "days_since_acquisition",
    "activity_month",
]


def contract_windows(customers: DataFrame, as_of=None, start=None, end=None) -> DataFrame:
    """Customers with their active window; open contracts run to ``as_of`` (default: today).

    ``start`` and ``end`` clip the window, so that a question about a few days expands a few days only.
    Empty windows (also: no start date) are dropped, as they have no active day.
    """
    first = F.col("started_at")
    last = F.coalesce(F.col("churned_at"), F.current_date() if as_of is None else as_date(as_of))
    # A null start must stay null: greatest() would ignore it.
    if start is not None:
        first = F.when(first.isNotNull(), F.greatest(first, as_date(start)))
    if end is not None:
        last = F.least(last, as_date(end))
    windows = customers.withColumns({"window_start": first, "window_end": last})
    return windows.where(F.col("window_start") <= F.col("window_end"))


#: Contract months that one task expands: some three million days.
MONTHS_PER_TASK = 100_000
#: Times as many tasks where days are gathered by key in place, so that a task's days fit its memory.
GROUPED_TASKS = 4


def expansion_tasks(windows: DataFrame) -> int:
    """Tasks for the expansion of contract windows, from the months they cover; counted in one small job."""
    first, last = F.col("window_start"), F.col("window_end")
    months = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1
    total = windows.agg(F.sum(months.cast("bigint"))).first()[0] or 0
    return max(2 * windows.sparkSession.sparkContext.defaultParallelism, -(-total // MONTHS_PER_TASK))


def spread(windows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Contract windows dealt evenly over tasks, by default as many as their months need, before they are expanded.

    A contract grows into a thousand rows, so a split that is comfortable to read is too large to expand, and
    adaptive execution would even merge small inputs into one task.  Dealing round-robin
    keeps a customer with very many contracts from gathering in one task.  0 leaves the partitions as they are.
    """
    if tasks is None:
        tasks = expansion_tasks(windows)
    return windows.repartition(tasks) if tasks else windows


def contract_months(customers: DataFrame, as_of=None, start=None, end=None, tasks: int | None = None) -> DataFrame:
    """One row per customer and calendar month: the days active in it and the daily premium.

    The daily premium is constant within a month, so everything that depends on the month is computed here,
    about thirty times less often than per day.
    """
    return window_months(contract_windows(customers, as_of, start, end), tasks)


def window_months(windows: DataFrame, tasks: int | None = None) -> DataFrame:
    """``contract_months`` of contracts whose windows are known."""
    months = spread(windows, tasks).withColumn(
        "month_start", F.explode(month_series(F.col("window_start"), F.col("window_end")))
    )
    month = F.col("month_start")
    daily = round_half_away(F.col("monthly_premium").cast("double") / days_in_month(month), 6)
    return months.withColumns(
        {
            "active_from": F.greatest(F.col("window_start"), month),
            "active_to": F.least(F.col("window_end"), F.last_day(month)),
            "daily_premium": daily,
            "activity_month": month_bucket(month),
        }
    ).drop("window_start", "window_end", "month_start")


def expand_days(months: DataFrame, *more: str) -> DataFrame:
    """Contract months to mart rows, one per day; ``more`` columns go along."""
    days = months.withColumn("activity_date", F.explode(daily_series(F.col("active_from"), F.col("active_to"))))
    return days.withColumn(
        "days_since_acquisition", days_between(F.col("activity_date"), F.col("acquisition_date"))
    ).select(*MART_COLUMNS, *more)


def customer_activity_daily(
    customers: DataFrame, as_of=None, start=None, end=None, tasks: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The mart: one row per customer and active day, both window ends included.

    Only contracts are shuffled, to spread the work; days are expanded in place.  With ``by``, columns that a contract month
    has, contract months are shuffled by them, so that a grouping by these columns moves no day.
    """
    if not by:
        return expand_days(contract_months(customers, as_of, start, end, tasks))
    tasks = tasks or GROUPED_TASKS * expansion_tasks(contract_windows(customers, as_of, start, end))
    return expand_days(contract_months(customers, as_of, start, end, tasks=0).repartition(tasks, *by))


def months_touched(customers: DataFrame, as_of=None) -> DataFrame:
    """The months any of the contracts was active in."""
    return contract_months(customers, as_of, tasks=0).select("activity_month").distinct()


def storage_layout(customers: DataFrame, as_of=None, rows_per_file: int = 10_000_000) -> tuple[int, int]:
    """(files per month, writing tasks) for the mart, from the size of its largest month.

    Counts contract months, not days; the result is one row.
    """
    days = days_between(F.col("active_to"), F.col("active_from")) + 1
    by_month = contract_months(customers, as_of).groupBy("activity_month").agg(F.sum(days).alias("rows"))
    size = by_month.agg(
        F.max("rows").alias("largest"), F.min("activity_month").alias("first"), F.max("activity_month").alias("last")
    ).first()
    return layout_of(size.largest, size.first, size.last, rows_per_file)


def layout_of(largest: int | None, first: str, last: str, rows_per_file: int = 10_000_000) -> tuple[int, int]:
    """(files per month, writing tasks) for months from ``first`` to ``last`` of at most ``largest`` rows each."""
    files = max(1, -(-(largest or 0) // rows_per_file))
    return files, files * (_month_number(last) - _month_number(first) + 1) if largest else 1


def _month_number(text: str) -> int:
    return int(text[:4]) * 12 + int(text[5:7])


def activity_for_storage(customers: DataFrame, as_of=None, files_per_month: int = 1, tasks: int = 1) -> DataFrame:
    """The mart laid out for a write partitioned by month; ``storage_layout`` gives the two numbers.

    Rows are moved while they are still contract months, then expanded inside the writing tasks: the shuffle
    carries a thirtieth of the mart.  Each file of a month is a task of its own: contracts are dealt over a month's
    files by their whole content, so that no customer or month can fill a task, and no two files meet in one.
    """
    return expand_days(month_files(contract_months(customers, as_of, tasks=0), files_per_month, tasks))


def month_files(months: DataFrame, files_per_month: int, tasks: int) -> DataFrame:
    """Contract months dealt over the files of their month, each file a task."""
    share = F.pmod(F.xxhash64("user_id", "started_at", "monthly_premium"), F.lit(files_per_month))
    number = F.substring("activity_month", 1, 4).cast("int") * 12 + F.substring("activity_month", 6, 2).cast("int")
    # Months follow one another, so that a number modulo the tasks is a task of its own.
    return months.repartitionById(tasks, F.pmod(number * files_per_month + share, F.lit(tasks)).cast("int"))


def activity_summary(mart: DataFrame) -> DataFrame:
    """Summary layer by (activity_date, product_group) for boards that need no customer detail."""
    from .kpis import active_customers

    return active_customers(mart)


def active_on(customers: DataFrame, day, as_of=None) -> DataFrame:
    """Customers active on one day, straight from the contract dates."""
    return contract_windows(customers, as_of, day, day).drop("window_start", "window_end")


def active_counts_on_dates(customers: DataFrame, dates: DataFrame, as_of=None, date_column: str = "as_of_date") -> DataFrame:
    """Number of customers active on each day of ``dates`` on which any is, without a row per customer and day.

    Contracts add one on their first day and take it off after their last; the days, merged into the same order, read the
    running total.  The window sees calendar days, whatever the customers.
    """
    days = dates.select(F.col(date_column).cast("date").alias("day")).where(F.col("day").isNotNull()).distinct()
    change = lambda day, sign: F.struct(day.alias("day"), F.lit(sign).cast("bigint").alias("sign"))
    changes = contract_windows(customers, as_of).select(
        F.inline(F.array(change(F.col("window_start"), 1), change(F.date_add("window_end", 1), -1)))
    )
    merged = changes.groupBy("day").agg(F.sum("sign").alias("sign")).join(days.withColumn("asked", F.lit(True)), "day", "full")
    running = F.sum(F.coalesce("sign", F.lit(0))).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = merged.select(F.col("day").alias(date_column), "asked", running.alias("active_customers"))
    return counted.where(F.col("asked") & (F.col("active_customers") > 0)).drop("asked")


def active_on_dates(customers: DataFrame, dates: DataFrame, as_of=None, date_column: str = "as_of_date") -> DataFrame:
    """Customers active on each of many days: the range join, as an equi-join on the month.

    Contracts are bucketed by month, in as many tasks as their months need, then filtered to the days inside the window.  The distinct days are
    broadcast: a calendar bounds them (36,525 days in a century, about 16 bytes each), whatever the data.
    """
    days = dates.select(F.col(date_column).cast("date").alias(date_column)).where(F.col(date_column).isNotNull())
    days = days.distinct().withColumn("_month", F.trunc(F.col(date_column), "month"))
    windows = spread(contract_windows(customers, as_of)).withColumn(
        "_month", F.explode(month_series(F.col("window_start"), F.col("window_end")))
    )
    return (
        windows.join(F.broadcast(days), "_month")
        .where(F.col(date_column).between(F.col("window_start"), F.col("window_end")))
        .drop("_month", "window_start", "window_end")
    )

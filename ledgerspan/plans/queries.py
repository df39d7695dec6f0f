"""Named queries over the test tables, one per operator.  Each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import days_in_month, exact_sum
from ..operators import activity, changes, diagnostics, history, keyed, kpis, quality, reports, stored
from ..operators import reconciliation as recon
from ..operators.ledger import land_files
from ..operators.premiums import amount_days, is_chargeable, monthly_premiums, rounding_order
from ..operators.silver import to_silver
from ..session import scratch_database, shared_folder, staged, track_databases
from ..sources.landing import ingest_transactions
from ..sources.reference_data import accounting_from_rows, read_accounting_csv
from ..sources.tables import LAYERS, create_layers, with_lineage, write_table
from . import adapters as data
from .adapters import AS_OF
from .incremental import refresh_activity, refresh_activity_from_contracts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The parameters shared with the oracle.
RANGE = ("1996-01-01", "1996-12-31")
UNTIL = "1998-06-30"
DAY = "1997-03-15"
ZONE = "America/New_York"
SNAPSHOTS = ("2001-08-01 00:00:00", "2001-08-02 00:00:00", "2001-08-03 00:00:00")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


def _reconciliation(spark, sf_dir, **options):
    monthly = staged(data.monthly(spark, sf_dir))
    return recon.reconcile(data.accounting_from(monthly), monthly, **options)


def _mart(spark, sf_dir, start=None, end=None, by=()):
    return activity.customer_activity_daily(data.customers(spark, sf_dir), AS_OF, start, end, by=by)


# --- landing, silver, premiums -----------------------------------------------------------------


@query
def ingest_csv(spark, sf_dir):
    """Raw rows written as CSV files and landed again."""
    folder = shared_folder(spark, "landing")
    data.raw_transactions(spark, sf_dir).write.option("header", True).option("escape", '"').csv(folder)
    landed = ingest_transactions(spark, folder)
    return landed.withColumn("has_provenance", F.col("_source_file").endswith(".csv") & F.col("_ingested_at").isNotNull()).drop(
        "_source_file", "_ingested_at"
    )


@query
def bronze_rows(spark, sf_dir):
    return data.bronze(spark, sf_dir).drop("_ingested_at")


@query
def silver_transactions(spark, sf_dir):
    return data.silver(spark, sf_dir)


@query
def silver_without_party_test(spark, sf_dir):
    return data.silver(spark, sf_dir, require_party=False).select("transaction_id", "_dq_flags", "_is_clean")


@query
def monthly_premiums_query(spark, sf_dir):
    return data.monthly(spark, sf_dir)


@query
def monthly_premiums_with_unmatched(spark, sf_dir):
    return monthly_premiums(data.silver(spark, sf_dir), include_unmatched=True)


# --- reconciliation ----------------------------------------------------------------------------


@query
def reconciliation(spark, sf_dir):
    return _reconciliation(spark, sf_dir)


@query
def reconciliation_with_unmatched(spark, sf_dir):
    return _reconciliation(spark, sf_dir, include_unmatched=True, use_abs_base=True)


def _sweep(spark, sf_dir):
    """Only what the sweep and the close need of silver is kept between them."""
    rows = data.silver(spark, sf_dir, require_party=False)
    narrow = ["party", "transaction_month", "transaction_date", "premium_amount", "status", "status_raw", "_is_clean"]
    rows = staged(rows.where(F.col("_is_clean")).select(*narrow))
    close = data.accounting_from(monthly_premiums(rows.where(F.col("party").isNotNull())))
    return recon.status_sweep_detail(rows, close)


@query
def status_sweep_detail(spark, sf_dir):
    return _sweep(spark, sf_dir)


@query
def status_sweep_totals(spark, sf_dir):
    return recon.status_sweep_totals(_sweep(spark, sf_dir))


@query
def status_sweep_best(spark, sf_dir):
    return recon.status_sweep_best(_sweep(spark, sf_dir))


@query
def alerts(spark, sf_dir):
    return recon.reconciliation_alerts(_reconciliation(spark, sf_dir))


@query
def gross_vs_net_gap(spark, sf_dir):
    return recon.gross_vs_net_gap(_reconciliation(spark, sf_dir))


# --- diagnostics -------------------------------------------------------------------------------


@query
def refund_summary(spark, sf_dir):
    return diagnostics.refund_summary(data.silver(spark, sf_dir, require_party=False))


@query
def status_breakdown(spark, sf_dir):
    return diagnostics.status_breakdown(data.silver(spark, sf_dir, require_party=False))


@query
def unparseable_count(spark, sf_dir):
    return diagnostics.unparseable_count(data.silver(spark, sf_dir))


@query
def dq_excluded_rows(spark, sf_dir):
    return diagnostics.dq_excluded_rows(data.silver(spark, sf_dir))


@query
def dq_flag_counts(spark, sf_dir):
    return diagnostics.dq_flag_counts(data.silver(spark, sf_dir))


@query
def cutoff_months(spark, sf_dir):
    return diagnostics.cutoff_month_counts(data.silver(spark, sf_dir), ZONE)


@query
def cutoff_monthly_premiums(spark, sf_dir):
    """The monthly mart with the booking date taken in an agreed zone."""
    return monthly_premiums(data.silver(spark, sf_dir, booking_zone=ZONE))


@query
def boundary_transactions(spark, sf_dir):
    return diagnostics.boundary_transactions(data.silver(spark, sf_dir), hours=48)


@query
def rounding_order_query(spark, sf_dir):
    return rounding_order(data.silver(spark, sf_dir))


# --- activity mart and KPIs --------------------------------------------------------------------


@query
def activity_daily_rows(spark, sf_dir):
    """Every row of the whole mart with all its columns, as a hash for each customer's month.

    Rows that differ by their day only are counted by day first, so that what they share is written out once a month; every mart row has
    a day.
    """
    day = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    micros = lambda c: F.rint(F.col(c) * 1e6).cast("bigint").cast("string")
    key, dates = ["user_id", "activity_month"], ["acquisition_date", "started_at", "churned_at"]
    shared = [*key, *dates, "product_group", "daily_premium", "monthly_premium"]
    rows = _mart(spark, sf_dir, by=key).select(
        *shared,
        F.trunc("activity_date", "month").alias("first_day"),
        # The same for all days of a customer's month.
        (F.col("days_since_acquisition") - F.dayofmonth("activity_date")).alias("days_before"),
        F.dayofmonth("activity_date").alias("day"),
    )
    times = [F.count_if(F.col("day") == d).alias(f"times_{d}") for d in range(1, 32)]
    months = rows.groupBy(*shared, "first_day", "days_before").agg(*times)
    cells = [*map(day, dates), F.col("product_group"), micros("daily_premium"), micros("monthly_premium")]
    month = F.col("first_day").cast("string")
    months = months.withColumns({"cells": F.concat_ws("|", *cells), "month": F.substring(month, F.lit(1), F.length(month) - 2)})

    def text(d: int) -> Column:
        date = F.concat(F.col("month"), F.lit(f"{d:02d}"))
        return F.when(F.col(f"times_{d}") > 0, F.concat_ws("|", date, "cells", (F.col("days_before") + d).cast("string")))

    repeated = [F.array_repeat(text(d), F.col(f"times_{d}").cast("int")) for d in range(1, 32)]
    # Nothing is added by the first list; its lambda keeps the texts out of the method generated for the counts, which the JVM would
    # find too long to compile.
    lists = months.select(*key, F.concat(F.filter(F.array("month"), lambda month: month.isNull()), *repeated).alias("rows"))
    whole = lists.groupBy(*key).agg(F.sort_array(F.flatten(F.collect_list("rows"))).alias("rows"))
    return whole.select("user_id", "activity_month", F.size("rows").cast("bigint").alias("mart_rows"), F.md5(F.concat_ws(",", "rows")).alias("rows_md5"))


@query
def activity_months(spark, sf_dir):
    """The whole mart, counted by month and product group."""
    mart = _mart(spark, sf_dir)
    return mart.groupBy("activity_month", "product_group").agg(
        F.count(F.lit(1)).alias("mart_rows"),
        F.sum("days_since_acquisition").alias("customer_days"),
        F.min("activity_date").alias("first_day"),
        F.max("activity_date").alias("last_day"),
    )


@query
def activity_daily_content(spark, sf_dir):
    """Every column of the whole mart, by month and product group, as exact sums."""
    day = lambda c: F.unix_date(c).cast("bigint")
    return _mart(spark, sf_dir).groupBy("activity_month", "product_group").agg(
        F.count(F.lit(1)).alias("mart_rows"),
        F.sum(F.col("user_id").cast("bigint")).alias("user_ids"),
        F.sum(day("activity_date")).alias("activity_days"),
        F.sum(day("activity_date") * F.col("user_id").cast("bigint")).alias("days_by_user"),
        F.sum(day("acquisition_date")).alias("acquisition_days"),
        F.sum(day("started_at")).alias("start_days"),
        F.sum(day("churned_at")).alias("churn_days"),
        F.count("churned_at").alias("churned_rows"),
        F.sum(F.rint(F.col("daily_premium") * 1e6).cast("bigint")).alias("daily_micros"),
        F.sum(F.rint(F.col("monthly_premium") * 100).cast("bigint")).alias("monthly_cents"),
        F.sum("days_since_acquisition").alias("customer_days"),
    )


@query
def activity_summary(spark, sf_dir):
    return activity.activity_summary(_mart(spark, sf_dir))


@query
def kpi_active_customers(spark, sf_dir):
    return kpis.active_customers(_mart(spark, sf_dir, *RANGE), *RANGE)


@query
def kpi_active_customers_distinct(spark, sf_dir):
    """KPI 1 for tables whose grain isn't checked."""
    return kpis.active_customers(_mart(spark, sf_dir, *RANGE), *RANGE, one_row_per_day=False)


@query
def kpi_one_day(spark, sf_dir):
    """KPI 1 of one day."""
    return kpis.active_customers(_mart(spark, sf_dir, DAY, DAY), DAY, DAY)


@query
def kpi_accumulated_by_customer_window(spark, sf_dir):
    """Rows, first and last day and premium of each customer, as the mart holds them."""
    return _mart(spark, sf_dir).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("active_days"),
        F.min("activity_date").alias("first_day"),
        F.max("activity_date").alias("last_day"),
        exact_sum(F.col("daily_premium"), 2).alias("premium"),
    )


@query
def kpi_unrounded(spark, sf_dir):
    """KPI 2 to four decimals, where a plain sum of doubles tells the same."""
    mart = _mart(spark, sf_dir, *RANGE)
    return kpis.between_dates(mart, *RANGE).groupBy("product_group").agg(exact_sum(F.col("daily_premium"), 4).alias("premium_collected"))


@query
def earned_premium_unrounded(spark, sf_dir):
    """Earned premium to four decimals, against a sum of the shares of each row."""
    written = data.silver(spark, sf_dir).where(is_chargeable() & (F.col("status") == "processed"))
    shares = written.select(
        "party", F.col("transaction_month").alias("month"), amount_days().alias("days"), days_in_month(F.col("transaction_date")).alias("length")
    )
    return shares.groupBy("party", "month").agg(exact_sum(F.col("days"), 4, divisor=F.max("length")).alias("earned_premium"))


@query
def kpi_active_customers_running(spark, sf_dir):
    return kpis.active_customers_from_contracts(data.customers(spark, sf_dir), "1995-01-01", AS_OF, AS_OF)


@query
def kpi_premium_collected(spark, sf_dir):
    return kpis.premium_collected(_mart(spark, sf_dir, *RANGE), *RANGE)


@query
def kpi_premium_collected_contracts(spark, sf_dir):
    return kpis.premium_collected_from_contracts(data.customers(spark, sf_dir), *RANGE, AS_OF)


@query
def kpi_accumulated_premium(spark, sf_dir):
    return kpis.accumulated_premium(_mart(spark, sf_dir, None, UNTIL), UNTIL)


@query
def kpi_accumulated_premium_by_user(spark, sf_dir):
    return kpis.accumulated_premium(_mart(spark, sf_dir, None, UNTIL), UNTIL, by_product=False)


@query
def kpi_accumulated_premium_contracts(spark, sf_dir):
    return kpis.accumulated_premium_from_contracts(data.customers(spark, sf_dir), UNTIL, AS_OF)


@query
def active_on_date(spark, sf_dir):
    return activity.active_on(data.customers(spark, sf_dir), DAY, AS_OF)


@query
def active_on_dates(spark, sf_dir):
    """Customers active on each day an order was placed in, counted per day."""
    days = data.table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("as_of_date"))
    active = activity.active_on_dates(data.customers(spark, sf_dir), days, AS_OF)
    return active.groupBy("as_of_date").agg(F.count(F.lit(1)).alias("active_customers"))


@query
def active_counts_on_dates(spark, sf_dir):
    """The same counts from contract starts and ends."""
    days = data.table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("as_of_date"))
    return activity.active_counts_on_dates(data.customers(spark, sf_dir), days, AS_OF)


# --- keyed replacement -------------------------------------------------------------------------


def _by_month(mart: DataFrame) -> DataFrame:
    return mart.groupBy("activity_month").agg(
        F.count(F.lit(1)).alias("mart_rows"),
        F.count_if(F.col("churned_at").isNull()).alias("open_rows"),
        F.sum("days_since_acquisition").alias("customer_days"),
    )


def _contracts(spark, sf_dir):
    """Contracts, stored because a correction reads them several times, and their changed end dates."""
    contracts = staged(data.customers(spark, sf_dir))
    return contracts, data.contract_changes(contracts)


def _rebuilt(contracts, changes):
    """The recomputed windows of the changed customers."""
    changed = contracts.join(changes.select("user_id"), "user_id", "left_semi")
    return activity.customer_activity_daily(keyed.apply_contract_changes(changed, changes), AS_OF)


@query
def changed_since(spark, sf_dir):
    feed = data.customer_feed(data.customers(spark, sf_dir))
    return keyed.changed_since(feed, F.lit(AS_OF).cast("timestamp_ntz"))


@query
def next_watermark(spark, sf_dir):
    return keyed.next_watermark(data.customer_feed(data.customers(spark, sf_dir)))


@query
def contract_updates(spark, sf_dir):
    return keyed.apply_contract_changes(*_contracts(spark, sf_dir))


@query
def delete_insert(spark, sf_dir):
    """Upsert by (user, day): days a shortened window lost stay in the mart."""
    contracts, changes = _contracts(spark, sf_dir)
    mart, batch = activity.customer_activity_daily(contracts, AS_OF), staged(_rebuilt(contracts, changes))
    return _by_month(keyed.delete_insert(mart, batch, ["user_id", "activity_date"]))


@query
def retro_truncate(spark, sf_dir):
    contracts, changes = _contracts(spark, sf_dir)
    mart = activity.customer_activity_daily(contracts, AS_OF)
    return _by_month(keyed.truncate_entities_after(mart, staged(changes)))


@query
def retro_replace_entities(spark, sf_dir):
    contracts, changes = _contracts(spark, sf_dir)
    mart = activity.customer_activity_daily(contracts, AS_OF)
    return _by_month(keyed.retroactive_churn(mart, contracts, staged(changes), AS_OF))


@query
def retro_impact(spark, sf_dir):
    contracts, changes = _contracts(spark, sf_dir)
    changed = contracts.join(changes.select("user_id"), "user_id", "left_semi")
    before = activity.customer_activity_daily(changed, AS_OF)
    return keyed.correction_impact(before, _rebuilt(contracts, changes))


@query
def sync_columns(spark, sf_dir):
    """Contracts brought to the layout of the change feed: one column new, one gone."""
    contracts = data.customers(spark, sf_dir)
    return keyed.sync_columns(contracts, data.customer_feed(contracts).drop("product_group"))


@query
def stored_mart_refresh(spark, sf_dir):
    """The mart written by month, then corrected in place for the changed customers."""
    contracts, changes = _contracts(spark, sf_dir)
    mart = f"{scratch_database(spark)}.activity"
    stored.create_activity_mart(contracts, mart, AS_OF)
    rebuilt = with_lineage(_rebuilt(contracts, changes), "_loaded_at")
    stored.replace_entities_in_table(spark, mart, rebuilt, changes)
    return _by_month(spark.table(mart))


@query
def stored_truncate(spark, sf_dir):
    """The stored mart without the days after the new end dates."""
    contracts, changes = _contracts(spark, sf_dir)
    mart = f"{scratch_database(spark)}.activity"
    stored.create_activity_mart(contracts, mart, AS_OF)
    stored.truncate_entities_in_table(spark, mart, changes)
    return _by_month(spark.table(mart))


@query
def stored_upsert(spark, sf_dir):
    """Changed customers' days put into the stored mart by (user, day)."""
    contracts, changes = _contracts(spark, sf_dir)
    mart = f"{scratch_database(spark)}.activity"
    stored.create_activity_mart(contracts, mart, AS_OF)
    batch = with_lineage(_rebuilt(contracts, changes), "_loaded_at")
    stored.upsert_into_table(spark, mart, batch, ["user_id", "activity_date"])
    return _by_month(spark.table(mart))


@query
def stored_schema_sync(spark, sf_dir):
    """An upsert whose batch has gained a column and lost one: the table follows, old rows read null."""
    contracts, changes = _contracts(spark, sf_dir)
    mart = f"{scratch_database(spark)}.activity"
    stored.create_activity_mart(contracts, mart, AS_OF)
    batch = _rebuilt(contracts, changes).withColumn("channel", F.lit("web"))
    columns = [c for c in batch.columns if c not in ("acquisition_date", "activity_month")]
    batch = with_lineage(batch.select(*columns, "activity_month"), "_loaded_at")
    stored.upsert_into_table(spark, mart, batch, ["user_id", "activity_date"])
    held = spark.table(mart)
    return held.groupBy("activity_month").agg(
        F.count(F.lit(1)).alias("mart_rows"),
        F.count("channel").alias("with_channel"),
        F.lit("acquisition_date" in held.columns).alias("has_acquisition_date"),
    )


@query
def incremental_refresh(spark, sf_dir):
    """Mart and summary brought up to date with the contracts changed since the stored watermark; the summary's totals by month."""
    contracts, changes = _contracts(spark, sf_dir)
    database = scratch_database(spark)
    names = [f"{database}.{t}" for t in ("activity", "activity_summary", "watermarks")]
    first = contracts.withColumn("updated_at", F.lit("2001-08-01").cast("timestamp_ntz"))
    refresh_activity(spark, first, *names, AS_OF)
    later = data.customer_feed(contracts).select("user_id", "updated_at")
    feed = keyed.apply_contract_changes(contracts, changes).join(later, "user_id")
    refresh_activity(spark, feed, *names, AS_OF)
    totals = spark.table(names[1]).groupBy("activity_month").agg(F.sum("active_customers").alias("summary_rows"))
    return _by_month(spark.table(names[0])).join(totals, "activity_month")


def _moved(spark, sf_dir):
    """Two states of the contracts, neither of which tells when a contract changed."""
    contracts, changes_ = _contracts(spark, sf_dir)
    return contracts, staged(data.contracts_later(contracts, changes_))


@query
def entity_changes(spark, sf_dir):
    """Customers that are new, changed or gone, by fingerprints of their contracts."""
    prints = [changes.entity_fingerprints(state) for state in _moved(spark, sf_dir)]
    return changes.entity_changes(*prints)


def _refreshed(spark, sf_dir):
    """Mart, summary and contracts stored, then brought up to the later state of the contracts."""
    database = scratch_database(spark)
    names = [f"{database}.{t}" for t in ("activity", "activity_summary", "contracts")]
    for state in _moved(spark, sf_dir):
        refresh_activity_from_contracts(spark, state, *names, AS_OF)
    return names


@query
def contracts_refresh(spark, sf_dir):
    return _by_month(spark.table(_refreshed(spark, sf_dir)[0]))


@query
def summary_by_differences(spark, sf_dir):
    """Every day of the summary that signed differences were added to."""
    summary = spark.table(_refreshed(spark, sf_dir)[1])
    return summary.select("activity_date", "product_group", "active_customers", "daily_premium_total")


# --- history -----------------------------------------------------------------------------------


def _states(spark, sf_dir):
    """Three states of the transactions: as first seen, changed with deletions, deletions undone."""
    first = staged(history.snapshot_input(data.silver_states(spark, sf_dir)))
    return first, data.silver_next(first), data.silver_next(first, with_deletes=False)


def _history(spark, sf_dir):
    first, second, third = _states(spark, sf_dir)
    rows = history.initial_history(first, SNAPSHOTS[0])
    rows = staged(history.scd2_merge(rows, second, SNAPSHOTS[1]))
    return history.scd2_merge(rows, third, SNAPSHOTS[2])


@query
def scd2_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def scd2_as_of(spark, sf_dir):
    return history.as_of_read(_history(spark, sf_dir), "2001-08-02 12:00:00")


@query
def stored_snapshots(spark, sf_dir):
    """The same three snapshots taken into a stored history table."""
    table = f"{scratch_database(spark)}.transactions_history"
    for state, moment in zip(_states(spark, sf_dir), SNAPSHOTS, strict=True):
        stored.snapshot_table(spark, table, state, moment)
    return spark.table(table).drop("snapshot_run", "key_bucket")


@query
def stored_as_of(spark, sf_dir):
    """The stored history read as it stood between two snapshots."""
    table = f"{scratch_database(spark)}.transactions_history"
    for state, moment in zip(_states(spark, sf_dir), SNAPSHOTS, strict=True):
        stored.snapshot_table(spark, table, state, moment)
    return history.as_of_read(spark.table(table), "2001-08-02 12:00:00").drop("snapshot_run", "key_bucket")


# --- data checks -------------------------------------------------------------------------------


def _lineitem(spark, sf_dir):
    return data.table(spark, sf_dir, "lineitem")


@query
def dq_not_null(spark, sf_dir):
    return quality.failing_rows(data.silver(spark, sf_dir), quality.not_null("party")).select("transaction_id")


@query
def dq_accepted_values(spark, sf_dir):
    return quality.failing_rows(
        data.bronze(spark, sf_dir), quality.accepted_values("status", ["processed", "failed"])
    )


@query
def dq_unique(spark, sf_dir):
    return quality.failing_rows(_lineitem(spark, sf_dir), quality.unique("l_orderkey"))


@query
def dq_unique_combination(spark, sf_dir):
    return quality.failing_rows(
        _lineitem(spark, sf_dir), quality.unique_combination(["l_orderkey", "l_linenumber"])
    )


@query
def dq_suite(spark, sf_dir):
    """All declared checks over the five tables, each layer stored once and read by the next."""
    bronze = staged(data.bronze(spark, sf_dir))
    silver = staged(to_silver(bronze))
    monthly = staged(monthly_premiums(silver))
    compared = staged(recon.reconcile(data.accounting_from(monthly), monthly))
    suites = [
        ("bronze", bronze, quality.BRONZE_CHECKS),
        ("silver", silver, quality.SILVER_CHECKS),
        ("monthly", monthly, quality.MONTHLY_CHECKS),
        ("reconciliation", compared, quality.RECONCILIATION_CHECKS),
        ("activity", _mart(spark, sf_dir), quality.ACTIVITY_CHECKS),
    ]
    results = [quality.run_checks(df, checks, name) for name, df, checks in suites]
    out = results[0]
    for result in results[1:]:
        out = out.unionByName(result)
    return out


@query
def dq_by_month(spark, sf_dir):
    """The mart's checks kept by month; after a correction only its months are read again."""
    contracts, changes_ = _contracts(spark, sf_dir)
    database = scratch_database(spark)
    mart, results = f"{database}.activity", f"{database}.activity_checks"
    stored.create_activity_mart(contracts, mart, AS_OF)
    checks = [*quality.ACTIVITY_CHECKS, quality.accepted_values("product_group", ["building", "machinery", "household"])]
    stored.check_table(spark, mart, results, checks)
    done = stored.truncate_entities_in_table(spark, mart, changes_)
    merged = stored.check_table(spark, mart, results, checks, done["rewritten"] + done["dropped"])
    return merged.withColumn("table_name", F.lit("activity"))


# --- report datasets ---------------------------------------------------------------------------


@query
def rpt_written_pivot(spark, sf_dir):
    return reports.written_pivot(data.monthly(spark, sf_dir))


@query
def rpt_written_vs_earned(spark, sf_dir):
    return reports.written_vs_earned(data.monthly(spark, sf_dir))


@query
def rpt_finance_vs_accounting(spark, sf_dir):
    return reports.finance_vs_accounting(_reconciliation(spark, sf_dir))


@query
def rpt_delta_series(spark, sf_dir):
    return reports.delta_series(_reconciliation(spark, sf_dir))


@query
def rpt_status_matrix(spark, sf_dir):
    return reports.status_matrix(_reconciliation(spark, sf_dir))


@query
def rpt_status_totals(spark, sf_dir):
    return reports.status_totals(_reconciliation(spark, sf_dir))


@query
def rpt_status_counts(spark, sf_dir):
    return reports.status_counts(data.silver(spark, sf_dir))


@query
def rpt_status_amounts(spark, sf_dir):
    return reports.status_amounts(data.silver(spark, sf_dir))


@query
def rpt_party_totals(spark, sf_dir):
    return reports.party_totals(data.monthly(spark, sf_dir))


@query
def rpt_delta_pct(spark, sf_dir):
    return reports.delta_percentages(_reconciliation(spark, sf_dir))


@query
def rpt_delta_series_ordered(spark, sf_dir):
    return reports.numbered(reports.delta_series(_reconciliation(spark, sf_dir)), "party", "month")


@query
def rpt_sweep_ordered(spark, sf_dir):
    """The sweep in the order it is printed: scenario, party, month."""
    return reports.numbered(_sweep(spark, sf_dir), "scenario_rank", "party", "month")


@query
def rpt_status_breakdown_ordered(spark, sf_dir):
    rows = diagnostics.status_breakdown(data.silver(spark, sf_dir, require_party=False))
    return reports.numbered(rows, "party", "transaction_month", "status_raw")


@query
def rpt_refunds_ordered(spark, sf_dir):
    rows = diagnostics.refund_summary(data.silver(spark, sf_dir, require_party=False))
    return reports.numbered(rows, "party", "transaction_month")


@query
def rpt_kpi_days_ordered(spark, sf_dir):
    """KPI 1 over a range, a row a day and group, in order."""
    rows = kpis.active_customers(_mart(spark, sf_dir, *RANGE), *RANGE)
    return reports.numbered(rows, "activity_date", "product_group")


@query
def rpt_party_totals_ordered(spark, sf_dir):
    """Largest first."""
    totals = reports.party_totals(data.monthly(spark, sf_dir))
    return reports.numbered(totals, "total_written_premium", descending=True)


# --- landing and layers ------------------------------------------------------------------------


@query
def layer_rows(spark, sf_dir):
    """Rows written to each layer's table, as counted while writing, and found in it; a second run replaces the first."""
    prefix = f"{scratch_database(spark)}_"
    create_layers(spark, prefix, shared_folder(spark, "layers"))
    track_databases(spark, [f"{prefix}{layer}" for layer in LAYERS])
    raw = data.bronze(spark, sf_dir)
    tables = {"bronze": raw, "silver": with_lineage(to_silver(raw), "_silver_transformed_at"), "seeds": data.accounting_from(data.monthly(spark, sf_dir))}
    counts = []
    for layer, rows in tables.items():
        name = f"{prefix}{layer}.rows"
        written = [write_table(rows, name) for _ in range(2)][-1]
        held = spark.table(name)
        stamped = F.count_if(F.col("_silver_transformed_at").isNotNull()) if layer == "silver" else F.lit(0).cast("bigint")
        counts.append(held.agg(F.lit(layer).alias("layer"), F.lit(written).cast("bigint").alias("written"), F.count(F.lit(1)).alias("held"), stamped.alias("stamped")))
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def reference_from_rows(spark, sf_dir):
    """Close and contracts as program constants (here the rows of the adapters), typed alike: the figures finance would compare."""
    monthly = staged(data.monthly(spark, sf_dir))
    close = accounting_from_rows(spark, (tuple(r) for r in data.accounting_from(monthly).toLocalIterator()))
    return recon.reconcile(close, monthly).select("party", "month", "accounting_premium", "finance_premium", "reconciliation_status")


@query
def open_windows_today(spark, sf_dir):
    """Open contracts run to the current day where no other is given: days of each contract up to it."""
    windows = activity.contract_windows(data.customers(spark, sf_dir))
    days = F.date_diff("window_end", "window_start").cast("bigint") + 1
    return windows.select("user_id", (F.col("window_end") == F.current_date()).alias("runs_to_today"), days.alias("days"))


@query
def missing_input(spark, sf_dir):
    """Which of the tables' files can be read: a missing path is an error of the read, at once."""
    found = []
    for name in ("orders", "no_such_orders"):
        try:
            rows = spark.read.parquet(f"{sf_dir}/{name}.parquet").agg(F.count(F.lit(1)).alias("rows"))
            found.append(rows.select(F.lit(name).alias("input"), "rows", F.lit("").alias("error")))
        except AnalysisException as error:
            found.append(spark.range(1).select(F.lit(name).alias("input"), F.lit(None).cast("bigint").alias("rows"), F.lit(error.getCondition()).alias("error")))
    return found[0].unionByName(found[1])


@query
def landing_ledger(spark, sf_dir):
    """Raw rows landed from a folder that grows, each file once although the folder is landed three times."""
    folder, table = shared_folder(spark, "ledger"), f"{scratch_database(spark)}.raw"
    raw = data.raw_transactions(spark, sf_dir)
    for turn, run in enumerate(("r1", "r2", "r3")):
        if turn < 2:
            half = raw.where(F.col("transaction_id").cast("bigint") % 2 == turn)
            half.write.mode("append").option("header", True).option("escape", '"').csv(folder)
        land_files(spark, folder, table, run)
    landed = spark.table(table)
    return landed.withColumn("has_provenance", F.col("_source_file").endswith(".csv") & F.col("_ingested_at").isNotNull()).drop(
        "_source_file", "_ingested_at", "_source_path"
    )


@query
def accounting_from_csv(spark, sf_dir):
    """The close written as a file and read with its declared types."""
    folder = shared_folder(spark, "close")
    data.accounting_from(data.monthly(spark, sf_dir)).write.option("header", True).csv(folder)
    return read_accounting_csv(spark, folder)

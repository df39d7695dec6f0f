"""The full run: landing files to marts, checks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import diagnostics, kpis, quality
from ..operators.history import snapshot_input
from ..operators.premiums import monthly_premiums
from ..operators.reconciliation import reconcile, reconciliation_alerts, status_sweep_detail, status_sweep_totals
from ..operators.silver import to_silver
from ..operators.stored import check_table, snapshot_table
from ..schemas import BRONZE_COLUMNS
from ..sources.landing import read_transactions_csv
from ..sources.reference_data import read_accounting_csv
from ..sources.tables import create_layers, with_lineage, write_table
from .incremental import refresh_activity, refresh_activity_from_contracts


def run_pipeline(
    spark: SparkSession,
    transactions_csv: str | list[str],
    accounting_csv: str,
    customers: DataFrame | None = None,
    prefix: str = "",
    location: str | None = None,
    as_of=None,
    snapshot_at=None,
    raise_on_error: bool = True,
    kpi_range: tuple[str, str] | None = None,
) -> dict[str, int]:
    """Builds every table in order and returns the rows written to each.

    Beside the marts these are the status sweep, the root-cause tables, the alerts, and with ``customers`` the activity
    summary and, for ``kpi_range``, the KPIs of those days.  Customers with a column ``updated_at`` are an incremental feed:
    only those changed since the run before are rebuilt.  Without it changes are found by comparing contracts with those of the run
    before.  Each layer is written once and read back by the next, so the landing files are parsed a single time.
    Check results go to ``gold.data_checks``; with ``raise_on_error`` a failed check of severity error stops the
    run after all results are stored.  ``snapshot_at`` also takes a snapshot of silver with that validity time.
    """
    create_layers(spark, prefix, location)
    name = lambda layer, table: f"{prefix}{layer}.{table}"
    rows: dict[str, int] = {}

    def store(df: DataFrame, layer: str, table: str) -> DataFrame:
        rows[f"{layer}.{table}"] = write_table(df, name(layer, table))
        return spark.table(name(layer, table))

    raw = store(read_transactions_csv(spark, transactions_csv), "bronze", "raw_transactions")
    bronze = raw.select(*BRONZE_COLUMNS)
    accounting = store(read_accounting_csv(spark, accounting_csv), "seeds", "accounting_closing")
    silver = store(with_lineage(to_silver(bronze), "_silver_transformed_at"), "silver", "silver_transactions")
    monthly = store(with_lineage(monthly_premiums(silver), "_created_at"), "gold", "monthly_premiums")
    reconciliation = store(
        with_lineage(reconcile(accounting, monthly), "_reconciled_at"), "gold", "accounting_reconciliation"
    )
    sweep = store(status_sweep_detail(silver, accounting), "gold", "status_sweep")
    store(status_sweep_totals(sweep), "gold", "status_sweep_totals")
    store(reconciliation_alerts(reconciliation), "gold", "reconciliation_alerts")
    store(diagnostics.refund_summary(silver), "gold", "refund_summary")
    store(diagnostics.status_breakdown(silver), "gold", "status_breakdown")
    store(diagnostics.unparseable_count(silver), "gold", "unparseable_count")
    results = [
        quality.run_checks(bronze, quality.BRONZE_CHECKS, "raw_transactions"),
        quality.run_checks(silver, quality.SILVER_CHECKS, "silver_transactions"),
        quality.run_checks(monthly, quality.MONTHLY_CHECKS, "monthly_premiums"),
        quality.run_checks(reconciliation, quality.RECONCILIATION_CHECKS, "accounting_reconciliation"),
    ]
    if customers is not None:
        mart, summary = name("gold", "customer_activity_daily"), name("gold", "activity_summary")
        refresh, known = (
            (refresh_activity, "watermarks") if "updated_at" in customers.columns else (refresh_activity_from_contracts, "contracts")
        )
        later = spark.catalog.tableExists(name("gold", known))
        done = refresh(spark, customers, mart, summary, name("gold", known), as_of)
        for table in ("customer_activity_daily", "activity_summary"):
            rows[f"gold.{table}"] = spark.table(name("gold", table)).count()
        if kpi_range:
            days = spark.table(mart)
            store(kpis.active_customers(days, *kpi_range), "gold", "kpi_active_customers")
            store(kpis.premium_collected(days, *kpi_range), "gold", "kpi_premium_collected")
            store(kpis.accumulated_premium(days, kpi_range[1]), "gold", "kpi_accumulated_premium")
        # Months that stay as they were keep the results of their checks.
        months = done["rewritten"] + done["dropped"] if later else None
        checked = check_table(spark, mart, name("gold", "activity_checks"), quality.ACTIVITY_CHECKS, months)
        results.append(checked.withColumn("table_name", F.lit("customer_activity_daily")))
    if snapshot_at is not None:
        snapshot_table(spark, name("snapshots", "transactions_history"), snapshot_input(silver), snapshot_at)
    checks = results[0]
    for result in results[1:]:
        checks = checks.unionByName(result)
    stored = store(checks, "gold", "data_checks")
    if raise_on_error:
        quality.enforce(stored)
    return rows

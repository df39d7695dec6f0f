"""Table layouts and value domains."""

from __future__ import annotations

# Column order of the tables.
RAW_COLUMNS = [
    "transaction_id",
    "created_at",
    "premium_amount",
    "premium_currency",
    "charged_party",
    "status",
]
BRONZE_COLUMNS = RAW_COLUMNS + ["_source_file", "_ingested_at"]
RAW_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)
ACCOUNTING_SCHEMA = "party string, month string, accounting_premium double"
CUSTOMER_SCHEMA = (
    "user_id string, acquisition_date date, started_at date, churned_at date, "
    "monthly_premium double, product_group string"
)
SNAPSHOT_COLUMNS = [
    "transaction_id",
    "transaction_date",
    "transaction_month",
    "premium_amount",
    "premium_currency",
    "party",
    "status",
    "status_raw",
    "_status_normalized",
    "_dq_flags",
    "_is_clean",
    "_bronze_ingested_at",
    "_silver_transformed_at",
]

# Accepted domains.
CURRENCIES = ["EUR"]
PARTIES = ["berlinre", "dronant", "getland", "liadigital"]
RAW_STATUSES = ["processed", "process", "failed", "refunded"]
STATUSES = ["processed", "failed", "refunded"]
RECONCILIATION_STATUSES = ["MATCH", "NEAR_MATCH", "DISCREPANCY"]
DQ_FLAGS = ["unparseable_timestamp", "unparseable_premium", "negative_premium", "missing_party"]

# The status sets compared by the sweep, in declared order.
STATUS_SCENARIOS = {
    "processed_only": ["processed"],
    "processed_plus_refunded": ["processed", "refunded"],
    "all_non_failed": ["processed", "refunded", "process"],
    "all_statuses": ["processed", "refunded", "process", "failed"],
}

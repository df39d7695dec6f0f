"""Cleaning and typing of transactions.  Narrow: one pass, no shuffle, no row dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import month_bucket, parse_amount, parse_us_timestamp


def to_silver(bronze: DataFrame, require_party: bool = True, booking_zone: str | None = None) -> DataFrame:
    """Bronze rows with parsed columns, normalised status and data-quality flags.

    ``_dq_flags`` is the empty string for a row without findings.  ``require_party=False`` leaves the
    party out of ``_is_clean`` (the flag is still listed).  ``booking_zone`` reads the UTC
    timestamps in that zone before the date and month are taken, for a cut-off agreed with accounting.
    """
    created = parse_us_timestamp(F.col("created_at"))
    if booking_zone:
        created = F.convert_timezone(F.lit("UTC"), F.lit(booking_zone), created)
    # The parsed values pass through a one-element inline.  Catalyst would otherwise push a filter on them below
    # this select and parse every row again there, once per mention of a column.
    parsed = bronze.select(
        "transaction_id",
        "premium_currency",
        F.col("charged_party").alias("party"),
        F.col("status").alias("status_raw"),
        "_source_file",
        F.col("_ingested_at").alias("_bronze_ingested_at"),
        F.inline(
            F.array(
                F.struct(
                    created.alias("created_at_ts"), parse_amount(F.col("premium_amount")).alias("premium_amount")
                )
            )
        ),
    )
    ts, amount, party, raw = (F.col(c) for c in ("created_at_ts", "premium_amount", "party", "status_raw"))
    flags = F.concat_ws(
        ",",
        F.when(ts.isNull(), "unparseable_timestamp"),
        F.when(amount.isNull(), "unparseable_premium"),
        F.when(amount < 0, "negative_premium"),
        F.when(party.isNull(), "missing_party"),
    )
    clean = ts.isNotNull() & amount.isNotNull() & (amount >= 0)
    if require_party:
        clean = clean & party.isNotNull()
    date = ts.cast("date")
    return parsed.select(
        "transaction_id",
        "created_at_ts",
        date.alias("transaction_date"),
        month_bucket(date).alias("transaction_month"),
        "premium_amount",
        "premium_currency",
        "party",
        F.when(raw == "process", "processed").otherwise(raw).alias("status"),
        "status_raw",
        (raw == "process").alias("_status_normalized"),
        flags.alias("_dq_flags"),
        clean.alias("_is_clean"),
        "_source_file",
        "_bronze_ingested_at",
    )

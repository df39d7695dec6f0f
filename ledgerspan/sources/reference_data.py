"""Small reference tables: the accounting close and contract samples."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ACCOUNTING_SCHEMA, CUSTOMER_SCHEMA


def read_accounting_csv(spark: SparkSession, path: str) -> DataFrame:
    """The accounting close as a typed table (party, month, accounting_premium)."""
    return spark.read.schema(ACCOUNTING_SCHEMA).option("header", True).option("enforceSchema", False).csv(path)


def accounting_from_rows(spark: SparkSession, rows: Iterable[tuple[str, str, float]]) -> DataFrame:
    """The accounting close from program constants."""
    return spark.createDataFrame(list(rows), ACCOUNTING_SCHEMA)


def customers_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Contracts from constants; dates may be ISO text, a null end means still active."""

    def date(value):
        return dt.date.fromisoformat(value) if isinstance(value, str) else value

    typed = [(u, date(a), date(s), date(c), float(p), g) for u, a, s, c, p, g in rows]
    return spark.createDataFrame(typed, CUSTOMER_SCHEMA)

import datetime as dt
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from ledgerspan.session import build_session  # noqa: E402
from ledgerspan.sources import accounting_from_rows, customers_from_rows, with_provenance  # noqa: E402

# The accounting close and the sample contracts of the reference data.
ACCOUNTING = [
    ("berlinre", "2025-06", 1483.22),
    ("berlinre", "2025-07", 1098.74),
    ("berlinre", "2025-08", 714.06),
    ("dronant", "2025-06", 2983.41),
    ("dronant", "2025-07", 1780.19),
    ("dronant", "2025-08", 1107.07),
    ("getland", "2025-06", 1730.31),
    ("getland", "2025-07", 1412.28),
    ("getland", "2025-08", 660.19),
    ("liadigital", "2025-06", 2241.79),
    ("liadigital", "2025-07", 1353.47),
    ("liadigital", "2025-08", 878.49),
]
CUSTOMERS = [
    ("USR001", "2025-01-15", "2025-02-01", None, 9.99, "liability"),
    ("USR002", "2025-01-20", "2025-02-01", "2025-04-30", 14.99, "liability"),
    ("USR003", "2025-03-01", "2025-03-15", "2025-06-30", 7.50, "household"),
    ("USR004", "2025-02-10", "2025-02-15", None, 12.00, "household"),
    ("USR005", "2025-01-05", "2025-01-10", "2025-03-31", 5.99, "legal"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.default.parallelism": "8",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def accounting(spark):
    return accounting_from_rows(spark, ACCOUNTING)


@pytest.fixture(scope="session")
def customers(spark):
    return customers_from_rows(spark, CUSTOMERS)


@pytest.fixture(scope="session")
def make_bronze(spark):
    """Bronze rows from (created_at, premium_amount, party, status) tuples."""

    def make(rows):
        raw = [(str(i), *r[:2], "EUR", *r[2:]) for i, r in enumerate(rows)]
        schema = (
            "transaction_id string, created_at string, premium_amount string, premium_currency string, "
            "charged_party string, status string"
        )
        return with_provenance(spark.createDataFrame(raw, schema), "rows.csv")

    return make


def day(text):
    return dt.date.fromisoformat(text)

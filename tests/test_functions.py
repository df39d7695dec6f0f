import datetime as dt
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerspan.functions import (
    daily_series,
    days_left_in_month,
    exact_sum,
    parse_amount,
    parse_us_timestamp,
    round_half_away,
)

TIMESTAMPS = [
    "6/1/2025 9:05:07", "06/30/2025 23:59:59", "6/1/25 9:05:07", " 6/1/2025  9:05:07 ", "6/1/2025 9:5:7",
    "6/1/2025 9:05", "6/1/12025 9:05:07", "006/1/2025 9:05:07", "6/1/2025 9:05:60", "6/1/2025 24:00:00",
    "2/30/2025 1:00:00", "2/29/2024 1:00:00", "13/1/2025 1:00:00", "6/1/2025 9:05:07.5", "junk", "", None,
    "2025-06-01 09:05:07", "3/30/2025 2:30:00",
]
AMOUNTS = [
    "1.5", " 2 ", "1e3", "1,5", "nan", "-nan", "inf", "-inf", "Infinity", "", "1_000", "1__0", "_1", "1_",
    "1_0.5_0", "5.0d", "5f", "12L", "0x10", ".5", "5.", "+3", "--3", "1e", "1 2", "n/a", None, "1e-400", "1E5",
]


def test_timestamps_parse_like_strptime(spark):
    rows = spark.createDataFrame([(t,) for t in TIMESTAMPS], "t string")
    got = [r[0] for r in rows.select(parse_us_timestamp(F.col("t"))).collect()]
    con = duckdb.connect()
    sql = "select try_strptime(?, '%m/%d/%Y %H:%M:%S')"
    assert got == [con.execute(sql, [t]).fetchall()[0][0] for t in TIMESTAMPS]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    """02:30 does not exist in Berlin on that day."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = spark.createDataFrame([("3/30/2025 2:30:00",)], "t string").select(parse_us_timestamp(F.col("t")))
        assert row.collect()[0][0] == dt.datetime(2025, 3, 30, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_amounts_parse_like_a_tolerant_cast(spark):
    rows = spark.createDataFrame([(a,) for a in AMOUNTS], "a string")
    got = [r[0] for r in rows.select(parse_amount(F.col("a"))).collect()]
    con = duckdb.connect()
    want = [con.execute("select try_cast(? as double)", [a]).fetchall()[0][0] for a in AMOUNTS]
    assert [str(v) for v in got] == [str(v) for v in want]


@pytest.mark.parametrize("digits", [2, 4, 6])
def test_rounding_matches_the_scaled_double(spark, digits):
    rng = random.Random(digits)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-3, 9) for _ in range(3000)]
    values += [rng.randint(0, 10**6) / 1000 + 0.0005 for _ in range(3000)]
    values += [0.0, 0.5, 1.005, -1.005, 2.5, 0.49999999999999994, math.inf, -math.inf]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in rows.select(round_half_away(F.col("v"), digits)).collect()]
    con = duckdb.connect()
    assert got == [r[0] for r in con.execute(f"select round(unnest(?::double[]), {digits})", [values]).fetchall()]


def test_exact_sum_ignores_order_and_partitioning(spark):
    rng = random.Random(7)
    cents = [rng.randint(-(10**10), 10**10) for _ in range(20000)]
    rows = [(c / 100,) for c in cents]
    want = sum(cents) / 100
    for partitions in (1, 7, 32):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "v double").repartition(partitions)
        assert df.agg(exact_sum(F.col("v"))).collect()[0][0] == want


def test_exact_sum_special_values(spark):
    rows = [
        ("none", None), ("nan", math.nan), ("nan", 1.0), ("inf", math.inf), ("big", 1e15), ("big", 0.1),
        ("long", 0.1234567891), ("long", 0.0000000009), ("mixed", None), ("mixed", 2.25),
    ]
    got = dict(
        (r.k, r.v)
        for r in spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(exact_sum(F.col("v")).alias("v")).collect()
    )
    assert got["none"] is None and math.isnan(got["nan"]) and got["inf"] == math.inf
    assert got["big"] == pytest.approx(1e15 + 0.1)
    assert got["long"] == pytest.approx(0.12345679, abs=1e-15)
    assert got["mixed"] == 2.25


def test_daily_series_guards_empty_ranges(spark):
    rows = [("2025-01-30", "2025-02-02"), ("2025-01-01", "2025-01-01"), ("2025-01-02", "2025-01-01"), (None, "2025-01-01")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b")
    )
    got = [r[0] for r in df.select(F.size(daily_series(F.col("a"), F.col("b")))).collect()]
    assert got[:2] == [4, 1] and all(g in (-1, None) for g in got[2:])
    assert df.select(F.explode(daily_series(F.col("a"), F.col("b")))).count() == 5


def test_days_left_count_the_day_itself(spark):
    rows = spark.createDataFrame([("2025-06-01",), ("2025-06-30",), ("2024-02-29",)], "d string")
    assert [r[0] for r in rows.select(days_left_in_month(F.col("d").cast("date"))).collect()] == [30, 1, 1]

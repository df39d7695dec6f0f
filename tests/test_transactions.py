import datetime as dt

import pytest
from conftest import ACCOUNTING
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerspan.operators import diagnostics, reports
from ledgerspan.operators import reconciliation as recon
from ledgerspan.operators.premiums import monthly_premiums, rounding_order
from ledgerspan.operators.silver import to_silver
from ledgerspan.schemas import BRONZE_COLUMNS
from ledgerspan.sources import accounting_from_rows, ingest_transactions, read_accounting_csv, read_transactions_csv
from ledgerspan.streaming import stream_silver

# Published monthly figures (party, month, written, earned, transactions, refunds, refunded).
MONTHLY = [
    ("berlinre", "2025-06", 1476.45, 1127.42, 208, 5, 21.86),
    ("berlinre", "2025-07", 1084.40, 1024.93, 170, 4, 27.85),
    ("berlinre", "2025-08", 714.06, 705.18, 117, 3, 54.13),
    ("dronant", "2025-06", 2983.41, 2257.05, 424, 9, 48.17),
    ("dronant", "2025-07", 1771.90, 1661.43, 265, 3, 41.59),
    ("dronant", "2025-08", 1100.99, 1087.83, 183, 1, 3.60),
    ("getland", "2025-06", 1730.31, 1317.68, 240, 6, 24.59),
    ("getland", "2025-07", 1412.28, 1305.80, 176, 3, 13.12),
    ("getland", "2025-08", 660.19, 651.12, 95, 3, 19.69),
    ("liadigital", "2025-06", 2239.33, 1723.61, 331, 6, 33.17),
    ("liadigital", "2025-07", 1353.47, 1252.87, 221, 3, 12.53),
    ("liadigital", "2025-08", 878.49, 867.06, 148, 1, 2.16),
]
# The published deltas that are not zero, with their percent and status.
DELTAS = {
    ("berlinre", "2025-06"): (-6.77, 0.4564, "NEAR_MATCH"),
    ("berlinre", "2025-07"): (-14.34, 1.3051, "DISCREPANCY"),
    ("dronant", "2025-07"): (-8.29, 0.4657, "NEAR_MATCH"),
    ("dronant", "2025-08"): (-6.08, 0.5492, "NEAR_MATCH"),
    ("liadigital", "2025-06"): (-2.46, 0.1097, "NEAR_MATCH"),
}


@pytest.fixture(scope="module")
def published(spark):
    rows = [(p, m, w, round(w - r, 2), r, n, e) for p, m, w, e, n, _, r in MONTHLY]
    schema = (
        "party string, month string, written_premium double, net_premium double, refunded_premium double, "
        "transaction_count bigint, earned_premium double"
    )
    return spark.createDataFrame(rows, schema)


def test_silver_edge_rows(make_bronze):
    at = "7/4/2025 0:00:00"
    rows = to_silver(
        make_bronze(
            [
                ("6/1/2025 9:05:07", "4.50", "berlinre", "process"),
                ("junk", "4.5", "dronant", "processed"),
                ("13/1/2025 1:00:00", "x", None, "failed"),
                (at, "-3", "getland", "refunded"),
                (at, "0", "getland", "processed"),
                (at, "1", "getland", None),
                (at, "5.0d", "getland", "processed"),
            ]
        )
    ).orderBy("transaction_id").collect()
    first = rows[0]
    assert (first.transaction_month, first.premium_amount, first.status, first.status_raw) == (
        "2025-06", 4.5, "processed", "process",
    )
    assert [r._dq_flags for r in rows] == [
        "", "unparseable_timestamp", "unparseable_timestamp,unparseable_premium,missing_party",
        "negative_premium", "", "", "unparseable_premium",
    ]
    assert [r._is_clean for r in rows] == [True, False, False, False, True, True, False]
    assert [r._status_normalized for r in rows] == [True, False, False, False, False, None, False]


def test_clean_flag_without_the_party_test(make_bronze):
    rows = make_bronze([("7/4/2025 0:00:00", "1", None, "processed")])
    assert to_silver(rows).first()._is_clean is False
    loose = to_silver(rows, require_party=False).first()
    assert loose._is_clean is True and loose._dq_flags == "missing_party"


def test_booking_zone_moves_the_month(make_bronze):
    rows = make_bronze([("1/31/2025 23:30:00", "1", "getland", "processed")])
    assert to_silver(rows).first().transaction_month == "2025-01"
    assert to_silver(rows, booking_zone="Europe/Berlin").first().transaction_month == "2025-02"
    months = diagnostics.cutoff_month_counts(to_silver(rows), "Europe/Berlin").collect()
    assert {(r.transaction_month, r.utc_rows, r.zone_rows) for r in months} == {("2025-01", 1, 0), ("2025-02", 0, 1)}


def test_filters_do_not_repeat_the_parse(make_bronze):
    df = to_silver(make_bronze([("7/4/2025 0:00:00", "1", "getland", "processed")])).where(F.col("_is_clean"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(regexp_replace(created_at") == 1


def test_monthly_premiums(make_bronze):
    rows = [
        ("6/1/2025 0:00:00", "100", "getland", "processed"),
        ("6/16/2025 0:00:00", "100", "getland", "process"),
        ("6/30/2025 0:00:00", "100", "getland", "processed"),
        ("6/10/2025 0:00:00", "20.5", "getland", "refunded"),
        ("6/10/2025 0:00:00", "0", "getland", "processed"),
        ("6/10/2025 0:00:00", "7", "getland", "failed"),
        ("2/28/2025 0:00:00", "28", "dronant", "processed"),
        ("2/29/2024 0:00:00", "29", "dronant", "processed"),
        ("2/10/2024 0:00:00", "9", "berlinre", "refunded"),
    ]
    silver = to_silver(make_bronze(rows))
    got = {(r.party, r.month): r for r in monthly_premiums(silver).collect()}
    june = got["getland", "2025-06"]
    assert (june.written_premium, june.premium, june.earned_premium) == (300.0, 300.0, 153.33)
    assert (june.refunded_premium, june.refund_count, june.net_premium, june.transaction_count) == (20.5, 1, 279.5, 3)
    assert str(june.first_transaction_date) == "2025-06-01" and str(june.last_transaction_date) == "2025-06-30"
    assert got["dronant", "2025-02"].earned_premium == got["dronant", "2024-02"].earned_premium == 1.0
    assert got["dronant", "2025-02"].refund_count == 0 and got["dronant", "2025-02"].net_premium == 28.0
    assert ("berlinre", "2024-02") not in got
    extra = monthly_premiums(silver, include_unmatched=True).where("party = 'berlinre'").first()
    assert (extra.written_premium, extra.net_premium, extra.transaction_count) == (0.0, -9.0, 0)


def test_published_reconciliation(published, accounting):
    result = recon.reconcile(accounting, published)
    rows = {(r.party, r.month): r for r in result.collect()}
    assert len(rows) == 12
    for key, row in rows.items():
        delta, pct, status = DELTAS.get(key, (0.0, 0.0, "MATCH"))
        assert (row.delta, row.delta_pct, row.reconciliation_status) == (delta, pct, status)
        assert row.is_reconciled == (status == "MATCH")
    gaps = recon.gross_vs_net_gap(result).first()
    assert gaps.gross_abs_delta == 37.94 and gaps.net_widens_gap
    totals = {r.reconciliation_status: r.party_months for r in reports.status_totals(result).collect()}
    assert totals == {"MATCH": 7, "NEAR_MATCH": 4, "DISCREPANCY": 1}
    assert {(r.party, r.month) for r in recon.reconciliation_alerts(result).collect()} == set(DELTAS)
    above = reports.delta_percentages(result).where("above_threshold").collect()
    assert [(r.party, r.month) for r in above] == [("berlinre", "2025-07")]


def test_published_report_totals(published):
    by_party = [(r.party, r.total_written_premium) for r in reports.party_totals(published).collect()]
    assert by_party == [("dronant", 5856.3), ("liadigital", 4471.29), ("getland", 3802.78), ("berlinre", 3274.91)]
    months = {r.month: r for r in reports.written_vs_earned(published).collect()}
    assert months["2025-06"].written_premium == 8429.5 and months["2025-08"].earned_premium == 3311.19
    grid = reports.written_pivot(published.where("not (party = 'getland' and month = '2025-08')"))
    assert {r.month: r.getland for r in grid.collect()}["2025-08"] == 0.0


@pytest.mark.parametrize(
    "account, finance, delta, pct, status",
    [
        (100.0, 100.0, 0.0, 0.0, "MATCH"),
        (1483.22, 1483.23, 0.01, 0.0007, "MATCH"),
        (100.0, 99.5, -0.5, 0.5, "NEAR_MATCH"),
        (100.0, 98.0, -2.0, 2.0, "DISCREPANCY"),
        (0.0, 5.0, 5.0, None, "DISCREPANCY"),
        (0.0, 0.0, 0.0, None, "MATCH"),
        (-50.0, 10.0, 60.0, -120.0, "NEAR_MATCH"),
        (70.0, None, -70.0, 100.0, "DISCREPANCY"),
    ],
)
def test_reconciliation_edges(spark, account, finance, delta, pct, status):
    accounting = accounting_from_rows(spark, [("a", "2025-01", account)])
    rows = [("a", "2025-01", finance, finance, 0.0, 1)] if finance is not None else [("b", "2025-01", 70.0, 70.0, 0.0, 1)]
    monthly = spark.createDataFrame(
        rows,
        "party string, month string, written_premium double, net_premium double, refunded_premium double, "
        "transaction_count bigint",
    )
    got = recon.reconcile(accounting, monthly).collect()
    assert [(r.delta, r.delta_pct, r.reconciliation_status) for r in got] == [(delta, pct, status)]


def test_signed_and_absolute_base(spark):
    accounting = accounting_from_rows(spark, [("a", "2025-01", -50.0)])
    monthly = spark.createDataFrame(
        [("a", "2025-01", 10.0, 10.0, 0.0, 1), ("b", "2025-01", 5.0, 5.0, 0.0, 1)],
        "party string, month string, written_premium double, net_premium double, refunded_premium double, "
        "transaction_count bigint",
    )
    assert recon.reconcile(accounting, monthly, use_abs_base=True).first().reconciliation_status == "DISCREPANCY"
    assert recon.reconcile(accounting, monthly).count() == 1
    assert recon.reconcile(accounting, monthly, include_unmatched=True).count() == 2


def _sweep_rows():
    rows = [("6/2/2025 0:00:00", str(w), p, "processed") for p, m, w, *_ in MONTHLY if m == "2025-06"]
    rows += [("6/2/2025 0:00:00", str(r), p, "refunded") for p, m, *_, r in MONTHLY if m == "2025-06"]
    return rows + [("6/2/2025 0:00:00", "3.5", "getland", "failed"), ("6/2/2025 0:00:00", "1", None, "process")]


def test_status_sweep(spark, make_bronze):
    silver = to_silver(make_bronze(_sweep_rows()), require_party=False)
    accounting = accounting_from_rows(spark, [a for a in ACCOUNTING if a[1] == "2025-06"])
    detail = recon.status_sweep_detail(silver, accounting)
    totals = {r.scenario: r.total_abs_delta for r in recon.status_sweep_totals(detail).collect()}
    assert totals["processed_only"] == 9.23
    assert totals["processed_plus_refunded"] == totals["all_non_failed"] < totals["all_statuses"]
    assert recon.status_sweep_best(detail).first().scenario == "processed_only"
    # Each scenario equals the sweep over that scenario alone.
    for name, statuses in (("processed_only", ["processed"]), ("all_statuses", ["processed", "refunded", "failed"])):
        alone = recon.status_sweep_detail(silver, accounting, {name: statuses}).drop("scenario_rank")
        both = detail.where(F.col("scenario") == name).drop("scenario_rank")
        assert sorted(alone.collect()) == sorted(both.collect())


def test_sweep_tie_goes_to_the_first_declared(spark, make_bronze):
    silver = to_silver(make_bronze([("6/2/2025 0:00:00", "5", "getland", "processed")]))
    accounting = accounting_from_rows(spark, [("getland", "2025-06", 6.0)])
    detail = recon.status_sweep_detail(silver, accounting, {"z": ["processed"], "a": ["processed", "failed"]})
    assert recon.status_sweep_best(detail).first().scenario == "z"


def test_diagnostics(make_bronze):
    silver = to_silver(
        make_bronze(
            [
                ("7/2/2025 23:59:59", "5", "getland", "refunded"),
                ("7/15/2025 0:00:00", "-2", "getland", "refunded"),
                ("junk", "3", "getland", "refunded"),
                ("7/30/2025 0:00:00", "4", "getland", "process"),
                ("7/15/2025 0:00:00", "x", None, "failed"),
            ]
        )
    )
    refunds = {r.transaction_month: (r.refund_count, r.refunded_amount) for r in diagnostics.refund_summary(silver).collect()}
    assert refunds == {"2025-07": (2, 3.0), None: (1, 3.0)}
    assert diagnostics.unparseable_count(silver).first()[0] == 1
    flags = {r.dq_flag: (r.flagged_rows, r.flagged_amount) for r in diagnostics.dq_flag_counts(silver).collect()}
    assert flags == {
        "negative_premium": (1, -2.0), "unparseable_timestamp": (1, 3.0),
        "unparseable_premium": (1, None), "missing_party": (1, None),
    }
    assert diagnostics.dq_excluded_rows(silver).count() == 3
    near = {r.transaction_id: r.boundary for r in diagnostics.boundary_transactions(silver).collect()}
    assert near == {"0": "month_start", "3": "month_end"}
    assert diagnostics.boundary_transactions(silver, party="dronant").count() == 0
    statuses = {r.status_raw: r.transaction_count for r in diagnostics.status_breakdown(silver).collect()}
    assert statuses == {"refunded": 1, "process": 1}
    assert rounding_order(silver).first().written_difference == 0.0


CSV = (
    'created_at,transaction_id,note,premium_amount,premium_currency,charged_party,status\n'
    '6/1/2025 9:05:07,t1,"a ""quoted"", text",4.50,EUR,berlinre,process\n'
    '6/2/2025 9:05:07,t2,"",007,EUR,,processed\n'
    '6/3/2025 9:05:07,t3,,x,EUR,"",failed\n'
)


def test_csv_landing_goes_by_header_names(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    rows = ingest_transactions(spark, str(tmp_path / "in.csv")).orderBy("transaction_id").collect()
    assert rows[0].__fields__ == BRONZE_COLUMNS
    assert [r.premium_amount for r in rows] == ["4.50", "007", "x"]
    assert [r.charged_party for r in rows] == ["berlinre", None, None]
    assert {r._source_file for r in rows} == {"in.csv"} and rows[0]._ingested_at is not None
    assert read_transactions_csv(spark, str(tmp_path / "in.csv")).orderBy("transaction_id").first().note == 'a "quoted", text'


def test_missing_file_fails(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ingest_transactions(spark, str(tmp_path / "none.csv"))


def test_accounting_csv(spark, tmp_path):
    path = tmp_path / "closing.csv"
    path.write_text("party,month,accounting_premium\n" + "".join(f"{p},{m},{a}\n" for p, m, a in ACCOUNTING))
    assert sorted(map(tuple, read_accounting_csv(spark, str(path)).collect())) == ACCOUNTING


def test_streamed_silver_equals_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    header = "transaction_id,created_at,premium_amount,premium_currency,charged_party,status\n"
    line = "{i},6/{d}/2025 1:00:00,{i}.25,EUR,getland,process\n"
    out, state = str(tmp_path / "silver"), str(tmp_path / "state")
    for batch in range(2):
        text = header + "".join(line.format(i=i, d=i + 1) for i in range(batch * 5, batch * 5 + 5))
        (landing / f"{batch}.csv").write_text(text)
        stream_silver(spark, str(landing), out, state).awaitTermination()
        assert spark.read.parquet(out).count() == 5 * (batch + 1)
    batch_rows = to_silver(ingest_transactions(spark, str(landing))).drop("_bronze_ingested_at")
    streamed = spark.read.parquet(out).select(*batch_rows.columns)
    assert sorted(streamed.collect()) == sorted(batch_rows.collect())


def test_reports_keep_values_outside_the_lists(spark):
    monthly = spark.createDataFrame(
        [("getland", "2025-01", 1.0), ("newpartner", "2025-01", 5.0), ("other2", "2025-01", 2.0), (None, "2025-01", 3.0)],
        "party string, month string, written_premium double",
    )
    row = reports.written_pivot(monthly).first()
    assert (row.getland, row.other, row.unknown, row.berlinre) == (1.0, 7.0, 3.0, 0.0)
    silver = spark.createDataFrame(
        [("p", "2025-01", s, 2.0, True) for s in ("processed", "chargeback", None)] + [("p", "2025-01", "processed", 9.0, False)],
        "party string, transaction_month string, status string, premium_amount double, _is_clean boolean",
    )
    counts, amounts = reports.status_counts(silver).first(), reports.status_amounts(silver).first()
    assert (counts.processed, counts.failed, counts.other, counts.unknown, counts.total) == (1, 0, 1, 1, 3)
    assert (amounts.processed, amounts.refunded, amounts.other, amounts.unknown) == (2.0, 0.0, 2.0, 2.0)
    compared = spark.createDataFrame(
        [("x", "2025-01", "MATCH"), ("y", "2025-01", "DISCREPANCY"), (None, "2025-01", "NEAR_MATCH")],
        "party string, month string, reconciliation_status string",
    )
    row = reports.status_matrix(compared).first()
    assert (row.other, row.unknown, row.getland) == ("DISCREPANCY", "NEAR_MATCH", None)


def test_landing_of_dotted_headers(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("transaction_id,partner.ref,a`b\n1,x,\n")
    row = read_transactions_csv(spark, str(tmp_path / "raw.csv")).first()
    assert (row["partner.ref"], row["a`b"]) == ("x", None)


def test_numbering_over_ranges(spark):
    """Places over several ranges, with ties and nulls, equal those of one sort; no exchange gathers all rows in one task."""
    from ledgerspan.operators.reports import numbered

    values = [None, "a", "a", "b", "c", None, "c", "c"]
    rows = [(values[i % 8], i % 5 if i % 3 else None, i) for i in range(400)] + [("a", 1, 1)] * 3
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(7)
    for descending in (False, True):
        got = numbered(df, "k", "v", descending=descending)
        first = lambda x: (x is None, -x if descending and isinstance(x, int) else x or 0)
        text = lambda x: (x is None, [-ord(c) for c in x or ""] if descending else x or "")
        want = sorted(rows, key=lambda r: (text(r[0]), first(r[1]), r[2]))
        assert [tuple(r) for r in got.orderBy("row_number").select("k", "v", "id").collect()] == want
        assert sorted(r.row_number for r in got.collect()) == list(range(1, len(rows) + 1))
        assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert numbered(df.limit(0), "k").count() == 0


def test_repeated_days_are_found_in_their_months(spark):
    from ledgerspan.operators import quality

    days = [(f"u{i % 40}", dt.date(2025, 1 + i % 3, 1 + i % 28)) for i in range(28 * 3 * 40)]
    rows = sorted(set(days), key=str)
    odd = [(None, dt.date(2025, 1, 1)), (None, None), ("u1", None), ("x", dt.date(2025, 2, 28)), ("x", dt.date(2025, 3, 28))]
    check = quality.unique_combination(["user_id", "activity_date"])
    table = lambda more: spark.createDataFrame(rows + odd + more, "user_id string, activity_date date")
    assert quality.failing_rows(table([]), check).count() == 0
    planted = [("u3", rows[200][1]), rows[5], rows[5], (None, None), (None, dt.date(2025, 1, 1)), ("u1", None), ("x", dt.date(2025, 3, 28))]
    found = {tuple(r) for r in quality.failing_rows(table(planted), check).collect()}
    want = table(planted).groupBy("user_id", "activity_date").count().where("count > 1")
    assert found == {tuple(r) for r in want.collect()} and len(found) >= 5
    (one,) = quality.run_checks(table(planted), [check]).collect()
    assert one.failures == len(found) and not one.passed


def test_only_months_are_shuffled_for_uniqueness(spark):
    """A customer's month moves as one row, merged within the task that reads it."""
    from ledgerspan.operators import activity, quality

    contracts = spark.range(50).select(
        F.col("id").cast("string").alias("user_id"), *(F.lit(dt.date(2024, 1, 1)).alias(c) for c in ("acquisition_date", "started_at")),
        F.lit(dt.date(2024, 12, 31)).alias("churned_at"), F.lit(30.0).alias("monthly_premium"), F.lit("p").alias("product_group"),
    )
    mart = activity.customer_activity_daily(contracts, tasks=3)
    months = quality._months(mart, ["user_id", "activity_date"])
    assert months.collect() and mart.count() == 50 * 366
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and months.count() == 50 * 12
    assert months.where("_rows <> _days").count() == 0

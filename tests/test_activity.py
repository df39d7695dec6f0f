import datetime as dt

import pytest
from conftest import day
from pyspark.sql import functions as F

from ledgerspan.operators import activity, keyed, kpis
from ledgerspan.sources import customers_from_rows

AS_OF = "2025-07-31"


@pytest.fixture(scope="module")
def mart(customers):
    return activity.customer_activity_daily(customers, AS_OF).cache()


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_mart_rows_per_customer(mart):
    counts = {r.user_id: r["count"] for r in mart.groupBy("user_id").count().collect()}
    assert counts["USR002"] == 89 and counts["USR003"] == 108 and counts["USR005"] == 81
    assert counts["USR001"] == (day(AS_OF) - day("2025-02-01")).days + 1
    assert mart.columns == activity.MART_COLUMNS


def test_daily_premium_and_derived_columns(mart):
    def at(user, date):
        return mart.where((F.col("user_id") == user) & (F.col("activity_date") == F.lit(date).cast("date"))).first()

    assert at("USR002", "2025-02-10").daily_premium == 0.535357
    assert at("USR002", "2025-04-10").daily_premium == 0.499667
    row = at("USR003", "2025-03-15")
    assert (row.days_since_acquisition, row.activity_month) == (14, "2025-03")


def test_empty_and_single_day_windows(spark):
    customers = customers_from_rows(
        spark,
        [
            ("one", "2025-01-01", "2025-01-05", "2025-01-05", 30.0, "p"),
            ("reversed", "2025-01-01", "2025-01-05", "2025-01-04", 30.0, "p"),
            ("nostart", "2025-01-01", None, "2025-01-04", 30.0, "p"),
            ("future", "2025-01-01", "2026-01-01", None, 30.0, "p"),
        ],
    )
    mart = activity.customer_activity_daily(customers, "2025-06-30")
    assert rows_of(mart, "user_id", "daily_premium") == [("one", 0.967742)]
    assert activity.customer_activity_daily(customers, "2025-06-30", start="2025-01-01").count() == 1


def test_clipped_mart_is_the_filtered_mart(customers, mart):
    clipped = activity.customer_activity_daily(customers, AS_OF, "2025-03-10", "2025-04-05")
    whole = kpis.between_dates(mart, "2025-03-10", "2025-04-05")
    assert sorted(clipped.collect()) == sorted(whole.collect())


def test_published_kpis(mart):
    first = kpis.active_customers(mart, "2025-03-01", "2025-03-05")
    by_group = {}
    for r in first.collect():
        by_group.setdefault(r.product_group, set()).add((r.active_customers, r.daily_premium_total))
    assert by_group == {"liability": {(2, 0.8058)}, "household": {(1, 0.3871)}, "legal": {(1, 0.1932)}}
    collected = kpis.premium_collected(mart, "2025-01-01", "2025-03-31")
    assert rows_of(collected, "product_group", "premium_collected") == [
        ("household", 22.11), ("legal", 16.23), ("liability", 49.96),
    ]
    accumulated = kpis.accumulated_premium(mart, "2025-04-30")
    assert rows_of(accumulated, "user_id", "accumulated_premium") == [
        ("USR001", 29.97), ("USR002", 44.97), ("USR003", 11.61), ("USR004", 30.0), ("USR005", 16.23),
    ]
    assert rows_of(kpis.accumulated_premium(mart, "2025-04-30", by_product=False), "user_id", "accumulated_premium") == (
        rows_of(accumulated, "user_id", "accumulated_premium")
    )


def test_contract_forms_give_the_same_figures(customers, mart):
    span = ("2025-01-01", AS_OF)
    running = kpis.active_customers_from_contracts(customers, *span, AS_OF)
    assert sorted(running.collect()) == sorted(kpis.active_customers(mart, *span).collect())
    assert sorted(kpis.active_customers(mart, *span, one_row_per_day=True).collect()) == sorted(running.collect())
    assert sorted(kpis.premium_collected_from_contracts(customers, "2025-02-10", "2025-05-05", AS_OF).collect()) == (
        sorted(kpis.premium_collected(mart, "2025-02-10", "2025-05-05").collect())
    )
    assert rows_of(kpis.accumulated_premium_from_contracts(customers, "2025-04-30", AS_OF), "user_id", "accumulated_premium") == (
        rows_of(kpis.accumulated_premium(mart, "2025-04-30"), "user_id", "accumulated_premium")
    )


def test_active_on_dates_matches_a_range_join(spark, customers):
    dates = ["2025-01-31", "2025-02-01", "2025-03-15", "2025-03-15", "2025-04-30", "2025-07-31", "2025-08-01", None]
    asked = spark.createDataFrame([(d,) for d in dates], "as_of_date string")
    got = rows_of(activity.active_on_dates(customers, asked, AS_OF), "as_of_date", "user_id")
    contracts = customers.collect()
    want = sorted(
        (day(d), c.user_id)
        for d in set(filter(None, dates))
        for c in contracts
        if c.started_at <= day(d) <= (c.churned_at or day(AS_OF))
    )
    assert got == want
    one = activity.active_on(customers, "2025-03-15", AS_OF)
    assert rows_of(one, "user_id") == [(u,) for d, u in want if d == day("2025-03-15")]
    assert one.columns == customers.columns


def test_large_expansions_get_more_tasks(spark):
    """As many as the contract months need, whatever the number of cores."""
    many = spark.range(60_000).selectExpr(
        "cast(id as string) as user_id", "date '2000-01-01' as acquisition_date", "date '2000-01-01' as started_at",
        "date '2019-12-31' as churned_at", "10.0D as monthly_premium", "'p' as product_group",
    )
    windows = activity.contract_windows(many)
    assert activity.expansion_tasks(windows) == -(-60_000 * 240 // activity.MONTHS_PER_TASK) > 2 * spark.sparkContext.defaultParallelism
    days = spark.createDataFrame([("2005-05-05",)], "as_of_date string")
    assert activity.active_counts_on_dates(many, days).first().active_customers == 60_000
    assert activity.active_on_dates(many.limit(10), days).count() == 10


def test_each_file_of_the_mart_has_a_task(customers):
    files, tasks = activity.storage_layout(customers, AS_OF, rows_per_file=40)
    months = activity.activity_for_storage(customers, AS_OF, files, tasks)
    seen = months.select("activity_month", F.spark_partition_id().alias("p")).distinct().groupBy("p").count()
    assert seen.agg(F.max("count")).first()[0] == 1


def test_expansion_is_spread_over_tasks(customers):
    assert activity.customer_activity_daily(customers, AS_OF, tasks=5).rdd.getNumPartitions() == 5


def test_hot_customer_and_group(spark):
    """One customer and product group holds a third of all contracts; work stays spread and sums whole."""
    rows = [("hot", i % 400, "big") if i % 3 == 0 else (f"u{i}", i % 400, f"p{i % 7}") for i in range(3000)]
    customers = spark.createDataFrame(rows, "user_id string, shift int, product_group string").select(
        "user_id",
        F.lit("2024-01-01").cast("date").alias("acquisition_date"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("shift")).alias("started_at"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("shift") + 100).alias("churned_at"),
        F.lit(31.0).alias("monthly_premium"),
        "product_group",
    )
    mart = activity.customer_activity_daily(customers, AS_OF, tasks=8)
    sizes = [r["count"] for r in mart.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    assert mart.count() == 3000 * 101
    totals = {r.user_id: r["count"] for r in mart.groupBy("user_id").count().collect()}
    assert totals["hot"] == 1000 * 101
    whole = kpis.premium_collected_from_contracts(customers, "2024-01-01", AS_OF, AS_OF)
    assert sorted(whole.collect()) == sorted(kpis.premium_collected(mart, "2024-01-01", AS_OF).collect())


# --- keyed replacement -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def shortened(spark):
    return spark.createDataFrame([("USR002", dt.date(2025, 2, 28))], "user_id string, new_end date")


def test_retroactive_churn_replaces_one_customer(customers, mart, shortened):
    after = keyed.retroactive_churn(mart, customers, shortened, AS_OF)
    mine = F.col("user_id") == "USR002"
    assert after.where(mine).count() == 28
    assert after.where(mine & (F.col("churned_at") == day("2025-02-28"))).count() == 28
    assert sorted(after.where(~mine).collect()) == sorted(mart.where(~mine).collect())
    assert sorted(keyed.retroactive_churn(after, customers, shortened, AS_OF).collect()) == sorted(after.collect())
    impact = keyed.correction_impact(mart.where(mine), after.where(mine)).first()
    assert (impact.rows_before, impact.amount_before, impact.rows_after, impact.amount_after) == (89, 44.97, 28, 14.99)
    assert (impact.rows_removed, impact.amount_removed) == (61, 29.98)
    cut = keyed.truncate_entities_after(mart, shortened)
    assert cut.where(mine).count() == 28 and cut.count() == after.count()


def test_delete_insert_leaves_stale_days(customers, mart, shortened):
    changed = keyed.apply_contract_changes(customers.where("user_id = 'USR002'"), shortened)
    rebuilt = activity.customer_activity_daily(changed, AS_OF)
    upserted = keyed.delete_insert(mart, rebuilt, ["user_id", "activity_date"])
    mine = upserted.where("user_id = 'USR002'")
    assert mine.count() == 89
    assert mine.where(F.col("churned_at") == day("2025-02-28")).count() == 28


def test_null_keys_and_duplicate_batch_keys(spark):
    target = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    batch = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "k string, v int")
    got = keyed.delete_insert(target, batch, ["k"])
    assert sorted(r.v for r in got.collect()) == [2, 3, 10, 11, 12]


def test_schema_sync(spark):
    target = spark.createDataFrame([("a", 1, "old")], "k string, v int, gone string")
    batch = spark.createDataFrame([("b", 2, 0.5)], "k string, v bigint, fresh double")
    got = keyed.delete_insert(target, batch, ["k"])
    assert got.dtypes == [("k", "string"), ("v", "bigint"), ("fresh", "double")]
    assert sorted(map(tuple, got.collect())) == [("a", 1, None), ("b", 2, 0.5)]


def test_change_detection(spark):
    rows = spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-02"), ("c", None)], "k string, t string")
    feed = rows.select("k", F.col("t").cast("timestamp_ntz").alias("updated_at"))
    mark = F.lit("2025-01-01").cast("timestamp_ntz")
    assert [r.k for r in keyed.changed_since(feed, mark).collect()] == ["b"]
    assert keyed.next_watermark(feed).first().watermark == dt.datetime(2025, 1, 2)


def test_reopened_contract(customers, spark):
    changes = spark.createDataFrame([("USR005", None)], "user_id string, new_end date")
    got = keyed.apply_contract_changes(customers, changes)
    assert {r.user_id: r.churned_at for r in got.collect()}["USR005"] is None
    assert {r.user_id: r.churned_at for r in got.collect()}["USR002"] == day("2025-04-30")


def test_days_grouped_by_customer_and_month_do_not_move(spark, customers, mart):
    """Contract months are shuffled by the key; nothing is, once they are expanded to days."""
    key = ["user_id", "activity_month"]
    laid_out = activity.customer_activity_daily(customers, AS_OF, by=key)
    counts = laid_out.groupBy(*key).agg(F.collect_list("activity_date").alias("days"))
    after_the_days = counts._jdf.queryExecution().executedPlan().toString().split("Generate explode")[0]
    assert "Exchange" not in after_the_days
    assert sorted(laid_out.collect()) == sorted(mart.collect())
    assert sum(len(r.days) for r in counts.collect()) == mart.count()


def test_daily_rows_are_written_out_by_month(spark, tmp_path):
    """The hash of a customer's month covers every mart row, repeated contracts' rows too; days are counted before texts are built."""
    import hashlib

    from ledgerspan.plans import adapters, queries

    customers = [(i, group) for i, group in ((3, "A"), (3, "A"), (4, "B"), (5, None), (17, "C"))]
    spark.createDataFrame(customers, "c_custkey bigint, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(c, dt.datetime(1996, m, 27)) for c in (3, 4, 5, 17) for m in (1, 2 + c % 3)] + [(5, None)]
    spark.createDataFrame(orders, "o_custkey bigint, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    found = queries.QUERIES["activity_daily_rows"](spark, str(tmp_path))
    want = {}
    for r in activity.customer_activity_daily(adapters.customers(spark, str(tmp_path)), adapters.AS_OF).collect():
        cells = [*(str(x or "-") for x in (r.activity_date, r.acquisition_date, r.started_at, r.churned_at)), r.product_group]
        cells += [str(round(r.daily_premium * 1e6)), str(round(r.monthly_premium * 1e6)), str(r.days_since_acquisition)]
        want.setdefault((r.user_id, r.activity_month), []).append("|".join(c for c in cells if c is not None))
    got = {(r.user_id, r.activity_month): (r.mart_rows, r.rows_md5) for r in found.collect()}
    assert got == {k: (len(v), hashlib.md5(",".join(sorted(v)).encode()).hexdigest()) for k, v in want.items()}
    assert max(n for n, _ in got.values()) == 62
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "times_31" in plan.split("collect_list", 1)[1]

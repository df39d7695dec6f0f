import datetime as dt

import pytest
from conftest import ACCOUNTING, day
from pyspark.sql import functions as F

from ledgerspan.operators import activity, changes, history, keyed, quality, stored
from ledgerspan.operators.silver import to_silver
from ledgerspan.operators.summary import totals_of
from ledgerspan.plans.incremental import contract_state, refresh_activity, refresh_activity_from_contracts
from ledgerspan.plans.pipeline import run_pipeline
from ledgerspan.session import release, scratch_database, shared_folder, staged
from ledgerspan.sources import create_layers, customers_from_rows

AS_OF = "2025-07-31"


@pytest.fixture
def database(spark):
    name = f"t_{dt.datetime.now():%H%M%S%f}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark, 'db')}'")
    return name


def months_of(spark, table):
    return {r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def test_stored_mart_equals_the_mart(spark, database, customers):
    table = f"{database}.mart"
    stored.create_activity_mart(customers, table, AS_OF, rows_per_file=40)
    want = activity.customer_activity_daily(customers, AS_OF)
    assert sorted(spark.table(table).select(*want.columns).collect()) == sorted(want.collect())
    from ledgerspan.operators import kpis

    plan = kpis.premium_collected(spark.table(table), "2025-03-01", "2025-03-31")._jdf.queryExecution().executedPlan()
    assert "activity_month" in plan.toString().split("PartitionFilters: ")[1].split("]")[0]


def test_emptied_months_disappear(spark, database):
    customers = customers_from_rows(
        spark,
        [
            ("a", "2025-01-01", "2025-01-10", "2025-06-20", 30.0, "p"),
            ("b", "2025-01-01", "2025-01-10", "2025-02-20", 30.0, "p"),
        ],
    )
    table = f"{database}.mart"
    stored.create_activity_mart(customers, table, AS_OF)
    assert max(months_of(spark, table)) == "2025-06"
    changes = spark.createDataFrame([("a", dt.date(2025, 3, 5))], "user_id string, new_end date")
    changed = keyed.apply_contract_changes(customers.where("user_id = 'a'"), changes)
    rebuilt = activity.customer_activity_daily(changed, AS_OF).withColumn("_loaded_at", F.current_timestamp())
    for _ in range(2):  # a second run changes nothing
        done = stored.replace_entities_in_table(spark, table, rebuilt, changes)
        assert months_of(spark, table) == {"2025-01", "2025-02", "2025-03"}
        got = {r.user_id: (r["count"], r.last) for r in spark.table(table).groupBy("user_id").agg(
            F.count("*").alias("count"), F.max("activity_date").alias("last")).collect()}
        assert got == {"a": (55, day("2025-03-05")), "b": (42, day("2025-02-20"))}
    assert done["dropped"] == []


def test_correction_finds_all_months_itself(spark, database, customers):
    """The months to rewrite come from the mart's own keys, not from what contracts say now."""
    table = f"{database}.mart"
    stored.create_activity_mart(customers, table, "2025-12-31")
    mine = customers.where("user_id = 'USR001'")
    changes = spark.createDataFrame([("USR001", dt.date(2025, 3, 31))], "user_id string, new_end date")
    changed = keyed.apply_contract_changes(mine, changes)
    rebuilt = activity.customer_activity_daily(changed, "2025-04-30").withColumn("_loaded_at", F.current_timestamp())
    done = stored.replace_entities_in_table(spark, table, rebuilt, changes)
    assert max(done["rewritten"] + done["dropped"]) == "2025-12"
    assert spark.table(table).where("user_id = 'USR001'").agg(F.max("activity_date")).first()[0] == day("2025-03-31")
    others = activity.customer_activity_daily(customers.where("user_id <> 'USR001'"), "2025-12-31")
    kept = spark.table(table).where("user_id <> 'USR001'").select(*others.columns)
    assert sorted(kept.collect(), key=repr) == sorted(others.collect(), key=repr)


def test_stored_truncation(spark, database, customers):
    table = f"{database}.mart"
    stored.create_activity_mart(customers, table, AS_OF)
    changes = spark.createDataFrame([("USR002", dt.date(2025, 2, 28)), ("nobody", dt.date(2025, 1, 1))], "user_id string, new_end date")
    done = stored.truncate_entities_in_table(spark, table, changes)
    assert done["rewritten"] + done["dropped"] == ["2025-03", "2025-04"]
    assert spark.table(table).where("user_id = 'USR002'").count() == 28
    assert stored.truncate_entities_in_table(spark, table, changes) == {"rewritten": [], "dropped": []}


def pending(spark, database):
    return [r.tableName for r in spark.sql(f"SHOW TABLES IN {database} LIKE 'pending_*'").collect()]


def lost(*_, **__):
    raise RuntimeError("driver lost")


@pytest.mark.parametrize("moment", ["before the commit", "after the commit", "within the copies", "after the copies"])
def test_a_lost_correction_is_repeated(spark, database, customers, monkeypatch, moment):
    """Before its commit a lost correction has changed nothing; later the next operation finishes it."""
    mart, summary = f"{database}.mart", f"{database}.summary"
    stored.create_activity_mart(customers, mart, AS_OF)
    before = sorted(spark.table(mart).collect(), key=repr)
    changes = spark.createDataFrame([("USR002", dt.date(2025, 2, 28))], "user_id string, new_end date")
    changed = keyed.apply_contract_changes(customers.where("user_id = 'USR002'"), changes)
    rebuilt = activity.customer_activity_daily(changed, AS_OF).withColumn("_loaded_at", F.current_timestamp())
    with monkeypatch.context() as patch:
        if moment == "before the commit":
            patch.setattr(spark, "createDataFrame", lost)
        elif moment == "after the commit":
            patch.setattr(stored, "_copy_all", lost)
        elif moment == "within the copies":
            # The rewritten months are there, the emptied ones still hold the old rows.
            patch.setattr(stored, "_drop_partitions", lost)
        else:
            real = type(spark).sql
            patch.setattr(type(spark), "sql", lambda self, text, *a, **k: lost() if text.startswith("DROP TABLE") else real(self, text, *a, **k))
        with pytest.raises(RuntimeError, match="driver lost"):
            stored.replace_entities_in_table(spark, mart, rebuilt, changes)
    assert pending(spark, database)
    if moment in ("before the commit", "after the commit"):
        assert sorted(spark.table(mart).collect(), key=repr) == before
    stored.finish(spark, mart)
    assert pending(spark, database) == []
    corrected = spark.table(mart).where("user_id = 'USR002'").count()
    assert corrected == (89 if moment == "before the commit" else 28)
    for _ in range(2):
        stored.replace_entities_in_table(spark, mart, rebuilt, changes)
        assert spark.table(mart).where("user_id = 'USR002'").count() == 28
        assert spark.table(mart).where("user_id <> 'USR002'").count() == sum(r.user_id != "USR002" for r in before)
    stored.refresh_activity_summary(spark, mart, summary)
    assert pending(spark, database) == [] and spark.table(summary).count() > 0


def test_layout_follows_the_batch(spark, database):
    table = f"{database}.facts"
    rows = spark.createDataFrame(
        [("a", day("2025-01-01"), 1, "x", "2025-01"), ("a", day("2025-02-01"), 1, "y", "2025-02")],
        "user_id string, activity_date date, v int, old string, activity_month string",
    )
    stored.create_partitioned(rows, table, ["activity_month"])
    batch = spark.createDataFrame(
        [("a", day("2025-01-01"), 9, 0.5, "2025-01")], "user_id string, activity_date date, v int, extra double, activity_month string"
    )
    for _ in range(2):
        stored.upsert_into_table(spark, table, batch, ["user_id", "activity_date"])
        held = spark.table(table)
        assert held.columns == ["user_id", "activity_date", "v", "extra", "activity_month"]
        assert sorted((str(r.activity_date), r.v, r.extra) for r in held.collect()) == [("2025-01-01", 9, 0.5), ("2025-02-01", 1, None)]


def test_stored_upsert(spark, database):
    table = f"{database}.facts"
    schema = "user_id string, activity_date date, v int, activity_month string"
    rows = [("a", day("2025-01-01"), 1, "2025-01"), ("b", day("2025-01-01"), 1, "2025-01"), ("a", day("2025-02-01"), 1, "2025-02")]
    spark.createDataFrame(rows, schema).write.partitionBy("activity_month").format("parquet").saveAsTable(table)
    batch = spark.createDataFrame([("a", day("2025-01-01"), 9, "2025-01"), ("c", day("2025-03-01"), 9, "2025-03")], schema)
    done = stored.upsert_into_table(spark, table, batch, ["user_id", "activity_date"])
    assert done == {"rewritten": ["2025-01", "2025-03"], "dropped": []}
    got = sorted((r.user_id, str(r.activity_date), r.v) for r in spark.table(table).collect())
    assert got == [("a", "2025-01-01", 9), ("a", "2025-02-01", 1), ("b", "2025-01-01", 1), ("c", "2025-03-01", 9)]


def test_summary_refresh(spark, database, customers):
    mart, summary = f"{database}.mart", f"{database}.summary"
    stored.create_activity_mart(customers, mart, AS_OF)
    stored.refresh_activity_summary(spark, mart, summary)
    changes = spark.createDataFrame([("USR002", dt.date(2025, 2, 28))], "user_id string, new_end date")
    changed = keyed.apply_contract_changes(customers.where("user_id = 'USR002'"), changes)
    rebuilt = activity.customer_activity_daily(changed, AS_OF).withColumn("_loaded_at", F.current_timestamp())
    done = stored.replace_entities_in_table(spark, mart, rebuilt, changes)
    assert done["rewritten"] == ["2025-02", "2025-03", "2025-04"]
    stored.refresh_activity_summary(spark, mart, summary, done["rewritten"] + done["dropped"])
    want = activity.activity_summary(spark.table(mart))
    assert sorted(spark.table(summary).select(*want.columns).collect()) == sorted(want.collect())


# --- history -----------------------------------------------------------------------------------

T1, T2, T3, T4 = (f"2025-0{m}-01 00:00:00" for m in range(1, 5))


def state(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, status string, premium_amount double, party string")


def states(spark):
    return [
        state(spark, [("same", "processed", 1.0, "x"), ("flip", "processed", 2.0, "x"), ("fill", "failed", None, "x"),
                      ("gone", "processed", 3.0, "x"), ("other", "processed", 4.0, "x")]),
        state(spark, [("same", "processed", 1.0, "x"), ("flip", "refunded", 2.0, "x"), ("fill", "failed", 5.0, "x"),
                      ("other", "processed", 4.0, "y"), ("new", "processed", 6.0, "x")]),
        state(spark, [("same", "processed", 1.0, "x"), ("flip", "refunded", 2.0, "x"), ("fill", "failed", 5.0, "x"),
                      ("gone", "processed", 3.0, "x"), ("other", "processed", 4.0, "y"), ("new", "processed", 6.0, "x")]),
    ]


def check_history(rows):
    versions = {}
    for r in rows:
        versions.setdefault(r.transaction_id, []).append(r)
    shape = {k: [(str(v.valid_from)[5:7], str(v.valid_to)[5:7] if v.valid_to else None) for v in sorted(vs, key=lambda v: v.valid_from)]
             for k, vs in versions.items()}
    assert shape == {
        "same": [("01", None)], "flip": [("01", "02"), ("02", None)], "fill": [("01", "02"), ("02", None)],
        "gone": [("01", "02"), ("03", None)], "other": [("01", None)], "new": [("02", None)],
    }
    assert versions["other"][0].party == "x"  # a column outside the check opens no version
    assert len({v.version_id for v in rows}) == len(rows)


def test_history_versions(spark):
    first, second, third = states(spark)
    rows = history.initial_history(first, T1)
    rows = history.scd2_merge(rows, second, T2)
    rows = history.scd2_merge(rows, third, T3)
    check_history(rows.collect())
    unchanged = history.scd2_merge(rows, third, T4)
    assert sorted(unchanged.collect(), key=repr) == sorted(rows.collect(), key=repr)
    at = {r.transaction_id for r in history.as_of_read(rows, "2025-02-15").collect()}
    assert at == {"same", "flip", "fill", "other", "new"}
    assert history.as_of_read(rows, "2024-12-31").count() == 0
    assert history.current_read(rows).count() == 6
    kept = history.scd2_merge(history.initial_history(first, T1), second, T2, invalidate_hard_deletes=False)
    assert kept.where("transaction_id = 'gone' and valid_to is null").count() == 1


def test_null_keys_close_and_reopen(spark):
    first = state(spark, [(None, "processed", 1.0, "x"), ("a", "processed", 1.0, "x")])
    rows = history.scd2_merge(history.initial_history(first, T1), first, T2)
    assert rows.where("transaction_id is null").count() == 2
    assert rows.where("transaction_id is null and valid_to is null").count() == 1
    assert rows.where("transaction_id = 'a'").count() == 1


def test_stored_snapshots(spark, database):
    table = f"{database}.history"
    for rows, moment in zip(states(spark), (T1, T2, T3), strict=True):
        stored.snapshot_table(spark, table, rows, moment)
    check_history(spark.table(table).collect())
    runs = {r[0].split("/")[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert runs == {"snapshot_run=open", "snapshot_run=20250201T000000000"}
    for read, partitions in ((history.as_of_read(spark.table(table), "2025-02-15"), "snapshot_run"), (history.current_read(spark.table(table)), "snapshot_run")):
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert partitions in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert {r.transaction_id for r in history.as_of_read(spark.table(table), "2025-02-15").collect()} == {"same", "flip", "fill", "other", "new"}
    with pytest.raises(ValueError, match="already holds"):
        stored.snapshot_table(spark, table, states(spark)[0], "2024-12-01 00:00:00")
    with pytest.raises(ValueError, match="duplicate key"):
        stored.snapshot_table(spark, table, state(spark, [("a", "x", 1.0, "p")] * 2), T4)


def test_a_snapshot_rewrites_changed_buckets_only(spark, database):
    table = f"{database}.history"
    first = state(spark, [(f"k{i}", "processed", 1.0, "x") for i in range(200)])
    stored.snapshot_table(spark, table, first, T1, buckets=16)
    files = lambda: {r[0] for r in spark.table(table).where("snapshot_run = 'open'").select("_metadata.file_path").distinct().collect()}
    before = files()
    stored.snapshot_table(spark, table, first, T2, buckets=16)
    assert files() == before
    changed = first.withColumn("status", F.when(F.col("transaction_id") == "k7", "refunded").otherwise(F.col("status")))
    stored.snapshot_table(spark, table, changed, T3, buckets=16)
    # One bucket is written anew: the files of the others are those of the first run.
    assert len(files() & before) == len(before) - 1
    held = {r.transaction_id: r for r in history.current_read(spark.table(table)).collect()}
    assert len(held) == 200 and held["k7"].status == "refunded"
    closed = spark.table(table).where("valid_to is not null").collect()
    assert [(r.transaction_id, str(r.updated_at)) for r in closed] == [("k7", T1)]


def test_a_history_gains_columns(spark, database):
    table = f"{database}.history"
    stored.snapshot_table(spark, table, state(spark, [("a", "processed", 1.0, "x"), ("b", "processed", 1.0, "x")]), T1)
    more = state(spark, [("a", "refunded", 1.0, "x"), ("b", "processed", 1.0, "x")]).withColumn("channel", F.lit("web")).drop("party")
    stored.snapshot_table(spark, table, more, T2)
    got = sorted((r.transaction_id, r.status, r.channel, r.party) for r in spark.table(table).collect())
    assert got == [("a", "processed", None, "x"), ("a", "refunded", "web", None), ("b", "processed", None, "x")]


def test_a_null_key_in_a_stored_history(spark, database):
    table = f"{database}.history"
    rows = state(spark, [(None, "processed", 1.0, "x"), ("a", "processed", 1.0, "x")])
    for moment in (T1, T2, T2):
        stored.snapshot_table(spark, table, rows, moment)
    held = spark.table(table)
    assert held.where("transaction_id is null and valid_to is null").count() == 1
    assert held.where("transaction_id = 'a'").count() == 1


def test_order_of_snapshots_is_guarded_in_memory(spark):
    first, second, _ = states(spark)
    with pytest.raises(Exception, match="may not be earlier"):
        history.scd2_merge(history.initial_history(first, T2), second, T1).collect()


def test_second_snapshot_of_one_moment(spark, database):
    """A correction under the same time adds to what that run closed."""
    table = f"{database}.history"
    first, second, _ = states(spark)
    stored.snapshot_table(spark, table, first, T1)
    stored.snapshot_table(spark, table, second, T2)
    stored.snapshot_table(spark, table, second, T2)
    assert spark.table(table).where("valid_to is not null").count() == 3
    stored.snapshot_table(spark, table, second.where("transaction_id <> 'same'"), T2)
    assert spark.table(table).where("valid_to is not null").count() == 4
    assert spark.table(table).where("valid_to is null").count() == 4


def test_snapshot_of_an_emptied_source(spark, database):
    table = f"{database}.history"
    first = states(spark)[0]
    stored.snapshot_table(spark, table, first, T1)
    stored.snapshot_table(spark, table, first.limit(0), T2)
    assert spark.table(table).where("valid_to is null").count() == 0
    assert spark.table(table).count() == 5


# --- checks and the whole run ------------------------------------------------------------------


def test_declared_checks_count(spark):
    suites = [
        quality.BRONZE_CHECKS, quality.SILVER_CHECKS, quality.MONTHLY_CHECKS,
        quality.RECONCILIATION_CHECKS, quality.ACTIVITY_CHECKS,
    ]
    assert [len(s) for s in suites] == [9, 7, 9, 6, 5]
    assert sum(map(len, suites)) == 36


def test_check_results(spark):
    rows = [("a", "x"), ("a", "y"), ("b", "y"), (None, "z"), (None, None)]
    df = spark.createDataFrame(rows, "k string, v string")
    checks = [
        quality.not_null("k"), quality.not_null("v", "warn"), quality.accepted_values("v", ["x"]), quality.unique("k"),
        quality.unique_combination(["k", "v"]), quality.accepted_values("v", ["x", "y", "z"]),
    ]
    results = quality.run_checks(df, checks, "t")
    assert sorted((r.check_name, r.column_name, r.failures, r.passed) for r in results.collect()) == [
        ("accepted_values", "v", 0, True), ("accepted_values", "v", 2, False), ("not_null", "k", 2, False),
        ("not_null", "v", 1, False), ("unique", "k", 1, False), ("unique_combination", "k,v", 0, True),
    ]
    for check, failures in ((checks[0], 2), (checks[2], 2), (checks[3], 1), (checks[4], 0)):
        assert quality.failing_rows(df, check).count() == failures
    with pytest.raises(ValueError, match="t.not_null"):
        quality.enforce(results)
    quality.enforce(quality.run_checks(df, [quality.unique("k", "warn"), checks[4]]))


@pytest.fixture
def landing(tmp_path):
    lines = ["transaction_id,created_at,premium_amount,premium_currency,charged_party,status,extra"]
    for i, (party, month, amount) in enumerate(ACCOUNTING):
        y, m = month.split("-")
        lines.append(f"p{i},{int(m)}/10/{y} 9:05:07,{amount},EUR,{party},{'process' if i % 2 else 'processed'},z")
    lines.append("r1,6/11/2025 9:05:07,5.5,EUR,getland,refunded,z")
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "closing.csv").write_text(
        "party,month,accounting_premium\n" + "".join(f"{p},{m},{a}\n" for p, m, a in ACCOUNTING)
    )
    return tmp_path


def test_pipeline(spark, landing, customers):
    prefix = f"run{dt.datetime.now():%H%M%S%f}_"
    written = run_pipeline(
        spark, str(landing / "raw.csv"), str(landing / "closing.csv"), customers, prefix,
        shared_folder(spark, "lake"), AS_OF, T1, kpi_range=("2025-01-01", "2025-03-31"),
    )
    # Premium collected in the first quarter, and premium accumulated by its end.
    collected = {r.product_group: r.premium_collected for r in spark.table(f"{prefix}gold.kpi_premium_collected").collect()}
    assert collected == {"household": 22.11, "legal": 16.23, "liability": 49.96}
    assert spark.table(f"{prefix}gold.status_sweep").count() == 48 and written["gold.status_sweep_totals"] == 4
    assert spark.table(f"{prefix}gold.refund_summary").count() == 1 and written["gold.reconciliation_alerts"] == 0
    assert written["gold.activity_summary"] > 0
    assert written["bronze.raw_transactions"] == written["silver.silver_transactions"] == 13
    assert written["gold.monthly_premiums"] == written["gold.accounting_reconciliation"] == 12
    assert written["gold.data_checks"] == 36
    recon = spark.table(f"{prefix}gold.accounting_reconciliation")
    assert {r.reconciliation_status for r in recon.collect()} == {"MATCH"}
    assert recon.columns[-1] == "_reconciled_at"
    assert spark.table(f"{prefix}bronze.raw_transactions").columns[-3:] == ["extra", "_source_file", "_ingested_at"]
    assert spark.table(f"{prefix}snapshots.transactions_history").count() == 13
    assert spark.table(f"{prefix}gold.customer_activity_daily").where("user_id = 'USR002'").count() == 89
    # The run can be repeated in place.
    again = run_pipeline(spark, str(landing / "raw.csv"), str(landing / "closing.csv"), None, prefix, None, AS_OF, T2)
    assert again["silver.silver_transactions"] == 13
    # Contracts that have changed in between are found without a time of change.
    later = contracts_after(customers, spark.createDataFrame([("USR002", dt.date(2025, 2, 28))], "user_id string, new_end date")).where("user_id is not null")
    third = run_pipeline(spark, str(landing / "raw.csv"), str(landing / "closing.csv"), later, prefix, None, AS_OF)
    assert third["gold.data_checks"] == 36
    check_marts(spark, [f"{prefix}gold.customer_activity_daily", f"{prefix}gold.activity_summary"], later, AS_OF)
    assert spark.table(f"{prefix}snapshots.transactions_history").count() == 13


def test_pipeline_stops_on_failed_checks(spark, landing):
    with open(landing / "raw.csv", "a") as f:
        f.write("x1,6/11/2025 9:05:07,5.5,USD,getland,unknown,z\n")
    prefix = f"bad{dt.datetime.now():%H%M%S%f}_"
    args = (spark, str(landing / "raw.csv"), str(landing / "closing.csv"), None, prefix, shared_folder(spark, "lake"))
    with pytest.raises(ValueError, match="premium_currency"):
        run_pipeline(*args)
    assert spark.table(f"{prefix}gold.data_checks").where("not passed").count() == 3


def test_incremental_run(spark, database, customers):
    names = [f"{database}.{t}" for t in ("mart", "summary", "watermarks")]
    first = customers.withColumn("updated_at", F.lit("2025-08-01").cast("timestamp_ntz"))
    refresh_activity(spark, first, *names, AS_OF)
    assert refresh_activity(spark, first, *names, AS_OF) == {"rewritten": [], "dropped": []}
    changes = spark.createDataFrame([("USR002", dt.date(2025, 2, 28))], "user_id string, new_end date")
    later = keyed.apply_contract_changes(customers, changes)
    feed = later.withColumn("updated_at", F.when(F.col("user_id") == "USR002", F.lit("2025-08-02")).otherwise(F.lit("2025-08-01")).cast("timestamp_ntz"))
    for rewritten in (["2025-02"], []):
        done = refresh_activity(spark, feed, *names, AS_OF)
        assert done["rewritten"] == ["2025-02", "2025-03", "2025-04"][: 3 * len(rewritten)]
        want = activity.customer_activity_daily(later, AS_OF)
        assert sorted(spark.table(names[0]).select(*want.columns).collect(), key=repr) == sorted(want.collect(), key=repr)
        summary = activity.activity_summary(want)
        assert sorted(spark.table(names[1]).select(*summary.columns).collect()) == sorted(summary.collect())
    assert [str(r.watermark) for r in spark.table(names[2]).collect()] == ["2025-08-02 00:00:00"]


def contracts_after(customers, changes, **more):
    """The sample with new ends, one customer gone, one new, one repriced."""
    later = keyed.apply_contract_changes(customers, changes).where("user_id <> 'USR003'")
    spark = customers.sparkSession
    new = customers_from_rows(spark, [("USR009", "2025-06-01", "2025-06-05", None, 3.0, "travel"), (None, "2025-06-01", "2025-06-05", "2025-06-09", 3.0, None)])
    return later.withColumn("monthly_premium", F.when(F.col("user_id") == "USR005", 6.5).otherwise(F.col("monthly_premium"))).unionByName(new)


def check_marts(spark, names, contracts, as_of):
    want = activity.customer_activity_daily(contracts, as_of)
    assert sorted(spark.table(names[0]).select(*want.columns).collect(), key=repr) == sorted(want.collect(), key=repr)
    summary = activity.activity_summary(want)
    assert sorted(spark.table(names[1]).select(*summary.columns).collect(), key=repr) == sorted(summary.collect(), key=repr)


def test_refresh_without_change_times(spark, database, customers):
    names = [f"{database}.{t}" for t in ("mart", "summary", "contracts")]
    nothing = {"rewritten": [], "dropped": []}
    for _ in range(2):
        assert refresh_activity_from_contracts(spark, customers, *names, AS_OF) == nothing
        check_marts(spark, names, customers, AS_OF)
    changes = spark.createDataFrame([("USR002", dt.date(2025, 2, 28))], "user_id string, new_end date")
    later = contracts_after(customers, changes)
    done = refresh_activity_from_contracts(spark, later, *names, AS_OF)
    assert done["rewritten"] == ["2025-01", "2025-02", "2025-03", "2025-04", "2025-05", "2025-06", "2025-07"]
    check_marts(spark, names, later, AS_OF)
    # A month later open contracts have grown: their earlier months stay as they are.
    done = refresh_activity_from_contracts(spark, later, *names, "2025-08-31")
    assert done == {"rewritten": ["2025-08"], "dropped": []}
    check_marts(spark, names, later, "2025-08-31")
    # Back again: the month is emptied and goes.
    done = refresh_activity_from_contracts(spark, later, *names, AS_OF)
    assert done == {"rewritten": [], "dropped": ["2025-08"]}
    check_marts(spark, names, later, AS_OF)
    none = later.limit(0)
    refresh_activity_from_contracts(spark, none, *names, AS_OF)
    check_marts(spark, names, none, AS_OF)
    refresh_activity_from_contracts(spark, customers, *names, AS_OF)
    check_marts(spark, names, customers, AS_OF)


@pytest.mark.parametrize("moment", ["before the commit", "after the commit", "within the copies"])
def test_a_lost_refresh_adds_differences_once(spark, database, customers, monkeypatch, moment):
    names = [f"{database}.{t}" for t in ("mart", "summary", "contracts")]
    refresh_activity_from_contracts(spark, customers, *names, AS_OF)
    later = contracts_after(customers, spark.createDataFrame([("USR002", dt.date(2025, 2, 28))], "user_id string, new_end date"))
    real, copied = stored._copy, []

    def copy(spark, table, *rest):
        if copied:
            lost()
        copied.append(table)
        return real(spark, table, *rest)

    with monkeypatch.context() as patch:
        if moment == "before the commit":
            patch.setattr(spark, "createDataFrame", lost)
        elif moment == "after the commit":
            patch.setattr(stored, "_copy_all", lost)
        else:
            patch.setattr(stored, "_copy", copy)
        with pytest.raises(RuntimeError, match="driver lost"):
            refresh_activity_from_contracts(spark, later, *names, AS_OF)
    refresh_activity_from_contracts(spark, later, *names, AS_OF)
    check_marts(spark, names, later, AS_OF)
    assert pending(spark, database) == []


def test_the_refresh_reads_changed_customers_only(spark, database, customers):
    """Neither the search for changes nor the summary's differences look into the mart."""
    names = [f"{database}.{t}" for t in ("mart", "summary", "contracts")]
    refresh_activity_from_contracts(spark, customers, *names, AS_OF)
    after = staged(contract_state(customers, AS_OF))
    found = changes.entity_changes(changes.stored_fingerprints(spark.table(names[2])), changes.stored_fingerprints(after))
    read = found._jdf.queryExecution().executedPlan().toString()
    assert read.count("ReadSchema: struct<user_id:string,fingerprint:bigint>") == 2 and read.count("FileScan") == 2
    # Months and summary follow from contracts of the customers found; the mart's own files are read where they are rewritten.
    ids = staged(spark.createDataFrame([("USR001",)], "user_id string"))
    months = changes.month_differences(*(changes.of_entities(rows, ids) for rows in (spark.table(names[2]).limit(0), after)))
    tables = totals_of(activity.expand_days(months, "times"), "times")._jdf.queryExecution().optimizedPlan().toString()
    assert "activity_month" not in tables.split("Relation", 1)[1] and months.count() > 0


def test_entity_changes(spark):
    shape = "user_id string, a string, b string, v double"
    old = [("same", "x", None, 1.0), ("swap", "x", None, 1.0), ("twice", "x", "y", 1.0), ("twice", "x", "y", 1.0), ("order", "p", "q", 1.0),
           ("order", "r", "s", 2.0), ("gone", "x", "y", 1.0), (None, "x", "y", 1.0), ("nan", "x", "y", float("nan"))]
    new = [("same", "x", None, 1.0), ("swap", None, "x", 1.0), ("twice", "x", "y", 1.0), ("order", "r", "s", 2.0), ("order", "p", "q", 1.0),
           ("new", "x", "y", 1.0), (None, "x", "y", 2.0), ("nan", "x", "y", float("nan"))]
    prints = [changes.entity_fingerprints(spark.createDataFrame(rows, shape)) for rows in (old, new)]
    got = {r.user_id: r.change for r in changes.entity_changes(*prints).collect()}
    assert got == {"swap": "changed", "twice": "changed", "gone": "gone", "new": "new", None: "changed"}


def scans_below_exchanges(df):
    """The scans that lie under an exchange in the plan Spark runs."""
    found, inside = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines():
        depth = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        inside = [d for d in inside if d < depth]
        if "Exchange" in line:
            inside.append(depth)
        if "Scan" in line and inside:
            found.append("FileScan" if "FileScan" in line else "Scan ExistingRDD")
    return found


def test_the_history_is_compared_where_it_lies(spark, database):
    """No exchange lies above the scan of the open versions, also with more shuffle partitions than buckets."""
    table = f"{database}.history"
    first = state(spark, [(f"k{i}", "processed", 1.0, "x") for i in range(200)])
    stored.snapshot_table(spark, table, first, T1, buckets=16)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        live = spark.table(table).where(F.col("snapshot_run") == history.OPEN_RUN)
        moved = history.moved_keys(live, first.where("transaction_id <> 'k3'"))
        assert [tuple(r) for r in moved.collect()] == [("k3", True, False)]
        assert "SelectedBucketsCount: 16 out of 16" in moved._jdf.queryExecution().executedPlan().toString()
        assert scans_below_exchanges(moved) == ["Scan ExistingRDD"]  # the source alone moves
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_scratch_tables_are_released(spark):
    name = scratch_database(spark)
    spark.range(3).write.saveAsTable(f"{name}.t")
    rows = staged(spark.range(5).toDF("id"))
    assert rows.count() == 5
    release(spark)
    assert not spark.catalog.databaseExists(name)
    with pytest.raises(Exception, match="(?i)not exist|PATH_NOT_FOUND|FileNotFound|FILE_NOT_EXIST"):
        rows.sparkSession.catalog.clearCache()
        rows.collect()


def test_layers(spark):
    create_layers(spark, "lay_", shared_folder(spark, "lake"))
    create_layers(spark, "lay_")
    names = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert {"lay_bronze", "lay_silver", "lay_gold", "lay_seeds", "lay_snapshots"} <= names


def test_silver_is_stateless(make_bronze):
    plan = to_silver(make_bronze([("6/1/2025 9:05:07", "1", "getland", "processed")]))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_rows_kept_are_written_where_they_are(spark, database, customers, monkeypatch):
    """A change gathers its new rows by partition; those read from the table neither move nor are sorted."""
    mart = f"{database}.mart"
    stored.create_activity_mart(customers, mart, AS_OF)
    changes_ = spark.createDataFrame([("USR002", dt.date(2025, 2, 28))], "user_id string, new_end date")
    changed = keyed.apply_contract_changes(customers.where("user_id = 'USR002'"), changes_)
    rebuilt = activity.customer_activity_daily(changed, AS_OF).withColumn("_loaded_at", F.current_timestamp())
    new, gathered, real = rebuilt.count(), [], stored._by_partition
    monkeypatch.setattr(stored, "_by_partition", lambda rows, columns: gathered.append(rows.count()) or real(rows, columns))
    stored.upsert_into_table(spark, mart, rebuilt, ["user_id", "activity_date"])
    stored.truncate_entities_in_table(spark, mart, changes_)
    stored.replace_entities_in_table(spark, mart, rebuilt, changes_)
    assert gathered == [new, new]
    want = keyed.retroactive_churn(activity.customer_activity_daily(customers, AS_OF), customers, changes_, AS_OF)
    assert sorted(spark.table(mart).select(*want.columns).collect()) == sorted(want.collect())


def test_copies_go_by_groups_of_partitions(spark, database, customers, monkeypatch):
    """Old and new files of a few partitions only lie side by side; a lost copy goes on with all of them."""
    mart = f"{database}.mart"
    stored.create_activity_mart(customers, mart, AS_OF)
    changes_ = spark.createDataFrame([("USR001", dt.date(2025, 2, 10)), ("USR004", dt.date(2025, 2, 15))], "user_id string, new_end date")
    monkeypatch.setattr(stored, "_COPIED_AT_A_TIME", 2)
    real, groups = stored._in_groups, []

    def in_groups(*args):
        for i, some in enumerate(real(*args)):
            if i and not groups:
                groups.append("lost")
                lost()
            groups.append(some.select("activity_month").distinct().count()) if groups else None
            yield some

    monkeypatch.setattr(stored, "_in_groups", in_groups)
    with pytest.raises(RuntimeError, match="driver lost"):
        stored.truncate_entities_in_table(spark, mart, changes_)
    stored.finish(spark, mart)
    assert max(groups[1:]) == 2 and len(groups) > 2 and pending(spark, database) == []
    want = keyed.truncate_entities_after(activity.customer_activity_daily(customers, AS_OF), changes_)
    assert sorted(spark.table(mart).select(*want.columns).collect()) == sorted(want.collect())


def test_packed_keys_match_like_keys(spark):
    """Days as bits of a month, months as bits of four years: the same rows go, null keys as before."""
    days = [None, *(dt.date(y, m, d) for y in (1959, 1970, 2024) for m in (1, 2, 12) for d in (1, 28, 31) if (m, d) != (2, 31))]
    target = spark.createDataFrame([(u, d) for u in ("a", "b", None) for d in days], "user_id string, activity_date date")
    batch = target.where("user_id is null or day(activity_date) > 27 and month(activity_date) < 12 or activity_date is null")
    keys = ["user_id", "activity_date"]
    got = keyed.without_keys(target, keyed.key_months(batch, keys, "activity_date"), keys, "activity_date")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, target.join(batch, keys, "left_anti").collect()))
    months = [f"{y}-{m:02d}" for y in (1959, 1970, 1999, 2024) for m in range(1, 13)]
    target = spark.createDataFrame([(u, m) for u in ("a", "b", None) for m in months], "user_id string, activity_month string")
    pairs = target.where("right(activity_month, 1) in ('1', '4') and coalesce(user_id, 'n') <> 'b' or activity_month = '1970-12'")
    got = target.join(changes.packed_months(pairs), changes.in_months(), "left_semi")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, pairs.collect()))


def test_a_refresh_joins_no_mart_rows_by_shuffle(spark, database, customers, monkeypatch):
    """Changed months are looked up by broadcast, whatever size Spark takes for small."""
    from ledgerspan.plans import incremental

    names = [f"{database}.{t}" for t in ("mart", "summary", "contracts")]
    refresh_activity_from_contracts(spark, customers, *names, AS_OF)
    later = contracts_after(customers, spark.createDataFrame([("USR002", dt.date(2025, 2, 28))], "user_id string, new_end date"))
    plans, real = [], incremental.commit

    def commit(spark, listed):
        plans.append(listed[0].result._jdf.queryExecution().executedPlan().toString())
        return real(spark, listed)

    monkeypatch.setattr(incremental, "commit", commit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        refresh_activity_from_contracts(spark, later, *names, AS_OF)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    kept = [line for line in plans[0].splitlines() if "LeftAnti" in line]
    assert kept and all("BroadcastHashJoin" in line for line in kept)
    check_marts(spark, names, later, AS_OF)


def test_sound_rows_are_dropped_before_failures_are_listed(spark, customers):
    """Null and domain checks filter rows before a list is built of each."""
    mart = activity.customer_activity_daily(customers, AS_OF)
    checks = [quality.not_null("user_id"), quality.not_null("daily_premium"), quality.accepted_values("product_group", ["liability"])]
    for found in (quality.run_checks(mart, checks), quality.results_by_partition(mart, checks, "activity_month")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert any("Filter" in line and " OR " in line for line in plan.splitlines())
    assert [r.failures for r in quality.run_checks(mart, checks).orderBy("check_name", "column_name").collect()] == [2, 0, 0]


@pytest.mark.parametrize("moment", ["none", "after the commit", "without a name", "before the partitions", "after the names"])
def test_a_change_of_most_rows_is_written_once(spark, database, customers, monkeypatch, moment):
    """The result, with the partitions left alone, takes the table's name; a lost job is finished, and later changes go on from it."""
    mart = f"{database}.mart"
    stored.create_activity_mart(customers, mart, AS_OF)
    columns = spark.table(mart).columns
    changes_ = spark.createDataFrame([("USR001", dt.date(2025, 2, 10)), ("USR004", dt.date(2025, 2, 15))], "user_id string, new_end date")
    want = keyed.truncate_entities_after(activity.customer_activity_daily(customers, AS_OF), changes_)
    gone = months_of(spark, mart) - {r[0] for r in want.select("activity_month").distinct().collect()}
    monkeypatch.setattr(stored, "_RENAMED_FROM", 1)
    monkeypatch.setattr(stored, "_in_groups", lambda *_: pytest.fail("copied row by row"))
    starts = {"without a name": "ALTER TABLE", "before the partitions": "MSCK", "after the names": "DROP TABLE IF EXISTS " + database + ".pending_commit"}
    with monkeypatch.context() as patch:
        if moment == "after the commit":
            patch.setattr(stored, "_copy_all", lost)
        elif moment in starts:
            real = type(spark).sql
            patch.setattr(type(spark), "sql", lambda self, text, *a, **k: lost() if text.startswith(starts[moment]) else real(self, text, *a, **k))
        if moment == "none":
            done = stored.truncate_entities_in_table(spark, mart, changes_)
            assert set(done["dropped"]) == gone and not set(done["rewritten"]) & gone
            assert "2025-01" not in done["rewritten"]
        else:
            with pytest.raises(RuntimeError, match="driver lost"):
                stored.truncate_entities_in_table(spark, mart, changes_)
    stored.finish(spark, mart)
    assert pending(spark, database) == [] and spark.table(mart).columns == columns
    assert sorted(spark.table(mart).select(*want.columns).collect()) == sorted(want.collect())
    assert months_of(spark, mart) == {r[0] for r in want.select("activity_month").distinct().collect()}
    monkeypatch.undo()
    # Rows of a new column, then a small change that is copied.
    batch = want.where("user_id = 'USR003'").withColumns({"_loaded_at": F.current_timestamp(), "channel": F.lit("web")})
    stored.upsert_into_table(spark, mart, batch, ["user_id", "activity_date"])
    held = spark.table(mart)
    assert held.where("channel = 'web'").count() == batch.count() and sorted(held.select(*want.columns).collect()) == sorted(want.collect())


def test_other_tables_are_copied_into(spark, database, customers, monkeypatch):
    """A table with properties keeps them; only plain ones are replaced by a result."""
    mart = f"{database}.mart"
    stored.create_activity_mart(customers, mart, AS_OF)
    spark.sql(f"ALTER TABLE {mart} SET TBLPROPERTIES ('owner_team' = 'finance')")
    monkeypatch.setattr(stored, "_RENAMED_FROM", 1)
    changes_ = spark.createDataFrame([("USR001", dt.date(2025, 2, 10)), ("USR004", dt.date(2025, 2, 15))], "user_id string, new_end date")
    stored.truncate_entities_in_table(spark, mart, changes_)
    assert ("owner_team", "finance") in [tuple(r) for r in spark.sql(f"SHOW TBLPROPERTIES {mart}").collect()]
    want = keyed.truncate_entities_after(activity.customer_activity_daily(customers, AS_OF), changes_)
    assert sorted(spark.table(mart).select(*want.columns).collect()) == sorted(want.collect())


def test_summary_totals_add_longs(spark):
    """No decimal is added for a mart row; large, negative and missing premiums count exactly as before."""
    import decimal

    premiums = [0.333333, -0.25, None, 1e6, -7654321.5, 1e12, 2.0, 0.0]
    rows = [(day("2025-01-01") + dt.timedelta(i % 2), f"p{i % 3}" if i % 5 else None, None if i % 7 == 0 else "u", p, (i % 4) * 700 - 900)
            for i, p in enumerate(premiums * 9)]
    mart = spark.createDataFrame(rows, "activity_date date, product_group string, user_id string, daily_premium double, times bigint")
    for sign in (None, "times"):
        totals, want = totals_of(mart, sign), {}
        for at, group, user, premium, times in rows:
            times = times if sign else 1
            sums = want.setdefault((at, group), [0, 0, 0, decimal.Decimal(0)])
            micros = decimal.Decimal(0 if premium is None else round(premium * 1e6))
            for i, more in enumerate((times, times * (user is not None), times * (premium is not None), micros * times)):
                sums[i] += more
        assert {(r[0], r[1]): list(r)[2:] for r in totals.collect()} == want
        partial = [line for line in totals._jdf.queryExecution().executedPlan().toString().splitlines() if "partial_sum" in line][-1]
        assert "partial_sum" in partial and "micros" in partial and "decimal" not in partial
    with pytest.raises(Exception, match="no sum can be kept"):
        totals_of(mart.withColumn("daily_premium", F.lit(float("nan")))).collect()


def test_rows_that_fail_alike_are_counted_before_they_are_listed(spark, customers):
    """Very many failing rows become one list entry for each way to fail."""
    mart = activity.customer_activity_daily(customers, AS_OF).withColumn("user_id", F.when(F.col("user_id") != "USR005", F.col("user_id")))
    checks = [quality.not_null("user_id"), quality.accepted_values("user_id", ["USR001"]), quality.accepted_values("product_group", ["legal"])]
    for found in (quality.run_checks(mart, checks), quality.results_by_partition(mart, checks, "activity_month")):
        plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
        listed = next(i for i, line in enumerate(plan) if "Generate explode(" in line and "sequence" not in line)
        days = next(i for i, line in enumerate(plan) if i > listed and "Generate explode(" in line)
        assert any("Aggregate" in line for line in plan[listed + 1 : days])
    groups = {r.product_group for r in customers.collect()} - {"legal"}
    assert sorted(r.failures for r in quality.run_checks(mart, checks).collect()) == sorted([81, 3, len(groups)])

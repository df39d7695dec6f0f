"""Landing with a ledger of files, and checks kept by partition."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerspan.operators import quality, stored
from ledgerspan.operators.ledger import land_files, ledger_of
from ledgerspan.session import shared_folder

HEADER = "transaction_id,created_at,premium_amount,premium_currency,charged_party,status\n"


@pytest.fixture
def database(spark):
    name = f"l_{dt.datetime.now():%H%M%S%f}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark, 'db')}'")
    return name


def put(folder, name, *ids):
    (folder / name).write_text(HEADER + "".join(f"{i},6/1/2025 9:05:07,4.50,EUR,getland,processed\n" for i in ids))


def landed(spark, table):
    rows = spark.table(table).collect()
    return sorted((r.transaction_id, r._source_file, r.landing_run) for r in rows)


def test_files_count_once(spark, database, tmp_path):
    table = f"{database}.raw"
    put(tmp_path, "a.csv", 1, 2)
    put(tmp_path, "b c.csv", 3)
    assert land_files(spark, str(tmp_path), table, "r1") == {"landed": 2, "replaced": 0}
    first = [("1", "a.csv", "r1"), ("2", "a.csv", "r1"), ("3", "b c.csv", "r1")]
    names = [(i, f.replace(" ", "%20"), r) for i, f, r in first]
    assert landed(spark, table) in (first, names)
    for run in ("r1", "r2"):
        assert land_files(spark, str(tmp_path), table, run) == {"landed": 0, "replaced": 0}
    put(tmp_path, "d.csv", 4)
    put(tmp_path, "a.csv", 2, 5, 6)  # another length: 1 goes, 5 and 6 come
    (tmp_path / "b c.csv").unlink()  # gone files keep their rows
    assert land_files(spark, str(tmp_path), table, "r2") == {"landed": 2, "replaced": 1}
    got = landed(spark, table)
    assert [(i, r) for i, _, r in got] == [("2", "r2"), ("3", "r1"), ("4", "r2"), ("5", "r2"), ("6", "r2")]
    files = spark.table(ledger_of(table))
    assert files.count() == 3 and files.select("_source_path").distinct().count() == 3
    # A run whose only file has changed goes.
    put(tmp_path, "d.csv", 7, 8)
    put(tmp_path, "a.csv", 9)
    assert land_files(spark, str(tmp_path), table, "r3") == {"landed": 2, "replaced": 2}
    assert [(i, r) for i, _, r in landed(spark, table)] == [("3", "r1"), ("7", "r3"), ("8", "r3"), ("9", "r3")]


def test_a_lost_landing_is_repeated(spark, database, tmp_path, monkeypatch):
    table = f"{database}.raw"
    put(tmp_path, "a.csv", 1, 2)
    land_files(spark, str(tmp_path), table, "r1")
    put(tmp_path, "b.csv", 3)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(stored, "_drop_partitions", lost)  # rows are copied, the ledger isn't
        with pytest.raises(RuntimeError, match="driver lost"):
            land_files(spark, str(tmp_path), table, "r2")
    assert land_files(spark, str(tmp_path), table, "r2") == {"landed": 0, "replaced": 0}
    assert [(i, r) for i, _, r in landed(spark, table)] == [("1", "r1"), ("2", "r1"), ("3", "r2")]


def facts(spark, rows):
    return spark.createDataFrame(rows, "user_id string, activity_date date, product_group string, daily_premium double, activity_month string")


def day(text, user="a", group="p", premium=1.0):
    return user, dt.date.fromisoformat(text), group, premium, text[:7]


CHECKS = [*quality.ACTIVITY_CHECKS, quality.accepted_values("product_group", ["p", "q"])]


def test_checks_by_partition(spark, database):
    table, results = f"{database}.mart", f"{database}.results"
    rows = [day("2025-01-01"), day("2025-01-01"), day("2025-01-02", group="odd"), day("2025-02-01", group="odd"), day("2025-02-02", premium=None),
            day("2025-03-01", user=None), day("2025-03-02", group=None), day("2025-03-03", group="strange")]
    stored.create_partitioned(facts(spark, rows), table, ["activity_month"])
    merged = stored.check_table(spark, table, results, CHECKS)
    assert sorted(merged.collect()) == sorted(quality.run_checks(spark.table(table), CHECKS, table).collect())
    failures = {(r.check_name, r.column_name): r.failures for r in merged.collect()}
    assert failures["accepted_values", "product_group"] == 2 and failures["unique_combination", "user_id,activity_date"] == 1
    # January is mended and March emptied: only they are read again.
    batch = facts(spark, [day("2025-01-01"), day("2025-01-02", group="q")])
    done = stored.upsert_into_table(spark, table, batch, ["user_id", "activity_date"])
    assert done["rewritten"] == ["2025-01"]
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (activity_month = '2025-03')")
    before = spark.table(results).where("part = '2025-02'").select("_metadata.file_path").distinct().collect()
    merged = stored.check_table(spark, table, results, CHECKS, ["2025-01", "2025-03"])
    assert sorted(merged.collect()) == sorted(quality.run_checks(spark.table(table), CHECKS, table).collect())
    assert before == spark.table(results).where("part = '2025-02'").select("_metadata.file_path").distinct().collect()
    assert {r.part for r in spark.table(results).select("part").distinct().collect()} == {"2025-01", "2025-02"}


def test_keys_across_partitions_are_refused(spark):
    rows = facts(spark, [day("2025-01-01")])
    with pytest.raises(ValueError, match="across partitions"):
        quality.results_by_partition(rows, [quality.unique("user_id")], "activity_month")
    assert quality.results_by_partition(rows.where(F.lit(False)), CHECKS, "activity_month").count() == 0

"""Keyed operators applied to stored, partitioned tables.

Plain Parquet tables have neither DELETE nor MERGE, so a change writes the partitions it touches anew, and no others.  Its
result is first written to a table of its own, then a small table that lists such results is created, which is the point of
commit, and only then Spark's dynamic partition overwrite copies the results into their tables and one statement drops the
partitions that have no row left.  A change of most rows of a large table writes the other partitions to its result too, which then takes
the table's name: each row is written once, not twice.  Spark creates a table when all its files are written, so a job lost before the
commit leaves every table as it was.  One lost later leaves some partitions new and some old, or a table without its name, until ``finish``
has copied or named the listed results again, which every operation here does first.  One writer at a time works on a database.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from ..sources.tables import with_lineage
from .activity import activity_for_storage, storage_layout
from .history import OPEN_RUN, VALIDITY_COLUMNS, history_run, initial_history, moved_keys, require_later, step_from
from .keyed import day_of, delete_insert, few, key_months, replace_entities, sync_columns, without_keys
from .quality import Check, merged_results, results_by_partition
from .summary import summary_from, totals_of

Partition = tuple[str, ...]
#: Buckets of a history's open versions; a snapshot rewrites those it changes.
BUCKETS = 64
#: Names of results that wait to be copied, and of the table that commits them.
_RESULT, _COMMIT = "pending_result_", "pending_commit_"


def create_activity_mart(customers: DataFrame, table: str, as_of=None, rows_per_file: int = 10_000_000) -> None:
    """First run: the mart partitioned by month, in files of about ``rows_per_file`` rows."""
    files, tasks = storage_layout(customers, as_of, rows_per_file)
    rows = with_lineage(activity_for_storage(customers, as_of, files, tasks), "_loaded_at")
    with _settings(rows.sparkSession, _IN_PLACE):
        create_partitioned(rows, table, ["activity_month"])


def create_partitioned(rows: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    """Stores a table partitioned by the given columns."""
    rows.write.mode("overwrite").format("parquet").partitionBy(*partition_by).saveAsTable(table)


@dataclass(frozen=True)
class Change:
    """Rows that replace the ``touched`` partitions of a table; None stands for all of it.

    Without ``gather`` the result's tasks hold rows of a few partitions each already, as those read from the table do: they are
    written where they are, and no row moves.
    """

    table: str
    result: DataFrame
    touched: set[Partition] | None
    partition_by: tuple[str, ...]
    gather: bool = True


def _database(spark: SparkSession, table: str) -> str:
    return table.rpartition(".")[0] or spark.catalog.currentDatabase()


def _tables(spark: SparkSession, database: str, prefix: str) -> list[str]:
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{prefix}*'").collect()
    return sorted(f"{database}.{r.tableName}" for r in found)


def _existing(spark: SparkSession, table: str) -> set[Partition]:
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {tuple(part.split("=", 1)[1] for part in r[0].split("/")) for r in rows}


def _partitions(rows: DataFrame, column: str) -> set[Partition]:
    """Distinct partition values; as many as the table has partitions, so they fit the driver."""
    return {(str(r[0]),) for r in rows.select(column).distinct().collect()}


#: Inserts replace the partitions they have rows for.
_DYNAMIC_OVERWRITE = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
#: A task keeps a file open for each partition it meets, where it would else sort its rows by partition and spill them; beyond that
#: number it does sort.  A split is about a file of the mart, which holds many rows a byte.
_IN_PLACE = {"spark.sql.maxConcurrentOutputFileWriters": "64", "spark.sql.files.maxPartitionBytes": "32m"}
#: Partitions that are copied at a time: old and new files of these only lie side by side.
_COPIED_AT_A_TIME = 16
#: Partitions are known by their folders, and enter the catalog (``MSCK REPAIR``) when a result has its table's name.
_BY_FOLDER = {"spark.sql.hive.manageFilesourcePartitions": "false"}
#: Changed rows from which on a result takes its table's name; fewer are copied soon, and other partitions keep their files.
_RENAMED_FROM = 10_000_000


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the writes within."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _in_groups(rows: DataFrame, partitions: set[Partition], columns: list[str]) -> Iterator[DataFrame]:
    """The rows of some partitions after those of others; all at once where they are few or not told by one plain value."""
    values = sorted(v for v, *_ in partitions)
    if len(columns) > 1 or len(values) <= _COPIED_AT_A_TIME or not all(re.fullmatch(r"\d[\d-]*", v) for v in values):
        yield rows
        return
    for i in range(0, len(values), _COPIED_AT_A_TIME):
        yield rows.where(F.col(columns[0]).cast("string").isin(values[i : i + _COPIED_AT_A_TIME]))


def _drop_partitions(spark: SparkSession, table: str, columns: Sequence[str], partitions: Iterable[Partition]) -> None:
    """One statement for all partitions without a row."""
    specs = []
    for values in sorted(partitions):
        bad = [v for v in values if not re.fullmatch(r"[\w.-]+", v)]
        if bad:
            raise ValueError(f"partition values must be plain words: {bad}")
        specs.append("PARTITION (" + ", ".join(f"{c} = '{v}'" for c, v in zip(columns, values, strict=True)) + ")")
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")


def _plain(spark: SparkSession, table: str) -> bool:
    """Whether a table is no more than its rows and partitions: a managed Parquet table without buckets, properties or comments."""
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    kind = (about.get("Type"), (about.get("Provider") or "").lower())
    more = {"Num Buckets", "Table Properties", "Comment", "Storage Properties", "Collation"} & set(about)
    return kind == ("MANAGED", "parquet") and not more and not any(f.metadata for f in spark.table(table).schema.fields)


def _takes_name(spark: SparkSession, change: Change) -> bool:
    """Whether the change's result, with the rows of the partitions it leaves alone, should become the table.

    That writes those rows once where copying would write the changed ones a second time.
    """
    if not spark.catalog.tableExists(change.table) or not _plain(spark, change.table):
        return False
    if change.touched is None:
        return True
    held, result = spark.table(change.table), change.result
    types = {f.name: f.dataType for f in result.schema.fields}
    alike = all(types.get(f.name) == f.dataType for f in held.schema.fields)
    if len(change.partition_by) > 1 or not alike or ("None",) in change.touched:
        return False
    changed = held.where(_is_touched(change)).count()
    return changed >= _RENAMED_FROM and 2 * changed > held.count()


def _is_touched(change: Change) -> Column:
    values = sorted(v for (v,) in change.touched or ())
    return F.coalesce(F.col(change.partition_by[0]).cast("string").isin(values), F.lit(False))


def _with_the_rest(spark: SparkSession, change: Change) -> DataFrame:
    """The change's result and the rows of all partitions it leaves alone, in the table's layout and what the result adds."""
    if change.touched is None:
        return change.result
    held = spark.table(change.table)
    result = change.result.select(*held.columns, *[c for c in change.result.columns if c not in held.columns])
    return result.unionByName(sync_columns(held.where(~_is_touched(change)), result))


def _take_name(spark: SparkSession, table: str, result: str, touched: list[str] | None) -> dict[str, list[str]]:
    """Gives a committed result the name of its table; one that has it already keeps it."""
    if spark.catalog.tableExists(result):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {result} RENAME TO {_database(spark, table)}.{table.rpartition('.')[2]}")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)
    written = {"/".join(p) for p in _existing(spark, table)}
    changed = written if touched is None else set(touched)
    return {"rewritten": sorted(changed & written), "dropped": sorted(changed - written)}


def _copy(
    spark: SparkSession, table: str, result: str, touched: list[str] | None, columns: list[str], takes_name: bool = False
) -> dict[str, list[str]]:
    """Puts a committed result into its table; doing so again changes nothing."""
    if takes_name:
        return _take_name(spark, table, result, touched)
    rows = spark.table(result)
    written = _existing(spark, result)
    held = spark.table(table).columns
    emptied: set[Partition] = set()
    if touched is None or set(held) - set(rows.columns):
        with _settings(spark, _IN_PLACE):
            rows.write.mode("overwrite").format("parquet").partitionBy(*columns).saveAsTable(table)
    else:
        new = [f for f in rows.schema.fields if f.name not in held]
        if new:
            # Partitions that aren't rewritten read null for it.
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        emptied = {tuple(p.split("/")) for p in touched} - written
        if written:
            with _settings(spark, _DYNAMIC_OVERWRITE | _IN_PLACE):
                for some in _in_groups(rows.select(*spark.table(table).columns), written, columns):
                    some.write.insertInto(table, overwrite=True)
        _drop_partitions(spark, table, columns, emptied & _existing(spark, table))
    spark.catalog.refreshTable(table)
    text = lambda found: sorted("/".join(p) for p in found)
    return {"rewritten": text(written), "dropped": text(emptied)}


def _copy_all(spark: SparkSession, commit: str) -> list[dict[str, list[str]]]:
    listed = spark.table(commit).orderBy("place").collect()
    done = [_copy(spark, r.table, r.result, r.touched, r.partition_by, "takes_name" in r and r.takes_name) for r in listed]
    # The results may go once the commit is gone; without it they are rests of a lost job.
    spark.sql(f"DROP TABLE IF EXISTS {commit}")
    for r in listed:
        spark.sql(f"DROP TABLE IF EXISTS {r.result}")
    return done


def finish(spark: SparkSession, table: str) -> None:
    """Copies what a lost job had committed to the table's database, and drops what it hadn't."""
    database = _database(spark, table)
    for commit in _tables(spark, database, _COMMIT):
        _copy_all(spark, commit)
    for result in _tables(spark, database, _RESULT):
        spark.sql(f"DROP TABLE IF EXISTS {result}")


def commit(spark: SparkSession, changes: Sequence[Change]) -> list[dict[str, list[str]]]:
    """Replaces partitions of one or more tables of a database, all or none of them; returns what was rewritten and dropped.

    A result that has columns its table hasn't adds them.  Columns can't be removed from a stored table: one that has
    others than the result is replaced whole, so the result must then be all of it.  Where most rows of a large table change, the result
    takes its name.
    """
    changes = [c for c in changes if c.touched is None or c.touched]
    if not changes:
        return []
    database, token = _database(spark, changes[0].table), uuid.uuid4().hex
    listed = []
    for place, change in enumerate(changes):
        name, takes_name = f"{database}.{_RESULT}{token}_{place}", _takes_name(spark, change)
        rows = _with_the_rest(spark, change) if takes_name else change.result
        rows = _by_partition(rows, change.partition_by) if change.gather else rows
        with _settings(spark, ({} if change.gather else _IN_PLACE) | (_BY_FOLDER if takes_name else {})):
            rows.write.format("parquet").partitionBy(*change.partition_by).saveAsTable(name)
        touched = None if change.touched is None else ["/".join(p) for p in sorted(change.touched)]
        listed.append((place, change.table, name, touched, list(change.partition_by), takes_name))
    schema = "place int, table string, result string, touched array<string>, partition_by array<string>, takes_name boolean"
    name = f"{database}.{_COMMIT}{token}"
    spark.createDataFrame(listed, schema).coalesce(1).write.format("parquet").saveAsTable(name)
    return _copy_all(spark, name)


def _replace(
    spark: SparkSession, table: str, result: DataFrame, touched: set[Partition], column: str, gather: bool = True
) -> dict[str, list[str]]:
    """Replaces the touched partitions by ``result``, whose layout the table takes; a lost column makes that a rewrite of all."""
    held = spark.table(table)
    whole = bool(touched) and bool(set(held.columns) - set(result.columns))
    if whole:
        rest = held.where(~F.col(column).isin(sorted(v for (v,) in touched)))
        result = result.unionByName(sync_columns(rest, result))
    done = commit(spark, [Change(table, result, None if whole else touched, (column,), gather)])
    if not done:
        return {"rewritten": [], "dropped": []}
    if not whole:
        return done[0]
    touched_names = {v for (v,) in touched}
    rewritten = [p for p in done[0]["rewritten"] if p in touched_names]
    return {"rewritten": rewritten, "dropped": sorted(touched_names - set(rewritten))}


def _by_partition(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows gathered by partition for writing; adaptive execution splits the large ones."""
    return rows.hint("rebalance", *[F.col(c) for c in columns])


def upsert_into_table(
    spark: SparkSession, table: str, batch: DataFrame, keys: Sequence[str], partition_by: str = "activity_month"
) -> dict[str, list[str]]:
    """``delete_insert`` on a stored table, which takes the batch's layout.

    The partition column must follow from the keys (a month from its day), so that only the
    batch's partitions can hold a match.  Batch and distinct keys are written once; few keys are broadcast, the days of one month
    as one, and then the rows kept are not shuffled for the match.  The batch's rows alone are gathered by partition.
    """
    finish(spark, table)
    batch = staged(batch)
    touched = _partitions(batch, partition_by)
    target = spark.table(table).where(F.col(partition_by).isin(sorted(v for (v,) in touched)))
    day, gathered = day_of(batch, keys), _by_partition(batch, [partition_by])
    if day and day_of(target, keys) == day:
        kept = without_keys(target, few(staged(key_months(batch, keys, day))), keys, day)
        result = sync_columns(kept, batch).unionByName(gathered)
    else:
        result = delete_insert(target, gathered, keys, replaced=few(staged(batch.select(*keys).distinct())))
    return _replace(spark, table, result, touched, partition_by, gather=False)


def replace_entities_in_table(
    spark: SparkSession,
    table: str,
    rebuilt: DataFrame,
    changed_ids: DataFrame,
    key: str = "user_id",
    partition_by: str = "activity_month",
) -> dict[str, list[str]]:
    """``replace_entities`` on a stored table: rewrites the partitions the changed entities had or now have.

    Which they had is read from the table's own key column, whatever the caller believes.  Rebuilt rows and ids are written once.
    """
    finish(spark, table)
    ids, rebuilt = few(staged(changed_ids.select(key).distinct())), staged(rebuilt)
    target = spark.table(table)
    touched = _partitions(target.join(ids, key, "left_semi"), partition_by) | _partitions(rebuilt, partition_by)
    kept = target.where(F.col(partition_by).isin(sorted(v for (v,) in touched)))
    gathered = _by_partition(rebuilt, [partition_by])
    return _replace(spark, table, replace_entities(kept, gathered, ids, key), touched, partition_by, gather=False)


def truncate_entities_in_table(
    spark: SparkSession, table: str, changes: DataFrame, key: str = "user_id", new_end: str = "new_end", partition_by: str = "activity_month"
) -> dict[str, list[str]]:
    """``truncate_entities_after`` on a stored table: only partitions that hold a day to remove are rewritten."""
    finish(spark, table)
    cut = few(staged(changes.select(F.col(key).alias("_key"), F.col(new_end).alias("_end"))))
    target = spark.table(table)
    later = (F.col(key) == F.col("_key")) & (F.col("activity_date") > F.col("_end"))
    touched = _partitions(target.join(cut, later, "left_semi"), partition_by)
    kept = target.where(F.col(partition_by).isin(sorted(v for (v,) in touched))).join(cut, later, "left_anti")
    return _replace(spark, table, kept, touched, partition_by, gather=False)


def refresh_activity_summary(spark: SparkSession, mart: str, summary: str, months: Sequence[str] | None = None) -> None:
    """Builds the summary table, or renews the given months of it from the mart."""
    finish(spark, summary)
    rows = spark.table(mart)
    if months is not None:
        rows = rows.where(F.col("activity_month").isin(list(months)))
    daily = summary_from(totals_of(rows))
    if months is None:
        create_partitioned(_by_partition(daily, ["activity_month"]), summary, ["activity_month"])
    else:
        _replace(spark, summary, daily, {(m,) for m in months}, "activity_month")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raises when a key occurs twice; null keys are not compared."""
    keys = list(keys)
    present = df.dropna(subset=keys)
    clash = present.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if clash:
        raise ValueError(f"duplicate key {tuple(clash[0][k] for k in keys)} on {keys}")


def _bucket_of(key: str, buckets: int):
    """The number Spark gives the bucket of a key, as a column."""
    return F.pmod(F.hash(key), buckets).cast("int")


def snapshot_table(
    spark: SparkSession, table: str, current: DataFrame, as_of, key: str = "transaction_id", buckets: int = BUCKETS, **options
) -> None:
    """Takes one snapshot into a history table.

    The table is partitioned by ``snapshot_run``, ``open`` or the run that closed a version, and the open versions also by
    their key's bucket; its files are bucketed by the key alike, so that the compare joins the open versions where they lie
    and only the source moves.  It reads keys and checked columns.  A run then rewrites the buckets of open versions that change
    and adds its own partition of closed ones.  Columns that the source gains are added; those it loses stay and are null in new
    versions.  A snapshot earlier than the latest one raises.  Give about as many ``buckets`` as tasks should compare.
    """
    require_unique(current, [key])
    columns = ["snapshot_run", "key_bucket"]
    run, opened = history_run(F.lit(as_of)), F.lit(OPEN_RUN)
    if not spark.catalog.tableExists(table):
        first = initial_history(current, as_of, key).select("*", opened.alias("snapshot_run"), _bucket_of(key, buckets).alias("key_bucket"))
        writer = first.repartition(buckets, key).write.format("parquet").partitionBy(*columns).bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(table)
        return
    finish(spark, table)
    history = spark.table(table)
    live = history.where(F.col("snapshot_run") == OPEN_RUN)
    require_later(live, as_of)
    buckets = buckets_of(spark, table)
    fields = [c for c in history.columns if c not in (*VALIDITY_COLUMNS, *columns)]
    fields += [c for c in current.columns if c not in fields]
    held = {f.name: f.dataType for f in [*history.schema.fields, *current.schema.fields]}
    current = current.select(*[c if c in current.columns else F.lit(None).cast(held[c]).alias(c) for c in fields])
    old = live.select(*[F.col(c) if c in live.columns else F.lit(None).cast(held[c]).alias(c) for c in fields], *VALIDITY_COLUMNS, "key_bucket")
    moved = staged(moved_keys(old, current, key, **options).select("*", _bucket_of(key, buckets).alias("key_bucket")))
    keyless = old.where(F.col(key).isNull()).limit(1).count() + current.where(F.col(key).isNull()).limit(1).count()
    touched = {r[0] for r in moved.select("key_bucket").distinct().collect()}
    if keyless:
        touched.add(spark.range(1).select(F.lit(None).cast(held[key]).alias(key)).select(_bucket_of(key, buckets)).first()[0])
    if not touched:
        return
    some = F.col("key_bucket").isin(sorted(touched))
    step = step_from(old.where(some).drop("key_bucket"), current.where(_bucket_of(key, buckets).isin(sorted(touched))), moved, as_of, key, **options)
    closed = F.col("valid_to").isNotNull()
    step = step.select(
        "*", F.when(closed, run).otherwise(opened).alias("snapshot_run"), F.when(closed, 0).otherwise(_bucket_of(key, buckets)).alias("key_bucket")
    )
    step = staged(step)
    # Versions an earlier run of the same moment closed stay in its partition.
    name = spark.range(1).select(run).first()[0]
    before = history.where(F.col("snapshot_run") == name).join(step.where(closed).select("version_id"), "version_id", "left_anti")
    result = step.unionByName(sync_columns(before, step))
    commit(spark, [Change(table, result, {(OPEN_RUN, str(b)) for b in touched}, tuple(columns))])


def buckets_of(spark: SparkSession, table: str) -> int:
    """How many buckets a table was created with."""
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return int(about["Num Buckets"])


def check_table(
    spark: SparkSession, table: str, results: str, checks: Sequence[Check], partitions: Iterable[str] | None = None, partition_by: str = "activity_month"
) -> DataFrame:
    """Checks a stored table partition by partition and keeps the results; returns those of the whole table.

    With ``partitions`` only these are read: a correction's rewritten and dropped ones.  What was found in the others stays as it
    is, and a partition that has gone loses its results.
    """
    finish(spark, results)
    rows = spark.table(table)
    if partitions is None or not spark.catalog.tableExists(results):
        create_partitioned(_by_partition(results_by_partition(rows, checks, partition_by), ["part"]), results, ["part"])
    else:
        some = sorted(set(partitions))
        found = results_by_partition(rows.where(F.col(partition_by).isin(some)), checks, partition_by)
        _replace(spark, results, found, {(p,) for p in some}, "part")
    return merged_results(spark.table(results), checks, table)

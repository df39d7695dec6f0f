"""Filter interaction audit: what each filter removes in every order, kept up while files arrive."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerspan.llm.common import map_arrow, shared_folder, text_or_empty

FILTERS = "ABCDE"
#: Micro-batches that the files are read in; megabytes of files for each partition of the state, and for each of its keys.
BATCHES, STATE_MB, KEY_MB = 4, 64, 2
#: Rows that a task merges at a time before they are shuffled.
MERGED = 1 << 16
#: The bit of the filter on copies, which alone depends on other rows.
_COPY = 1 << FILTERS.index("E")

_ROW = ["key", "who", "mask", "known", "id"]
_MERGED = "key binary, who string, mask int, known boolean, id bigint, n_least bigint, n bigint"
_DELTA = "who string, mask int, n bigint"


def own_failures(text: Column, words: Column) -> Column:
    """Bits of the filters A to D that a text fails, from the text and its words alone."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    fails = [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * capitals.cast("bigint") > 10 * F.length(text).cast("bigint"),
        text.rlike("[#$%&*|]"),
    ]
    return sum((fail.cast("int") * (1 << bit) for bit, fail in enumerate(fails)), F.lit(0))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``key`` (hash of the text), ``mask`` of A to D, ``who`` (good and toxic as 0 or 1, then the part), ``known`` and ``id`` of each row."""
    texts = docs.select(
        text_or_empty().cast("string").alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("bigint").alias("id"),
    )
    # Steps of their own: what is used several times is then computed once.
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words")
    narrow = texts.select("*", words).select(
        F.unhex(F.sha2("text", 256)).alias("key"), own_failures(F.col("text"), F.col("words")).alias("mask"), "part", "id"
    )
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    flags = [F.coalesce(F.col(c), F.lit(0)).cast("string") for c in ("good", "toxic")]
    return narrow.join(marks, "id", "left").select(
        "key",
        F.concat(*flags, "part").alias("who"),
        "mask",
        F.col("id").isNotNull().alias("known"),
        F.coalesce("id", F.lit(0)).alias("id"),
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a text become one for each part and label: the least id, its rows, all rows."""

    def merged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).group_by(_ROW).aggregate([([], "count_all")]).to_pandas()
        rows = rows.rename(columns={"count_all": "n_least"})
        rows["n"] = rows.groupby(_ROW[:-1], sort=False)["n_least"].transform("sum")
        least = rows.groupby(_ROW[:-1], sort=False)["id"].transform("min")
        return pa.RecordBatch.from_pandas(rows[rows["id"] == least], preserve_index=False)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= MERGED:
            yield merged(held)
            held, size = [], 0
    if size:
        yield merged(held)


_HELD = pa.schema([("key", pa.binary()), ("least", pa.int64()), ("who", pa.string()), ("n", pa.int64())])


def retract(rows: pd.DataFrame, held: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Changes of the counters (``who``, ``mask``, ``n``) by merged ``rows``, and the state after them.

    The state ``held`` has, for each text, the least id seen and how many rows of it each part and label has: those that don't
    count as copies.  All rows arrive as copies; those of the least id are taken back.  Should a smaller id arrive, the
    earlier ones become copies.
    """
    known = rows[rows["known"]]
    arrived = known.groupby("key", sort=False).agg(arrived=("id", "min"), mask=("mask", "first"))
    held = held.merge(arrived, left_on="key", right_index=True, how="left")
    gone = held["arrived"] < held["least"]
    before = held[["key", "least"]].drop_duplicates("key").set_index("key")["least"]
    least = known["key"].map(arrived["arrived"])
    least = least.where(~(known["key"].map(before) < least), known["key"].map(before).fillna(0)).astype("int64")
    first = known[known["id"] == least]
    late = held[gone]
    moves = [
        rows.loc[~rows["known"], ["who", "mask", "n"]],
        known[["who", "n"]].assign(mask=known["mask"] | _COPY),
        first[["who", "mask"]].assign(n=first["n_least"]),
        first[["who"]].assign(mask=first["mask"] | _COPY, n=-first["n_least"]),
        late[["who", "mask"]].assign(n=-late["n"]),
        late[["who", "n"]].assign(mask=late["mask"].astype("int64") | _COPY),
    ]
    change = pd.concat(moves).astype({"mask": "int64", "n": "int64"}).groupby(["who", "mask"], as_index=False)["n"].sum()
    now = first[["key", "who"]].assign(least=first["id"], n=first["n_least"])
    after = pd.concat([held.loc[~gone, ["key", "least", "who", "n"]], now[["key", "least", "who", "n"]]])
    return change[change["n"] != 0], after.groupby(["key", "least", "who"], as_index=False, sort=False)["n"].sum()


def _update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames))
    held = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else _HELD.empty_table().to_pandas()
    change, after = retract(rows, held)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, _HELD, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(pa.Table.from_pandas(after, _HELD, preserve_index=False))
    state.update((out.getvalue().to_pybytes(),))
    yield change.astype({"mask": "int32"})


def stream_changes(spark: SparkSession, documents: str, labels: str, folder: str, batches: int = BATCHES) -> DataFrame:
    """Reads all files of ``documents`` as available-now micro-batches; ``who``, ``mask`` and ``n`` of every change are left in ``folder``.

    Each batch filters its texts, merges equal ones within tasks, and updates the state of the texts, from which the changes
    follow.  A call of Python for each text would cost some two milliseconds, so that the state's key is a range of text hashes, as many
    as the files have megabytes: it holds some hundred or thousand texts at any size of the table.  State, offsets and the list of whole output files lie in ``folder``: started again with the same one after a loss, the
    stream goes on behind the last whole batch and counts nothing twice.  The number of state partitions follows from the size of the files.
    """
    sizes = spark.read.format("binaryFile").load(documents).agg(F.sum("length"), F.count("*")).first()
    total = sizes[0] or 0
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(max(6, total // (STATE_MB << 20))))
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    # Many stores are small: without this each would reserve some megabytes of disk.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    # A stream reads a lone file only by a pattern; this one matches the path itself, a file or a folder.
    pattern = f"{documents.rstrip('/')[:-1]}[{documents.rstrip('/')[-1]}]"
    docs = (
        session.readStream.schema(session.read.parquet(documents).schema)
        .option("maxBytesPerTrigger", str(max(1, -(-total // batches))))
        .parquet(pattern)
    )
    merged = map_arrow(labelled(docs, session.read.parquet(labels)), _merge, _MERGED)
    ranges = F.pmod(F.xxhash64("key"), F.lit(max(64, total // (KEY_MB << 20))))
    changes = merged.withColumn("range", ranges).groupBy("range").applyInPandasWithState(
        _update, _DELTA, "texts binary", "append", GroupStateTimeout.NoTimeout
    )
    query = (
        changes.writeStream.format("parquet")
        .option("path", f"{folder}/changes")
        .option("checkpointLocation", f"{folder}/progress")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(_DELTA).parquet(f"{folder}/changes")


def orders() -> list[tuple[str, int, int, int]]:
    """Every order and step, with the bit of its filter and those of the filters before it."""
    found = []
    for order in map("".join, itertools.permutations(FILTERS)):
        bits = [1 << FILTERS.index(name) for name in order]
        found += [(order, step + 1, bit, sum(bits[:step])) for step, bit in enumerate(bits)]
    return found


def report(changes: DataFrame) -> DataFrame:
    """The counters of all parts in every order and step; their number is bounded by the parts, not the documents."""
    counters = changes.groupBy("who", "mask").agg(F.sum("n").alias("n"))
    steps = F.split(F.lit(",".join(" ".join(map(str, step)) for step in orders())), ",")
    step = F.split("step", " ")
    rows = counters.select("who", "mask", "n", F.explode(steps).alias("step")).select(
        F.substring("who", 1, 1).alias("good"),
        F.substring("who", 2, 1).alias("toxic"),
        F.expr("substring(who, 3)").alias("part"),
        "mask",
        "n",
        step[0].alias("filter_order"),
        *(step[i].cast("int").alias(name) for i, name in ((1, "step"), (2, "bit"), (3, "earlier"))),
    )
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    everything = len(list(itertools.permutations(FILTERS)))
    counted = {
        "kept": ~fails & ~gone,
        "removed": fails & ~gone,
        "redundant": fails & gone,
        "unique_fails": F.col("mask") == F.col("bit"),
        "good_lost": fails & ~gone & (F.col("good") == "1"),
        "toxic_lost": fails & ~gone & (F.col("toxic") == "1"),
    }
    # Of the filters a document fails, each comes first in the same number of orders.
    share = F.when(fails, F.col("n") * F.expr(f"{everything} div bit_count(mask)")).otherwise(0)
    return rows.groupBy("part", "filter_order", "step").agg(
        *(F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(name) for name, condition in counted.items()),
        F.sum(share).alias("shapley"),
    )


def filter_audit(spark: SparkSession, documents: str, labels: str, batches: int = BATCHES) -> DataFrame:
    """How five filters interact on the table of files at ``documents``, for each language (``part``), order and step.

    Filters: A, under 100 words; B, under 80 % distinct words; C, over 10 % capitals; D, a character of ``#$%&*|``; E, the same text as
    a smaller doc_id.  Columns: ``part``, ``filter_order``, ``step``, and the documents of the part that are ``kept`` after the step, ``removed``
    in it, ``redundant`` (failing its filter, removed before), ``unique_fails`` (failing no other), ``good_lost``, ``toxic_lost`` (removed
    here, with such a label) and ``shapley`` (removed by the filter, summed over all orders).  A null text is empty, a null language
    the part ''.  A null doc_id is no copy and makes none; rows of one doc_id and text are no copies of each other.  Labels of
    repeated ids are merged, one mark is enough.  An empty table gives no rows.  Other columns are not read.
    """
    return report(stream_changes(spark, documents, labels, shared_folder(spark, "audit"), batches))

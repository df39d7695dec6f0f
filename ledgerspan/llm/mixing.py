"""Mixing sources to target weights by proportionate-fair scheduling of their blocks."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspan.llm.common import shared_folder

#: Slots of a scheduling cycle that the weights are rounded to, rows of a block, and rows ranked by one task.
SLOTS, BLOCK, RANKED = 1000, 16, 50_000
#: Default weights grow as this power of a source's rows: large sources are damped, small ones raised.
TEMPERATURE = 0.5
#: Blocks of a schedule that the driver holds at once, and the last slot a long can number.
CHUNK, LAST_SLOT = 1 << 20, 2**63 - 1


def slot_parts(weights: Mapping[str, float], slots: int = SLOTS) -> dict[str, int]:
    """Weights as whole slots of a cycle, at least one for a source, largest remainders rounded up first."""
    if len(weights) > slots or any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive, and sources no more than the slots of a cycle")
    total, free = sum(weights.values()), slots - len(weights)
    exact = {s: w / total * free for s, w in weights.items()}
    parts = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: slots - sum(parts.values())]:
        parts[s] += 1
    return parts


def _schedule(parts: list[int]) -> Column:
    """Source by slot of a cycle, as an array, by earliest deadline first.

    The k-th block (from 0) of a source with p of S slots is released at slot floor(k S / p) and due before ceil((k + 1) S / p).
    The weights fill the cycle, so that every deadline is met and no source ever deviates from its share by a whole block.
    """
    slots, n = sum(parts), len(parts)
    share = F.array(*map(F.lit, parts))

    def due(done: Column, i: Column, t: Column) -> Column:
        """Deadline and number of a source as one value, if its next block is released."""
        released = (done < share[i]) & (F.floor(done * slots / share[i]) <= t)
        return F.when(released, F.ceil((done + 1) * slots / share[i]) * n + i)

    def step(state: Column, t: Column) -> Column:
        pick = F.array((F.array_min(F.transform(state["done"], lambda d, i: due(d, i, t))) % n).cast("int"))
        return F.aggregate(
            pick,
            state,
            lambda s, p: F.struct(
                F.transform(s["done"], lambda d, i: d + (i == p).cast("int")).alias("done"),
                F.concat(s["order"], F.array(p)).alias("order"),
            ),
        )

    empty = F.struct(F.array_repeat(F.lit(0), n).alias("done"), F.array().cast("array<int>").alias("order"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), empty, step, lambda s: s["order"])


def schedule(weights: list[float], rows: list[int], block: int) -> Iterator[tuple[int, int, int, int]]:
    """Source, block, slot and first position of every block, by earliest deadline first from the weights themselves.

    The k-th block of a source with weight w of W is released at slot floor(k W / w) and due before ceil((k + 1) W / w), in exact
    integers, so that the deviation from the weight stays under one block however long the schedule is.  Sources that have run out
    free their slots; where nothing is released, slots are passed over.
    """
    exact = [Fraction(w) for w in weights]
    if any(not w > 0 for w in exact):
        raise ValueError("weights must be positive")
    scale = math.lcm(*(w.denominator for w in exact))
    shares = [int(w * scale) for w in exact]
    total = sum(shares)
    later = [(0, i, 0) for i, n in enumerate(rows) if n]
    ready: list[tuple[int, int, int]] = []
    slot = position = 0
    while later or ready:
        if not ready and later[0][0] > slot:
            slot = later[0][0]
        while later and later[0][0] <= slot:
            _, i, k = heapq.heappop(later)
            heapq.heappush(ready, (-(-(k + 1) * total // shares[i]), i, k))
        _, i, k = heapq.heappop(ready)
        yield i, k, min(slot, LAST_SLOT), position
        position += min(block, rows[i] - k * block)
        slot += 1
        if (k + 1) * block < rows[i]:
            heapq.heappush(later, ((k + 1) * total // shares[i], i, k + 1))


def _stored_schedule(spark: SparkSession, weights: Mapping[str, float], counts: Mapping[str, int], block: int) -> DataFrame:
    """The schedule in the shared folder; the driver holds ``CHUNK`` blocks of it at once."""
    names, folder = sorted(counts), shared_folder(spark, "mixing")
    blocks = schedule([weights[s] for s in names], [counts[s] for s in names], block)
    while part := list(islice(blocks, CHUNK)):
        source, *numbers = zip(*part)
        columns = [pa.array([names[i] for i in source], pa.string()), *(pa.array(x, pa.int64()) for x in numbers)]
        found = pa.Table.from_arrays(columns, names=["_source", "_block", "_slot", "_first"])
        spark.createDataFrame(found).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def _by_schedule(ranked: DataFrame, starts: DataFrame, planned: DataFrame, block: int) -> DataFrame:
    """Rows with slot and position; a range's blocks reach it as one array, so that rows aren't shuffled once more."""
    first = F.floor(F.col("_before") / block)
    last = F.floor((F.col("_before") + F.col("_n") - 1) / block)
    held = starts.select("_source", "_range", F.explode(F.sequence(first, last)).alias("_block")).join(planned, ["_source", "_block"])
    held = held.groupBy("_source", "_range").agg(F.array_sort(F.collect_list(F.struct("_block", "_slot", "_first"))).alias("_held"))
    rows = ranked.join(held, ["_source", "_range"]).withColumn("_block", F.floor(F.col("_rank") / block))
    own = F.col("_held")[(F.col("_block") - first).cast("int")]
    return rows.select("_row", "_source", "_block", own["_slot"].alias("_slot"), (own["_first"] + F.col("_rank") % block).alias("_position"))


def _ranked(docs: DataFrame, source: Column, key: Column, rows_per_task: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their rank in their source by a hash of ``key``, and each source's ranges with their rows and the rows before.

    A source may hold a third of all rows: each source is cut into ranges of the hash, ranked apart, after the ranges' sizes
    are summed up.  Ranges follow from the number of rows.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.coalesce(source.cast("string"), F.lit("")).alias("_source"),
        F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")).alias("_hash"),
    )
    total = rows.count()
    digits = 0
    while digits < 8 and 16**digits * rows_per_task < total:
        digits += 1
    rows = rows.withColumn("_range", F.substring("_hash", 1, digits) if digits else F.lit(""))
    sizes = rows.groupBy("_source", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_source").orderBy("_range")
    starts = sizes.select("_source", "_range", "_n", (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    within = Window.partitionBy("_source", "_range").orderBy("_hash", F.xxhash64("_row"))
    ranked = rows.withColumn("_in_range", F.row_number().over(within) - 1).join(starts.drop("_n"), ["_source", "_range"])
    return ranked.withColumn("_rank", F.col("_before") + F.col("_in_range")), starts


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    *,
    source: str = "source",
    key: str = "doc_id",
    block: int = BLOCK,
    slots: int | None = SLOTS,
    rows_per_task: int = RANKED,
) -> DataFrame:
    """``_row`` (the columns of ``docs``), ``_source``, ``_block``, ``_slot`` and ``_position`` of every row.

    ``_position`` numbers all rows from 0 in mixed order.  Until the first source runs out, each source's blocks at any slot are
    within one block of its weight; afterwards the others go on in their ratio.  No row is dropped or repeated.  Sources that
    ``weights`` doesn't name share its smallest weight.

    Without ``weights`` they are the sources' rows to the power ``TEMPERATURE``, in whole slots of a cycle of ``slots`` (one for each
    source, the rest shared), as the SQL of op2 has them: the deviation is under one block from those, not from the power itself.
    With ``slots=None``, with more sources than slots, and with ``weights`` nothing is rounded.

    Null sources count as the source "".  Rows with equal or null keys are ordered by a hash of their columns; the place of
    repeated rows among each other is arbitrary, as they are alike.  An empty table gives no rows.  The driver sees one row a source
    and, where nothing is rounded, deals the blocks one after another, a few microseconds each.
    """
    ranked, starts = _ranked(docs, F.col(source), F.col(key), rows_per_task)
    counts = {r["_source"]: r["_n"] for r in starts.groupBy("_source").agg(F.sum("_n").alias("_n")).collect()}
    rounded = weights is None and slots is not None and len(counts) <= slots
    if weights is None:
        weights = {s: n**TEMPERATURE for s, n in counts.items()}
    else:
        least = min(weights.values(), default=1.0)
        weights = {s: weights.get(s, least) for s in counts}
    if not counts:
        return ranked.select("_row", "_source", *(F.lit(0).cast("bigint").alias(c) for c in ("_block", "_slot", "_position")))
    if not rounded:
        return _by_schedule(ranked, starts, _stored_schedule(docs.sparkSession, weights, counts, block), block)
    parts = slot_parts(weights, slots)
    names = sorted(counts)
    shares = [parts[s] for s in names]
    spark = docs.sparkSession
    order = F.col("_order")
    cycle = (
        spark.range(1)
        .select(_schedule(shares).alias("_order"))
        .select(
            F.inline(
                F.transform(
                    order,
                    lambda s, t: F.struct(
                        t.alias("_in_cycle"),
                        F.array(*map(F.lit, names))[s].alias("_source"),
                        F.size(F.filter(F.slice(order, F.lit(1), t), lambda x: x == s)).alias("_turn"),
                        F.transform(
                            F.sequence(F.lit(0), F.lit(len(names) - 1)),
                            lambda i: F.size(F.filter(F.slice(order, F.lit(1), t), lambda x: x == i)),
                        ).alias("_passed"),
                    ),
                )
            )
        )
    )
    share_of = F.create_map(*(x for s in names for x in (F.lit(s), F.lit(parts[s]))))
    rows = ranked.withColumn("_block", F.floor(F.col("_rank") / block)).withColumn("_share", share_of[F.col("_source")])
    rows = rows.withColumn("_cycle", F.floor(F.col("_block") / F.col("_share"))).withColumn("_turn", (F.col("_block") % F.col("_share")).cast("int"))
    rows = rows.join(cycle, ["_source", "_turn"])
    held = F.array(*(F.struct(F.lit(p).cast("bigint").alias("share"), F.lit(counts[s]).cast("bigint").alias("rows")) for s, p in zip(names, shares)))
    earlier = F.aggregate(
        F.zip_with(held, "_passed", lambda h, p: F.least(h["rows"], block * (F.col("_cycle") * h["share"] + p))),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )
    return rows.select(
        "_row",
        "_source",
        "_block",
        (F.col("_cycle") * slots + F.col("_in_cycle")).alias("_slot"),
        (earlier + F.col("_rank") % block).alias("_position"),
    )

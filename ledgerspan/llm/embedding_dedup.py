"""Embedding near-duplicates by a tiled comparison in the order of principal components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspan.llm.common import map_arrow, staged
from ledgerspan.llm.components import components

#: Slack of the bounds: they are compared in rotated coordinates, links in the given ones.
_SLACK = 1e-9


@dataclass(frozen=True)
class Settings:
    """Vectors link at a cosine of ``threshold`` or more.

    The others change cost, not results: a tile holds ``tile`` vectors; ``steps`` are the leading dimensions after which bounds are
    tested, and ``boxed`` those by whose ranges whole tiles are told apart; the rotation is fitted on ``sample`` vectors.
    """

    threshold: float = 0.98
    tile: int = 1024
    steps: tuple[int, ...] = (4, 8, 16, 32)
    boxed: int = 8
    sample: int = 4096


def _usable(label: str, embedding: str):
    """Whether a vector can link at all: a label, and components that are finite and not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(
        F.col(label).isNotNull() & ~F.exists(embedding, bad) & F.exists(embedding, lambda x: x != 0), F.lit(False)
    )


def rotation(vectors: np.ndarray) -> np.ndarray:
    """Orthogonal matrix whose columns are the principal directions of unit vectors, strongest first."""
    _, directions = np.linalg.eigh(vectors.T @ vectors)
    return np.ascontiguousarray(directions[:, ::-1])


def _units(raw: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def linked(a: np.ndarray, b: np.ndarray, turn: np.ndarray, settings: Settings) -> np.ndarray | None:
    """Which unit vectors of ``a`` link with which of ``b``, as a matrix; None if none can.

    Products are summed over the leading principal dimensions; what the rest can add is at most the product of the norms of both
    rests.  Vectors that can't reach the threshold with any other leave the comparison.
    """
    ra, rb = a @ turn, b @ turn
    rows, columns = np.arange(len(a)), np.arange(len(b))
    partial, done = np.zeros((len(a), len(b))), 0
    for step in (s for s in settings.steps if s < a.shape[1]):
        partial += ra[rows, done:step] @ rb[columns, done:step].T
        rest = np.outer(np.sqrt((ra[rows, step:] ** 2).sum(axis=1)), np.sqrt((rb[columns, step:] ** 2).sum(axis=1)))
        able = partial + rest >= settings.threshold - _SLACK
        keep_rows, keep_columns = able.any(axis=1), able.any(axis=0)
        if not keep_rows.any():
            return None
        rows, columns, done = rows[keep_rows], columns[keep_columns], step
        partial = partial[np.ix_(keep_rows, keep_columns)]
    links = np.zeros((len(a), len(b)), dtype=bool)
    links[np.ix_(rows, columns)] = a[rows] @ b[columns].T >= settings.threshold
    return links if links.any() else None


def _groups(links: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Connected rows and columns of a link matrix."""
    left = links.any(axis=1)
    while left.any():
        rows = np.zeros(len(left), dtype=bool)
        rows[np.argmax(left)] = True
        while True:
            columns = links[rows].any(axis=0)
            wider = links[:, columns].any(axis=1)
            if (wider == rows).all():
                break
            rows = wider
        yield np.flatnonzero(rows), np.flatnonzero(columns)
        left &= ~rows


def _fit(classes: DataFrame, settings: Settings) -> dict[int, np.ndarray]:
    """A rotation for each vector length of a bounded sample (the smallest keys)."""
    rows = classes.orderBy("key").limit(settings.sample).select("dim", F.col("embedding").cast("array<double>")).collect()
    found = {}
    for dim in {r[0] for r in rows}:
        found[dim] = rotation(_units(np.array([r[1] for r in rows if r[0] == dim], dtype=float)))
    return found


def _tiles(classes: DataFrame, turns, settings: Settings) -> DataFrame:
    """Vectors of a label in the order of their first principal coordinate, cut into tiles; a row a tile."""
    turn_of = lambda dim: turns.value.get(dim, np.eye(dim))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(4).to_pylist()
            first = [float((_units(np.array([x], dtype=float)) @ turn_of(len(x))[:, :1])[0, 0]) for x in rows]
            packed = [np.array(x, dtype="<f8").tobytes() for x in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in (0, 1, 2, 3, 5)), pa.array(first, pa.float64()), pa.array(packed, pa.binary())],
                names=["key", "label", "dim", "n", "first", "place", "packed"],
            )

    placed = map_arrow(
        classes.select("key", "label", "dim", "n", F.col("embedding").cast("array<double>").alias("embedding"), "first"),
        place,
        "key string, label string, dim int, n bigint, first bigint, place double, packed binary",
    )
    ranged = placed.repartitionByRange("label", "dim", "place").sortWithinPartitions("label", "dim", "place", "key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = TaskContext.get().partitionId() << 32

        def tile() -> pa.RecordBatch:
            nonlocal number
            number += 1
            _, label, dim, *_ = held[0]
            vectors = b"".join(h[6] for h in held)
            turned = (_units(np.frombuffer(vectors, dtype="<f8").reshape(len(held), dim)) @ turn_of(dim))[:, : settings.boxed]
            row = {
                "tile": number, "label": label, "dim": dim, "vectors": vectors, "low": turned.min(axis=0).tolist(), "high": turned.max(axis=0).tolist(),
                "keys": [h[0] for h in held], "counts": [h[3] for h in held], "firsts": [h[4] for h in held],
            }
            return pa.RecordBatch.from_pylist([row], schema=_TILE)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if held and (len(held) == settings.tile or held[0][1:3] != row[1:3]):
                    yield tile()
                    held = []
                held.append(row)
        if held:
            yield tile()

    return staged(map_arrow(ranged, cut, _TILE_SCHEMA))


_TILE = pa.schema(
    [
        ("tile", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("vectors", pa.binary()), ("low", pa.list_(pa.float64())),
        ("high", pa.list_(pa.float64())), ("keys", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("firsts", pa.list_(pa.int64())),
    ]
)
_TILE_SCHEMA = (
    "tile bigint, label string, dim int, vectors binary, low array<double>, high array<double>, "
    "keys array<string>, counts array<bigint>, firsts array<bigint>"
)


def _compared(tiles: DataFrame, turns, settings: Settings) -> DataFrame:
    """``key``, ``links`` and ``root`` of each vector that links within a pair of tiles; ``root`` is a vector it is connected to.

    A tile meets tiles of its label only, and only those whose ranges of leading coordinates come close enough: at a cosine c
    unit vectors are at most sqrt(2 - 2 c) apart.  No pairs of vectors leave a task, just sums and a star for each group.
    """
    meta = tiles.select("tile", "label", "dim", "low", "high")
    other = meta.select(F.col("tile").alias("tile2"), "label", "dim", F.col("low").alias("low2"), F.col("high").alias("high2"))
    below = F.zip_with("low", "high2", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    above = F.zip_with("low2", "high", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    apart = F.aggregate(F.zip_with(below, above, lambda x, y: x * x + y * y), F.lit(0.0), lambda total, x: total + x)
    close = apart <= 2 - 2 * settings.threshold + _SLACK
    pairs = meta.join(other, ["label", "dim"]).where((F.col("tile") <= F.col("tile2")) & close).select("tile", "tile2")
    body = tiles.select("tile", "dim", "vectors", "keys", "counts")
    second = tiles.select(F.col("tile").alias("tile2"), F.col("vectors").alias("vectors2"), F.col("keys").alias("keys2"), F.col("counts").alias("counts2"))
    both = pairs.join(body, "tile").join(second, "tile2")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(i)[at] for i, name in enumerate(batch.schema.names)}
                dim = row["dim"].as_py()
                turn = turns.value.get(dim, np.eye(dim))
                a, b = (_units(np.frombuffer(row[c].as_py(), dtype="<f8").reshape(-1, dim)) for c in ("vectors", "vectors2"))
                links = linked(a, b, turn, settings)
                same = row["tile"].as_py() == row["tile2"].as_py()
                if links is None:
                    continue
                if same:
                    links |= links.T
                    np.fill_diagonal(links, False)
                keys, counts = (np.array(row[c].as_py()) for c in ("keys", "counts"))
                keys2, counts2 = (np.array(row[c].as_py()) for c in ("keys2", "counts2"))
                here, there = links @ counts2, counts @ links
                out_keys, out_links, out_roots = [], [], []
                if same:  # so that a vector's row and column are in one group
                    np.fill_diagonal(links, links.any(axis=1))
                for rows, columns in _groups(links):
                    root = keys[rows[0]]
                    out_keys += keys[rows].tolist()
                    out_links += here[rows].tolist()
                    if not same:
                        out_keys += keys2[columns].tolist()
                        out_links += there[columns].tolist()
                    out_roots += [root] * (len(out_keys) - len(out_roots))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_keys, pa.string()), pa.array(out_links, pa.int64()), pa.array(out_roots, pa.string())],
                    names=["key", "links", "root"],
                )

    return staged(map_arrow(both.select("tile", "tile2", "dim", "vectors", "vectors2", "keys", "keys2", "counts", "counts2"), compare, "key string, links bigint, root string"))


def near_duplicates(vectors: DataFrame, settings: Settings = Settings(), *, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``.

    Vectors of one label (and length) are compared; equal ones first become one, with their number, so that copies cost one
    vector each.  Vectors that are null, zero, without a label, or hold null or non-finite components link with nothing: they
    keep their own id.  Repeated rows are copies of each other; a null id is a vector too, but smallest only where all ids
    are null.  An empty table gives no rows; other columns are not read.
    """
    words = F.array_join(F.transform(embedding, lambda x: x.cast("string")), ",")
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(embedding).alias("embedding"),
        F.when(_usable(label, embedding), F.sha2(F.concat_ws("|", F.col(label).cast("string"), words), 256)).alias("key"),
    )
    classes = staged(
        rows.where("key is not null")
        .groupBy("key")
        .agg(
            F.any_value("label").alias("label"),
            F.any_value("embedding").alias("embedding"),
            F.count("*").alias("n"),
            F.min("vec_id").alias("first"),
        )
        .withColumn("dim", F.size("embedding"))
    )
    turns = vectors.sparkSession.sparkContext.broadcast(_fit(classes, settings))
    found = _compared(_tiles(classes, turns, settings), turns, settings)
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("key"), "root")
    known = classes.select("key", "n", "first").join(links, "key", "left").join(roots, "key", "left")
    known = known.select("key", "first", F.coalesce("root", "key").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(least, "root").select("key", "n_links", "component_id")
    some = rows.where("key is not null").select("vec_id", "key").join(known, "key").select("vec_id", "n_links", "component_id")
    none = rows.where("key is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

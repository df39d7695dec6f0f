"""N-gram Jaccard join: globally ordered shingle sets, candidates by prefixes, verification in a prefix tree."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspan.llm.common import map_arrow, staged
from ledgerspan.llm.components import components

U = np.uint64
#: Fixed odd multipliers of the hashes.
_A, _B = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
#: Bytes of text whose words are held at a time.
_PIECE = 1 << 20
_BLANK = re.compile(rb"[ \t-\r]")
_NULL_ID = -(1 << 63)


@dataclass(frozen=True)
class Settings:
    """``words``: shingle length.  Links need 7 times the overlap >= 3 times the summed sizes, a similarity of 0.75.

    The others change cost, not results.  ``bits``: log2 of the counters that order shingles by frequency, whatever the corpus'
    size; ``bands`` of two minima each find most links early; a shingle counted ``hot`` times is dealt over ``salts``
    tasks; a prefix tree has some ``members`` and is held against ``probes``.
    """

    words: int = 5
    bits: int = 20
    bands: int = 8
    hot: int = 4096
    salts: int = 64
    members: int = 256
    probes: int = 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * _A
    x = (x ^ (x >> U(29))) * _B
    return x ^ (x >> U(32))


def _word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words in order, a piece of the text at a time; bytes.split and lower know the ASCII blanks and letters only."""
    parts, start = [], 0
    while start < len(data):
        blank = _BLANK.search(data, start + _PIECE)
        end = blank.start() if blank else len(data)
        words = data[start:end].lower().split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U, count=len(words)))
        start = end
    return np.concatenate(parts) if parts else np.empty(0, U)


def shingle_set(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text has one, a text without words none."""
    hashes = _word_hashes(text.encode("utf-8", "surrogatepass"))
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    value = np.full(len(hashes) - width + 1, width, dtype=U)
    for k in range(width):
        value = (value ^ (value >> U(32))) * _A + hashes[k : k + len(value)]
    return np.unique(_mixed(value))


def needed(size_a, size_b):
    """The least overlap of sets of these sizes that links them."""
    return (3 * (size_a + size_b) + 6) // 7


def _signature(values: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh3_64_digest(values.tobytes()), dtype=">i8")[0])


def _bands(values: np.ndarray, bands: int) -> list[int]:
    """Hashes of pairs of minima over the set under ``2 * bands`` fixed permutations."""
    factors = _mixed(np.arange(1, 2 * bands + 1, dtype=U)) | U(1)
    minima = np.full(2 * bands, np.iinfo(U).max, dtype=U)
    for start in range(0, len(values), 1 << 14):
        np.minimum(minima, np.multiply.outer(factors, values[start : start + (1 << 14)]).min(axis=1), out=minima)
    return _mixed(minima[::2] * _B + minima[1::2] + np.arange(bands, dtype=U)).view(np.int64).tolist()


_CHUNKS = 16


def _chunk_rows(counts: np.ndarray) -> tuple[list[int], list[bytes]]:
    parts = np.split(counts, _CHUNKS)
    return list(range(_CHUNKS)), [zlib.compress(p.tobytes(), 1) for p in parts]


def _summed(counted: DataFrame, size: int) -> np.ndarray:
    """Counters summed over tasks: by chunk and group of tasks, then by chunk; the driver gets ``size`` counters."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(size // _CHUNKS, dtype=np.int64)
        for blob in table.column("counts"):
            total += np.frombuffer(zlib.decompress(blob.as_py()), dtype=np.int64)
        kept = {c: table.column(c).slice(0, 1) for c in table.column_names if c != "counts"}
        return pa.table(kept | {"counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    spread = counted.select("chunk", (F.spark_partition_id() % 64).alias("part"), "counts")
    some = spread.groupBy("chunk", "part").applyInArrow(add, "chunk int, part int, counts binary")
    rows = some.select("chunk", "counts").groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect()
    total = np.zeros(size, dtype=np.int64)
    for row in rows:
        part = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.int64)
        total[row["chunk"] * len(part) : (row["chunk"] + 1) * len(part)] = part
    return total


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _profile(docs: DataFrame, settings: Settings) -> DataFrame:
    """A row a document: size, signature and bands of its set; and rows that count shingles by bucket, one set a task.

    ``row`` is a hash that tells rows apart, but not repeated ones.
    """
    shift = U(64 - settings.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names = np.zeros(1 << settings.bits, dtype=np.int64), ["doc_id", "row", "n", "sig", "bands", "chunk", "counts"]
        for batch in batches:
            n, sigs, bands = [], [], []
            for text in batch.column(1):
                values = shingle_set(text.as_py(), settings.words)
                n.append(len(values))
                sigs.append(_signature(values))
                bands.append(_bands(values, settings.bands) if len(values) else None)
                np.add.at(counts, values >> shift, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(n, pa.int64()),
                    pa.array(sigs, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.nulls(len(n), pa.int32()),
                    pa.nulls(len(n), pa.binary()),
                ],
                names=names,
            )
        chunks, blobs = _chunk_rows(counts)
        empty = [pa.nulls(len(chunks), kind) for kind in (*[pa.int64()] * 4, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(chunks, pa.int32()), pa.array(blobs, pa.binary())], names=names)

    rows = _texts(docs).withColumn("row", _row_key())
    return map_arrow(rows, run, "doc_id bigint, row bigint, n bigint, sig bigint, bands array<bigint>, chunk int, counts binary")


def _order(counts: np.ndarray) -> np.ndarray:
    """Frequency class of a bucket, one byte: eight classes to a doubling."""
    return np.minimum(255, 8 * np.log2(1 + counts)).astype(np.uint8)


def _hot_class(hot: int) -> int:
    return int(min(255, 8 * np.log2(1 + hot)))


def _keys(values: np.ndarray, order: np.ndarray, bits: int) -> np.ndarray:
    """A set in the global order, rare shingles first: frequency class in the first byte, then the hash."""
    keys = (order[values >> U(64 - bits)].astype(U) << U(56)) | ((values << U(8)) >> U(8))
    keys.sort()
    return keys


def _place(sig: np.ndarray, doc: np.ndarray, bits: int) -> np.ndarray:
    return _mixed(sig.astype(np.int64).view(U) * _A + doc.astype(np.int64).view(U)) >> U(64 - bits)


def _marked(nodes: DataFrame, bits: int) -> np.ndarray:
    """A filter of fixed size that holds all of ``nodes`` (``sig``, ``doc``) and few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            counts[_place(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits)] = 1
        chunks, blobs = _chunk_rows(counts)
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(blobs, pa.binary())], names=["chunk", "counts"])

    return _summed(map_arrow(nodes.select("sig", "doc"), run, "chunk int, counts binary"), 1 << bits) > 0


def _sets(docs: DataFrame, nodes: DataFrame, order, settings: Settings) -> DataFrame:
    """``sig``, ``n``, ``doc`` and the ordered set of the documents that stand for ``nodes`` (and a few others)."""
    marked = docs.sparkSession.sparkContext.broadcast(_marked(nodes, settings.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = shingle_set(text.as_py(), settings.words)
                sig, doc = _signature(values), _NULL_ID if doc is None else doc
                if marked.value[_place(np.array([sig]), np.array([doc]), settings.bits)[0]]:
                    for column, value in zip(out, (sig, len(values), doc, _keys(values, order.value, settings.bits).tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["sig", "n", "doc", "keys"],
            )

    return map_arrow(_texts(docs), run, "sig bigint, n bigint, doc bigint, keys binary")


def _present(anchor: np.ndarray, part: np.ndarray) -> int:
    at = np.searchsorted(anchor, part)
    return int(np.count_nonzero(anchor[np.minimum(at, len(anchor) - 1)] == part))


_STEP = 128


class PrefixTree:
    """Ordered sets as the paths of a prefix tree, held as a sorted list: a subtree is a range that shares its first keys."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.paths = [sets[i] for i in self.order]
        self.sizes = np.array([len(p) for p in self.paths], dtype=np.int64)

    def linked(self, probe: np.ndarray, first_only: bool = False) -> list[int]:
        """Numbers of the sets that link to ``probe``, or of one of them.

        The overlap of a shared stretch is counted once for its subtree; a subtree is left as soon as what its sets and
        the probe still have after this place can't make up the overlap that any of its sizes needs.
        """
        paths, sizes, need = self.paths, self.sizes, needed(len(probe), self.sizes)
        found, stack = [], [(0, len(paths), 0, 0)] if paths else []
        while stack and not (found and first_only):
            low, high, depth, overlap = stack.pop()
            first, last = paths[low], paths[high - 1]
            end = min(len(first), len(last))
            if high - low > 1:
                differ = np.flatnonzero(first[depth:end] != last[depth:end])
                end = depth + int(differ[0]) if len(differ) else end
            while True:
                rest = len(probe) - (int(np.searchsorted(probe, first[depth - 1], "right")) if depth else 0)
                if not np.any(overlap + np.minimum(sizes[low:high] - depth, rest) >= need[low:high]):
                    break
                if depth == end:
                    start = low
                    while start < high and sizes[start] == depth:
                        if overlap >= need[start]:
                            found.append(self.order[start])
                        start += 1
                    while start < high:
                        stop, key = start + 1, paths[start][depth]
                        while stop < high and paths[stop][depth] == key:
                            stop += 1
                        stack.append((start, stop, depth, overlap))
                        start = stop
                    break
                step = min(depth + _STEP, end)
                overlap += _present(probe, first[depth:step])
                depth = step
        return found[:1] if first_only else found


def _node(prefix: str = "") -> Column:
    """A distinct set: its signature, its size, and the document that stands for it."""
    return F.struct(*(F.col(prefix + c).alias(c) for c in ("sig", "n", "doc")))


_GROUP = ["x", "y", "z"]
_PAIR = ["a_sig", "a_n", "a_doc", "b_sig", "b_n", "b_doc"]


def _verified(docs: DataFrame, groups: DataFrame, first_only: bool, order, settings: Settings) -> DataFrame:
    """Links ``a``, ``b`` within groups: of every probe with all members of its group, or with one of them.

    ``groups`` has the group (``x``, ``y``, ``z``), the ``node`` and whether it is a ``probe``.  Groups hold few members, which
    become a prefix tree; probes pass by one at a time.  Sets are made anew from the texts of the nodes concerned.
    """
    groups = staged(groups)
    sets = _sets(docs, groups.select("node.sig", "node.doc"), order, settings)
    rows = groups.select(*_GROUP, "probe", "node.*").join(sets, ["sig", "n", "doc"]).select(*_GROUP, "probe", "sig", "n", "doc", "keys")
    rows = rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "probe")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, sets, tree = None, [], [], None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            out = []
            for key, probe, node, packed in zip(zip(*columns[:3]), columns[3], zip(*columns[4:7]), batch.column(7)):
                if key != group:
                    group, nodes, sets, tree = key, [], [], None
                values = np.frombuffer(packed.as_py(), dtype=U)
                if not probe:
                    nodes.append(node)
                    sets.append(values)
                    continue
                tree = tree or PrefixTree(sets)
                out += [(*nodes[i], *node) for i in tree.linked(values, first_only)]
            made = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=_PAIR)

    found = map_arrow(rows, run, ", ".join(f"{c} bigint" for c in _PAIR))
    return staged(found.select(_node("a_").alias("a"), _node("b_").alias("b")).distinct())


def _dealt(number: Column, each: int) -> Column:
    """Parts that so many rows are dealt into."""
    return F.greatest(F.ceil(number / each), F.lit(1))


def _early_groups(nodes: DataFrame, settings: Settings) -> DataFrame:
    """Groups that share a band, as stars: the members are held against one of them, not against each other.

    Each band's group has a centre of its own, so that a node is held against several.  A centre's partners are dealt into groups.
    """
    bands = F.array(*(F.col(f"band{i}") for i in range(settings.bands)))
    banded = nodes.select(_node().alias("a"), F.explode(bands).alias("band"))
    centre = F.min_by("a", F.xxhash64("band", "a")).alias("b")
    first = banded.groupBy("band").agg(centre, F.count("*").alias("_members")).where("_members > 1").select("band", "b")
    pairs = staged(banded.join(first, "band").where(F.col("a") != F.col("b")).select("a", "b").distinct())
    load = pairs.groupBy("b").agg(F.count("*").alias("load")).select("b", _dealt(F.col("load"), settings.members).alias("parts"))
    part = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    partners = pairs.join(load, "b").select(F.col("b.sig").alias("x"), F.col("b.n").alias("y"), part.alias("z"), F.lit(0).alias("probe"), F.col("a").alias("node"))
    parts = F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int")))
    centres = load.select(F.col("b.sig").alias("x"), F.col("b.n").alias("y"), parts.alias("z"), F.lit(1).alias("probe"), F.col("b").alias("node"))
    return partners.unionByName(centres)


def _prefixes(docs: DataFrame, order, settings: Settings) -> DataFrame:
    """``sig``, ``n`` and the first keys of each set: sets that link share a key among these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task need no second row
        for batch in batches:
            sigs, sizes, firsts = [], [], []
            for text in batch.column(1):
                values = shingle_set(text.as_py(), settings.words)
                sig = _signature(values)
                if not len(values) or sig in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add(sig)
                keys = _keys(values, order.value, settings.bits)
                sigs.append(sig)
                sizes.append(len(keys))
                firsts.append(keys[: len(keys) - (3 * len(keys) + 3) // 4 + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs, pa.int64()), pa.array(sizes, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
                names=["sig", "n", "firsts"],
            )

    return map_arrow(_texts(docs), run, "sig bigint, n bigint, firsts array<bigint>")


def _late_groups(docs: DataFrame, nodes: DataFrame, labels: DataFrame, order, settings: Settings) -> DataFrame:
    """Members of components, and as probes the nodes of others that share a prefix key with one of them.

    A key that few documents have is seen by one task.  Hot ones, known from the counters, pass untested and are
    tested by minima that are taken before rows move.  Of two components the nodes of the smaller are held against all of the larger
    one, dealt into groups: a large one is not multiplied by its neighbours.
    """
    rows = _prefixes(docs, order, settings).join(labels, ["sig", "n"], "left")
    rows = rows.select("sig", "n", F.coalesce("label", "sig").alias("label"), F.posexplode("firsts").alias("pos", "key"))
    hot = F.shiftrightunsigned("key", 56) >= _hot_class(settings.hot)
    rows = rows.select("*", F.when(hot, F.pmod(F.xxhash64("sig"), settings.salts) + 1).otherwise(0).alias("salt"))
    group = Window.partitionBy("key", "salt")
    rows = rows.select("*", F.min("label").over(group).alias("_low"), F.max("label").over(group).alias("_high"))
    rows = staged(rows.where((F.col("salt") > 0) | (F.col("_low") != F.col("_high"))).select("key", "sig", "n", "label", "pos").distinct())
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    rows = rows.join(sizes, "label", "left").withColumn("rank", F.struct(F.coalesce("size", F.lit(1)).alias("size"), "label"))
    left = F.col("n") - F.col("pos")  # keys from this one on: all that is common, if this is the first common key
    larger = rows.groupBy("key", F.col("rank").alias("rank2")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(left).alias("left2"))
    several = larger.groupBy("key").agg(F.min("rank2").alias("_low"), F.max("rank2").alias("_high"))
    several = several.where(F.col("_low") != F.col("_high")).select("key")
    pairs = rows.join(several, "key", "left_semi").join(larger, "key").where(
        (F.col("rank") < F.col("rank2"))
        & (4 * F.col("high") >= 3 * F.col("n"))
        & (4 * F.col("n") >= 3 * F.col("low"))
        & (7 * F.least(left, F.col("left2")) >= 3 * (F.col("n") + F.greatest("low", F.ceil(0.75 * F.col("n")))))
    )
    pairs = staged(pairs.select("sig", "n", F.col("rank2.label").alias("label"), F.col("rank2.size").alias("size")).distinct())
    load = pairs.groupBy("label", "size").agg(F.count("*").alias("load")).select(
        "label", _dealt(F.col("size"), settings.members).alias("blocks"), _dealt(F.col("load"), settings.probes).alias("parts")
    )
    each = lambda number, kind: F.explode(F.transform(F.sequence(F.lit(1), F.col(number)), lambda i: (i - 1).cast(kind)))
    grouped = nodes.join(labels, ["sig", "n"], "left").select(_node().alias("node"), F.coalesce("label", "sig").alias("label"))
    members = grouped.join(load, "label").select(
        F.col("label").alias("x"), F.pmod(F.xxhash64("node"), F.col("blocks")).alias("y"), each("parts", "int").alias("z"), F.lit(0).alias("probe"), "node"
    )
    probes = pairs.join(nodes.select("sig", "n", "doc"), ["sig", "n"]).join(load, "label").select(
        F.col("label").alias("x"), F.col("blocks"), F.pmod(F.xxhash64("sig", "n"), F.col("parts")).cast("int").alias("z"), F.lit(1).alias("probe"), _node().alias("node")
    )
    probes = probes.select("x", each("blocks", "bigint").alias("y"), "z", "probe", "node")
    return members.unionByName(probes)


def ngram_join(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest ``doc_id`` reachable by links) of every row.

    Documents link at 100 * overlap >= 75 * union of their sets of distinct shingles.  Equal sets are one node, so that copies
    cost one row each.  Shingles are ordered by frequency, counted over all documents.  First, groups that agree in two minima are
    checked against one of their members and joined; then every pair that shares a key of its prefixes and isn't joined yet is
    checked: a pair that links does, so none is lost.  Both check in a prefix tree.

    Null or empty texts and those without words have size 0, link with nothing and keep their own ``doc_id``; texts of fewer
    words have one shingle.  Repeated rows are copies of each other; a null ``doc_id`` is reached but never the smallest unless
    it is alone, when the component is null.  An empty table gives no rows; other columns are not read.
    """
    rows, ids = _grouped(docs, settings)
    least = ids.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = ids.join(least, "root").select("sig", "n", "component_id")
    some = rows.where("n > 0").join(ids, ["sig", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` but for all of each component except the one with the smallest ``doc_id`` (nulls last).

    Rows without words stay, repeated rows of the one that stays don't.  Rows to drop are joined away by a hash of id and text; only
    rows that repeat are compared whole.
    """
    rows, ids = _grouped(docs, settings)
    full = rows.where("n > 0")
    members = full.join(ids.select("sig", "n", "root"), ["sig", "n"])
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    first = members.groupBy("root").agg(F.min(order).alias("_first")).select("root", F.col("_first.row").alias("_kept"))
    dropped = members.join(first, "root").where(F.col("row") != F.col("_kept")).select(F.col("row").alias("_dropped")).distinct()
    repeated = full.groupBy("row").agg(F.count("*").alias("_times")).where("_times > 1").select(F.col("row").alias("_repeated"))
    names = docs.columns
    kept = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), _row_key().alias("_key"))
    kept = kept.join(dropped, F.col("_key") == F.col("_dropped"), "left_anti")
    same = F.col("_key") == F.col("_repeated")
    single = kept.join(repeated, same, "left_anti").select("_row.*")
    return single.unionByName(kept.join(repeated, same, "left_semi").dropDuplicates(["_key"]).select("_row.*"))


def _labels(joined: DataFrame) -> DataFrame:
    """``label``, the root's signature, of all nodes that are joined to others."""
    label = F.col("root.sig").alias("label")
    ends = joined.select("node", label).unionByName(joined.select(F.col("root").alias("node"), label).distinct())
    return ends.select("node.sig", "node.n", "label")


def _grouped(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """A row a document (``doc_id``, ``row``, ``n``, ``sig``), and of every set its component's ``root`` and ``first`` id."""
    context = docs.sparkSession.sparkContext
    profile = staged(_profile(docs, settings))
    order = context.broadcast(_order(_summed(profile.where("chunk is not null").select("chunk", "counts"), 1 << settings.bits)))
    rows = profile.where("chunk is null").select("doc_id", "row", "n", "sig", "bands")
    nodes = rows.where("n > 0").groupBy("sig", "n")
    nodes = staged(
        nodes.agg(
            F.min(F.coalesce("doc_id", F.lit(_NULL_ID))).alias("doc"),
            F.min("doc_id").alias("first"),
            # Equal sets have equal bands, whose minima need no sort as arrays would.
            *(F.min(F.col("bands")[i]).alias(f"band{i}") for i in range(settings.bands)),
        )
    )
    joined = components(_verified(docs, _early_groups(nodes, settings), False, order, settings))
    late = _verified(docs, _late_groups(docs, nodes, _labels(joined), order, settings), True, order, settings)
    if not late.isEmpty():
        joined = components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(late))
    roots = joined.select("node.sig", "node.n", "root")
    ids = nodes.join(roots, ["sig", "n"], "left").select("sig", "n", "first", F.coalesce("root", _node()).alias("root"))
    return rows.select("doc_id", "row", "n", "sig"), ids

"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspan.llm.common import held_out, map_arrow

#: Label of a text without letters.
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
#: Fixed odd multipliers and shift of the n-gram hash.
_STEP, _MIX = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Settings:
    """``orders``: n-gram lengths; ``bits``: log2 of the buckets; ``sample``: labelled rows learned from at most."""

    orders: tuple[int, ...] = (1, 2, 3)
    bits: int = 16
    smoothing: float = 0.5
    sample: int = 50_000
    piece: int = 1 << 16
    evidence: int = 50


@dataclass(frozen=True)
class Model:
    """``logs``: buckets by languages, the log probability of a bucket in a language; its size is fixed."""

    langs: tuple[str, ...]
    logs: np.ndarray
    prior: np.ndarray
    settings: Settings


def buckets(text: str, settings: Settings) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a lower-cased text, a piece at a time; pieces overlap so that none is lost or doubled."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    shift = np.uint32(32 - settings.bits)
    for order in settings.orders:
        n = len(points) - order + 1
        for start in range(0, max(n, 0), settings.piece):
            stop = min(start + settings.piece, n)
            value = np.full(stop - start, order, dtype=np.uint32)
            for k in range(order):
                value = (value ^ points[start + k : stop + k]) * _STEP * _MIX
                value ^= value >> np.uint32(15)
            yield (value * _MIX) >> shift


def learn(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Counts n-grams by language over a bounded sample of the rows with a language that aren't held out.

    The sample (``settings.sample`` rows with the smallest hashes of text and id, so that it doesn't depend on the layout)
    bounds the work, not what is scored.  Each task sums its rows into sparse counts by language, Spark adds them up,
    and the driver gets a table of languages by buckets.  Rows without text or language teach nothing; without
    any row the model knows no language and every text is undetermined.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("pick"))
    total = rows.count()
    if total > settings.sample:
        edge = int((settings.sample / total) * 2**64) - 2**63
        rows = rows.where(F.col("pick") < edge)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = sums.setdefault(lang, np.zeros(1 << settings.bits, dtype=np.int64))
                seen[lang] = seen.get(lang, 0) + 1
                for part in buckets(text.as_py(), settings):
                    held += np.bincount(part, minlength=len(held))
        for lang, held in sums.items():
            at = np.flatnonzero(held)
            keys = np.append(at, -1)  # bucket -1 holds the number of texts
            values = np.append(held[at], seen[lang])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int32()), pa.array(values, pa.int64())],
                names=["lang", "bucket", "n"],
            )

    counted = (
        map_arrow(rows.select("lang", "text"), count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    ).toArrow()
    names, keys, values = (counted.column(i) for i in range(3))
    langs = tuple(sorted(set(names.to_pylist())))
    table, texts = np.full((1 << settings.bits, len(langs)), settings.smoothing), np.zeros(len(langs))
    where = np.searchsorted(np.array(langs, dtype=object), np.array(names.to_pylist(), dtype=object)) if langs else np.empty(0, int)
    keys, values = keys.to_numpy(), values.to_numpy()
    real = keys >= 0
    np.add.at(table, (keys[real], where[real]), values[real])
    np.add.at(texts, where[~real], values[~real])
    logs = np.log(table / table.sum(axis=0)) if langs else table
    prior = np.log(texts / texts.sum()) if langs else texts
    return Model(langs, logs.astype(np.float32), prior, settings)


def classify(model: Model, text: str | None) -> tuple[str, float]:
    """The language with the highest posterior; und and 0 for a null text, one without a letter, or an empty model.

    The score is the posterior with the evidence counted as ``settings.evidence`` n-grams at most: n-grams overlap, and
    the plain posterior of any longer text is 1.
    """
    if not model.langs or not text or not _LETTER.search(text):
        return UNDETERMINED, 0.0
    total, n = np.zeros(len(model.langs)), 0
    for part in buckets(text, model.settings):
        counts = np.bincount(part, minlength=1 << model.settings.bits) if len(part) > 1 << model.settings.bits else None
        total += counts @ model.logs if counts is not None else model.logs[part].sum(axis=0, dtype=np.float64)
        n += len(part)
    best = int(np.argmax(total + model.prior))
    total = total * (min(n, model.settings.evidence) / n) + model.prior
    weight = np.exp(total - total.max())
    return model.langs[best], float(weight[best] / weight.sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (0 to 1) for every row of ``docs``.

    The model's table has a fixed size (buckets by languages) and is broadcast.  A null text, or one without a letter, is
    ``und`` with score 0; equal scores go to the language first in order; repeated rows give repeated results; a null ``doc_id``
    counts as held out.  Only ``doc_id`` and ``text`` are read.
    """
    rows = docs.select(
        F.col("text").cast("string").alias("text"), F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out")
    )
    return _with_language(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows whose language is told with a score of ``least`` or more, with it in ``lang``; other columns as they are.

    Texts go by once: rows aren't joined back.
    """
    numbered = docs.select(F.col("text").cast("string"), F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))).toDF("text", "others")
    found = _with_language(numbered, model).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    named = {"text": F.col("text"), "lang": F.col("lang_pred")}
    return found.select(*((named[c] if c in named else F.col("others")[c]).alias(c) for c in docs.columns))


def _with_language(rows: DataFrame, model: Model) -> DataFrame:
    """``rows``, whose first column is the text, with ``lang_pred`` and ``score``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [classify(shared.value, text.as_py()) for text in batch.column(0)]
            added = [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_arrow(rows, run, schema)

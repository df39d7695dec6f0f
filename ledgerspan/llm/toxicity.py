"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspan.llm.common import held_out, map_arrow

_WORD = regex.compile(r"\p{L}+")
#: Texts are read in pieces of so many code points, cut at a character that isn't a letter.
_PIECE = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``examples``: labelled rows learned from at most (in expectation); they bound the vocabulary and the index.

    A term is a whole word or a word's first letters (``stems`` of them), or either found so many times (``repeats``): the cosine
    alone can't tell a lone mention from many.  Terms are taken whose presence goes with the label, by a chi-square of
    ``least_chi`` or more in ``least_df`` examples or more, and that are ``least_lift`` times as frequent with one label as with the other.  ``neighbours`` vote by the ``power`` of their cosine; ``prior`` is the
    weight of the rate of labels among them.
    """

    examples: int = 20_000
    stems: tuple[int, ...] = (4, 5, 6)
    repeats: tuple[int, ...] = (2, 4)
    least_chi: float = 20.0
    least_lift: float = 3.0
    least_df: int = 3
    neighbours: int = 8
    power: int = 4
    block: int = 4096
    prior: float = 0.1
    threshold: float = 0.7


@dataclass(frozen=True)
class Index:
    """Postings by term, in order of example; ``starts``: where a term's postings of a block begin.

    ``most`` holds the largest weight of each term in each block: with it a block's best cosine is bounded without reading it.
    Equal examples are one entry with their number and the share of them that is toxic.
    """

    examples: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    most: np.ndarray
    toxic: np.ndarray
    doc: np.ndarray
    count: np.ndarray
    block: int

    @classmethod
    def build(
        cls,
        vectors: Sequence[tuple[np.ndarray, np.ndarray]],
        toxic: Sequence[float],
        doc: Sequence[int],
        terms: int,
        block: int,
        count: Sequence[int] | None = None,
    ) -> Index:
        n = len(vectors)
        blocks = -(-n // block)
        sizes = [len(ids) for ids, _ in vectors]
        term = np.concatenate([np.empty(0, np.int64), *(ids for ids, _ in vectors)]).astype(np.int64)
        weight = np.concatenate([np.empty(0), *(w for _, w in vectors)])
        example = np.repeat(np.arange(n), sizes)
        order = np.lexsort((example, term))
        term, weight, example = term[order], weight[order], example[order]
        edges = np.arange(blocks + 1) * block
        key = term * (blocks * block + 1) + example
        starts = np.searchsorted(key, (np.arange(terms) * (blocks * block + 1))[:, None] + edges[None, :])
        most = np.zeros((terms, max(blocks, 1)))
        np.maximum.at(most, (term, example // block), weight)
        return cls(example, weight, starts, most, np.asarray(toxic, float), np.asarray(doc, np.int64), np.asarray([1] * n if count is None else count, np.int64), block)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The entries that hold the ``k`` examples with the highest cosines above 0, ties in order of entry; exactly as a full scan finds them."""
        bound = weights @ self.most[ids]
        best, score, held = np.empty(0, np.int64), np.empty(0), 0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (held >= k and bound[b] < score[-1] - 1e-12):
                break
            exact = np.zeros(self.block)
            for t, w in zip(ids, weights):
                low, high = self.starts[t, b], self.starts[t, b + 1]
                exact[self.examples[low:high] - b * self.block] += w * self.weights[low:high]
            hits = np.flatnonzero(exact)
            best, score = np.concatenate([best, hits + b * self.block]), np.concatenate([score, exact[hits]])
            kept = np.lexsort((best, -score))[:k]
            sums = np.cumsum(self.count[best[kept]])
            kept = kept[: np.searchsorted(sums, k) + 1]
            best, score, held = best[kept], score[kept], sums[len(kept) - 1] if len(kept) else 0
        return best, score


@dataclass(frozen=True)
class Model:
    """A vocabulary, inverse document frequencies over all documents, and an index of bounded size."""

    terms: tuple[str, ...]
    idf: np.ndarray
    index: Index
    rate: float
    rate_of_none: float
    settings: Settings = field(default_factory=Settings)


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        end = start + _PIECE
        while end < len(text) and text[end].isalpha():
            end += 1
        yield text[start:end]
        start = end


def _leveled(counts: Counter[str], repeats: tuple[int, ...]) -> Iterator[str]:
    """The terms, and those found often enough once more with that number."""
    for term, n in counts.items():
        yield term
        yield from (f"{term}{least}" for least in repeats if n >= least)


def _terms_of(text: str, settings: Settings) -> set[str]:
    """All terms of a text.  Whole words end in a blank, stems don't."""
    words = Counter(w for piece in _pieces(text) for w in _WORD.findall(piece.lower()))
    found: Counter[str] = Counter()
    for w, n in words.items():
        found[w + " "] += n
        for k in settings.stems:
            if len(w) >= k:
                found[w[:k]] += n
    return set(_leveled(found, settings.repeats))


class Matcher:
    """Finds the vocabulary's terms at word beginnings with one automaton over the text."""

    def __init__(self, terms: Sequence[str], repeats: tuple[int, ...]):
        self.number, self.repeats = {t: i for i, t in enumerate(terms)}, repeats
        self.plain = {t.rstrip("0123456789") for t in terms}
        self.automaton = ahocorasick.Automaton()
        for bare in {t.rstrip() for t in self.plain}:
            self.automaton.add_word(bare, bare)
        if terms:
            self.automaton.make_automaton()

    def counts(self, text: str) -> Counter[int]:
        """By term number how often it is found; terms with a number of times count once."""
        found: Counter[str] = Counter()
        for piece in _pieces(text) if self.plain else ():
            lower = piece.lower()
            for end, bare in self.automaton.iter(lower):
                before = end - len(bare)
                if before >= 0 and lower[before].isalpha():
                    continue
                if bare in self.plain:
                    found[bare] += 1
                if bare + " " in self.plain and not (end + 1 < len(lower) and lower[end + 1].isalpha()):
                    found[bare + " "] += 1
        known = ((self.number.get(t), found.get(t, 1)) for t in _leveled(found, self.repeats))
        return Counter({number: n for number, n in known if number is not None})


@functools.lru_cache(maxsize=4)
def _matcher(terms: tuple[str, ...], repeats: tuple[int, ...]) -> Matcher:
    return Matcher(terms, repeats)


def vector(counts: Counter[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers in order, and their TF-IDF weights (1 + log of the count) at length 1."""
    ids = np.array(sorted(counts), dtype=np.int64)
    weights = np.array([1 + np.log(counts[i]) for i in ids.tolist()]) * idf[ids] if len(ids) else np.empty(0)
    length = np.sqrt((weights**2).sum())
    return (ids, weights / length) if length > 0 else (ids[:0], weights[:0])


def _choose(texts: DataFrame, settings: Settings) -> list[str]:
    """All terms that go with the label among the examples, strongest first; the bounded examples bound their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter(), Counter()
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[toxic].update(_terms_of(text.as_py() or "", settings))
                seen[toxic][""] += 1
        for toxic, terms in enumerate(seen):
            items = list(terms.items())
            for start in range(0, len(items), 1 << 16):
                part = items[start : start + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in part], pa.string()), pa.array([toxic] * len(part), pa.int32()), pa.array([n for _, n in part], pa.int64())],
                    names=["term", "toxic", "n"],
                )

    counted = map_arrow(texts.select("toxic", "text"), count, "term string, toxic int, n bigint").groupBy("term")
    counted = counted.agg(F.sum(F.col("n") * F.col("toxic")).alias("a"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("b"))
    often = counted.where((F.col("term") == "") | (F.col("a") + F.col("b") >= settings.least_df))
    totals = often.where("term = ''").first()
    if totals is None or not totals["a"] or not totals["b"]:
        return []
    pos, neg = float(totals["a"]), float(totals["b"])
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    chi = (pos + neg) * F.pow(a * (neg - b) - b * (pos - a), F.lit(2)) / ((a + b) * (pos + neg - a - b) * pos * neg)
    lift = (a + 0.5) / (b + 0.5) * ((neg + 1) / (pos + 1))
    often = often.where((F.col("term") != "") & (a + b < pos + neg) & (F.greatest(lift, 1 / lift) >= settings.least_lift))
    ranked = often.select("term", chi.alias("chi")).where(F.col("chi") >= settings.least_chi)
    return [r["term"] for r in ranked.orderBy(F.desc("chi"), "term").collect()]


def _document_frequencies(docs: DataFrame, terms: tuple[str, ...], repeats: tuple[int, ...]) -> tuple[int, np.ndarray]:
    """Over all documents: their number and how many hold each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            seen[-1] += batch.num_rows
            for text in batch.column(0):
                seen.update(_matcher(terms, repeats).counts(text.as_py() or "").keys())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    counted = map_arrow(docs.select(F.col("text").cast("string").alias("text")), count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    df, total = np.zeros(len(terms)), 0
    for row in counted.collect():
        if row["term"] < 0:
            total = row["n"]
        else:
            df[row["term"]] = row["n"]
    return total, df


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Chooses the vocabulary and indexes examples from a bounded sample of labelled rows that aren't held out.

    The sample takes the rows with the smallest hashes of ``doc_id``, ``settings.examples`` of them in expectation, so that its ids can be
    broadcast and the index has a bounded size; document frequencies cover all documents.  A ``doc_id`` labelled both ways
    counts as toxic; null labels and ids teach nothing.  Without examples of both labels the model has no terms.
    """
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    total = known.count()
    if total > settings.examples:
        known = known.where(F.xxhash64("doc_id") < int(settings.examples / total * 2**64) - 2**63)
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = own.join(F.broadcast(known), "doc_id")
    terms = tuple(_choose(texts, settings))
    repeats = settings.repeats
    number, df = _document_frequencies(docs, terms, repeats)
    idf = np.log((1 + number) / (1 + df)) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(_matcher(terms, repeats).counts(text.as_py() or "").items()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([[i for i, _ in x] for x in found], pa.list_(pa.int32())),
                    pa.array([[n for _, n in x] for x in found], pa.list_(pa.int32())),
                ],
                names=["doc_id", "toxic", "terms", "counts"],
            )

    held = map_arrow(texts.select("doc_id", "toxic", "text"), count, "doc_id bigint, toxic int, terms array<int>, counts array<int>")
    same = held.groupBy("terms", "counts").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    rows = sorted(same.collect(), key=lambda r: (r["terms"], r["counts"]))
    full = [r for r in rows if r["terms"]]
    none = [r for r in rows if not r["terms"]]
    vectors = [vector(Counter(dict(zip(r["terms"], r["counts"]))), idf) for r in full]
    index = Index.build(vectors, [r["toxic"] / r["n"] for r in full], [r["doc_id"] for r in full], len(terms), settings.block, [r["n"] for r in full])
    toxic, n = sum(r["toxic"] for r in rows), sum(r["n"] for r in rows)
    rate = (toxic + 0.5) / (n + 1)
    rate_of_none = (sum(r["toxic"] for r in none) + 0.5) / (sum(r["n"] for r in none) + 1) if none else rate
    return Model(terms, idf, index, rate, rate_of_none, settings)


def vote(model: Model, text: str | None) -> tuple[float, list[int], list[float]]:
    """Score, and as evidence the example documents that voted with their cosines, nearest first.

    Each of the nearest examples votes, equal ones too; of equal ones one document is named, and where only some of them are among the
    nearest, they vote with the share of all.  Votes weigh by a power of the cosine; the rate of labels among all examples votes with ``settings.prior``.  A text without any term
    (or null or empty) has no neighbours and scores as the examples without terms do.
    """
    ids, weights = vector(_matcher(model.terms, model.settings.repeats).counts(text or ""), model.idf)
    if not len(ids):
        return model.rate_of_none, [], []
    best, score = model.index.nearest(ids, weights, model.settings.neighbours)
    count = model.index.count[best]
    voters = np.minimum(count, model.settings.neighbours - (np.cumsum(count) - count))
    prior, votes = model.settings.prior, voters * score**model.settings.power
    value = (votes @ model.index.toxic[best] + prior * model.rate) / (votes.sum() + prior)
    return float(min(max(value, 0.0), 1.0)), model.index.doc[best].tolist(), score.tolist()


def score(docs: DataFrame, model: Model, evidence: int = 3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``evidence`` (nearest examples, their cosines) of every row.

    Rows are independent: repeated ones give repeated results, a null ``doc_id`` stays and counts as held out, other
    columns are not read.  The model has a bounded size and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vote(shared.value, text.as_py()) for text in batch.column(2)]
            scores = [x[0] for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(x >= shared.value.settings.threshold) for x in scores], pa.int32()),
                    pa.array([x[1][:evidence] for x in found], pa.list_(pa.int64())),
                    pa.array([x[2][:evidence] for x in found], pa.list_(pa.float64())),
                ],
                names=["doc_id", "held_out", "score", "predicted", "evidence", "cosines"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return map_arrow(rows, run, "doc_id bigint, held_out boolean, score double, predicted int, evidence array<bigint>, cosines array<double>")

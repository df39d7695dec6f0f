"""Packing documents into training sequences by order-preserving dynamic programming."""

from __future__ import annotations

import json
import re
from array import array
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerspan.llm.common import map_arrow
from ledgerspan.llm.splitting import pieces

#: Tokens of a sequence, and the id that ends each document.
WINDOW, END_ID = 1024, 0
#: What a cut costs, in tokens of padding: at the end of a sentence, and inside one.
SENTENCE, INSIDE = 4, 16
#: Of sentences that end within so many tokens the last end counts: short ones go with the next.
SPACING = 16
#: Sequences filled to the brim, across sentences, that may precede a cut at a boundary.
BRIMS = 2
#: Sequences planned together, and how many of them are planned again with what follows.
HORIZON, AGAIN = 1024, 16
# What a token does at the end of a sentence, as bits: the first two are compared after a shift.
_CLOSES, _OPENS, _BREAKS = 1, 2, 4
#: More than any cost.
_FAR = 1 << 62
#: Bytes of ids sent to Spark at a time.
_BATCH = 1 << 22

# The pattern that byte-level tokenizers split text by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The byte behind each character of a byte-level vocabulary: printable ones are themselves, the others follow from 256 on.
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


def read_tokenizer(path: str) -> str:
    """A tokenizer file's content.  A vocabulary is some megabytes whatever the corpus, so that it can be broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _bytes_of(token: str) -> bytes:
    """The bytes that a byte-level vocabulary writes as printable characters."""
    return bytes(_BYTE_OF[c] for c in token)


def ranks_of(spec: dict) -> dict[bytes, int] | None:
    """Tokens by rank where ranks say all: plain byte-level splitting, and merges in the order of the ids they make."""
    split, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not spec.get("normalizer")
    if not plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return None
    vocabulary = model["vocab"]
    merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in merges]
    single = [vocabulary[c] for c in _BYTE_OF if c in vocabulary]
    if len(single) < 256 or made != sorted(made) or made[0] <= max(single):
        return None
    special = {token["content"] for token in spec.get("added_tokens", ())}
    return {_bytes_of(token): i for token, i in vocabulary.items() if token not in special}


class Encoder:
    """Token ids as the library ``tokenizers`` gives them, special tokens' strings being ordinary text.

    Where the file's merges are in the order of their ids, as those of byte-level vocabularies are, joining the pair of the
    least rank is the same as the first merge, and the encoder for ranks is four times as fast; other files go through
    the library itself.  Long texts are encoded a piece at a time, cut where no match can run across.
    """

    def __init__(self, content: str):
        spec = json.loads(content)
        self.library = Tokenizer.from_str(content)
        self.library.encode_special_tokens = True
        ranks = ranks_of(spec)
        self.by_rank = ranks and tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        raw = [self.library.decode([i]) for i in range(self.library.get_vocab_size())]
        #: Tokens after which a sentence ends if the next one opens with white space; line ends always do.
        kinds = [
            _CLOSES * bool(re.search(r"[.!?。！？]['\")\]»”’]*$", token)) + _OPENS * token[:1].isspace() + _BREAKS * ("\n" in token)
            for token in raw
        ]
        self.kinds = np.array(kinds, np.uint8)

    def ids(self, text: str) -> np.ndarray:
        if not self.by_rank:
            return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        found = array("I")
        for piece, single in pieces(text):
            found.extend(array("I", self.by_rank._encode_single_piece(piece) if single else self.by_rank.encode_ordinary(piece)))
        return np.frombuffer(found, "<u4")

    def sentence_ends(self, ids: np.ndarray, spacing: int = SPACING) -> np.ndarray:
        """Places inside a document where a sentence or line has ended, the last of each ``spacing`` tokens."""
        kinds = self.kinds[ids]
        left, right = kinds[:-1], kinds[1:]
        ends = np.flatnonzero((left & _CLOSES & (right >> 1)) | (left & ~right & _BREAKS)) + 1
        cells = ends // spacing
        last = np.ones(len(ends), bool)
        last[:-1] = cells[1:] != cells[:-1]
        return ends[last]


_ENCODERS: dict[int, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def with_brims(places: np.ndarray, penalties: np.ndarray, window: int, inside: int) -> tuple[list[int], list[int]]:
    """Boundaries with further places, a window apart, where none lies within a window."""
    before = np.concatenate([[0], places[:-1]])
    wide = np.flatnonzero(places - before > window)
    if not len(wide):
        return places.tolist(), penalties.tolist()
    extra = [np.arange(before[i] + window, places[i], window) for i in wide]
    places = np.concatenate([places, *extra])
    penalties = np.concatenate([penalties, np.full(sum(map(len, extra)), inside)])
    order = np.argsort(places, kind="stable")
    return places[order].tolist(), penalties[order].tolist()


def sequence_ends(
    places: Sequence[int], penalties: Sequence[int], window: int = WINDOW, inside: int = INSIDE, brims: int = BRIMS, last: bool = True
) -> list[int]:
    """Where sequences over the tokens 0 to ``places[-1]`` end, at the least sum of padding and cut penalties.

    ``places`` are ascending boundaries with the penalty of a cut there, at most a window apart.  The cost of reaching a boundary
    is the least over earlier ones of their cost plus the padding between, which is ``window`` less the distance: the
    minimum of cost plus place over a sliding window, kept in a monotone queue.  A further queue for each number of
    sequences filled to the brim before adds the cuts those make inside sentences.  Lengths that are powers of two need no
    padding and are looked up.  With ``last`` the final tokens may also be split into powers of two.
    """
    at = [0, *places]
    cost, back = [0] * len(at), [0] * len(at)
    level = [0] * len(at)  # cost plus place
    place = np.array(at)
    # Which boundaries lie a power of two before each one: few do, so that they are found for all at once.
    exact: dict[int, list[int]] = {}
    for power in (1 << k for k in range(window.bit_length() - 1)):
        before = np.searchsorted(place, place - power)
        for j in np.flatnonzero(place[before] == place - power).tolist():
            exact.setdefault(j, []).append(int(before[j]))
    # For each number of full sequences before: the queue and its first place, which boundaries may enter, and which still count.
    queues = []
    for full in range(brims + 1):
        enter = np.searchsorted(place, place - window * full).tolist()
        leave = np.searchsorted(place, place - window * (full + 1)).tolist()
        queues.append(([], enter, leave, window * (full + 1) + inside * full))
    heads, entered = [0] * len(queues), [0] * len(queues)
    numbered = list(enumerate(queues))
    for j in range(1, len(at)):
        here = at[j]
        best, best_from = _FAR, 0
        for number, (queue, enter, leave, extra) in numbered:
            until = enter[j]
            i = entered[number]
            if i < until:
                head = heads[number]
                while i < until:
                    value = level[i]
                    while len(queue) > head and level[queue[-1]] > value:
                        queue.pop()
                    queue.append(i)
                    i += 1
                entered[number] = i
            elif not queue:
                continue
            since = leave[j]
            head = heads[number]
            size = len(queue)
            while head < size and queue[head] < since:
                head += 1
            heads[number] = head
            if head < size:
                i = queue[head]
                total = level[i] + extra
                if total < best:
                    best, best_from = total, i
        best -= here
        for i in exact.get(j, ()):
            if cost[i] < best:
                best, best_from = cost[i], i
        cost[j], back[j] = best + penalties[j - 1], best_from
        level[j] = cost[j] + here
    split_from = None
    if last and len(at) > 1:
        end = at[-1]
        for i in range(len(at) - 2, -1, -1):
            if end - at[i] > window:
                break
            total = cost[i] + inside * ((end - at[i]).bit_count() - 1) + penalties[-1]
            if total < cost[-1]:
                cost[-1], back[-1], split_from = total, i, i
    ends: list[int] = []
    j = len(at) - 1
    while j:
        i = back[j]
        if j == len(at) - 1 and i == split_from:
            rest = end - at[i]
            steps = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
        else:
            steps = [window] * ((at[j] - at[i] - 1) // window)
        between = np.cumsum([at[i], *steps])[1:].tolist()
        ends.extend(reversed(between if between and between[-1] == at[j] else [*between, at[j]]))
        j = i
    return ends[::-1]


class _Packer:
    """Sequences of one stream of documents; holds the tokens of some hundred sequences, or of one long document."""

    def __init__(self, first_id: int, window: int, sentence: int, inside: int):
        self.next_id, self.window, self.sentence, self.inside = first_id, window, sentence, inside
        self.docs: deque[list] = deque()  # id, token ids, tokens packed before
        self.places, self.penalties = [np.empty(0, int)], [np.empty(0, int)]
        self.held = 0

    def add(self, doc_id, ids: np.ndarray, sentence_ends: np.ndarray) -> Iterator[tuple]:
        self.docs.append([doc_id, ids, 0])
        self.places += [sentence_ends + self.held, np.array([self.held + len(ids)])]
        self.penalties += [np.full(len(sentence_ends), self.sentence), np.zeros(1, int)]
        self.held += len(ids)
        if self.held > HORIZON * self.window:
            yield from self.flush(False)

    def flush(self, last: bool = True) -> Iterator[tuple]:
        if not self.held:
            return
        places, penalties = np.concatenate(self.places), np.concatenate(self.penalties)
        ends = sequence_ends(*with_brims(places, penalties, self.window, self.inside), self.window, self.inside, last=last)
        if not last:
            ends = ends[:-AGAIN]
        done = 0
        for end in ends:
            yield from self._sequence(end - done)
            done = end
        self.held -= done
        later = places > done
        self.places, self.penalties = [places[later] - done], [penalties[later]]

    def _sequence(self, size: int) -> Iterator[tuple]:
        offset = 0
        while offset < size:
            doc_id, ids, start = self.docs[0]
            length = min(len(ids) - start, size - offset)
            yield doc_id, start, length, len(ids), self.next_id, offset, ids[start : start + length].tobytes()
            offset += length
            self.docs[0][2] += length
            if start + length == len(ids):
                self.docs.popleft()
        self.next_id += 1


_SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())]
)


def pack(docs: DataFrame, spec: str, window: int = WINDOW, sentence: int = SENTENCE, inside: int = INSIDE) -> DataFrame:
    """Every token of ``docs`` in sequences of at most ``window``: one row for each piece of a document in a sequence.

    Columns: ``doc_id``, ``start`` (tokens of the document before the piece), ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` in
    the sequence, ``ids`` (little-endian 32-bit).  Documents keep the order in which Spark reads them; each task packs the rows
    of its own partition, so that nothing is shuffled, and its last sequence is split into powers of two where that costs less
    than padding.  Within a task some hundred sequences are planned at a time, the last of them again with what follows.
    Sequence ids count up from the partition's number times 2^40; reading the same files in the same splits gives them
    again after a lost executor.  A document ends with the id 0, so that a null or empty text is one token; a null ``doc_id``
    stays null, a repeated row is packed again, an empty table gives no rows.  Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        packer = _Packer(TaskContext.get().partitionId() << 40, window, sentence, inside)

        def found() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(END_ID))
                    yield from packer.add(doc_id, ids, encoder.sentence_ends(ids))
            yield from packer.flush()

        rows, size = [], 0
        for row in found():
            rows.append(row)
            size += len(row[-1]) + 64
            if size > _BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    return map_arrow(texts, run, names)

"""Greedy word-piece lengths by a linear longest-match automaton."""

from __future__ import annotations

import base64
from collections.abc import Collection, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspan.llm.common import map_arrow
from ledgerspan.llm.splitting import pieces

#: Words whose counts a worker remembers before it forgets them all, and the longest it remembers (memory, not result).
REMEMBERED, LONGEST = 1 << 19, 48


class Automaton:
    """A vocabulary trie with failure links; each node knows how many pieces are popped when its link is taken.

    ``initial`` pieces begin a word, ``continuing`` ones follow; the same vocabulary may serve as both.  A link
    leads from a node to what stands for the rest after the longest pieces of the node's string are taken,
    so that a word takes as many steps as it has bytes, however often the greedy match has to back up.
    """

    def __init__(self, initial: Collection[bytes], continuing: Collection[bytes] | None = None):
        self.next: list[dict[int, int]] = [{}]
        whole: list[bool] = [False]
        self.rest = 0
        for piece in initial:
            self._add(whole, 0, piece)
        if continuing is not None:
            self.rest = self._node(whole)
            for piece in continuing:
                self._add(whole, self.rest, piece)
        self.popped, self.fail = [0] * len(self.next), [-1] * len(self.next)
        level = list({0, self.rest})
        while level:
            below = []
            for node in level:
                for byte, child in self.next[node].items():
                    if whole[child]:
                        self.popped[child], self.fail[child] = 1, self.rest
                    else:
                        self._link(node, byte, child)
                    below.append(child)
            level = below

    def _node(self, whole: list[bool]) -> int:
        self.next.append({})
        whole.append(False)
        return len(self.next) - 1

    def _add(self, whole: list[bool], node: int, piece: bytes) -> None:
        for byte in piece:
            if byte not in self.next[node]:
                self.next[node][byte] = self._node(whole)
            node = self.next[node][byte]
        whole[node] = bool(piece)

    def _link(self, parent: int, byte: int, child: int) -> None:
        """The child's string isn't a piece: pop what the parent pops, then look for the byte from there."""
        count, node = self.popped[parent], self.fail[parent]
        while node >= 0 and byte not in self.next[node]:
            count, node = count + self.popped[node], self.fail[node]
        if node >= 0:
            self.popped[child], self.fail[child] = count, self.next[node][byte]

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 if some rest of it begins with no piece, as for an unknown word."""
        step, popped, fail, node, total = self.next, self.popped, self.fail, 0, 0
        for byte in word:
            while (child := step[node].get(byte)) is None:
                total, node = total + popped[node], fail[node]
                if node < 0:
                    return 1
            node = child
        while node != self.rest and node:
            total, node = total + popped[node], fail[node]
            if node < 0:
                return 1
        return total


class Counts(dict):
    """Remembered counts by word; a long word is counted each time."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        count = self.automaton.count(word.encode())
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = count
        return count


def rank_pieces(ranks: bytes) -> list[bytes]:
    """The byte strings of a rank file."""
    return [base64.b64decode(line.split()[0]) for line in ranks.splitlines() if line]


def token_counts(docs: DataFrame, vocabulary: Collection[bytes], pattern: str, continuing: Collection[bytes] | None = None) -> DataFrame:
    """Per document ``n_words`` (matches of ``pattern``) and ``n_tokens`` (greedy longest-match pieces of all words).

    The vocabulary doesn't grow with the corpus and is broadcast.  A null or empty text counts 0; repeated rows
    give repeated results, a null ``doc_id`` stays null, an empty table gives no rows.  Other columns
    are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((list(vocabulary), None if continuing is None else list(continuing)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, words = Counts(Automaton(*shared.value)), regex.compile(pattern)
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column(1):
                total = number = 0
                for piece, single in pieces(text.as_py() or ""):
                    found = [piece] if single else words.findall(piece)
                    number += len(found)
                    total += sum(map(counts.__getitem__, found))
                n_words.append(number)
                n_tokens.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, run, "doc_id bigint, n_words bigint, n_tokens bigint")

"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspan.llm.common import map_arrow
from ledgerspan.llm.splitting import CHUNK, pieces

#: Tokens sent to Spark at a time.
_TOKENS = 1 << 20


def read_ranks(path: str) -> bytes:
    """A rank file's bytes.  A vocabulary is about a megabyte whatever the corpus, so that it can be broadcast."""
    with open(path, "rb") as f:
        return f.read()


@functools.lru_cache(maxsize=4)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoder of a rank file's content, built once in each worker."""
    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, ranks.splitlines()))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def encode(enc: tiktoken.Encoding, text: str, size: int = CHUNK) -> Iterator[np.ndarray]:
    """Token ids of a text as little-endian 32-bit arrays, a piece at a time."""
    for piece, single in pieces(text, size):
        ids = enc._encode_single_piece(piece) if single else enc.encode_ordinary(piece)
        yield np.asarray(ids, dtype="<u4")


def decode(enc: tiktoken.Encoding, ids: np.ndarray) -> bytes:
    """Raw bytes: a token may end inside a character, so that nothing is decoded to text here."""
    return enc.decode_bytes(ids.tolist())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def token_digest(docs: DataFrame, ranks: bytes, pattern: str, with_ids: bool = False) -> DataFrame:
    """Every text encoded, and its ids decoded again: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, ``n_bytes``.

    The hashes are of the ids as little-endian 32-bit integers and of the bytes decoded from them, whose number is ``n_bytes``;
    ``with_ids`` adds the ids themselves.  Long texts go through a piece at a time.  A null or empty text has no ids and no bytes; a
    repeated row gives a repeated result, a null ``doc_id`` stays null, an empty table gives no rows.  Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kinds = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("n_bytes", pa.int64())]
    if with_ids:
        kinds.append(("ids", pa.list_(pa.int32())))

    def digest(enc: tiktoken.Encoding, text: str) -> tuple:
        count, size, ids_hash, text_hash, kept = 0, 0, hashlib.sha256(), hashlib.sha256(), [np.empty(0, "<i4")]
        for ids in encode(enc, text):
            raw = decode(enc, ids)
            count, size = count + len(ids), size + len(raw)
            ids_hash.update(ids.tobytes())
            text_hash.update(raw)
            if with_ids:
                kept.append(ids.view("<i4"))
        row = count, ids_hash.hexdigest(), text_hash.hexdigest(), size
        return (*row, np.concatenate(kept)) if with_ids else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(shared.value, pattern)
        for batch in batches:
            start, rows = 0, []
            for at, text in enumerate(batch.column(1)):
                rows.append(digest(enc, text.as_py() or ""))
                if at + 1 == batch.num_rows or (with_ids and sum(row[0] for row in rows) > _TOKENS):
                    columns = [pa.array(x, kind) for x, (_, kind) in zip(zip(*rows), kinds)]
                    names = ["doc_id", *(name for name, _ in kinds)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(rows)), *columns], names=names)
                    start, rows = at + 1, []

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint"
    return map_arrow(_texts(docs), run, schema + ", ids array<int>" * with_ids)


def decode_ids(tokens: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``doc_id`` and ``decoded``, the bytes of the array column ``ids``; null ids give null."""
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(shared.value, pattern)
        for batch in batches:
            for at in range(batch.num_rows):
                ids = batch.column(1)[at].as_py()
                raw = None if ids is None else enc.decode_bytes(ids)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), pa.array([raw], pa.binary())], names=["doc_id", "decoded"])

    return map_arrow(tokens.select("doc_id", F.col("ids").cast("array<int>").alias("ids")), run, "doc_id bigint, decoded binary")

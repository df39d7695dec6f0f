"""Conversation structure repair: the cheapest edits to well-formed turns, found once for all conversations that end alike."""

from __future__ import annotations

import hashlib
import itertools
import os.path
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerspan.llm.common import BLANKS, map_arrow, staged

#: What the edits cost; an undeleted truncated turn adds ``TRUNCATED``.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Symbols of a signature: the role's initial (``x``: another), upper case if truncated; ``GONE`` must be deleted.
INITIALS, GONE = "sua", "d"

# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a; and what each role leads to.
_STATES = range(4)
_KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
_GIVEN = (2, 2, 3, 2)  # the next user or assistant turn
_ROLE = {2: "user", 3: "assistant"}

Node = tuple[tuple[int, ...], tuple[str, ...]]
#: No turn is left: cost to go and first edit in each state.
END: Node = ((0, 2 * INSERT, INSERT, 0), ("", "I", "I", ""))


def node(symbol: str, rest: Node) -> Node:
    """Cost to go and first edit, by grammar state, of the turns from one of this ``symbol`` on; ``rest`` is the node behind it.

    Edits begin with different letters, so that among equal costs the first letter decides the least audit.
    """
    after = rest[0]
    late = TRUNCATED if symbol.isupper() else 0
    best = []
    for state in _STATES:
        options = [(DELETE + after[state], "D")]
        if symbol != GONE:
            options.append((REROLE + late + after[_GIVEN[state]], "R"))
            kept = _KEPT.get((symbol.lower(), state))
            if kept is not None:
                options.append((KEEP + late + after[kept], "K"))
        best.append(min(options))
    first = best
    for _ in range(2):  # a third insertion before the same turn would only lead back
        best = [min(first[state], (INSERT + best[_GIVEN[state]][0], "I")) for state in _STATES]
    return tuple(cost for cost, _ in best), tuple(edit for _, edit in best)


def audits(signatures: Iterable[str]) -> Iterator[tuple[int, str, int]]:
    """Cost and audit of each signature, given in the order of their reversed strings, and the nodes made for it.

    Signatures that end alike are neighbours then.  A node stands for the rest of a signature; those of the one at hand are
    open, and the next one goes on from the longest rest that both share, so that each node is made once.
    """
    opened, path, audit = [END], "", ""
    known = False
    for signature in signatures:
        reverse = signature[::-1]
        shared = len(os.path.commonprefix([path, reverse]))
        if known and shared == len(path) == len(reverse):
            yield opened[-1][0][0], audit, 0
            continue
        del opened[shared + 1 :]
        for symbol in reverse[shared:]:
            opened.append(node(symbol, opened[-1]))
        edits, at, state = [], len(reverse), 0
        while edit := opened[at][1][state]:
            edits.append(edit)
            if edit == "K":
                state = _KEPT[signature[len(signature) - at].lower(), state]
            elif edit != "D":
                state = _GIVEN[state]
            at -= edit != "I"
        path, audit, known = reverse, "".join(edits), True
        yield opened[-1][0][0], audit, len(reverse) - shared


def _ordered(*more: str) -> list[Column]:
    return [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), *map(F.col, more)]


def _rows(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``digest`` and ``gone`` (the row only says that there is a conversation)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    return turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.sha2(text, 256).alias("digest"),
        F.coalesce(gone, F.lit(False)).alias("gone"),
    )


def _symbols(rows: DataFrame) -> DataFrame:
    """Each row's symbol, ``D`` for duplicates and empty for those gone, in the order of the conversations; one shuffle, without texts."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    plain = F.when(initial.isin(*INITIALS), initial).otherwise("x")
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        initial.alias("initial"),
        F.when(F.col("gone"), F.lit(""))
        .when(F.ltrim(trimmed, F.lit(BLANKS)) == "", F.lit(GONE))
        .when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), plain)
        .otherwise(F.upper(plain))
        .alias("symbol"),
    )
    earlier = Window.partitionBy("conv_id", "role", "digest", F.col("symbol") == "").orderBy(F.col("turn").asc_nulls_first())
    again = (F.row_number().over(earlier) > 1) & ~F.col("symbol").isin("", GONE)
    found = narrow.repartition("conv_id").select("*", again.alias("again"))
    return found.sortWithinPartitions(*_ordered("again")).select(
        "conv_id", "turn", "initial", F.when(F.col("again"), F.lit("D")).otherwise(F.col("symbol")).alias("symbol")
    )


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of some thousand rows, fewer where their texts are long."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += 256 + sum(len(x) for x in row if isinstance(x, str))
        if chars > size:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of the sorted rows, one for each conversation: its counts, and a letter for each turn."""
    rows = _lists(batches)
    row = next(rows, None)
    while row is not None:
        current, letters, illegal, last = row[0], [], 0, None
        distinct, least, most = 0, None, None
        while row is not None and row[0] == current:
            _, turn, initial, symbol = row
            if symbol:
                illegal += last is not None and (last, initial) not in _LEGAL
                last = initial
                letters.append(symbol)
                if turn is not None and turn != most:
                    distinct, least, most = distinct + 1, turn if least is None else least, turn
            row = next(rows, None)
        signature = "".join(letters)
        gaps = most - least + 1 - distinct if distinct else 0
        late = sum(map(signature.count, "SUAX"))
        yield current, gaps, signature.count(GONE), signature.count("D"), late, illegal, signature.replace("D", GONE)


def _fields(conv_id: StructField, *more: StructField) -> StructType:
    return StructType([conv_id, *(StructField(name, LongType()) for name in _COUNTS), *more])


def planned(turns: DataFrame) -> DataFrame:
    """``conv_id``, the counts ``gaps``, ``blank``, ``duplicate``, ``truncated`` and ``illegal``, ``cost`` and ``audit`` of each conversation.

    Signatures are dealt out by ranges of their reversed strings, those of equal ones by conversation, so that a task meets the
    signatures that end alike one after another and a frequent signature is spread over tasks.
    """
    rows = _symbols(_rows(turns))
    conv_id = rows.schema["conv_id"]
    counted = _fields(conv_id, StructField("signature", StringType()))
    shape = to_arrow_schema(counted)
    found = staged(map_arrow(rows, lambda batches: _batches(_conversations(batches), shape), counted))
    result = _fields(conv_id, StructField("cost", LongType()), StructField("audit", StringType()))
    result_shape = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, read = itertools.tee(_lists(batches))
        edits = ((*row[:-1], cost, audit) for row, (cost, audit, _) in zip(rows, audits(row[-1] for row in read)))
        return _batches(edits, result_shape)

    backwards = F.reverse("signature")
    return map_arrow(found.repartitionByRange(backwards, "conv_id").sortWithinPartitions(backwards, "conv_id"), run, result)


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """For each conversation its plan, then its repaired turns one after another: ``(plan, edit, role, text)``; edit is empty for the plan."""
    plan, audit, at, state = (), "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            at, state = at + 1, _GIVEN[state]
            yield plan, "I", _ROLE[state], ""

    for conv_id, kind, role, text, *found in rows:
        if kind == 0:
            yield from inserted()
            plan, audit, at, state = (conv_id, *found), found[-1], 0, 0
            yield plan, "", "", ""
            continue
        yield from inserted()
        edit, at = audit[at], at + 1
        if edit == "K":
            state = _KEPT[role[:1], state]
            yield plan, edit, role, text
        elif edit == "R":
            state = _GIVEN[state]
            yield plan, edit, _ROLE[state], text
    yield from inserted()


def _plans_and_turns(turns: DataFrame) -> DataFrame:
    """Each conversation's plan (``kind`` 0) before its turns, all of one conversation in one partition."""
    plans, rows = planned(turns), _rows(turns).where(~F.col("gone"))
    found = [*_COUNTS, "cost", "audit"]
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in plans.select(*found).dtypes]
    both = plans.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), *(F.lit("").alias(c) for c in ("role", "text", "digest")), *found
    ).unionByName(rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "digest", *empty))
    order = _ordered()
    ordered = both.repartition("conv_id").sortWithinPartitions(order[0], F.col("kind"), *order[1:])
    return ordered.select("conv_id", "kind", "role", "text", *found)


def repair(turns: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id``, ``position`` from 0, ``edit`` (``K`` kept, ``R`` other role, ``I`` inserted), ``role``, ``text``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``.  Rows and nulls as in ``repair_digest``.
    """
    both = _plans_and_turns(turns)
    kinds = [("position", LongType()), ("edit", StringType()), ("role", StringType()), ("text", StringType())]
    schema = StructType([both.schema["conv_id"], *(StructField(name, kind) for name, kind in kinds)])
    shape = to_arrow_schema(schema)

    def numbered(rows: Iterator[tuple]) -> Iterator[tuple]:
        position = 0
        for plan, edit, role, text in _edited(rows):
            if edit:
                yield plan[0], position, edit, role, text
            position = position + 1 if edit else 0

    return map_arrow(both, lambda batches: _batches(numbered(_lists(batches)), shape), schema)


def repair_digest(turns: DataFrame) -> DataFrame:
    """One row for each conversation: what is wrong with it, the cheapest edits, and a hash of the repaired turns.

    A conversation's rows are taken by turn (nulls first), then role, then the hash of the text.  Its signature has a letter for
    each: the role's initial and the row's first fault, which is ``blank`` (no character but white space), ``duplicate`` (role and text of
    an earlier row) or ``truncated`` (the last character isn't ``.``, ``!`` or ``?``).  ``gaps`` are turn numbers missing between the first and
    the last, ``illegal`` neighbours whose initials aren't su, ua or au.  ``audit`` has the initials of the edits Keep, Rerole, Delete
    and Insert that give role initials ``(s?(ua)+)?`` at the least ``cost``, the least string among equals.  ``repaired_sha256`` hashes
    the repaired rows ``role:text``, joined by line ends.

    Null roles and texts are one blank; an empty role has no initial and can't be kept.  Repeated rows are duplicates.  Rows
    marked in a boolean column ``gone`` only say that there is such a conversation; without other rows all counts are 0, the audit
    empty.  Null conv_ids are one conversation.  An empty table gives no rows; other columns are not read.  Turns are read one
    after another: a task holds a letter for each turn of a conversation, as its audit does, and the texts of one batch.
    """
    both = _plans_and_turns(turns)
    text_fields = [StructField(name, StringType()) for name in ("audit", "repaired_sha256")]
    schema = _fields(both.schema["conv_id"], StructField("cost", LongType()), *text_fields)
    shape = to_arrow_schema(schema)

    def hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, sha, first = None, None, True
        for plan, edit, role, text in _edited(rows):
            if not edit:
                if last is not None:
                    yield *last, sha.hexdigest()
                last, sha, first = plan, hashlib.sha256(), True
                continue
            sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        if last is not None:
            yield *last, sha.hexdigest()

    return map_arrow(both, lambda batches: _batches(hashed(_lists(batches)), shape), schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a hash of conversation and turn, for trials: dropped (``gone``), emptied, robbed of sentence ends, doubled, or given to the user."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return (
        conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), fate.alias("fate"))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            (F.col("fate") == 0).alias("gone"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )

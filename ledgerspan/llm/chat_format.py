"""Chat formatting: records of many layouts become canonical turns, and turns one reversible training text."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template.  All begin with ``<|``; inside roles and texts that pair gets one more backslash.
TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
#: The role whose texts the loss covers.
LEARNED = "assistant"
#: Other names of canonical roles (fixed values).
ROLES = {"human": "user", "gpt": LEARNED, "bot": LEARNED, "model": LEARNED}


class Part(NamedTuple):
    """One turn of a record: the path of its text, its role or the path of it, and the path of its number."""

    text: str
    role: str = ""
    role_path: str = ""
    turn_path: str = ""


class Layout(NamedTuple):
    """A layout by an example with its nested fields, and the turns taken from it, of each element of ``each`` if given."""

    name: str
    example: dict
    parts: Sequence[Part]
    each: str = ""


#: Production mappings.
LAYOUTS = (
    Layout("turn", {"conv_id": 0, "turn": 0, "role": "", "text": ""}, [Part("text", role_path="role", turn_path="turn")]),
    Layout("messages", {"conv_id": 0, "messages": [{"role": "", "content": ""}]}, [Part("content", role_path="role")], "messages"),
    Layout("shared", {"conv_id": 0, "conversations": [{"from": "", "value": ""}]}, [Part("value", role_path="from")], "conversations"),
    Layout("prompt", {"conv_id": 0, "prompt": "", "completion": ""}, [Part("prompt", "user"), Part("completion", LEARNED)]),
    Layout(
        "system_prompt",
        {"conv_id": 0, "system": "", "prompt": "", "completion": ""},
        [Part("system", "system"), Part("prompt", "user"), Part("completion", LEARNED)],
    ),
    Layout("instruction", {"conv_id": 0, "instruction": "", "output": ""}, [Part("instruction", "user"), Part("output", LEARNED)]),
    Layout(
        "instruction_input",
        {"conv_id": 0, "instruction": "", "input": "", "output": ""},
        [Part("instruction", "user"), Part("input", "user"), Part("output", LEARNED)],
    ),
)


def fingerprint(record: Column) -> Column:
    """Hash of a record's nested field paths: its schema, fields in order of name, without the types of values.

    A field that is null counts, one that is missing doesn't.
    """
    return F.xxhash64(F.regexp_replace(F.schema_of_variant(record), r": [A-Z]+(\([0-9,]+\))?(?=[,>])", ""))


def _text(source: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(source, f"$.{path}", "string"), F.lit(""))


def _turn(part: Part, source: Column, place: Column) -> Column:
    if part.role:
        role = F.lit(part.role)
    else:
        given = _text(source, part.role_path)
        role = given
        for name, canonical in ROLES.items():
            role = F.when(given == name, canonical).otherwise(role)
    number = F.try_variant_get(source, f"$.{part.turn_path}", "bigint") if part.turn_path else place.cast("bigint")
    return F.struct(number.alias("turn"), role.alias("role"), _text(source, part.text).alias("text"))


def _turns(layout: Layout, record: Column) -> Column:
    if layout.each:
        return F.transform(
            F.try_variant_get(record, f"$.{layout.each}", "array<variant>"), lambda x, i: _turn(layout.parts[0], x, i)
        )
    return F.array(*(_turn(part, record, F.lit(i)) for i, part in enumerate(layout.parts)))


def canonical_turns(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``conv_id``, ``layout``, ``turn``, ``role``, ``text`` of all turns of the variant column ``record``.

    The record's fingerprint selects the mapping.  A record of no known layout (or a null one) gives one row with a
    null layout, so that it is seen and not lost.  Null roles and texts are empty; a null number or conversation stays null.
    """
    record, found = F.col("record"), F.col("_fingerprint")
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<turn:bigint,role:string,text:string>>")
    for layout in layouts:
        known = fingerprint(F.parse_json(F.lit(json.dumps(layout.example))))
        name = F.when(found == known, layout.name).otherwise(name)
        turns = F.when(found == known, _turns(layout, record)).otherwise(turns)
    rows = records.select("record", fingerprint(record).alias("_fingerprint"))
    rows = rows.select(F.try_variant_get(record, "$.conv_id", "bigint").alias("conv_id"), name.alias("layout"), turns.alias("_turns"))
    return rows.select("conv_id", "layout", F.explode_outer("_turns").alias("_turn")).select("conv_id", "layout", "_turn.*")


def escape(text: Column) -> Column:
    """Every ``<``, backslashes, ``|`` gets one more backslash, so that no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``pieces``, the conversation's text in pieces marked with ``loss``; joined they are the text.

    Turns are ordered by number, then role and text, so that ties and repeated rows have one order; null numbers come first.
    A conversation is one text and so one row, however long; conversations are spread over tasks, turns of a null
    conversation form one.  Turns of no known layout are left out.
    """
    rows = turns.where(F.col("layout").isNotNull()).select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            "text",
            F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)).alias("head"),
            escape(F.col("text")).alias("body"),
        ).alias("_turn"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    piece = lambda text, loss: F.struct(text.alias("piece"), loss.alias("loss"))
    off = F.lit(False)
    return ordered.select(
        "conv_id",
        F.flatten(
            F.transform(
                "_turns",
                lambda x: F.array(piece(x["head"], off), piece(x["body"], x["role"] == LEARNED), piece(F.lit(END), off)),
            )
        ).alias("pieces"),
    )


def formatted(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda x: x["piece"]), "")


def read_back(text: Column) -> Column:
    """The turns (role and text) of a formatted text."""
    bare = F.slice(F.split(text, r"<\|turn\|>"), F.lit(2), F.greatest(F.size(F.split(text, r"<\|turn\|>")) - 1, F.lit(0)))

    def turn(x: Column) -> Column:
        role = F.substring_index(x, BODY, 1)
        start = F.length(role) + len(BODY)
        return F.struct(
            unescape(role).alias("role"), unescape(x.substr(start + 1, F.length(x) - start - len(END))).alias("text")
        )

    return F.transform(bare, turn)


def format_digest(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Formats all records and reads back what the output holds, by conversation.

    Turns come from the joined text alone, the text under the loss mask from the pieces that have it.
    """
    text = F.col("_formatted")
    out = format_turns(canonical_turns(records, layouts)).select("conv_id", "pieces", formatted(F.col("pieces")).alias("_formatted"))
    out = out.select(
        "conv_id",
        read_back(text).alias("_turns"),
        F.array_join(F.transform(F.filter("pieces", lambda x: x["loss"]), lambda x: unescape(x["piece"])), "").alias("_learned"),
        F.length(text).cast("bigint").alias("formatted_chars"),
    )
    return out.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("_learned").cast("bigint").alias("loss_chars"),
        F.sha2("_learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )

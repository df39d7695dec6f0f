"""Quality rules: a threshold table compiled into one projection of text statistics."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspan.llm.common import BLANKS, text_or_empty

#: Signs counted as symbols, and words of a repeated window.
SYMBOLS, WINDOW = "#*$%&|<>", 5
#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for on with as was are be by this from or an at not have has but "
    "der die das und ist nicht ein eine zu den von mit sich auf für des dem im auch es "
    "le la les de des et en un une que qui dans pour du au est par sur avec plus "
    "el los las y del que se una por con para su al lo como más"
).split()


class Rule(NamedTuple):
    """A document fails when ``metric`` compares so with ``threshold``; documents of under ``words`` words pass."""

    metric: str
    fails_if: str
    threshold: float
    words: int = 0


#: Production thresholds.
RULES = (
    Rule("n_words", "<", 10),
    Rule("mean_word_chars", "<", 2.0),
    Rule("mean_word_chars", ">", 20.0),
    Rule("symbol_ratio", ">", 0.25),
    Rule("stop_word_ratio", "<", 0.01, 50),
    Rule("dup_line_ratio", ">", 0.5),
    Rule("blank_line_ratio", ">", 0.9),
)
_COMPARE = {"<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge}


def verdict(rules: Sequence[Rule]) -> Column:
    """The rule table as one boolean expression over the metric columns; a metric that is null fails nothing."""
    passed = F.lit(True)
    for rule in rules:
        fails = _COMPARE[rule.fails_if](F.col(rule.metric), F.lit(rule.threshold)) & (F.col("n_words") >= rule.words)
        passed = passed & ~F.coalesce(fails, F.lit(False))
    return passed


def _repeated_words() -> Column:
    """Words that lie in windows found twice or more, from ``_windows``, the hash of the window at each position.

    Sorted with their positions, equal windows are neighbours; a window adds the words that the one before it,
    among the repeated, doesn't hold.
    """
    ordered = F.col("_ordered")
    same = lambda x, i: ((i > 0) & (ordered[F.greatest(i - 1, F.lit(0))]["hash"] == x["hash"])) | (
        (i + 1 < F.size(ordered)) & (ordered[F.least(i + 1, F.size(ordered) - 1)]["hash"] == x["hash"])
    )
    return F.sort_array(F.transform(F.filter(ordered, same), lambda x: x["at"]))


def text_metrics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every whole text.

    Words are runs of anything but blank, tab, line feed, vertical tab, form feed and return.  A null text is empty: all
    counts are 0 and ratios null.  Rows are independent: repeated rows give repeated results, and a null ``doc_id`` stays.
    """
    text = F.col("_text")
    steps = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("_text"))
    steps = steps.select(
        "doc_id",
        F.filter(F.split(text, f"[{BLANKS}]+"), lambda x: x != "").alias("_words"),
        F.split(text, "\n").alias("_all_lines"),
        F.length(F.translate(text, BLANKS, "")).cast("bigint").alias("word_chars"),
        F.length(text).alias("_chars"),
        F.length(F.translate(text, SYMBOLS, "")).alias("_plain"),
    )
    steps = steps.select(
        "doc_id",
        "word_chars",
        F.size("_words").cast("bigint").alias("n_words"),
        (F.col("_chars") - F.col("_plain")).cast("bigint").alias("n_symbols"),
        F.size(F.filter("_words", lambda x: F.lower(x).isin(STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        F.size("_all_lines").cast("bigint").alias("n_lines"),
        F.filter("_all_lines", lambda x: F.length(F.translate(x, BLANKS, "")) > 0).alias("_lines"),
        F.transform("_words", lambda x: F.xxhash64(x)).alias("_hashes"),
    )
    kept = ["doc_id", "n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines"]
    hashes = F.col("_hashes")
    steps = steps.select(
        *kept,
        F.size("_lines").cast("bigint").alias("n_full_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(hashes) - WINDOW),
                lambda i: F.xxhash64(*(hashes[i + k] for k in range(WINDOW))),
            ),
        ).alias("_windows"),
    )
    kept += ["n_full_lines", "n_dup_lines"]
    steps = steps.select(
        *kept,
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("hash"), i.alias("at")))),
        ).alias("_ordered"),
    )
    steps = steps.select(*kept, F.when(F.col("_ordered").isNotNull(), _repeated_words()).alias("_at"))
    at = F.col("_at")
    covered = F.aggregate(
        F.when(F.size(at) > 1, F.sequence(F.lit(1), F.size(at) - 1)).otherwise(F.array().cast("array<int>")),
        F.lit(WINDOW).cast("bigint"),
        lambda total, i: total + F.least(F.lit(WINDOW), at[i] - at[i - 1]),
    )
    return steps.select(*kept, F.when(F.size(at) > 0, covered).otherwise(F.lit(0).cast("bigint")).alias("n_repeat_words"))


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The metrics, the ratios the rules use, ``base_failed`` and ``kept`` for every row of ``docs``.

    The base fails documents of under 10 words and those of whose words over a fifth lie in repeated windows.
    See ``text_metrics`` for nulls and repeated rows.  Columns of ``docs`` other than ``doc_id`` and ``text`` aren't read.
    """
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    metrics = text_metrics(docs).select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ratio("n_dup_lines", "n_full_lines").alias("dup_line_ratio"),
        (1 - ratio("n_full_lines", "n_lines")).alias("blank_line_ratio"),
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
    )
    return metrics.select("*", (~F.col("base_failed") & verdict(rules)).alias("kept"))

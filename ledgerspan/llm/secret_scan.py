"""Secret scans: candidates found in whole texts, told apart by how many owners and repositories share a value."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspan.llm.common import staged, text_or_empty

#: Kinds in order, pattern, group holding the value, characters the value must have.
KINDS = (
    (
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: A value is a copied example if it has at least so many owners, in at least so many repositories.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 5, 10
LIVE, EXAMPLE = "live", "example"
_BLOCK = 256


#: Words of which a match holds one, in lower case: a text without them isn't searched.
WORDS = {"assign": ("password", "passwd", "secret", "token", "api_key", "apikey"), "access": ("akia",)}


def _where_needed(name: str, text: Column) -> Column:
    """The text, or an empty one where it can't hold a match: finding a word costs a tenth of the pattern's search."""
    if name not in WORDS:
        return text
    held = F.exists(F.array(F.lower(text)), lambda low: functools.reduce(Column.__or__, [F.contains(low, F.lit(w)) for w in WORDS[name]]))
    return F.when(held, text).otherwise(F.lit(""))


def _has_findings(text: Column) -> Column:
    """Whether ``findings`` wouldn't be empty: a match of any kind with a value long enough, searched for once."""
    longest = [
        (F.array_max(F.transform(F.regexp_extract_all(_where_needed(name, text), F.lit(pattern), F.lit(group)), F.length)), least)
        for name, pattern, group, least in KINDS
    ]
    return functools.reduce(Column.__or__, [F.coalesce(length, F.lit(0)) >= least for length, least in longest])


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda total, x: total + x)


def _sums_before(lengths: Column) -> Column:
    """For each element the sum of those before it, by blocks: a text may hold very many matches."""
    blocks = F.when(
        F.size(lengths) > 0,
        F.transform(
            F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
            lambda b: _total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))),
        ),
    )
    starts = F.transform(blocks, lambda x, b: _total(F.slice(blocks, F.lit(1), b)))
    return F.transform(
        lengths,
        lambda x, i: starts[F.floor(i / _BLOCK).cast("int")]
        + _total(F.slice(lengths, (F.floor(i / _BLOCK) * _BLOCK + 1).cast("int"), i % _BLOCK)),
    )


def _findings(rows: DataFrame) -> DataFrame:
    """Adds ``findings``: kind, start, end (code points, end exclusive) and hash of the value, by start and kind.

    What lies between matches and the matches themselves have the lengths that give the places; the last piece follows
    the last match and is left out.
    """
    text = F.col("_text")
    for name, pattern, group, _ in KINDS:
        searched = _where_needed(name, text)
        rows = rows.withColumn(f"_{name}", F.regexp_extract_all(searched, F.lit(pattern), F.lit(0)))
        if group:
            values = F.when(F.size(f"_{name}") > 0, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(F.col(f"_{name}"))
        else:
            values = F.col(f"_{name}")
        rows = rows.withColumn(f"_{name}_value", values)
        rows = rows.withColumn(
            f"_{name}_gap",
            F.when(F.size(f"_{name}") > 0, F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(f"_{name}")), F.length)),
        )
    rows = rows.drop("_text")
    for name, *_ in KINDS:
        both = F.zip_with(f"_{name}_gap", f"_{name}", lambda gap, match: gap + F.length(match))
        rows = rows.withColumn(f"_{name}_step", F.when(F.size(f"_{name}") > 0, both))
    parts = []
    for number, (name, _, _, least) in enumerate(KINDS):
        rows = rows.withColumn(f"_{name}_before", _sums_before(F.col(f"_{name}_step")))
        parts.append(_structs(name, number, least))
    return rows.withColumn("findings", F.sort_array(F.concat(*parts)))


def _structs(name: str, number: int, least: int) -> Column:
    match, value, gap, before = (F.col(f"_{name}{part}") for part in ("", "_value", "_gap", "_before"))
    found = F.transform(
        match,
        lambda m, i: F.struct(
            (before[i] + gap[i]).cast("bigint").alias("start"),
            F.lit(number).alias("kind"),
            (before[i] + gap[i] + F.length(m)).cast("bigint").alias("end"),
            F.length(value[i]).alias("size"),
            F.sha2(value[i], 256).alias("value"),
        ),
    )
    return F.filter(found, lambda x: x["size"] >= least)


def _of_kind(number: int) -> Column:
    return F.size(F.filter("findings", lambda x: x["kind"] == number)).cast("bigint")


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Every row's ``findings`` with the columns ``doc_id``, ``owner`` and ``repository``; a null text has none.

    Matches are leftmost and don't overlap within a kind.  Rows are independent.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        text_or_empty().alias("_text"),
    )
    return _findings(rows).select("doc_id", "owner", "repository", "findings")


def ownership(scanned: DataFrame, owners: int = EXAMPLE_OWNERS, repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """``value``, ``n_owners``, ``n_repositories`` and ``class`` of every candidate value of the corpus.

    Tasks first keep each value, owner and repository once, so that a value pasted into a third of all rows is
    small before it moves.  A null owner or repository counts as none.
    """
    found = scanned.select("owner", "repository", F.explode("findings.value").alias("value"))
    counts = found.groupBy("value").agg(
        F.countDistinct("owner").alias("n_owners"), F.countDistinct("repository").alias("n_repositories")
    )
    copied = (F.col("n_owners") >= owners) & (F.col("n_repositories") >= repositories)
    return counts.select("*", F.when(copied, EXAMPLE).otherwise(LIVE).alias("class"))


def _joined(findings: Column) -> Column:
    kinds = F.array(*(F.lit(name) for name, *_ in KINDS))
    return F.array_join(
        F.transform(findings, lambda x: F.concat_ws(":", kinds[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def secret_report(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: findings by kind, their digest and places, and how many are live or copied examples.

    A value with many owners in many repositories is an example that people copy; one that stays with few owners looks live.
    A null text is empty.  Repeated rows give repeated results and count once for ownership.  A null ``doc_id`` stays; other
    columns are not read.  The scan runs once; its narrow result is kept in the shared folder and only rows with
    findings are shuffled.
    """
    kinds = [name for name, *_ in KINDS]
    scanned = staged(scan(docs, owner, repository))
    counted = scanned.select(
        "doc_id",
        F.col("findings.value").alias("_values"),
        *(_of_kind(number).alias(f"n_{name}") for number, name in enumerate(kinds)),
        _joined(F.col("findings")).alias("spans"),
    ).withColumn("base_sha256", F.sha2("spans", 256))
    columns = ["doc_id", *(f"n_{name}" for name in kinds), "base_sha256", "spans"]
    clean = counted.where(F.size("_values") == 0).select(*columns, F.lit(0).cast("bigint").alias("n_live"), F.lit(0).cast("bigint").alias("n_example"))
    found = counted.where(F.size("_values") > 0)
    # One row for each id and set of values: repeated rows share it.
    keys = found.select("doc_id", "_values").distinct()
    classes = ownership(scanned).select("value", "class")
    judged = (
        keys.select("doc_id", "_values", F.explode("_values").alias("value"))
        .join(classes, "value")
        .groupBy(F.col("doc_id").alias("_id"), F.col("_values").alias("_set"))
        .agg(F.count_if(F.col("class") == LIVE).alias("n_live"), F.count_if(F.col("class") == EXAMPLE).alias("n_example"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_values") == F.col("_set"))
    return clean.unionByName(found.join(judged, same, "left").select(*columns, "n_live", "n_example"))


def redact(docs: DataFrame, owner: str = "source", repository: str = "doc_id", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with live-looking values replaced by ``mask``; copied examples and all other text stay as they are.

    A row's text is rebuilt from the places of its live findings; overlapping ones (a hexadecimal value that is also
    assigned) give one mask.  Columns and rows stay, repeated rows too.  Only rows with findings are kept in the shared folder and
    shuffled; the others pass by.  Whether there is a finding is asked in a search of its own, as a filter on findings would have Spark
    build them anew for each place that names them.
    """
    names = docs.columns
    some = _has_findings(text_or_empty())
    found = _findings(
        docs.where(some).select(
            F.struct(*(F.col(f"`{name}`") for name in names)).alias("_row"),
            F.col(owner).cast("string").alias("owner"),
            F.col(repository).cast("string").alias("repository"),
            text_or_empty().alias("_text"),
        )
    ).select("_row", "owner", "repository", "findings")
    clean = docs.where(~some)
    hits = staged(found.withColumn("_key", F.xxhash64("_row")))
    copied = ownership(hits).where(F.col("class") == EXAMPLE).select("value")
    examples = (
        hits.select("_key", F.explode("findings.value").alias("value"))
        .join(copied, "value")
        .groupBy("_key")
        .agg(F.collect_set("value").alias("_examples"))
    )
    none = F.array().cast("array<string>")
    live = F.filter("findings", lambda x: ~F.array_contains(F.coalesce("_examples", none), x["value"]))
    live = F.array_sort(live, lambda x, y: ((x["end"] - x["size"]) - (y["end"] - y["size"])).cast("int"))
    text = F.col("_row")["text"]

    def step(state: Column, x: Column) -> Column:
        """A value ends its finding.  Between values the text is copied; of one that begins inside another only the rest is skipped."""
        start = x["end"] - x["size"]
        between = F.array(text.substr(state["at"] + 1, start - state["at"]), F.lit(mask))
        parts = F.when(start < state["at"], state["parts"]).otherwise(F.concat(state["parts"], between))
        return F.struct(F.greatest(x["end"], state["at"]).alias("at"), parts.alias("parts"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("parts"))
    rebuilt = F.aggregate(
        live,
        start,
        step,
        lambda state: F.concat(F.array_join(state["parts"], ""), text.substr(state["at"] + 1, F.length(text).cast("bigint"))),
    )
    masked = hits.join(examples, "_key", "left").withColumn("_masked", rebuilt)
    fields = (F.col("_masked").alias(n) if n == "text" else F.col("_row")[n].alias(n) for n in names)
    return clean.unionByName(masked.select(*fields))

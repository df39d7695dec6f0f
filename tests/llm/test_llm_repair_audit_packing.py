"""Conversation repair, filter audit and packing against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import duckdb
import pandas as pd
import public_tokenizers
import pytest
from helpers import WORD, empty_documents, odd_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerspan.llm import conversation_repair as repair
from ledgerspan.llm import filter_audit as audit
from ledgerspan.llm import packing

# ---------------------------------------------------------------------------- conversation repair


def plain_plan(roles: list[str], faults: list[str]) -> tuple[int, str]:
    """Cost and audit by a search over rows and grammar positions, strings and all."""
    given = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i: int, state: str, inserted: int) -> tuple[int, str]:
        options = [] if i < len(roles) or state not in ("", "a") else [(0, "")]

        def add(cost, edit, then):
            options.append((cost + then[0], edit + then[1]))

        if inserted < 2:
            add(3, "I", best(i, given[state], inserted + 1))
        if i < len(roles):
            add(4, "D", best(i + 1, state, 0))
            if faults[i] in ("", "truncated"):
                late = 3 * (faults[i] == "truncated")
                add(3 + late, "R", best(i + 1, given[state], 0))
                initial = roles[i][:1]
                if initial == given[state] or (initial == "s" and state == ""):
                    add(late, "K", best(i + 1, initial, 0))
        return min(options, default=(10**9, "~"))

    return best(0, "", 0)


def plain_repair(turns: list[tuple]) -> tuple:
    """The digest of one conversation's ``(turn, role, text)`` rows, in the columns' order."""
    rows = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in turns]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns_known = [turn for turn, *_ in rows if turn is not None]
    gaps = max(turns_known) - min(turns_known) + 1 - len(set(turns_known)) if turns_known else 0
    roles = [role for _, role, _ in rows]
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(roles))
    cost, edits = plain_plan(roles, faults)
    out, at = [], 0
    for edit in edits:
        expected = "user" if not out or out[-1][0][:1] in "sa" else "assistant"
        if edit in "KR":
            out.append((roles[at] if edit == "K" else expected, rows[at][2]))
        if edit == "I":
            out.append((expected, ""))
        at += edit != "I"
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, edits, digest


def random_turns(rng: random.Random, size: int) -> list[tuple]:
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "agent", None]
    texts = ["Yes.", "No!", "Why?", "so on", "", " \n\t", None, "Yes.", "a.b", "Done. \n", "x" * 50]
    return [(rng.choice([None, i, i, i + 1]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Text {i}.") for i in range(size)]


SCHEMA = "conv_id long, turn long, role string, text string, symbol string, digest string, kind int, gaps string, copy int"


def turns_table(spark, conversations: dict):
    rows = [(key, *turn, "x", None, 7, "y", 1) for key, turns in conversations.items() for turn in turns]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_repair_matches_a_plain_search(spark):
    rng = random.Random(11)
    conversations = {key: random_turns(rng, rng.randrange(1, 10)) for key in range(200)} | {None: random_turns(rng, 7)}
    conversations |= {1000 + n: conversations[5] for n in range(30)}
    got = repair.repair_digest(turns_table(spark, conversations))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {row[0]: tuple(row)[1:] for row in got.collect()} == {key: plain_repair(turns) for key, turns in conversations.items()}


def test_repaired_turns(spark):
    turns = [(0, "system", "Be kind."), (1, "user", "Hi?"), (2, "user", "Hi?"), (3, "tool", "Result."), (4, "assistant", "Then"), (9, "user", "Bye.")]
    got = repair.repair(turns_table(spark, {1: turns, 2: [(0, "user", " ")]})).orderBy("conv_id", "position").collect()
    wanted = [("K", "system", "Be kind."), ("K", "user", "Hi?"), ("K", "assistant", "Then"), ("K", "user", "Bye."), ("I", "assistant", "")]
    assert [(r.conv_id, r.position, r.edit, r.role, r.text) for r in got] == [(1, n, *row) for n, row in enumerate(wanted)]
    digest = {r.conv_id: r for r in repair.repair_digest(turns_table(spark, {1: turns, 2: [(0, "user", " ")]})).collect()}
    text = "\n".join(f"{r.role}:{r.text}" for r in got if r.conv_id == 1)
    assert digest[1].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (digest[2].audit, digest[2].cost, digest[2].repaired_sha256) == ("D", 4, hashlib.sha256(b"").hexdigest())


def test_nodes_are_made_once_for_shared_endings():
    rng = random.Random(5)
    signatures = {"".join(rng.choice("suaxSUAXd") for _ in range(rng.randrange(0, 8))) for _ in range(500)}
    ordered = sorted((s for s in signatures for _ in range(2)), key=lambda s: s[::-1])
    found = list(repair.audits(ordered))
    endings = {s[i:] for s in signatures for i in range(len(s))}
    assert sum(made for *_, made in found) == len(endings)
    role, fault = {"s": "s", "u": "u", "a": "a", "x": "x", "d": "x"}, {"d": "blank"}
    for signature, (cost, edits, _) in zip(ordered, found):
        faults = [fault.get(c, "truncated" if c.isupper() else "") for c in signature]
        assert (cost, edits) == plain_plan([role[c.lower()] for c in signature], faults)


def test_long_and_empty_conversations(spark):
    long = [(i, "user" if i % 2 == 0 else "assistant", f"Text {i}.") for i in range(5000)]
    copies = [(None, "user", "Same.")] * 3000
    got = {r.conv_id: r for r in repair.repair_digest(turns_table(spark, {1: long, 2: copies})).collect()}
    assert (got[1].cost, got[1].audit, got[1].gaps) == (0, "K" * 5000, 0)
    assert (got[2].duplicate, got[2].cost, got[2].gaps) == (2999, 4 * 2999 + 3, 0) and Counter(got[2].audit) == {"D": 2999, "K": 1, "I": 1}
    empty = turns_table(spark, {1: long[:1]}).where("false")
    assert repair.repair_digest(empty).count() == 0 and repair.repair(empty).count() == 0


def test_damage(spark):
    turns = {key: [(t, "assistant", f"A.{t}? b!") for t in [*range(12), None]] for key in [*range(40), None]}
    got = defaultdict(list)
    for row in repair.damaged(turns_table(spark, turns)).collect():
        got[row.conv_id, row.turn].append((row.role, row.text, row.gone))
    for key in turns:
        for turn, role, text in turns[key]:
            fate = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
            one = ("user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text, fate == 0)
            assert got[key, turn] == [one] * (2 if fate == 3 else 1)


# ---------------------------------------------------------------------------- filter audit

AUDIT_COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_audit(docs: list[tuple], labels: list[tuple]) -> dict:
    """Documents are ``(doc_id, text, lang)``; one filter after another in every order."""
    least: dict = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, mark in labels if mark == 1 and i is not None}
    fails = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        bad = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)}
        bad |= {"D": bool(re.search("[#$%&*|]", text)), "E": doc_id is not None and doc_id > least[text]}
        fails.append((doc_id, lang or "", {f for f in bad if bad[f]}))
    out: dict = defaultdict(lambda: [0] * 7)
    total: Counter = Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for doc_id, part, bad in fails:
            gone = False
            for step, f in enumerate(order, 1):
                cell = out[part, order, step]
                here = f in bad
                cell[0] += not gone and not here
                cell[1] += not gone and here
                cell[2] += gone and here
                cell[3] += bad == {f}
                cell[4] += not gone and here and doc_id in good
                cell[5] += not gone and here and doc_id in toxic
                total[part, f] += not gone and here
                gone |= here
    for (part, order, step), cell in out.items():
        cell[6] = total[part, order[step - 1]]
    return {key: tuple(cell) for key, cell in out.items()}


def audit_documents() -> list[tuple]:
    rng = random.Random(2)
    base = ["", "short", " ".join(f"w{i}" for i in range(120)), " ".join(f"w{i % 60}" for i in range(130)), "ALL CAPS " * 60, "a # b " * 70, "é" * 400]
    texts = base + [f"{' '.join(rng.choice(['one', 'Two', 'three', '#', 'FOUR', str(i)]) for i in range(rng.randrange(200)))}" for _ in range(30)]
    docs = [(rng.randrange(300), rng.choice([*texts, None]), rng.choice(["en", "de", None, ""])) for _ in range(600)]
    return [*docs, *docs[:40], (None, "short", "en"), (None, None, None), (-5, "short", "fr")]


@pytest.mark.parametrize("files", [1, 7])
def test_audit_matches_every_order(spark, tmp_path, files):
    docs = audit_documents()
    labels = [(i, i % 3 % 2, i % 5 % 2) for i in range(-5, 250)] + [(4, None, 1), (4, 1, None), (None, 1, 1)]
    # Files in the order of falling ids, so that later ones take back what earlier ones counted.
    rows = sorted(docs, key=lambda d: -1000 if d[0] is None else d[0], reverse=True)
    shape = "doc_id long, text string, lang string, who string, mask string, part int, n int, key int"
    for n in range(files):
        part = [(*row, "x", None, 1, 2, 3) for row in rows[n * len(rows) // files : (n + 1) * len(rows) // files]]
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = audit.filter_audit(spark, f"{tmp_path}/documents.parquet", f"{tmp_path}/labels.parquet", batches=5)
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in AUDIT_COLUMNS) for r in got.collect()}
    assert found == plain_audit(docs, labels)


def test_audit_goes_on_where_it_was_stopped(spark, tmp_path):
    """Files that arrive after a run are counted by the next one with the same folder, the earlier ones are not counted again."""
    docs = [(i, f"text {i % 7}", "en") for i in range(100, 0, -1)]
    shape = "doc_id long, text string, lang string"
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for part in (docs[:50], docs[50:]):
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
        changes = audit.stream_changes(spark, f"{tmp_path}/documents.parquet", f"{tmp_path}/labels.parquet", f"{tmp_path}/work")
    counted = {r.mask: r.n for r in changes.groupBy("mask").agg(F.sum("n").alias("n")).collect()}
    assert counted[1] == 7 and counted[1 | 16] == 93 and changes.where("n < 0").count() > 0
    empty = spark.createDataFrame([], shape)
    empty.write.parquet(f"{tmp_path}/none.parquet")
    assert audit.filter_audit(spark, f"{tmp_path}/none.parquet", f"{tmp_path}/labels.parquet").count() == 0


def retract(rows: list[tuple], held: list[tuple]) -> tuple[dict, list[tuple]]:
    columns = ["key", "who", "mask", "known", "id", "n_least", "n"]
    change, after = audit.retract(pd.DataFrame(rows, columns=columns), pd.DataFrame(held, columns=["key", "least", "who", "n"]).astype({"least": "int64", "n": "int64"}))
    return {(r.who, r.mask): r.n for r in change.itertuples()}, sorted(map(tuple, after[["key", "least", "who", "n"]].values.tolist()))


def test_retraction():
    change, held = retract([(b"t", "00en", 1, True, 9, 2, 5), (b"u", "00en", 2, True, 2**60 + 1, 1, 1)], [])
    assert change == {("00en", 1): 2, ("00en", 17): 3, ("00en", 2): 1} and held == [(b"t", 9, "00en", 2), (b"u", 2**60 + 1, "00en", 1)]
    change, held = retract([(b"t", "10de", 1, True, 4, 1, 1), (b"t", "00en", 1, True, 9, 1, 1)], held)
    assert change == {("00en", 1): -2, ("00en", 17): 3, ("10de", 1): 1} and held == [(b"t", 4, "10de", 1), (b"u", 2**60 + 1, "00en", 1)]
    change, held = retract([(b"t", "00en", 1, False, 0, 3, 3), (b"u", "00en", 2, True, 2**60 + 1, 1, 2), (b"t", "10de", 1, True, 4, 1, 1)], held)
    assert change == {("00en", 1): 3, ("00en", 2): 1, ("00en", 18): 1, ("10de", 1): 1}
    assert held == [(b"t", 4, "10de", 2), (b"u", 2**60 + 1, "00en", 2)]


# ---------------------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def vocabulary():
    return packing.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


@cache
def library(vocabulary: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.encode_special_tokens = True
    return tokenizer


@cache
def library_ids(vocabulary: str, text: str | None) -> list[int]:
    return [*library(vocabulary).encode(text or "", add_special_tokens=False).ids, 0]


def padding(size: int, window: int) -> int:
    return 0 if size & (size - 1) == 0 else window - size


def plain_cost(places: list[int], penalties: list[int], window: int, inside: int, brims: int, last: bool) -> int:
    at, cost = [0, *places], [0]
    for j in range(1, len(at)):
        options = []
        for i in range(j):
            gap = at[j] - at[i]
            for full in range(brims + 1):
                rest = gap - window * full
                if 0 < rest <= window:
                    options.append(cost[i] + inside * full + (padding(rest, window) if full == 0 else window - rest))
            if last and j == len(at) - 1 and gap <= window:
                options.append(cost[i] + inside * (gap.bit_count() - 1))
        cost.append(min(options) + penalties[j - 1])
    return cost[-1]


def cost_of(ends: list[int], places: list[int], penalties: list[int], window: int, inside: int) -> int:
    charge = dict(zip(places, penalties))
    return sum(padding(b - a, window) for a, b in itertools.pairwise([0, *ends])) + sum(charge.get(end, inside) for end in ends)


@pytest.mark.parametrize("last", [False, True])
def test_cuts_are_the_cheapest(last):
    rng = random.Random(7)
    for _ in range(150):
        window, brims = rng.choice([16, 32]), rng.choice([0, 1, 2])
        places = list(itertools.accumulate(rng.randrange(1, window + 1) if rng.random() < 0.2 else rng.randrange(1, 6) for _ in range(rng.randrange(1, 60))))
        penalties = [rng.choice([0, 2, 3]) for _ in places[:-1]] + [0]
        ends = packing.sequence_ends(places, penalties, window, 5, brims, last)
        assert ends[-1] == places[-1] and all(0 < b - a <= window for a, b in itertools.pairwise([0, *ends]))
        # A rest of a power of two behind a full sequence costs less than the plan counts.
        assert cost_of(ends, places, penalties, window, 5) <= plain_cost(places, penalties, window, 5, brims, last)
        if brims == 0 and not last:
            assert cost_of(ends, places, penalties, window, 5) == plain_cost(places, penalties, window, 5, brims, last)


def sequences(pieces, texts: dict[object, list[str]], vocabulary: str) -> dict[int, int]:
    """Checks that all tokens lie in exactly one place; the size of each sequence."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces.collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        assert [o for o, _ in sorted(places)] == [0, *itertools.accumulate(n for _, n in sorted(places))][:-1]
    assert set(by_doc) == set(texts)
    for doc_id, found in by_doc.items():
        wanted = Counter((at, token) for text in texts[doc_id] for at, token in enumerate(library_ids(vocabulary, text)))
        got = Counter()
        for r in found:
            ids = memoryview(bytes(r.ids)).cast("I").tolist()
            assert len(ids) == r.length > 0 and r.doc_tokens in {len(library_ids(vocabulary, t)) for t in texts[doc_id]}
            got.update((r.start + i, token) for i, token in enumerate(ids))
        assert got == wanted
    return {s: sum(n for _, n in places) for s, places in by_sequence.items()}


def test_pack_odd_texts(spark, vocabulary):
    docs = odd_documents(spark)
    texts = defaultdict(list)
    for row in docs.collect():
        texts[row.doc_id].append(row.text)
    for window in (1024, 64):
        assert max(sequences(packing.pack(docs, vocabulary, window), texts, vocabulary).values()) <= window
    assert packing.pack(empty_documents(spark), vocabulary).count() == 0


def test_pack_documents_with_little_padding(spark, vocabulary):
    path = "/root/testdata/sf0.01/documents.parquet"
    texts = {doc_id: [text] for doc_id, text in duckdb.sql(f"select doc_id, text from '{path}'").fetchall()}
    sizes = sequences(packing.pack(spark.read.parquet(path), vocabulary), texts, vocabulary).values()
    assert sum(padding(size, 1024) for size in sizes) < 0.01 * sum(sizes)


def test_ranks_give_the_ids_of_the_library(vocabulary):
    encoder = packing.Encoder(vocabulary)
    assert encoder.by_rank
    signs = [f"a{chr(c)}b {chr(c)} 1{chr(c)}2 {chr(c)}{chr(c)}-{chr(c)}" for c in [*range(0, 0xD800, 7), *range(0xE000, 0x110000, 997)]]
    texts = [*signs, "it's we'LL <|endoftext|>x", "a" + " " * 3000 + "b\n\n\n c", "\r\n\x85\xa0 x", ""]
    found = encoder.library.encode_batch(texts, add_special_tokens=False)
    assert [one.ids for one in found] == [encoder.ids(text).tolist() for text in texts]


def test_odd_white_space_gives_the_ids_of_the_library(vocabulary):
    encoder = packing.Encoder(vocabulary)
    rng = random.Random(8)
    pieces = [" ", "  ", "   ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "word", "Word,", "'s", "'", "12", "3.5", "é", "\U0001f600", "-", "(", "a" * 60]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(6000)]
    found = encoder.library.encode_batch(texts, add_special_tokens=False)
    assert [one.ids for one in found] == [encoder.ids(text).tolist() for text in texts]
    long = " ".join(texts)
    assert encoder.library.encode(long, add_special_tokens=False).ids == encoder.ids(long).tolist()


def test_other_files_go_through_the_library():
    encoder = packing.Encoder(packing.read_tokenizer(public_tokenizers.path("word_bpe_49k.json")))
    assert not encoder.by_rank
    assert encoder.ids("Some words. More").tolist() == encoder.library.encode("Some words. More", add_special_tokens=False).ids


def test_sentences_and_documents_are_cut_last(vocabulary):
    encoder = packing.Encoder(vocabulary)
    ids = encoder.ids("One two. Three 3.14 four! Five\nsix")
    ends = [encoder.library.decode(ids[:end].tolist()) for end in encoder.sentence_ends(ids, 1)]
    assert encoder.sentence_ends(ids, 100).tolist() == [encoder.sentence_ends(ids, 1)[-1]] and not len(encoder.sentence_ends(ids[:1]))
    assert ends == ["One two.", "One two. Three 3.14 four!", "One two. Three 3.14 four! Five\n"]

"""Chat formatting and mixing against plain versions."""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter

from helpers import SF, empty_documents, odd_documents, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerspan.llm import chat_format, mixing, queries


def records(spark, *items):
    return spark.createDataFrame([(json.dumps(x),) for x in items], "r string").select(F.parse_json("r").alias("record"))


def conversations(df):
    found = {}
    for r in df.collect():
        found.setdefault((r.conv_id, r.layout), []).append((r.turn, r.role, r.text))
    return {k: [x[1:] for x in sorted(v, key=lambda x: (x[0] is not None, x))] for k, v in found.items()}


def test_layouts_give_the_same_turns(spark):
    turns = [("user", "hi"), ("assistant", "yo")]
    rows = [
        {"conv_id": 1, "messages": [{"role": r, "content": t} for r, t in turns]},
        {"conv_id": 2, "conversations": [{"value": "hi", "from": "human"}, {"from": "gpt", "value": "yo"}]},
        {"completion": "yo", "conv_id": 3, "prompt": "hi"},
        {"conv_id": 4, "instruction": "hi", "output": "yo"},
        {"conv_id": 5, "turn": 1, "role": "assistant", "text": "yo"},
        {"conv_id": 5, "turn": 0, "role": "user", "text": "hi"},
        {"conv_id": 6, "instruction": "hi", "input": None, "output": "yo"},
        {"conv_id": 7, "system": "s", "prompt": "hi", "completion": None},
        {"conv_id": 8, "strange": {"deep": [1, 2]}},
    ]
    got = conversations(chat_format.canonical_turns(records(spark, *rows)))
    assert [got[k] for k in ((1, "messages"), (2, "shared"), (3, "prompt"), (4, "instruction"), (5, "turn"))] == [turns] * 5
    assert got[(6, "instruction_input")] == [("user", "hi"), ("user", ""), ("assistant", "yo")]
    assert got[(7, "system_prompt")] == [("system", "s"), ("user", "hi"), ("assistant", "")]
    assert got[(8, None)] == [(None, None)]


def test_odd_records(spark):
    rows = records(spark, {"conv_id": 1, "turn": None, "role": None, "text": None}, {"conv_id": None, "prompt": "a", "completion": "b"})
    rows = rows.unionByName(spark.range(1).select(F.lit(None).cast("variant").alias("record")))
    found = {r.conv_id: r for r in chat_format.format_digest(rows).collect()}
    assert found[1].n_turns == 1 and found[1].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert found[None].n_turns == 2 and found[None].loss_chars == 1
    assert chat_format.format_digest(rows.where("false")).count() == 0


CONTROL = st.lists(st.sampled_from(["<", "|", "\\", "turn", "text", "end", ">", "<|end|>", "<|turn|>", "<\\|", "\n", "é", "\U0001f600", "$1", " "]), max_size=8).map("".join)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(CONTROL, CONTROL), min_size=1, max_size=30))
def test_formatted_text_is_reversible(spark, turns):
    rows = spark.createDataFrame([(1, "turn", i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, layout string, turn long, role string, text string")
    out = chat_format.format_turns(rows).select("pieces", chat_format.formatted(F.col("pieces")).alias("text"))
    row = out.select("text", chat_format.read_back(F.col("text")).alias("turns")).first()
    assert [tuple(t) for t in row.turns] == turns
    assert row.text.count("<|") == 3 * len(turns)


def test_digest_of_the_test_table(spark):
    plain = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        plain.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    odd = queries.ODD_TURN
    plain[-7] = [(0, "user", odd), (1, "assistant", odd)]
    want = []
    for conv, turns in plain.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        want.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    got = queries.op7_chat_format(spark, SF)
    assert rows_of(got, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(want, key=repr)


def earliest_deadline_first(parts):
    """The slots of a cycle, one after the other."""
    slots, done, order = sum(parts), [0] * len(parts), []
    for t in range(slots):
        able = [(-(-(d + 1) * slots // p), i) for i, (d, p) in enumerate(zip(done, parts)) if d < p and d * slots // p <= t]
        due, i = min(able)
        assert t < due
        done[i] += 1
        order.append(i)
    return order


def mixed(docs, **more):
    rows = mixing.mix(docs, **more).select("_row.*", "_source", "_block", "_slot", "_position").collect()
    return sorted(rows, key=lambda r: r._position)


def test_mixed_order_keeps_weights(spark):
    sizes = {"a": 700, "b": 200, "c": 100}
    docs = spark.createDataFrame([(f"{s}{i}", s) for s, n in sizes.items() for i in range(n)], "doc_id string, source string")
    rows = mixed(docs, weights={"a": 5, "b": 3, "c": 2}, block=4, slots=20, rows_per_task=16)
    assert [r._position for r in rows] == list(range(1000)) and len({r.doc_id for r in rows}) == 1000
    parts = mixing.slot_parts({"a": 5, "b": 3, "c": 2}, 20)
    order = earliest_deadline_first([parts[s] for s in "abc"])
    blocks = rows[::4]
    until = next(i for i, r in enumerate(blocks) if r._slot != i)  # the first source has run out
    assert until >= 100 // 4 * 20 // parts["c"] - 20
    done = Counter()
    for t, r in enumerate(blocks[:until]):
        assert r._source == "abc"[order[t % 20]]
        done[r._source] += 1
        assert all(abs(done[s] - (t + 1) * parts[s] / 20) < 1 for s in "abc")
    hashed = {s: sorted((hashlib.md5(f"{s}{i}".encode()).hexdigest(), f"{s}{i}") for i in range(n)) for s, n in sizes.items()}
    for s in sizes:
        assert [r.doc_id for r in rows if r._source == s] == [d for _, d in hashed[s]]


def test_default_weights_and_all_sources(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixed(docs.select("doc_id", "source"))
    counts = Counter(r.source for r in docs.select("source").collect())
    parts = mixing.slot_parts({s: n**0.5 for s, n in counts.items()})
    assert sum(parts.values()) == mixing.SLOTS
    names = sorted(parts)
    order = earliest_deadline_first([parts[s] for s in names])
    seen = Counter()
    slot_of = {}
    for t in range(5 * mixing.SLOTS):
        s = names[order[t % mixing.SLOTS]]
        slot_of[s, seen[s]] = t
        seen[s] += 1
    assert all(slot_of[r._source, r._block] == r._slot for r in rows)
    assert [r._slot for r in rows] == sorted(r._slot for r in rows)


def test_odd_rows_are_mixed_too(spark):
    odd = odd_documents(spark)
    rows = mixed(odd, block=2)
    assert [r._position for r in rows] == list(range(odd.count()))
    names = odd.columns
    assert sorted((tuple(r)[: len(names)] for r in rows), key=repr) == rows_of(odd)
    assert mixing.mix(empty_documents(spark)).count() == 0


def test_slot_parts():
    assert mixing.slot_parts({"a": 1, "b": 1e-9}, 10) == {"a": 9, "b": 1}
    assert sum(mixing.slot_parts({str(i): math.pi**i for i in range(7)}, 1000).values()) == 1000


def deviation(rows, weights, block):
    """The largest distance, in blocks, of any source from its weight while all sources last."""
    order, left, worst = [r._source for r in rows[::block]], Counter(r._source for r in rows), 0.0
    total, done = sum(weights.values()), Counter()
    for t, s in enumerate(order):
        if any(done[x] * block >= n for x, n in left.items()):
            break
        done[s] += 1
        worst = max(worst, *(abs(done[x] - (t + 1) * w / total) for x, w in weights.items()))
    return worst, t


def test_given_weights_hold_over_many_cycles(spark):
    weights = {"hot": 0.6} | {f"s{i:02}": 0.4 / 19 for i in range(19)}
    sizes = {s: round(20_000 * w) + 16 for s, w in weights.items()}
    docs = spark.createDataFrame([(f"{s}-{i}", s) for s, n in sizes.items() for i in range(n)], "doc_id string, source string")
    rows = mixed(docs, weights=weights, block=2, slots=100, rows_per_task=500)
    assert [r._position for r in rows] == list(range(sum(sizes.values()))) and len({r.doc_id for r in rows}) == len(rows)
    assert [r._slot for r in rows] == sorted(r._slot for r in rows)
    worst, slots = deviation(rows, weights, 2)
    assert slots > 90 * 100 and worst < 1


def test_unrounded_schedule_stays_within_a_block():
    for weights in ([0.6] + [0.4 / 19] * 19, [1 / (i + 1) ** 1.7 for i in range(40)], [math.pi**-i for i in range(20)]):
        total, done = sum(weights), [0] * len(weights)
        for t, (i, k, slot, _) in zip(range(30_000), mixing.schedule(weights, [10**9] * len(weights), 16)):
            assert slot == t and k == done[i]
            done[i] += 1
            assert all(abs(d - (t + 1) * w / total) < 1 + 1e-6 for d, w in zip(done, weights))


def test_weights_of_the_pipeline_are_not_rounded(spark):
    sizes = {"big": 9000} | {f"s{i:02}": 60 for i in range(19)}
    docs = spark.createDataFrame([(f"{s}-{i}", s) for s, n in sizes.items() for i in range(n)], "doc_id string, source string")
    rows = mixed(docs, block=1, slots=None)
    assert deviation(rows, {s: n**0.5 for s, n in sizes.items()}, 1)[0] < 1 + 1e-6


def test_more_sources_than_slots(spark):
    docs = spark.range(3500).selectExpr("cast(id as string) as doc_id", "concat('site', id % 1201) as source")
    rows = mixed(docs)
    assert [r._position for r in rows] == list(range(3500)) and len({r.doc_id for r in rows}) == 3500
    assert len({r.source for r in rows}) == 1201

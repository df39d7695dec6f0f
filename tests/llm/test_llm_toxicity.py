"""Nearest labelled examples: exactness of the index, and quality on rows that were held out."""

from __future__ import annotations

from collections import Counter

import numpy as np
from helpers import ODD_TEXTS, empty_documents, is_held_out, odd_documents

from ledgerspan.llm import toxicity
from ledgerspan.llm.common import table

LARGER = "/root/testdata/sf0.1"


def test_index_finds_what_a_full_scan_finds():
    pick = np.random.default_rng(9)
    for _ in range(60):
        terms, n = int(pick.integers(2, 12)), int(pick.integers(1, 90))
        dense = pick.random((n, terms)) * (pick.random((n, terms)) < 0.4)
        dense = dense[dense.any(axis=1)]
        if not len(dense):
            continue
        dense /= np.linalg.norm(dense, axis=1, keepdims=True)
        vectors = [(np.flatnonzero(x), x[x > 0]) for x in dense]
        index = toxicity.Index.build(vectors, np.zeros(len(dense)), np.arange(len(dense)), terms, block=8)
        for _ in range(10):
            query = pick.random(terms) * (pick.random(terms) < 0.5)
            if not query.any():
                continue
            ids = np.flatnonzero(query)
            best, score = index.nearest(ids, query[ids], 5)
            exact = dense @ query
            want = [i for i in np.lexsort((np.arange(len(exact)), -exact))[:5] if exact[i] > 0]
            assert np.allclose(score, exact[want]) and np.allclose(exact[best], exact[want])


def test_terms_and_matcher_agree():
    settings = toxicity.Settings()
    text = "Stupidity, stupid! STUPID9stupid unstupid été Étés stup" + " moron" * 4
    terms = sorted(toxicity._terms_of(text, settings))
    found = toxicity.Matcher(terms, settings.repeats).counts(text)
    assert set(found) == set(range(len(terms)))
    at = {t: found[i] for i, t in enumerate(terms)}
    assert at["stupid "] == 3 and at["stup"] == 5 and at["stup "] == 1 and at["moron 4"] == 1 and at["moron "] == 4 and "moro4" in at
    assert not toxicity.Matcher([], settings.repeats).counts(text)


def test_long_texts_are_read_in_pieces(monkeypatch):
    settings = toxicity.Settings()
    text = "one stupid word, and another. " * 50
    whole = toxicity._terms_of(text, settings)
    matcher = toxicity.Matcher(sorted(whole), settings.repeats)
    counts = matcher.counts(text)
    monkeypatch.setattr(toxicity, "_PIECE", 11)
    assert toxicity._terms_of(text, settings) == whole and matcher.counts(text) == counts


def test_held_out_toxic_documents_are_found(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    model = toxicity.learn(docs, labels)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.score(docs, model).collect() if r.doc_id in truth]
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if is_held_out(d)}
    found = Counter((truth[r.doc_id], r.predicted) for r in held)
    assert found[1, 1] >= 0.75 * (found[1, 0] + found[1, 1])
    assert found[0, 1] <= 0.01 * (found[0, 0] + found[0, 1])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(not is_held_out(d) for r in rows for d in r.evidence)


def test_many_toxic_words(spark):
    """No number of words is too many: each of 400 marks some rows, and rows that were held out are found by them."""
    pick = np.random.default_rng(4)
    spell = lambda n: "".join(chr(97 + n // 26**k % 26) for k in range(4))
    common, marks = ["w" + spell(int(n)) for n in pick.choice(26**4, 300, False)], ["z" + spell(37 * n) + "q" for n in range(400)]
    rows = []
    for i in range(16_000):
        words = [common[n] for n in pick.integers(0, 300, 30)]
        if i % 2:
            for mark in pick.choice(400, 2, False):
                words[int(pick.integers(0, 30))] = marks[mark]
        rows.append((i, " ".join(words), i % 2))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8)
    got = toxicity.score(frame, toxicity.learn(frame, frame)).where("held_out").select("doc_id", "predicted").collect()
    found = Counter((r.doc_id % 2, r.predicted) for r in got)
    assert found[1, 1] >= 0.9 * (found[1, 0] + found[1, 1])
    assert found[0, 1] <= 0.01 * (found[0, 0] + found[0, 1])


def test_odd_rows(spark):
    toxic = spark.createDataFrame([(100 + i, "you stupid moron you trash" if i % 2 else "a fine day to walk") for i in range(60)], "doc_id long, text string")
    labels = toxic.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic").unionByName(
        spark.createDataFrame([(None, 1), (100, None), (7, None)], "doc_id long, toxic int")
    )
    model = toxicity.learn(toxic, labels)
    rows = toxicity.score(odd_documents(spark), model).collect()
    assert len(rows) == len(ODD_TEXTS) and not any(r.predicted for r in rows)
    again = {r.doc_id: r for r in toxicity.score(toxic, model).collect()}
    assert all(r.predicted == d % 2 for d, r in again.items())
    assert toxicity.score(empty_documents(spark), model).count() == 0


def test_learning_from_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(empty_documents(spark), labels)
    assert not model.terms and {r.predicted for r in toxicity.score(odd_documents(spark), model).collect()} == {0}


def test_equal_examples_all_vote():
    terms = ("alpha ", "beta ", *(f"other{c} " for c in "abcdefg"))
    clean = (np.array([0, 1]), np.full(2, 2**-0.5))
    vectors = [*((np.array([0, 1, 2 + i]), np.full(3, 3**-0.5)) for i in range(7)), clean]
    index = toxicity.Index.build(vectors, [1.0] * 7 + [0.0], list(range(8)), len(terms), 4, [1] * 7 + [300])
    model = toxicity.Model(terms, np.ones(len(terms)), index, 0.02, 0.0)
    value, evidence, cosines = toxicity.vote(model, "alpha beta")
    assert value < 0.01 and evidence == [7] and np.allclose(cosines, 1)
    few = toxicity.Index.build(vectors, [1.0] * 7 + [0.0], list(range(8)), len(terms), 4, [1] * 7 + [3])
    best, score = few.nearest(*clean, 8)
    assert best.tolist() == [7, 0, 1, 2, 3, 4] and np.allclose(score, [1] + [(2 / 3) ** 0.5] * 5)

"""N-gram join, embedding near-duplicates and components against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import CLASHING, ODD_TEXTS, empty_documents, groups, near_groups, odd_documents, rows_of, shingles

from ledgerspan.llm import embedding_dedup, ngram_join
from ledgerspan.llm.components import components


def near_texts(seed: int, n: int) -> list[str]:
    """Originals, copies with few or many changed words, shared passages, and short texts."""
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = pick.choices(words, k=30)
    texts: list[list[str]] = []
    for _ in range(n):
        kind = pick.random()
        if kind < 0.35 or not texts:
            text = pick.choices(words, k=pick.choice([1, 3, 4, 5, 6, 20, 80]))
        elif kind < 0.85:
            text = list(pick.choice(texts))
            for _ in range(pick.randrange(1 + len(text) // 15)):
                text[pick.randrange(len(text))] = pick.choice(words)
        else:
            text = pick.choices(words, k=pick.choice([5, 10, 40])) + passage
        texts.append(text)
    return [pick.choice([" ", "\n", " \t"]).join(t) if pick.random() < 0.8 else " ".join(t).upper() for t in texts]


def expected(ids, texts):
    sizes, roots = near_groups(texts)
    least = {}
    for doc_id, root in zip(ids, roots):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted(((d, n, least.get(r)) for d, n, r in zip(ids, sizes, roots)), key=repr)


@pytest.mark.parametrize("settings", [ngram_join.Settings(), ngram_join.Settings(bits=10, bands=1, hot=4, salts=3, members=2, probes=3)])
def test_ngram_join_matches_all_pairs(spark, settings):
    texts = near_texts(11 if settings.bands > 1 else 12, 350)
    ids = [3 * i + 1 for i in range(len(texts))]
    random.Random(1).shuffle(ids)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(7)
    want = expected(ids, texts)
    assert len({c for _, _, c in want}) < 300
    assert rows_of(ngram_join.ngram_join(docs, settings), "doc_id", "n_shingles", "component_id") == want


def test_ngram_join_of_odd_rows(spark):
    got = rows_of(ngram_join.ngram_join(odd_documents(spark)), "doc_id", "n_shingles", "component_id")
    assert got == expected([r[0] for r in ODD_TEXTS], [r[1] for r in ODD_TEXTS])
    assert ngram_join.ngram_join(empty_documents(spark)).count() == 0


def test_one_of_each_component_stays(spark):
    odd = odd_documents(spark)
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns
    # 6 and the row without id are copies of 5, 8 of 7, 10 is near 9; texts without words all stay.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "7", "9", "11", "12", "13", "14", "None"])


def test_prefix_tree_finds_what_plain_overlap_finds():
    pick = np.random.default_rng(2)
    for _ in range(150):
        universe = np.arange(1, pick.integers(5, 400), dtype=np.uint64)
        anchor = np.sort(pick.choice(universe, size=pick.integers(1, len(universe) + 1), replace=False))
        sets = []
        for _ in range(pick.integers(1, 25)):
            mask = np.isin(universe, anchor) ^ (pick.random(len(universe)) < pick.choice([0, 0.02, 0.1, 0.3]))
            if mask.any():
                sets.append(universe[mask])
        sets += sets[:3]
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, anchor)) >= 75 * len(np.union1d(s, anchor))]
        tree = ngram_join.PrefixTree(sets)
        assert sorted(tree.linked(anchor)) == want
        assert len(tree.linked(anchor, first_only=True)) == min(len(want), 1) and set(tree.linked(anchor, first_only=True)) <= set(want)


def test_shingle_pieces_change_nothing(monkeypatch):
    text = "Alpha beta\tgamma\x0bdelta epsilon zeta eta theta iota " * 40
    whole = ngram_join.shingle_set(text)
    monkeypatch.setattr(ngram_join, "_PIECE", 13)
    assert (ngram_join.shingle_set(text) == whole).all() and len(whole) == len(shingles(text))


def test_components_of_long_chains_and_stars(spark):
    pick = random.Random(4)
    links = [(i, i + 1) for i in range(0, 120)] + [(500, 501 + i) for i in range(60)] + [(700, 700)]
    pick.shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long")
    roots = {r.node: r.root for r in components(frame).collect()}
    want = groups(800, links)
    assert roots == {i: r for i, r in enumerate(want) if r != i}
    assert components(frame.where("false")).count() == 0


def plain_links(rows):
    ids = [r[0] for r in rows]
    usable = [r[2] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.98:
                    links.append((i, j))
    roots = groups(len(rows), links)
    least = {}
    for doc, root in zip(ids, roots):
        if doc is not None:
            least[root] = min(least.get(root, doc), doc)
    return [(v, sum(k in link for link in links), least.get(roots[k]), v == least.get(roots[k])) for k, v in enumerate(ids)]


@pytest.mark.parametrize("tile", [1024, 7])
def test_embeddings_match_all_pairs(spark, tile):
    pick = np.random.default_rng(7)
    rows = []
    for k in range(140):
        if rows and pick.random() < 0.6:
            base = np.array(rows[pick.integers(len(rows))][1])
            vector = base + pick.normal(size=12) * pick.choice([0, 0.01, 0.05, 0.07]) * np.linalg.norm(base) / 3
        else:
            vector = pick.normal(size=12) * pick.choice([1e-3, 1, 50])
        rows.append((1000 - k, [float(np.float32(x)) for x in vector], int(pick.integers(3))))
    rows += [
        (1, None, 0), (2, [0.0] * 12, 0), (3, [float("nan")] + [1.0] * 11, 0), (4, [float("inf")] * 12, 0), (5, [None] + [1.0] * 11, 0),
        (6, [1.0] * 12, None), (7, [1.0] * 12, 2), (7, [1.0] * 12, 2), (8, [2.0] * 12, 2), (9, [1.0] * 5, 2), (10, [2.0] * 5, 2), (11, [], 1),
    ]
    frame = spark.createDataFrame([(*r, *[None] * 10) for r in rows], f"vec_id long, embedding array<float>, label int, {CLASHING.replace('label string', 'key string')}")
    got = rows_of(embedding_dedup.near_duplicates(frame.repartition(5), embedding_dedup.Settings(tile=tile, steps=(2, 5), boxed=3)))
    assert got == sorted(plain_links(rows), key=repr)
    assert embedding_dedup.near_duplicates(frame.where("false")).count() == 0


def test_a_vector_without_id(spark):
    frame = spark.createDataFrame([(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (None, None, 1)], "vec_id long, embedding array<float>, label int")
    got = rows_of(embedding_dedup.near_duplicates(frame))
    assert got == sorted([(None, 1, 5, False), (5, 1, 5, True), (None, 0, None, True), (None, 0, None, True)], key=repr)

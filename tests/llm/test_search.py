import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import documents, odd_rows, words
from tidemill.llm import search
from tidemill.llm.search import Tree, rank_documents, walk

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    held = [(k, Counter(terms(t))) for k, t in docs if terms(t)]
    total, count = sum(sum(c.values()) for _, c in held), len(held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c in held:
            m = 25 + (75 * sum(c.values()) * count) // total
            s = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text) if c[t]
            )
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out += [(item, r, key, -s) for r, (s, _, _, key) in enumerate(sorted(scored)[:top], 1)]
    return sorted(map(str, out))


def got(spark, docs, items):
    found = rank_documents(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string, key int, rank int"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(str(tuple(r)) for r in found.collect())


@pytest.mark.parametrize("cells", [1 << 22, 600])
def test_equal_to_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(search, "CELLS", cells)
    draw = random.Random(3)
    vocabulary = words(1, 60).split() + ["Été", "naïve", "the", "THE", "a1", "x-y", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(draw.choices(vocabulary, weights, k=draw.randint(1, 80)))) for i in range(300)]
    docs += odd_rows()
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # ties
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(1, 12))), 0, 0) for i in range(30)]
    items += [(100, None, 0, 0), (101, "", 0, 0), (102, "nowhere !?", 0, 0), (103, "the the the THE", 0, 0), (None, "the", 0, 0)]
    assert got(spark, [d[:2] for d in docs], items) == brute([d[:2] for d in docs], [i[:2] for i in items])


def test_items_in_blocks_and_repeated_items(spark, monkeypatch):
    monkeypatch.setattr(search, "ITEM_BYTES", 10)
    docs = [(i, words(i % 7, 30)) for i in range(50)]
    items = [(1, words(3, 5), 0, 0), (1, words(4, 5), 0, 0), (2, words(5, 4), 0, 0), (2, words(5, 4), 0, 0)]
    assert got(spark, docs, items) == brute(docs, [i[:2] for i in items[:3]])


def test_empty_tables(spark):
    assert got(spark, [], [(1, "the", 0, 0)]) == []
    assert got(spark, [(1, "the")], []) == []


def test_subtrees_under_the_tenth_score_are_left_out():
    draw = np.random.default_rng(1)
    tf = (draw.random((4000, 40)) < np.linspace(0.9, 0.02, 40)) * draw.integers(1, 5, (4000, 40))
    tree = Tree(tf, draw.integers(25, 200, 4000))
    assert sorted(r for rows in tree.own for r in rows) == list(range(4000))
    assert len(tree.low) > 100
    scored = []
    whole = search.scores
    columns, weight = np.array([3, 25, 38, 39]), np.array([10, 500, 3000, 3500])
    try:
        search.scores = lambda *a: scored.append(len(a[0])) or whole(*a)
        found = walk(tree, columns, weight, 0, [])
    finally:
        search.scores = whole
    best = np.sort(whole(tree.tf[:, columns], tree.m, weight))[::-1][:10]
    assert sorted((s for s, _ in found), reverse=True)[:10] == best.tolist()
    assert sum(scored) - len(tree.low) < 2000  # of 4,000 documents

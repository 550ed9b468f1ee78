import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import documents, odd_rows, words
from tidemill.llm import pitmanyor
from tidemill.llm.pitmanyor import END, pack, score_texts, seat, unpack

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), END]


class Restaurant:
    """Seats its customers one by one, with the sizes of all tables; a table is a customer of
    the parent, which is another restaurant or a probability."""

    def __init__(self, d, strength, parent, draw):
        self.d, self.s, self.parent, self.draw = d, strength, parent, draw
        self.sizes, self.c, self.t = defaultdict(list), 0, 0

    def above(self, w):
        return self.parent.chance(w) if isinstance(self.parent, Restaurant) else self.parent

    def chance(self, w):
        own = sum(self.sizes[w]) - self.d * len(self.sizes[w]) if w in self.sizes else 0
        return (own + (self.s + self.d * self.t) * self.above(w)) / (self.s + self.c)

    def add(self, w):
        tables = self.sizes[w]
        weights = [n - self.d for n in tables] + [(self.s + self.d * self.t) * self.above(w)]
        k = self.draw.choices(range(len(weights)), weights)[0]
        if k == len(tables):
            tables.append(0)
            self.t += 1
            if isinstance(self.parent, Restaurant):
                self.parent.add(w)
        tables[k] += 1
        self.c += 1

    def remove(self, w):
        tables = self.sizes[w]
        k = self.draw.choices(range(len(tables)), tables)[0]
        tables[k] -= 1
        self.c -= 1
        if not tables[k]:
            del tables[k]
            self.t -= 1
            if isinstance(self.parent, Restaurant):
                self.parent.remove(w)


def by_single_customers(learnt, texts, d, root_d, sweeps=60):
    """Scores by plain Gibbs sampling, one customer after the other."""
    draw = random.Random(1)
    size = len({w for t in learnt for w in tokens(t)})
    root = Restaurant(root_d, 1.0, 1 / (size + 1), draw)
    contexts = defaultdict(lambda: Restaurant(d, 1.0, root, draw))
    customers = [(u, w) for t in learnt for u, w in zip([END, *tokens(t)], tokens(t))]
    for u, w in customers:
        contexts[u].add(w)
    sums = Counter()
    for sweep in range(sweeps):
        for u, w in customers:
            contexts[u].remove(w)
            contexts[u].add(w)
        if sweep >= sweeps // 3:
            for k, t in enumerate(texts):
                for i, (u, w) in enumerate(zip([END, *tokens(t)], tokens(t))):
                    sums[k, i] += (contexts[u].chance(w) if u in contexts else root.chance(w)) / (sweeps - sweeps // 3)
    scores = [0.0] * len(texts)
    for (k, _), p in sums.items():
        scores[k] += math.log10(p)
    return scores


def test_close_to_gibbs_by_single_customers(spark, monkeypatch):
    monkeypatch.setattr(pitmanyor, "BLOCK", 3000)
    monkeypatch.setattr(pitmanyor, "HOT", 100)
    monkeypatch.setattr(pitmanyor, "PART", 1000)
    draw = random.Random(2)
    vocabulary = words(7, 60).split()

    def text(n):
        out = [draw.choice(vocabulary)]
        for _ in range(n):
            out.append(vocabulary[(vocabulary.index(out[-1]) * 7 + draw.choice([0, 0, 0, 1, 1, 2, draw.randint(0, 59)])) % 60])
        return " ".join(out)

    rare = words(8, 60).split()
    texts = [f"{text(draw.randint(5, 60))} {draw.choice(rare)} {text(3)}" for i in range(120)] + ["unknown words only", vocabulary[0] + " unknown", ""]
    rows = [(i, t) for i, t in enumerate(texts)]
    learnt = [t for i, t in rows if i % 3 and t]
    found = score_texts(documents(spark, rows), (F.col("doc_id") % 3 != 0) & (F.col("text") != ""))
    got = {r.doc_id: r for r in found.collect()}
    pairs = Counter((u, w) for t in learnt for u, w in zip([END, *tokens(t)], tokens(t)))
    singles = Counter(w for t in learnt for w in tokens(t))
    n = Counter(pairs.values())
    m = Counter(singles.values())
    d = n[1] / (n[1] + 2 * n[2])
    root_d = min(0.95, max(0.05, m[1] / (m[1] + 2 * m[2]))) if m[1] else 0.05
    expected = by_single_customers(learnt, texts, d, root_d)
    off = np.array([got[i].score - e for i, e in enumerate(expected)])
    length = np.array([len(tokens(t)) for t in texts])
    # log10 a token: both are samples, and short texts vary more.
    assert np.abs(off / length)[:120].max() < 0.06 and np.abs(off / length)[:120].mean() < 0.01
    assert abs(off.sum() / length.sum()) < 0.003
    held = [i for i in range(0, 120, 3)]
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held) + 100


def brute_base(rows, learns):
    count = Counter(w for (_, t), x in zip(rows, learns) if x for w in tokens(t))
    total = sum(count.values())
    return [
        (k, len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), total,
         sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in tokens(t)))
        for k, t in rows
    ]


@pytest.mark.parametrize("block", [16 << 20, 200])
def test_counts_and_base_scores(spark, monkeypatch, block):
    monkeypatch.setattr(pitmanyor, "BLOCK", block)
    monkeypatch.setattr(pitmanyor, "PART", block)
    rows = [r[:2] for r in odd_rows()] + [(20, "A a Ä ä\x0bb\x85c　d"), (21, "\x00 \x00\x00 a")]
    learns = [k is None or k % 2 == 0 for k, _ in rows]
    found = score_texts(documents(spark, rows), F.col("doc_id") % 2 == 0)
    assert found.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted(found.collect(), key=str)
    expected = sorted(brute_base(rows, learns), key=str)
    assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(str(r[:4]) for r in expected)
    assert np.allclose(sorted(r.base_score for r in got), sorted(r[4] for r in expected), rtol=1e-12)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    again = sorted(score_texts(documents(spark, rows), F.col("doc_id") % 2 == 0).collect(), key=str)
    assert got == again


def test_empty_table_and_nothing_to_learn_from(spark):
    assert score_texts(documents(spark, []), F.lit(True)).collect() == []
    got = score_texts(documents(spark, [(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]


def exact_tables(c, other, parent, gain, d):
    """Probabilities of 1, 2, ... tables."""
    p = np.zeros(c + 1)
    p[1] = 1.0
    for i in range(1, c):
        t = np.arange(c + 1)
        p = p * np.maximum(i - d * t, 0) + np.concatenate([[0], (p * (other + d * t) * (parent + gain * t))[:-1]])
        p /= p.sum()
    return p


@pytest.mark.parametrize(
    "c, other, parent, gain, d",
    [(2, 5.0, 0.1, 0.0, 0.6), (9, 40.0, 0.05, 0.001, 0.7), (80, 300.0, 0.02, 1e-4, 0.7), (400, 2.0, 0.01, 0.0, 0.5), (500, 50.0, 0.05, 0.0, 0.3), (33, 9.0, 0.02, 0.001, 0.85), (12, 9.0, 0.02, 0.001, 0.85)],
)
def test_seating_has_the_conditional_distribution(c, other, parent, gain, d):
    n = 20000
    t = seat(np.full(n, float(c)), np.full(n, other), np.full(n, parent), gain, d, np.random.default_rng(4))
    got = np.bincount(t.astype(int), minlength=c + 1)[: c + 1] / n
    expected = exact_tables(c, other, parent, gain, d)
    assert abs(got @ np.arange(c + 1) - expected @ np.arange(c + 1)) < 0.03 * (expected @ np.arange(c + 1))
    assert np.abs(got - expected).sum() < 0.08


def test_packed_arrays():
    for x in ([], [0], [255, 0], [256, 70000], [2**40, 1], [2**63, 5]):
        assert unpack(pack(np.array(x, np.uint64))).astype(np.uint64).tolist() == x
    assert unpack(pack(np.array([0.5, -2.0]))).tolist() == [0.5, -2.0]

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import documents, odd_rows, words
from tidemill.llm import runindex


def covered(texts, length):
    """Brute force: bytes in strings that start more than once."""
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                mark[i : i + length] = True
        out.append(mark)
    return out


def ranges(mark):
    edge = np.flatnonzero(np.diff(np.r_[False, mark, False]))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))




@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"abab", b"\0\0\0", b"xyz" * 9, b"b" * 20, b"q"]), max_size=6), max_size=8))
def test_marks_are_those_of_brute_force(parts):
    texts = [b"".join(p) for p in parts]
    before, runindex.LENGTH = runindex.LENGTH, 12
    try:
        assert runindex.marked(texts) == [ranges(m) for m in covered(texts, 12)]
    finally:
        runindex.LENGTH = before


def test_runs_are_few_in_repetitive_texts():
    base = words(1, 200).encode()
    index = runindex.RunIndex([base + bytes([65 + i]) for i in range(20)])
    assert len(index.heads) < 0.2 * len(index.left)
    order = sorted(range(len(index.left)), key=lambda p: index.data[p : p + index.left[p]].tobytes())
    assert [index.data[p : p + index.left[p]].tobytes() for p in index.first] == [
        index.data[order[h] : order[h] + index.left[order[h]]].tobytes() for h in index.heads
    ]


def expected(rows):
    texts = [(r[1] or "").encode() for r in rows]
    return [(r[0], len(t), ranges(m), t[:0] + bytes(np.frombuffer(t, np.uint8)[~m])) for r, t, m in zip(rows, texts, covered(texts, 400))]


def got(df):
    return [(r[0], r.n_bytes, [(s.low, s.high) for s in r.spans], bytes(r.kept)) for r in runindex.remove_repeats(df).collect()]


def test_odd_rows(spark):
    rows = [r if r[0] not in (8, 9) else (r[0], r[1][:6000]) for r in odd_rows()]
    assert sorted(map(str, got(documents(spark, rows)))) == sorted(map(str, expected(rows)))


@pytest.mark.parametrize("task", [1_500_000, 2000])
def test_hot_anchors_are_split(spark, monkeypatch, task):
    """A passage with one change in each copy: all contexts differ."""
    monkeypatch.setattr(runindex, "TASK_BYTES", task)
    base = words(3, 150)
    rows = [(i, words(100 + i, 30) + base[: 20 * i] + "#" + base[20 * i + 1 :]) for i in range(20)]
    rows += [(50, "ab" * 600), (51, "x" + "ab" * 400)]
    assert sorted(map(str, got(documents(spark, rows)))) == sorted(map(str, expected(rows)))


def test_empty_table(spark):
    assert runindex.remove_repeats(documents(spark, []).limit(0)).count() == 0

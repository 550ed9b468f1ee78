import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.cases import documents, odd_rows, words
from tidemill.llm.mixing import flight, landing, mix_sources, take_copies


def shares(sizes: dict) -> dict:
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    rest = 1.5 * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        rest -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def check(rows, got, tolerance=None):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len([w for w in (text or "").translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w])
    target = shares(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], abs=1e-9)
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    for source, goal in target.items():
        if tolerance:
            assert abs(taken[source] - goal) <= tolerance * max(goal, 1)
    assert len(got) == len(rows)


def test_flight_keeps_both_sums():
    draw = np.random.default_rng(1)
    size = draw.integers(0, 400, 500)
    p = np.full(500, 0.37)
    flown = flight(p, size, draw)
    assert flown.sum() == pytest.approx(p.sum())
    assert (flown * size).sum() == pytest.approx((p * size).sum())
    assert ((flown > 1e-9) & (flown < 1 - 1e-9)).sum() <= 2
    landed = landing(flown, size)
    assert set(np.unique(landed)) <= {0.0, 1.0}
    assert abs((landed - flown) @ size) <= size.max()


@pytest.mark.parametrize("chunk", [2000, 7])
def test_targets_are_met(spark, chunk):
    draw = random.Random(4)
    sources = ["a", "b", "c", "d", "é", "Z", None]
    rows = [(i, words(i, draw.randint(0, 60)), sources[0 if i % 3 == 0 else i % 7]) for i in range(700)]
    df = documents(spark, rows)
    got = mix_sources(df, chunk=chunk).collect()
    check(rows, got, 0.01)
    assert sorted(got, key=str) == sorted(mix_sources(df.repartition(3), chunk=chunk).collect(), key=str)


def test_few_documents_of_unlike_sizes_meet_their_targets(spark):
    """A large document must not be what is left open."""
    draw = random.Random(8)
    rows = [(i, words(i, draw.choice([3, 8, 20, 60, 150, 400, 900, 3000])), "abc"[i % 3]) for i in range(90)]
    check(rows, mix_sources(documents(spark, rows)).collect(), 0.002)


def test_texts_move_once(spark, capsys):
    df = documents(spark, [(i, words(i, 5)) for i in range(20)])
    take_copies(df, mix_sources(df)).explain("formatted")
    plan = capsys.readouterr().out
    text = f"c{df.columns.index('text')}#"
    exchanges = [part for part in plan.split("\n\n") if " Exchange" in part.split("\n")[0] and text in part]
    assert len(exchanges) == 1


def test_rows_of_one_key_and_size(spark):
    rows = [(1, "a b c")] * 5 + [(1, "d e f")] * 4 + [(None, "g h i")] * 3 + [(2, "one two")]
    df = documents(spark, rows)
    mixed = mix_sources(df)
    kept = sorted(str(r.doc_id) for r in take_copies(df, mixed).collect())
    assert kept == sorted(str(r.doc_id) for r in mixed.collect() for _ in range(r.copies))
    assert take_copies(df.limit(0), mix_sources(df.limit(0))).count() == 0


def test_odd_rows(spark):
    rows = odd_rows()
    df = documents(spark, rows)
    mixed = mix_sources(df)
    got = mixed.collect()
    check(rows, got)
    taken = take_copies(df, mixed)
    assert taken.columns == df.columns
    assert taken.count() == sum(r.copies for r in got)


def test_empty_table(spark):
    assert mix_sources(documents(spark, []).limit(0)).count() == 0

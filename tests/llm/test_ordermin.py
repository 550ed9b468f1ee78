import random

from tests.llm.cases import documents, odd_rows, words
from tidemill.llm import ordermin
from tidemill.llm.ordermin import alignment, near_duplicates, shingles


def brute(rows):
    """Classes from all pairs, by the plainest alignment."""
    named = [(k, t or "") for k, t, *_ in rows if k is not None]
    keys = sorted({k for k, _ in named})
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    own = [(k, shingles(t).tolist(), " ".join(t.lower().split())) for k, t in named]
    for i, (a, s, x) in enumerate(own):
        for b, t, y in own[:i]:
            if x == y or (s and t and longest(s, t) / (len(s) + len(t) - longest(s, t)) >= 0.8):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: find(k) for k in keys}


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def edited(text, seed, changes):
    draw, parts = random.Random(seed), text.split()
    for _ in range(changes):
        parts[draw.randrange(len(parts))] = f"new{draw.randrange(1000)}"
    return " ".join(parts)


def test_alignment_is_the_longest_common_subsequence():
    base = words(1, 120)
    for i in range(30):
        other = edited(base, i, i // 4)
        if i % 3 == 0:
            half = other.split()
            other = " ".join([*half[40:60], *half[:40], *half[60:]])
        a, b = shingles(base), shingles(other)
        n = longest(a.tolist(), b.tolist())
        exact = n / (len(a) + len(b) - n)
        assert (alignment(a, b) >= 0.8) == (exact >= 0.8)
        if exact >= 0.8:
            assert alignment(a, b) == exact


def test_repeated_shingles_are_told_apart():
    hashes = shingles("a b c d e " * 6)
    assert len(set(hashes.tolist())) == len(hashes) == 26


def test_groups(spark):
    base = words(5, 200)
    rows = [(100 + i, edited(base, i, 3)) for i in range(25)]  # copies meet through the base
    rows += [(7, base), (8, base), (9, base.upper())]
    rows += [(300 + i, words(50 + i, 150)) for i in range(20)]
    half = words(6, 100)  # a shared passage is no near copy
    rows += [(400 + i, half + " " + words(80 + i, 100)) for i in range(10)]
    got = {r.doc_id: r for r in near_duplicates(documents(spark, rows)).collect()}
    assert {k: r.class_id for k, r in got.items()} == brute(rows)
    assert all(r.kept == (k == r.class_id) for k, r in got.items())


def test_short_texts(spark):
    rows = []
    for i in range(160):
        n = 8 + i % 17
        own = words(1000 + i, n).split()
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join([*own, "more"] if i % 2 else ["more", *own]))]
    got = {r.doc_id: r.class_id for r in near_duplicates(documents(spark, rows)).collect()}
    assert got == brute(rows)
    assert all(got[2 * i + 1] == 2 * i for i in range(160))


def test_stragglers_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ordermin, "BLOCK", 3)
    monkeypatch.setattr(ordermin, "PICKED", 1)  # buckets of texts that are not alike
    half = words(6, 60)
    rows = [(i, half + " " + edited(words(80 + i % 5, 60), i, i // 9)) for i in range(20)]
    got = {r.doc_id: r.class_id for r in near_duplicates(documents(spark, rows)).collect()}
    assert got == brute(rows)


def test_only_classes_meet_again(spark, monkeypatch):
    """Links of stragglers connect classes; what is connected already is not gone over again."""
    seen, plain = [], ordermin.components

    def components(links, purpose):
        seen.append({(r.a, r.b) for r in links.collect()})
        found = plain(links, purpose)
        seen.append({r.id for r in found.collect()})
        return found

    verified = ordermin.verified
    monkeypatch.setattr(ordermin, "BLOCK", 3)
    monkeypatch.setattr(ordermin, "components", components)
    # As if some members missed their centres.
    monkeypatch.setattr(ordermin, "verified", lambda *given: verified(*given).where("greatest(a, b) % 3 <> 0"))
    base = words(5, 200)
    rows = [(100 + i, edited(base, i, 3)) for i in range(25)] + [(200 + i, edited(words(9, 150), i, 2)) for i in range(9)]
    got = {r.doc_id: r.class_id for r in near_duplicates(documents(spark, rows)).collect()}
    assert got == brute(rows)
    _, settled, more, _ = seen
    assert settled and more and not settled & {x for link in more for x in link}


def test_odd_rows(spark):
    rows = [r if r[0] not in (8, 9) else (r[0], r[1][:3000] + str(r[0])) for r in odd_rows()]
    got = near_duplicates(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    expected = brute(rows)
    assert all(r.class_id == expected.get(r.doc_id) for r in got)
    assert sorted(r.doc_id for r in got if r.kept and r.doc_id is not None) == sorted(set(expected.values()))
    assert all(r.kept for r in got if r.doc_id is None)


def test_empty_table(spark):
    assert near_duplicates(documents(spark, []).limit(0)).count() == 0

import hashlib

from tests.llm.cases import documents, lines, odd_rows, words
from tidemill.llm.winnow import GRAM, WINDOW, Winnower, fingerprints, likeness, neighbour_likeness, written


def brute(text, k=GRAM, w=WINDOW):
    """Windows one by one, with the hashes of the operator's own rolling."""
    winnow = Winnower(1, 1)
    codes = [ord(c) for c in text]
    if not codes:
        return []
    import numpy as np

    hashes = winnow.roller.hashes(np.array(codes, np.uint32), min(k, len(codes))).tolist()
    chosen = set()
    for i in range(max(1, len(hashes) - w + 1)):
        own = [h >> 24 for h in hashes[i : i + w]]
        chosen.add(i + max(j for j, h in enumerate(own) if h == min(own)))
    return [(hashes[p], p) for p in sorted(chosen)]


def test_windows():
    for text in ("", "a", "short text", words(1, 400), "ab" * 300, "é😀" * 200, "x" * 1000):
        hashes, positions = Winnower()(text)
        assert list(zip(hashes.tolist(), positions.tolist())) == brute(text)


def test_shared_strings_are_found():
    shared = words(2, 60)[: GRAM + WINDOW - 1]
    a, b = Winnower()(words(3, 90) + shared + words(4, 50)), Winnower()(shared)
    assert set(a[0].tolist()) & set(b[0].tolist())


def test_short_texts_keep_their_likeness():
    winnow, every, errors = Winnower(), Winnower(w=1), []
    for i in range(200):
        text, after = (words(900 + i + x, 60)[: 60 + i] for x in (0, 500))
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        got, exact = (likeness(f(text)[0], f(edited)[0]) for f in (winnow, every))
        assert got > 0 or exact < 0.2
        errors.append(abs(got - exact))
    assert sum(errors) / len(errors) < 0.1


def test_odd_rows(spark):
    rows = odd_rows()
    got = neighbour_likeness(documents(spark, rows)).collect()
    order = sorted(((k, t or "") for k, t, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = []
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        marks = [Winnower()(t) for t in (text, edited, after)]
        expected.append((key, len(text), edited, written(*marks[0]), written(*marks[1]),
                         likeness(marks[0][0], marks[1][0]), likeness(marks[0][0], marks[2][0])))
    digest = lambda r: (str(r[0]), r[1], hashlib.sha256(r[2].encode()).hexdigest(), *r[3:])
    assert sorted(map(digest, got)) == sorted(map(digest, expected))


def test_one_row_and_none(spark):
    (row,) = neighbour_likeness(documents(spark, [(1, "abcdef")])).collect()
    assert (row.edited, row.near_next) == ("abcdab", 1.0)
    assert neighbour_likeness(documents(spark, []).limit(0)).count() == 0


def test_positions_column(spark):
    df = documents(spark, [(1, words(5, 80)), (2, None), (3, lines(1, 3))])
    got = fingerprints(df, out="key")
    assert sorted(got.columns) == sorted(df.columns)
    rows = {r.doc_id: [(f.hash & (1 << 64) - 1, f.position) for f in r.key] for r in got.collect()}
    assert rows[2] == [] and rows[1] == brute(words(5, 80))

import numpy as np
import pytest

from tidemill.llm import subspace
from tidemill.llm.subspace import linked_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, key int, vec int, cell int, dim int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def able(v):
    return v and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows):
    """Links from all pairs; components over keys."""
    links = [0] * len(rows)
    root = {r[0]: r[0] for r in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, u, l) in enumerate(rows):
        for j, (b, v, m) in enumerate(rows[:i]):
            if None in (a, b, l) or l != m or not able(u) or not able(v) or len(u) != len(v):
                continue
            x, y = np.array(u) / np.abs(u).max(), np.array(v) / np.abs(v).max()
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links[i] += 1
                links[j] += 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted(((r[0], n, find(r[0])) for r, n in zip(rows, links)), key=str)


def got(df):
    result = linked_vectors(df).collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in result)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in result), key=str)


def cloud(seed, dim, n=150):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dim))
    return [
        (i, (centres[i % 6] * draw.uniform(0.1, 9) * (1 + 0.13 * draw.normal(size=dim))).tolist(), i % 7 % 2)
        for i in range(n)
    ]


@pytest.mark.parametrize("dim", [1, 2, 5, 16, 64])
def test_links_are_those_of_all_pairs(spark, dim):
    rows = cloud(dim, dim)
    assert got(frame(spark, rows)) == brute(rows)


def test_large_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(subspace, "TASK_BYTES", 20 * 8 * 8)
    rows = cloud(3, 12)
    assert got(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    x = [1.0, 2.0, -0.5]
    rows = [
        (1, x, 0), (2, x, 0), (3, [2 * a for a in x], 0), (4, x, 1), (5, x, None), (6, None, 0), (7, [], 0),
        (8, [0.0, 0.0, -0.0], 0), (9, [1.0, None, 2.0], 0), (10, [float("nan"), 1.0, 2.0], 0),
        (11, [float("inf"), 1.0, 2.0], 0), (None, x, 0), (12, x + [0.0], 0), (13, [a * 1e300 for a in x], 0),
        (14, [a * 1e-300 for a in x], 0), (15, [-a for a in x], 0),
    ]
    assert got(frame(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert linked_vectors(frame(spark, cloud(1, 3, 2)).limit(0)).count() == 0


def test_few_pairs_are_compared_and_none_is_missed():
    """Random unit vectors of one label, with pairs planted at the limit."""
    least, shares = 0.98, []
    for n in (5000, 20000):
        draw = np.random.default_rng(n)
        x = draw.normal(size=(n, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i in range(0, 200, 2):
            away = draw.normal(size=64)
            away -= (away @ x[i]) * x[i]
            cosine = draw.uniform(0.9801, 0.99)
            x[i + 1] = cosine * x[i] + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away)
        turned = x @ subspace.rotation(64)
        limits, compared, found = subspace.block_limits(64), 0, set()
        for low, high in zip(limits[:-1], limits[1:]):
            radius = np.sqrt((2 - 2 * least) * (high - low) / 64) + 1e-9
            y = turned[:, low:high]
            for i, j in subspace.close_pairs(y, y, radius):
                compared += len(i) * len(j)
                a, b = np.nonzero(turned[i] @ turned[j].T >= least)
                found.update((int(p), int(q)) for p, q in zip(i[a], j[b]) if p < q)
        shares.append(compared / n**2)
        assert {(i, i + 1) for i in range(0, 200, 2)} <= found
    assert shares[1] < 0.1 and shares[1] < 0.7 * shares[0]

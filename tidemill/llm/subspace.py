"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors are rotated and split into blocks of dimensions. If two of them lie within
a squared distance, then in some block they lie within that block's proportional share
of it. Each block is a range join: vectors meet in the cells of a grid over the block's
first coordinates, and those of a cell are halved along one coordinate after the other, with
only the strips beside a cut meeting across it, until few are left to compare by the whole
block. The union of what the blocks find is verified by exact cosines, and a pair counts
in the first block that finds it, so nothing counts twice.

Cells with many vectors are split into a grid of tasks. A task returns the number of
links of each vector and one link to the smallest it is connected to there, not the
pairs. Equal vectors take part once, with their number.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import components, saved

BLOCKS, GRID = 4, 3
CELL = 3.0  # width of a cell in radii
TASK_BYTES = 8 << 20  # of vectors on each side of a task
LEAF = 16  # vectors on each side that are compared at once
_SLACK = 1e-9


def rotation(n: int) -> np.ndarray:
    """An orthogonal matrix that depends on the dimension alone."""
    q, r = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))
    return q * np.sign(np.diag(r))


def block_limits(n: int) -> list[int]:
    blocks = max(1, min(BLOCKS, n // GRID))
    return [round(i * n / blocks) for i in range(blocks + 1)]


def units(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def packed(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, label, dim, vec): the components as doubles; null where the row links with
    nothing."""
    kind = {x: df.schema[x].dataType.simpleString() for x in (key, label)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, dims = [], []
            for v, l in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                x = None
                if v and l is not None and None not in v:
                    x = np.array(v, "<f8") + 0.0
                    top = np.abs(x).max()
                    x = x if np.isfinite(top) and top > 0 else None
                # Scaling by a power of two is exact and keeps norms in range.
                out.append(None if x is None else (x * 2.0 ** -np.frexp(top)[1]).tobytes())
                dims.append(0 if x is None else len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                ["key", "label", "dim", "vec"],
            )

    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), vector)
    return rows.mapInArrow(run, f"key {kind[key]}, label {kind[label]}, dim int, vec binary")


def _cells(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            at, blocks, cells, probes = [], [], [], []
            for n in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == n)
                x = units(batch.column("vec").take(pa.array(rows)).to_pylist()) @ rotation(n)
                limits = block_limits(n)
                for block, (low, high) in enumerate(itertools.pairwise(limits)):
                    radius = np.sqrt((2 - 2 * least + _SLACK) * (high - low) / n)
                    y = x[:, low : min(high, low + GRID)]
                    width = CELL * radius
                    home = np.floor(y / width).astype(np.int64)
                    first = np.floor((y - radius) / width).astype(np.int64)
                    last = np.floor((y + radius) / width).astype(np.int64)
                    # A ball reaches one neighbour in each coordinate at most.
                    shift = (last - home) + (first - home)
                    base = np.int64(1 << 16) ** np.arange(y.shape[1])[::-1]
                    place = (home + (1 << 15)) @ base
                    for mask in itertools.product((0, 1), repeat=y.shape[1]):
                        use = np.array(mask)
                        ok = (shift[:, use == 1] != 0).all(1)
                        other = (home + shift * use + (1 << 15)) @ base
                        if any(mask):
                            ok &= other > place  # the pair meets in the later of its cells
                        at.append(rows[ok])
                        blocks.append(np.full(ok.sum(), block))
                        cells.append(other[ok])
                        probes.append(np.full(ok.sum(), any(mask)))
            if not at:
                continue
            index = pa.array(np.concatenate(at))
            columns = [batch.column(c).take(index) for c in ("key", "label", "dim", "times", "vec")]
            columns += [pa.array(np.concatenate(blocks).astype(np.int32)), pa.array(np.concatenate(cells)), pa.array(np.concatenate(probes))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "label", "dim", "times", "vec", "block", "cell", "probe"])

    return run


def close_pairs(x: np.ndarray, y: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``x`` and rows of ``y``, few at a time, all of which are to be compared with each
    other: among them is every pair that differs by ``radius`` at most in each coordinate."""
    todo = [(np.arange(len(x)), np.arange(len(y)), 0)]
    while todo:
        i, j, depth = todo.pop()
        if not len(i) or not len(j):
            continue
        if len(i) * len(j) <= LEAF * LEAF or depth >= 3 * x.shape[1]:
            yield from ((i[at : at + 256], j) for at in range(0, len(i), 256))
            continue
        p, q = x[i, depth % x.shape[1]], y[j, depth % x.shape[1]]
        cut = np.median(q)
        low, high = p <= cut, q <= cut
        todo += [
            (i[low], j[high], depth + 1), (i[~low], j[~high], depth + 1),
            (i[low & (p >= cut - radius)], j[~high & (q <= cut + radius)], depth + 1),
            (i[~low & (p <= cut + radius)], j[high & (q >= cut - radius)], depth + 1),
        ]


def _join(least: float):
    def run(table: pa.Table) -> pa.Table:
        key = table["key"].to_numpy()
        times = table["times"].to_numpy()
        probe = table["probe"].to_numpy()
        side = table["side"].to_numpy()  # 1 left, 2 right, 3 both
        n, block = table["dim"][0].as_py(), table["block"][0].as_py()
        unit = units(table["vec"].to_pylist())
        x = unit @ rotation(n)
        limits = block_limits(n)
        left, right = np.flatnonzero(side & 1), np.flatnonzero(((side & 2) > 0) & ~probe)
        links = np.zeros(len(key), np.int64)
        root = np.arange(len(key))
        pairs = []

        def within(rows: np.ndarray, others: np.ndarray, b: int) -> np.ndarray:
            low, high = limits[b], limits[b + 1]
            p, q = x[rows, low:high], x[others, low:high]
            square = (p * p).sum(1)[:, None] + (q * q).sum(1)[None, :] - 2 * p @ q.T
            return square <= (2 - 2 * least + _SLACK) * (high - low) / n

        low, high = limits[block], limits[block + 1]
        radius = np.sqrt((2 - 2 * least + _SLACK) * (high - low) / n) + _SLACK
        for i, j in close_pairs(x[left, low:high], x[right, low:high], radius):
            rows, others = left[i], right[j]
            hit = within(rows, others, block)
            if not hit.any():
                continue
            # Two that are at home here meet from one side only.
            hit &= probe[rows][:, None] | (key[rows][:, None] < key[others][None, :])
            for b in range(block):
                hit &= ~within(rows, others, b)
            hit &= unit[rows] @ unit[others].T >= least
            i, j = np.nonzero(hit)
            np.add.at(links, rows[i], times[others[j]])
            np.add.at(links, others[j], times[rows[i]])
            pairs.append((rows[i], others[j]))
        if pairs:
            i, j = (np.concatenate(p) for p in zip(*pairs))
            order = np.argsort(key, kind="stable")
            rank = np.empty(len(key), np.int64)
            rank[order] = np.arange(len(key))
            root = rank.copy()
            while True:  # connected within the task: smallest rank reachable
                before = root.copy()
                np.minimum.at(root, i, root[j])
                np.minimum.at(root, j, root[i])
                root = root[order[root]]
                if (root == before).all():
                    break
            root = order[root]
        some = links > 0
        return pa.table({"key": table["key"].filter(pa.array(some)), "links": links[some], "root": table["key"].take(pa.array(root[some]))})

    return run


def linked_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98
) -> DataFrame:
    """(key, label, n_links, component_id, kept), one row for each row of ``df``.

    Vectors link if their labels are equal, they have equally many components and their
    cosine is at least ``least``. Null and zero vectors, those with a null, infinite or
    NaN component, rows with a null label or a null key link with nothing; a null key has
    a null component and is kept. Rows that repeat a key are one node of the components,
    and each counts as a link.
    """
    kind = {x: df.schema[x].dataType.simpleString() for x in (key, label)}
    every = saved(packed(df, key, vector, label), "vectors")
    able = every.where("vec is not null and key is not null")
    same = ["label", "dim", "vec"]
    groups = saved(able.groupBy(*same).agg(F.min("key").alias("rep"), F.count("*").alias("times")), "distinct-vectors")
    cells = saved(
        groups.withColumnRenamed("rep", "key").mapInArrow(
            _cells(least),
            f"key {kind[key]}, label {kind[label]}, dim int, times long, vec binary, block int, cell long, probe boolean",
        ),
        "vector-cells",
    )
    spot = ["label", "dim", "block", "cell"]
    loads = cells.groupBy(*spot).agg(F.count("*").alias("all"), F.count_if(~F.col("probe")).alias("homes"))
    # A cell without a vector at home, or with a single one, has no pair.
    loads = loads.where("homes > 0 and all > 1").select(
        *spot, *[F.ceil(F.col(n) * F.col("dim") * 8 / TASK_BYTES).cast("int").alias(m) for n, m in (("all", "p"), ("homes", "q"))]
    )
    met = cells.join(loads, spot)
    small = met.where("p = 1").withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(3)})
    large = met.where("p > 1")
    left = large.withColumns({"i": F.pmod(F.xxhash64("key"), "p").cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("q") - 1)), "side": F.lit(1)})
    right = large.where("not probe").withColumns({"i": F.explode(F.sequence(F.lit(0), F.col("p") - 1)), "j": F.pmod(F.xxhash64("key"), "q").cast("int"), "side": F.lit(2)})
    columns = [*spot, "i", "j", "side", "probe", "key", "times", "vec"]
    tasks = small.select(*columns).union(left.select(*columns)).union(right.select(*columns))
    found = saved(
        tasks.groupBy(*spot, "i", "j").applyInArrow(_join(least), f"key {kind[key]}, links long, root {kind[key]}"),
        "vector-links",
    )
    joined = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")), "vector-components")
    joined = saved(joined, "vector-classes")
    counts = found.groupBy(F.col("key").alias("rep")).agg(F.sum("links").alias("links"))
    # Copies of a vector link with each other, and so do rows that repeat a key.
    ranked = groups.join(counts, "rep", "left").select(
        *[F.col(c).alias(f"_{c}") for c in same], "rep", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    ties = able.join(ranked, (able["label"] == ranked["_label"]) & (able["dim"] == ranked["_dim"]) & (able["vec"] == ranked["_vec"]))
    ties = ties.select("key", "label", "n_links", "rep")
    rest = every.where("vec is null or key is null").select("key", "label", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("rep"))
    whole = ties.union(rest).join(joined, F.col("rep") == F.col("id"), "left")
    component = F.coalesce("component", "rep")
    return whole.select(
        F.col("key").alias(key), F.col("label").alias(label), "n_links", component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )

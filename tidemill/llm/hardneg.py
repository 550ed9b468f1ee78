"""Hard negatives of anchor vectors, found by filtering with segment summaries.

A vector is cut into segments; of each segment its mean and its deviation (the length of
what is left after taking the mean off) are kept. The product of the means, times the
segment's length, plus or minus the product of the deviations bounds a segment's share of
an inner product, and the sums bound the product. Pairs of vectors are judged first by one
segment, then by 4, 16 and so on; those that the bounds cannot settle go on to the next
level, and those left after the last are scored exactly, in integers.

Anchors meet all rows in a grid of blocks, first those of their own label for the
positives, then all for the negatives. A task settles a block of anchors against a block
of rows and returns the best few of each anchor, so what leaves it does not grow with a
label, and a label that holds a third of the rows is spread over many blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tidemill.llm.common import saved

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
ANCHOR_BYTES, ROW_BYTES = 8 << 20, 2 << 20  # of vectors in one block
STRIP = 128  # anchors that are settled at once
FAN = 4  # a segment is refined into so many
_EXACT = 2.0**53
_WIDE = 1e140  # components beyond this would overflow in sums of products


def quantised(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, label, dim, vec): floor(256 * x) of each component, as doubles. Rows that can't
    take part are left out; rows that agree in all count once."""
    kind = {x: df.schema[x].dataType.simpleString() for x in (key, label)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.finfo("<f8").max
        for batch in batches:
            keep, dims, vecs = [], [], []
            for i, v in enumerate(batch.column(2).to_pylist()):
                x = None if v is None or None in v else np.array(v, "<f8")
                if x is not None and np.isfinite(x).all():
                    with np.errstate(over="ignore"):
                        q = np.clip(np.floor(256 * x), -top, top) + 0.0
                    keep.append(i), dims.append(len(x)), vecs.append(q.tobytes())
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                ["key", "label", "dim", "vec"],
            )

    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("v"))
    rows = rows.where("key is not null and label is not null and v is not null").select("key", "label", "v")
    return rows.mapInArrow(run, f"key {kind[key]}, label {kind[label]}, dim int, vec binary").distinct()


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), dim)


def levels(dim: int) -> list[int]:
    """Numbers of segments, each a refinement of the one before."""
    counts, n = [], 1
    while n < dim:
        counts.append(n)
        n *= FAN
    return counts


def summary(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means (times the root of the length) and deviations of the segments."""
    limits = [round(i * x.shape[1] / segments) for i in range(segments + 1)]
    length = np.diff(limits)
    total = np.add.reduceat(x, limits[:-1], axis=1)
    mean = np.repeat(total / length, length, axis=1)
    return total / np.sqrt(length), np.sqrt(np.add.reduceat((x - mean) ** 2, limits[:-1], axis=1))


def products(x: np.ndarray, y: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``x`` and of ``y``, right where ``wanted``: all at once, or one
    by one where few are left."""
    if wanted.sum() * 8 > wanted.size:
        return x @ y.T
    out = np.zeros(wanted.shape)
    i, j = np.nonzero(wanted)
    for at in range(0, len(i), 1 << 16):
        p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        out[p, q] = np.einsum("ij,ij->i", x[p], y[q])
    return out


class Block:
    """Vectors with their summaries at each level."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.size = float(np.abs(x).max()) if x.size else 0.0
        with np.errstate(over="ignore", invalid="ignore"):
            self.parts = [summary(x, n) for n in levels(x.shape[1])]

    def bounds(self, rows: slice, other: Block, level: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner products of the strip ``rows`` with ``other``."""
        if self.size > _WIDE or other.size > _WIDE:
            return np.full(wanted.shape, -np.inf), np.full(wanted.shape, np.inf)
        (m, d), (n, e) = self.parts[level], other.parts[level]
        middle, away = products(m[rows], n, wanted), products(d[rows], e, wanted)
        # Rounding stays far below this share of the largest possible sum.
        away += 1 + 1e-12 * self.size * other.size * (self.x.shape[1] + 1) ** 2
        return middle - away, middle + away

    def scores(self, rows: slice, other: Block, wanted: np.ndarray) -> np.ndarray:
        """Inner products in whole numbers: Python's where doubles could round, and results
        beyond 64 bits as the nearest that fits."""
        if self.size * other.size * self.x.shape[1] < _EXACT:
            return products(self.x[rows], other.x, wanted).astype(np.int64)
        most, out = 2**63 - 1, np.zeros(wanted.shape, np.int64)
        x = [[int(v) for v in row] for row in self.x[rows].tolist()]
        y = {j: [int(v) for v in other.x[j].tolist()] for j in np.flatnonzero(wanted.any(0)).tolist()}
        for i, j in np.argwhere(wanted).tolist():
            out[i, j] = max(-most, min(most, sum(p * q for p, q in zip(x[i], y[j]))))
        return out


def nth_largest(value: np.ndarray, n: int) -> np.ndarray:
    """The n-th largest value of each row, as a column; the least there is where it has fewer."""
    if value.shape[1] < n:
        return np.full((len(value), 1), -np.inf)
    return np.partition(value, value.shape[1] - n, axis=1)[:, value.shape[1] - n, None]


def _positives(most: int):
    def run(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        side = table["anchor"].to_numpy()
        asks, rows = table.filter(pa.array(side)), table.filter(pa.array(~side))
        a, b = Block(matrix(asks["vec"], dim)), Block(matrix(rows["vec"], dim))
        # An anchor is not its own positive.
        same = {row: k for k, row in enumerate(zip(rows["key"].to_pylist(), rows["row"].to_pylist()))}
        own = np.array([same.get(row, -1) for row in zip(asks["key"].to_pylist(), asks["row"].to_pylist())], np.int64)
        out = []
        for at in range(0, len(own), STRIP):
            strip = slice(at, at + STRIP)
            open_ = np.arange(len(rows))[None, :] != own[strip][:, None]
            for level in range(len(a.parts)):
                least, greatest = a.bounds(strip, b, level, open_)
                open_ &= greatest >= nth_largest(np.where(open_, least, -np.inf), most)
            s = a.scores(strip, b, open_)
            # Ties are settled by key, later.
            i, j = np.nonzero(open_ & (s >= nth_largest(np.where(open_, s, -np.inf), most)))
            out.append((i + at, j, s[i, j]))
        i, j, s = (np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ((), (), ())))
        return _first(asks, rows, i, np.zeros(len(i), np.int32), j, s, most)

    return run


def _first(asks: pa.Table, rows: pa.Table, i: np.ndarray, place: np.ndarray, j: np.ndarray, score: np.ndarray, most: int) -> pa.Table:
    """The first rows of each anchor and place, by falling score and rising key."""
    columns = {
        "anchor_id": asks["key"].take(pa.array(i)), "anchor_row": asks["row"].take(pa.array(i)), "place": pa.array(place, pa.int32()),
        "key": rows["key"].take(pa.array(j)), "row": rows["row"].take(pa.array(j)), "score": pa.array(score, pa.int64()),
    }
    found = pa.table(columns)
    order = [("anchor_id", "ascending"), ("anchor_row", "ascending"), ("place", "ascending"), ("score", "descending"), ("key", "ascending"), ("row", "ascending")]
    found = found.take(pc.sort_indices(found, order))
    if not len(found):
        return found
    changes = [pc.not_equal(found[c].combine_chunks()[1:], found[c].combine_chunks()[:-1]).to_numpy(zero_copy_only=False) for c in ("anchor_id", "anchor_row", "place")]
    starts = np.concatenate([[True], np.logical_or.reduce(changes)])
    at = np.arange(len(found))
    return found.filter(pa.array(at - np.maximum.accumulate(np.where(starts, at, 0)) < most))


def window(score: int | float, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def _negatives(most: int, low: int, high: int):
    def run(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        side = table["anchor"].to_numpy()
        asks, rows = table.filter(pa.array(side)), table.filter(pa.array(~side))
        a, b = Block(matrix(asks["vec"], dim)), Block(matrix(rows["vec"], dim))
        kinds = {l: k for k, l in enumerate(set(rows["label"].to_pylist()))}
        label = np.array([kinds[l] for l in rows["label"].to_pylist()], np.int64)
        own = np.array([kinds.get(l, -1) for l in asks["label"].to_pylist()], np.int64)
        # Every positive of an anchor asks for a range of scores.
        spans = [[window(s, low, high) for s in x] for x in asks["scores"].to_pylist()]
        out = []
        for at in range(0, len(own), STRIP):
            strip = slice(at, at + STRIP)
            mine = spans[strip]
            places = max((len(x) for x in mine), default=0)
            span = np.array([x + [(1, 0)] * (places - len(x)) for x in mine], np.int64).reshape(len(mine), places, 2)
            span = [(span[:, p, :1], span[:, p, 1:], span[:, p, :1] <= span[:, p, 1:]) for p in range(places)]
            open_ = label[None, :] != own[strip][:, None]
            for level in range(len(a.parts)):
                least, greatest = a.bounds(strip, b, level, open_)
                stay = np.zeros(open_.shape, bool)
                for first, last, any_ in span:
                    floor = first
                    sure = open_ & (least >= first) & (greatest <= last)
                    if sure.any():
                        floor = np.maximum(first, nth_largest(np.where(sure, least, -np.inf), most))
                    stay |= any_ & (greatest >= floor) & (least <= last)
                open_ &= stay
            s = a.scores(strip, b, open_)
            least = np.iinfo(np.int64).min
            s[~open_] = least
            rising = np.sort(s, axis=1)
            for p, (first, last, _) in enumerate(span):
                end = (rising <= last).sum(1, keepdims=True)
                nth = np.take_along_axis(rising, np.maximum(end - most, 0), 1)
                i, j = np.nonzero((s >= np.maximum(np.where(end < most, least + 1, nth), first)) & (s <= last) & open_)
                out.append((i + at, np.full(len(i), p), j, s[i, j]))
        i, p, j, s = (np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ((), (), (), ())))
        return _first(asks, rows, i, p, j, s, most)

    return run


def hard_negatives(
    df: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each
    row where ``is_anchor`` (a condition on ``key``) and each of its nearest ``positives`` of
    the same label, the nearest ``negatives`` of other labels with a score between ``low`` and
    ``high`` per cent of the positive's. Higher scores come first, ties by smaller key.

    Rows with a null key, label or vector or with a null, NaN or infinite component take no
    part. Rows that agree in key, label and vector count once; rows that share a key only are
    rows of their own, and an anchor's other rows are all but itself. Vectors are compared
    with those of as many components; empty vectors score 0 with each other. Extra columns
    are not read. An empty table returns no rows.
    """
    kind = {"key": df.schema[key].dataType.simpleString()}
    row = F.xxhash64("key", "label", "vec")  # tells rows of one key apart
    every = saved(
        quantised(df, key, vector, label).withColumns({"row": row, "anchor": F.coalesce(is_anchor, F.lit(False))}), "vectors"
    )
    size = F.greatest(F.col("dim"), F.lit(1)) * 8
    cut = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(groups: list[str], anchors: DataFrame) -> GroupedData:
        """Anchors and rows of equal ``groups`` in a grid of blocks of bounded size."""
        blocks = every.groupBy(*groups).agg(
            F.ceil(F.count_if("anchor") * F.max(size) / ANCHOR_BYTES).cast("int").alias("p"),
            F.ceil(F.count("*") * F.max(size) / ROW_BYTES).cast("int").alias("q"),
        ).where("p > 0")
        at = {n: F.pmod("row", F.col(n)).cast("int") for n in "pq"}
        each = {n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)) for n in "pq"}
        columns = ["i", "j", "key", "label", "dim", "vec", "row", "scores"]
        left = anchors.join(blocks, groups).withColumns({"i": at["p"], "j": each["q"], "anchor": F.lit(True)})
        right = every.join(blocks, groups).withColumns(
            {"i": each["p"], "j": at["q"], "anchor": F.lit(False), "scores": F.lit(None).cast("array<long>")}
        )
        sides = left.select(*columns, "anchor").union(right.select(*columns, "anchor"))
        return sides.repartition(cut, *groups, "i", "j").groupBy(*groups, "i", "j")

    def best(found: DataFrame, group: list[str], most: int) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("score"), "key", "row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    found = f"anchor_id {kind['key']}, anchor_row long, place int, key {kind['key']}, row long, score long"
    anchors = every.where("anchor").withColumn("scores", F.lit(None).cast("array<long>"))
    near = dealt(["label", "dim"], anchors).applyInArrow(_positives(positives), found)
    near = saved(best(near, ["anchor_id", "anchor_row"], positives), "positives")
    scores = F.sort_array(F.collect_list(F.struct("rank", "score"))).getField("score")  # at most ``positives``
    asking = near.groupBy(F.col("anchor_id").alias("key"), F.col("anchor_row").alias("row")).agg(scores.alias("scores"))
    asking = anchors.drop("scores").join(asking, ["key", "row"])
    hard = dealt(["dim"], asking).applyInArrow(_negatives(negatives, low, high), found)
    hard = best(hard, ["anchor_id", "anchor_row", "place"], negatives)
    pairs = near.select(
        "anchor_id", "anchor_row", (F.col("rank") - 1).alias("place"), F.col("key").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return hard.join(pairs, ["anchor_id", "anchor_row", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("key").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )

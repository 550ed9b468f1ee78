"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import configure, scratch_dir

# Texts may be long, so the batches that reach Python are bounded by rows here
# and by bytes in Spark's own setting.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later jobs do not repeat
    its work, and a lost executor does not lose it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Strings of a column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def schema_with(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    """The fields of ``df`` and those given, which replace fields of the same name."""
    new = {name.lower() for name, _ in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    return T.StructType(kept + [T.StructField(n, t, True) for n, t in fields])


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns named by their place, so that none clashes with an operator's
    own, and the new name of each."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def append(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with the columns given, which replace columns of the same name."""
    new = {name.lower() for name in columns}
    names = [n for n in batch.schema.names if n.lower() not in new]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in names] + list(columns.values()), names + list(columns)
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Roller:
    """Hashes of all k-long substrings of an array, modulo 2**64.

    With B odd, the sum of c[i] * B**i over a substring, times B**-start, depends
    on the substring alone; both factors come from tables of powers.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self._inverse = pow(self.BASE, -1, 1 << 64)
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        ones = np.ones(n, np.uint64)
        up, down = ones * np.uint64(self.BASE), ones * np.uint64(self._inverse)
        up[0] = down[0] = 1
        self.up, self.down = np.cumprod(up), np.cumprod(down)

    def hashes(self, codes: np.ndarray, k: int) -> np.ndarray:
        n = len(codes)
        if n < k:
            return np.zeros(0, np.uint64)
        if n > len(self.up):
            self._grow(max(n, 2 * len(self.up)))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        return mix64((sums[k:] - sums[:-k]) * self.down[: n - k + 1])


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` neighbours, in linear time: each run is the end
    of one block of ``w`` and the start of the next."""
    n = len(values)
    if n <= w:
        return values.min(keepdims=True) if n else values
    top = np.iinfo(values.dtype).max
    blocks = np.full(-(-n // w) * w, top, values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lengths[i] - 1, for each i in turn."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)


def packed_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, row, packed): a hash of the text and its compressed bytes, null as empty.
    Shuffles of these move about half of what the texts would."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            raw = [t or b"" for t in batch.column(1).to_pylist()]
            row = [xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(row, pa.int64()), pa.array(map(zip_.compress, raw), pa.binary())],
                ["key", "row", "packed"],
            )

    return df.select(F.col(key).alias("key"), F.col(text).cast("binary")).mapInArrow(
        run, f"key {kind}, row long, packed binary"
    )


def components(links: DataFrame, purpose: str) -> DataFrame:
    """(id, component) of the ids in ``links`` (a, b): the smallest id reachable.

    Two steps alternate until nothing changes: every node's larger neighbours are linked
    to its smallest, then its smaller ones. Links are replaced, not multiplied, and the
    rounds grow with the logarithm of the longest chain. A centre's neighbours are never
    gathered: the minimum is joined to them.
    """
    edges = saved(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        purpose,
    )
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(large.distinct(), purpose)
        small = edges.groupBy("a").agg(F.min("b").alias("m"))
        pulled = edges.join(small, "a").where("b <> m").select(
            F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")
        )
        edges = saved(
            pulled.union(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), purpose
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))

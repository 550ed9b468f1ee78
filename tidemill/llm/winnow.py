"""Document fingerprints by winnowing.

All k-grams of code points are hashed by a rolling hash; of every window of ``w``
neighbouring hashes the smallest is kept, the rightmost one of ties. Two texts that
share ``k + w - 1`` code points in a row share a fingerprint. Positions are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemill.llm.common import Roller, append, schema_with, sliding_min, texts_of

GRAM, WINDOW = 24, 16
_LOW = (1 << 24) - 1
_SEGMENT = 1 << 23


class Winnower:
    def __init__(self, k: int = GRAM, w: int = WINDOW) -> None:
        self.k, self.w, self.roller = k, w, Roller()

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and their positions. A text shorter than ``k`` has the hash of the
        whole text; an empty one has none."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        hashes = self.roller.hashes(codes, min(self.k, len(codes)) or 1)
        chosen = []
        for base in range(0, len(hashes), _SEGMENT):
            # The order is that of the upper 40 bits; the lower 24 say how far right.
            part = hashes[base : base + _SEGMENT + self.w - 1]
            right = _LOW - np.arange(len(part))
            least = sliding_min((part & np.uint64(~_LOW & (1 << 64) - 1)) | right.astype(np.uint64), self.w)
            at = _LOW - (least & np.uint64(_LOW)).astype(np.int64) + base
            chosen.append(at[np.r_[True, at[1:] != at[:-1]]])
        positions = np.unique(np.concatenate(chosen)) if len(chosen) > 1 else (chosen or [np.zeros(0, np.int64)])[0]
        return hashes[positions], positions


def written(hashes: np.ndarray, positions: np.ndarray) -> str:
    """24 hexadecimal digits for each: 16 of the hash, 8 of the position."""
    out = np.empty((len(hashes), 3), ">u4")
    out[:, 0], out[:, 1], out[:, 2] = hashes >> np.uint64(32), hashes & np.uint64(0xFFFFFFFF), positions
    return out.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes by all hashes, each counted once; 1 if both have none."""
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def fingerprints(
    df: DataFrame, text: str = "text", out: str = "fingerprint", k: int = GRAM, w: int = WINDOW
) -> DataFrame:
    """``df`` with the fingerprint of ``text``: array<struct<hash, position>>, by position.

    Null and empty texts have an empty array. A column already named as ``out`` is
    replaced; all others pass.
    """
    entry = T.StructType([T.StructField("hash", T.LongType()), T.StructField("position", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow = Winnower(k, w)
        for batch in batches:
            found = [winnow(t) for t in texts_of(batch.column(text))]
            ends = np.r_[0, np.cumsum([len(h) for h, _ in found])].astype(np.int32)
            values = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([h for h, _ in found]).view(np.int64)),
                    pa.array(np.concatenate([p for _, p in found])),
                ],
                ["hash", "position"],
            )
            yield append(batch, **{out: pa.ListArray.from_arrays(pa.array(ends), values)})

    return df.mapInArrow(run, schema_with(df, (out, T.ArrayType(entry))))


def in_sequence(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, borrowed) dealt into ranges of ``key``, each partition in descending
    order, nulls last, rows of one key by text. Behind each range stands, as borrowed,
    the first row of the next range; behind the last one the very first row. So every
    row's successor is the row below it, and no task sees more than its ranges.

    The range limits are quantiles of the keys; only they and one row for each range
    are gathered.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    limits = (
        rows.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 10 * ranges))
        .first()[0]
        or []
    )
    limits = sorted(set(limits), reverse=True)
    steps = F.array(*[F.lit(x) for x in limits]).cast("array<long>")
    # Range 0 has the largest keys; the nulls come last.
    part = F.when(F.col("key").isNull(), F.lit(len(limits) + 1)).otherwise(
        F.size(F.filter(steps, lambda x: x > F.col("key"))) if limits else F.lit(0)
    )
    rows = rows.withColumn("part", part)
    firsts = rows.groupBy("part").agg(F.max("key").alias("key"))
    # A range's first row has its largest key and, of several, the smallest text.
    heads = (
        rows.join(F.broadcast(firsts.withColumnRenamed("key", "top")), "part")
        .where(F.col("key").eqNullSafe(F.col("top")))
        .groupBy("part").agg(F.first("key").alias("key"), F.min("text").alias("text"))
    )
    # One row for each range: their number is the number of partitions.
    order = Window.orderBy(F.desc("part"))
    lent = firsts.select(
        "part",
        F.coalesce(F.lag("part").over(order), F.min("part").over(Window.partitionBy())).alias("next"),
    )
    heads = heads.withColumnRenamed("part", "next").join(F.broadcast(lent), "next")
    both = rows.select("part", "key", "text", F.lit(False).alias("borrowed")).union(
        heads.select("part", "key", "text", F.lit(True))
    )
    return both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").sortWithinPartitions(
        "part", "borrowed", F.desc_nulls_last("key"), "text"
    )


def neighbour_likeness(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: (key, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next), where edited is the text whose last third is replaced by the start of
    the next row's, in descending order of ``key``.

    Null texts count as empty; rows with a null key come last; rows of one key stand
    in the order of their texts; repeated rows stay. An only row is its own successor.
    """
    kind = df.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    arrow = pa.schema(
        [(key, to_arrow_type(kind)), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow, above = Winnower(), None
        for batch in batches:
            out = []
            for k, t, b in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), batch["borrowed"].to_pylist()):
                own = winnow(t)
                if above:
                    key_, text_, mark = above
                    n = len(text_)
                    edited = text_[: n - n // 3] + t[: n // 3]
                    other = winnow(edited)
                    out.append((key_, n, edited, written(*mark), written(*other), likeness(mark[0], other[0]), likeness(mark[0], own[0])))
                above = None if b else (k, t, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return in_sequence(df, key, text).mapInArrow(run, schema)

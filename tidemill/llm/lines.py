"""Removal of repeated passages by content-defined line chunks.

The lines of a text are hashed, and a rolling hash over the last few line hashes
decides where a chunk ends. So chunk limits move with the lines: an insertion changes
the chunks around it and no others. Chunks of several lines that occur more than once
anywhere are compared byte for byte, and all but the first occurrence are removed.

Chunk limits miss passages that lie between them. So the shortest run of lines with at
least 50 words is taken from every line onwards, and back from every line. Such runs
cover every repeated passage of whole lines and that many words to its first and last
line, whatever its length. Equal runs, by 128 bits of hash, are treated like equal chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import append, mix64, positional, saved, schema_with, texts_of

ROLL = 2  # lines under the rolling hash
MEAN = 4  # one rolling hash in so many ends a chunk
LEAST = 2  # lines of a chunk, and lines that are not blank of one that may go
WORDS = 50  # of a run of lines that may go


def chunk_ends(lines: list[str], roll: int = ROLL, mean: int = MEAN, least: int = LEAST) -> list[int]:
    """Where the chunks end, exclusive; the last is the number of lines."""
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines), np.uint64, len(lines))
    rolled = np.zeros(len(lines), np.uint64)
    for back in range(min(roll, len(lines))):
        rolled[back:] += hashes[: len(lines) - back] * np.uint64(2 * back + 1)
    ends, start = [], 0
    for i in np.flatnonzero(mix64(rolled) % np.uint64(mean) == 0):
        if i + 1 - start >= least and i + 1 < len(lines):
            ends.append(int(i) + 1)
            start = int(i) + 1
    return [*ends, len(lines)]


def _chunks(text: str, only: set[int] | None = None) -> Iterator[tuple[int, int, str]]:
    """(number, hash, bytes as text) of the chunks that may be removed."""
    lines, start = text.split("\n"), 0
    for number, end in enumerate(chunk_ends(lines)):
        own = lines[start:end]
        if (only is None or number in only) and sum(not x.isspace() and x != "" for x in own) >= LEAST:
            body = "\n".join(own)
            yield number, xxhash.xxh3_64_intdigest(body.encode("utf-8", "surrogatepass")) - (1 << 63), body
        start = end


def _counts(lines: list[str]) -> np.ndarray:
    return np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))


def runs(text: str, least: int = WORDS) -> Iterator[tuple[int, int, bytes]]:
    """(first line, last line, hash) of the shortest runs with ``least`` words from each
    line on and back from each line. None begins or ends with a blank line."""
    lines = text.split("\n")
    counts = _counts(lines)
    full = np.flatnonzero(counts)
    sums = np.r_[0, np.cumsum(counts[full])]
    if sums[-1] < least:
        return
    onward = np.searchsorted(sums, sums[:-1] + least)  # one behind the last, of the full lines
    back = np.searchsorted(sums, sums[1:] - least, "right") - 1
    spans = {(i, e - 1) for i, e in enumerate(onward.tolist()) if e < len(sums)}
    spans.update((b, i) for i, b in enumerate(back.tolist()) if b >= 0)
    data = [x.encode("utf-8", "surrogatepass") for x in lines]
    ends = np.cumsum([len(x) + 1 for x in data])
    starts, whole = (ends - [len(x) + 1 for x in data]).tolist(), memoryview(b"\n".join(data))
    ends, full = (ends - 1).tolist(), full.tolist()
    for i, j in spans:
        first, last = full[i], full[j]
        yield first, last, xxhash.xxh3_128_digest(whole[starts[first] : ends[last]])


def _cut_lines(lines: list[str], chunks: list[int] | None, spans: list[dict] | None) -> np.ndarray:
    """Which lines go: those of the chunks, and of passages that the runs make up."""
    step = np.zeros(len(lines) + 1, np.int64)
    if chunks:
        ends = np.array([0, *chunk_ends(lines)])
        np.add.at(step, ends[chunks], 1)
        np.add.at(step, ends[np.array(chunks) + 1], -1)
    if spans:
        np.add.at(step, [x["first"] for x in spans], 1)
        np.add.at(step, [x["last"] + 1 for x in spans], -1)
    return np.cumsum(step[:-1]) > 0


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with repeated passages cut from ``text``, and n_lines, n_removed (lines).

    The occurrence with the smallest key (null last), then the smallest text hash, then
    the first in the text stays. Rows that agree in key and text are treated alike. A
    text that is null stays null; one that loses all its lines is empty. Single lines
    below 50 words, and blank lines, are never repeated passages. Columns of ``df`` named
    as those added are replaced.
    """
    plain, names = positional(df)
    done = _dedup(plain, names[key], names[text])
    added = ("n_lines", "n_removed")
    return done.select(*[F.col(c).alias(n) for n, c in names.items() if n.lower() not in added], *added)


def _dedup(df: DataFrame, key: str, text: str) -> DataFrame:
    docs = df.withColumns({"_key": F.col(key), "_row": F.xxhash64(text)})
    kind = df.schema[key].dataType
    place = [T.StructField("_key", kind), T.StructField("_row", T.LongType()), T.StructField("_chunk", T.IntegerType()),
             T.StructField("_hash", T.LongType())]

    def listed(batches: Iterator[pa.RecordBatch], bodies: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys, rows = texts_of(batch.column(text)), batch.column("_key"), batch.column("_row")
            suspects = batch.column("_suspects").to_pylist() if bodies else [None] * len(texts)
            at, numbers, hashes, kept = [], [], [], []
            for i, t in enumerate(texts):
                for number, own, body in _chunks(t, suspects[i] and set(suspects[i])):
                    at.append(i)
                    numbers.append(number)
                    hashes.append(own)
                    kept.append(body)
            index = pa.array(at, pa.int64())
            out = [keys.take(index), rows.take(index), pa.array(numbers, pa.int32()), pa.array(hashes, pa.int64())]
            names = ["_key", "_row", "_chunk", "_hash"]
            if bodies:
                out, names = [*out, pa.array(kept, pa.string())], [*names, "_body"]
            yield pa.RecordBatch.from_arrays(out, names)

    found = saved(
        docs.select(F.col(text), "_key", "_row").mapInArrow(lambda b: listed(b, False), T.StructType(place)),
        "line-chunks",
    )
    repeated = found.groupBy("_hash").count().where("count > 1").select("_hash")
    suspects = (
        found.join(repeated, "_hash", "left_semi")
        .groupBy(F.col("_key").alias("_k"), F.col("_row").alias("_r"))
        .agg(F.collect_set("_chunk").alias("_suspects"))
    )

    def same(other: DataFrame):
        return docs["_key"].eqNullSafe(other["_k"]) & (docs["_row"] == other["_r"])

    # All columns go along: then this shuffle of the texts serves the last join too.
    bodies = docs.join(suspects, same(suspects)).mapInArrow(
        lambda b: listed(b, True), T.StructType([*place, T.StructField("_body", T.StringType())])
    )
    first = F.min(F.struct(F.col("_key").isNull().alias("n"), "_key", "_row", "_chunk")).alias("_first")
    groups = (
        bodies.groupBy(F.col("_hash").alias("_h"), F.col("_body").alias("_b"))
        .agg(first, F.count("*").alias("_times")).where("_times > 1").drop("_times")
    )
    own = bodies.join(groups, (bodies["_hash"] == groups["_h"]) & (bodies["_body"] == groups["_b"]))
    is_first = (
        F.col("_key").eqNullSafe(F.col("_first._key"))
        & (F.col("_row") == F.col("_first._row")) & (F.col("_chunk") == F.col("_first._chunk"))
    )
    nothing = F.lit(None).cast("int")
    lost = own.where(~is_first).select("_key", "_row", "_chunk", nothing.alias("first"), nothing.alias("last"))
    lost = lost.union(_later_runs(docs, text).select("_key", "_row", nothing, "first", "last"))
    span = F.when(F.col("first").isNotNull(), F.struct("first", "last"))
    gone = lost.groupBy(F.col("_key").alias("_k"), F.col("_row").alias("_r")).agg(
        F.collect_set("_chunk").alias("_gone"), F.collect_set(span).alias("_spans")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept, n, removed = batch.column(text).to_pylist(), [], [], []
            numbers, spans = batch.column("_gone").to_pylist(), batch.column("_spans").to_pylist()
            for t, *found in zip(texts, numbers, spans):
                lines = (t or "").split("\n")
                n.append(len(lines) if t else 0)
                if not any(found):
                    kept.append(t)
                    removed.append(0)
                    continue
                drop = _cut_lines(lines, *found)
                kept.append("\n".join(x for x, d in zip(lines, drop.tolist()) if not d))
                removed.append(int(drop.sum()))
            whole = append(batch, **{text: pa.array(kept, pa.string()), "n_lines": pa.array(n, pa.int64()),
                                     "n_removed": pa.array(removed, pa.int64())})
            yield whole.drop_columns(["_key", "_row", "_k", "_r", "_gone", "_spans"])

    added = ((text, T.StringType()), ("n_lines", T.LongType()), ("n_removed", T.LongType()))
    return docs.join(gone, same(gone), "left").mapInArrow(cut, schema_with(df, *added))


def _later_runs(docs: DataFrame, text: str) -> DataFrame:
    """(_key, _row, first, last) of the runs that occur earlier too."""
    kind = docs.schema["_key"].dataType
    schema = T.StructType([T.StructField("_key", kind), T.StructField("_row", T.LongType()), T.StructField("first", T.IntegerType()),
                           T.StructField("last", T.IntegerType()), T.StructField("_high", T.LongType()), T.StructField("_low", T.LongType())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, first, last, hashes = [], [], [], []
            for i, t in enumerate(texts_of(batch.column(0))):
                for low, high, own in runs(t):
                    at.append(i)
                    first.append(low)
                    last.append(high)
                    hashes.append(own)
            index, halves = pa.array(at, pa.int64()), np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(index), batch.column(2).take(index), pa.array(first, pa.int32()), pa.array(last, pa.int32()),
                 pa.array(halves[:, 0]), pa.array(halves[:, 1])], schema.names)

    found = saved(docs.select(F.col(text), "_key", "_row").mapInArrow(listed, schema), "line-runs")
    place = F.struct(F.col("_key").isNull().alias("n"), "_key", "_row", "first")
    groups = saved(
        found.groupBy(F.col("_high").alias("_h"), F.col("_low").alias("_l"))
        .agg(F.min(place).alias("_first"), F.count("*").alias("_times")).where("_times > 1").drop("_times"),
        "line-run-groups",
    )
    both = found.join(groups, (found["_high"] == groups["_h"]) & (found["_low"] == groups["_l"]))
    is_first = (
        F.col("_key").eqNullSafe(F.col("_first._key"))
        & (F.col("_row") == F.col("_first._row")) & (F.col("first") == F.col("_first.first"))
    )
    return both.where(~is_first).select("_key", "_row", "first", "last")

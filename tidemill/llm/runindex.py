"""Removal of long repeated byte strings with a run-length index.

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere else is
removed. Two such strings have the same smallest k-gram hash, so each start is sent to
the group of its own: a context is a row of starts with one such anchor, together with
the bytes their strings reach. Equal contexts are kept once with their number.

Contexts of different content meet in the tasks of their anchors. There their
concatenation gets a Burrows-Wheeler transform, kept as runs with the text positions
(suffix array samples) of the first and last row of every run. Where a run ends, the
suffixes on either side differ in the byte before them, so their common prefix is not
implied by a longer one; everywhere else it is that of the position before, less one.
So the lengths at the run ends, streamed over the text, give the matching statistics:
how far each position matches some other. Stretches of ``LENGTH`` and more are marked.
The more repetitive the contexts, the fewer the runs.

An anchor whose contexts exceed what one task should hold is split by longer and longer
anchors, up to ``LENGTH`` itself, where all contexts of an anchor are equal. No context
is dropped, and the task's size is bounded at every size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import Roller, packed_texts, saved, sliding_min

LENGTH = 400
ANCHORS = (64, 256, 384, 400)  # bytes of an anchor, level by level
TASK_BYTES = 1_500_000
_SEGMENT = 1 << 22
_LOW = np.uint64((1 << 24) - 1)
_SPANS = "array<struct<low: int, high: int>>"


def contexts(data: np.ndarray, k: int, roller: Roller) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, number of starts) of a text's contexts, in text order."""
    n = len(data) - LENGTH + 1
    anchors, lows, sizes = [], [], []
    for base in range(0, max(n, 0), _SEGMENT):
        part = data[base : base + _SEGMENT + LENGTH - 1]
        hashes = roller.hashes(part, k)
        place = np.arange(len(hashes), dtype=np.uint64)
        at = sliding_min((hashes & ~_LOW) | place, LENGTH - k + 1) & _LOW
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        anchors.append(hashes[at[first].astype(np.int64)])
        lows.append(first + base)
        sizes.append(np.diff(np.r_[first, len(at)]))
    if not anchors:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(anchors), np.concatenate(lows), np.concatenate(sizes)


def _content(raw: bytes, low: int, size: int) -> int:
    return xxhash.xxh3_64_intdigest(raw[low : low + size + LENGTH - 1]) - (1 << 63)


def suffix_order(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes of the contexts in lexicographic order by prefix doubling; ``words`` holds
    the eight bytes from each position, ``left`` the bytes to its context's end. Only
    groups that are not settled are sorted again."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    order = np.argsort(words, kind="stable")
    first = np.r_[True, words[order][1:] != words[order][:-1]]
    start = np.flatnonzero(first)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(start, np.diff(np.r_[start, n]))
    alone = first & np.r_[first[1:], True]
    open_ = order[~alone]
    step, longest = 8, int(left.max(initial=0))
    while len(open_) and step < longest:
        ahead = np.where(left[open_] > step, rank[np.minimum(open_ + step, n - 1)] + 1, 0)
        key = (rank[open_] << 32) | ahead
        turn = np.argsort(key, kind="stable")
        open_, key = open_[turn], key[turn]
        group = key >> 32
        new = np.r_[True, key[1:] != key[:-1]]
        head = np.r_[True, group[1:] != group[:-1]]
        index = np.arange(len(key))
        # Its place among all suffixes: the group's, and how far down in the group.
        spot = group + np.repeat(index[new], np.diff(np.r_[index[new], len(key)])) - np.repeat(
            index[head], np.diff(np.r_[index[head], len(key)])
        )
        order[group + index - np.repeat(index[head], np.diff(np.r_[index[head], len(key)]))] = open_
        rank[open_] = spot
        open_ = open_[~(new & np.r_[new[1:], True])]
        step *= 2
    return order


class RunIndex:
    """Run-length Burrows-Wheeler transform of some texts, with samples at run ends."""

    def __init__(self, texts: list[bytes]) -> None:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        n = len(self.data) - 8
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.left = np.repeat(self.ends, sizes) - np.arange(n)
        words = np.zeros(n, np.uint64)
        for i in range(8):
            byte = np.where(self.left > i, self.data[i : n + i], 0).astype(np.uint64)
            words |= byte << np.uint64(56 - 8 * i)
        self.words = words
        order = suffix_order(words, self.left)
        before = self.data[order - 1].astype(np.int16)
        # What stands before a text's first byte equals nothing.
        outer = np.zeros(n, bool)
        outer[self.starts[sizes > 0]] = True
        outer = outer[order]
        self.heads = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | outer[1:] | outer[:-1]][:n])
        self.symbols = np.where(outer[self.heads], -1, before[self.heads])
        self.first = order[self.heads]
        self.last = order[np.r_[self.heads[1:], n] - 1] if n else order

    def common(self, p: np.ndarray, q: np.ndarray, least: int) -> np.ndarray:
        """Longest common prefixes of pairs of suffixes; 0 where under ``least``."""
        out = np.zeros(len(p), np.int64)
        most = np.minimum(self.left[p], self.left[q])
        live = np.flatnonzero(most >= least)
        live = live[self.words[p[live] + least - 8] == self.words[q[live] + least - 8]]
        step = 0
        while len(live):
            inside = most[live] > step
            a, b = p[live], q[live]
            equal = inside & (self.words[np.minimum(a + step, len(self.words) - 1)] == self.words[np.minimum(b + step, len(self.words) - 1)])
            stop = live[~equal]
            if len(stop):
                x, y, size = p[stop] + step, q[stop] + step, np.minimum(step, most[stop])
                going = np.ones(len(stop), bool)
                for i in range(8):
                    going &= (step + i < most[stop]) & (self.data[np.minimum(x + i, len(self.data) - 1)] == self.data[np.minimum(y + i, len(self.data) - 1)])
                    size += going
                out[stop] = np.where(size >= least, size, 0)
            live = live[equal]
            step += 8
        return out

    def statistics(self, least: int) -> np.ndarray:
        """How far each position matches another one, 0 where under ``least``."""
        n = len(self.left)
        reach = np.zeros(n, np.int64)
        p, q = self.last[:-1], self.first[1:]
        size = self.common(p, q, least)
        hit = size > 0
        np.maximum.at(reach, p[hit], p[hit] + size[hit])
        np.maximum.at(reach, q[hit], q[hit] + size[hit])
        # A match never leaves its text, so one pass over all of them will do.
        here = np.maximum.accumulate(reach) - np.arange(n)
        return np.where(here >= least, here, 0)


def marked(texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each text the byte ranges that lie in repeated strings."""
    index = RunIndex(texts)
    far = index.statistics(LENGTH)
    cover = np.zeros(len(far) + 1, np.int64)
    at = np.flatnonzero(far)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + far[at], -1)
    inside = np.cumsum(cover)[:-1] > 0
    out = []
    for low, high in zip(index.starts, index.ends):
        edge = np.flatnonzero(np.diff(np.r_[False, inside[low:high], False]))
        out.append(list(zip(edge[::2].tolist(), edge[1::2].tolist())))
    return out


def _spread(table: pa.Table) -> pa.Table:
    spans = marked(table["body"].to_pylist())
    return pa.table(
        {"anchor": table["anchor"], "content": table["content"],
         "spans": pa.array([[{"low": a, "high": b} for a, b in s] for s in spans], pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])))}
    ).filter(pa.array([bool(s) for s in spans], pa.bool_()))


def _whole(bytes_: Column) -> Column:
    return F.array(F.struct(F.lit(0).alias("low"), bytes_.cast("int").alias("high"))).cast(_SPANS)


def _spans_of(groups: DataFrame, level: int) -> DataFrame:
    """(anchor, content, spans) of contexts (anchor, content, times, body), no two equal."""
    groups = saved(groups, f"contexts-{level}")
    many = saved(
        groups.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.length("body")).alias("bytes")).where("n > 1"),
        f"anchors-{level}",
    )
    total = many.where(F.col("bytes") <= TASK_BYTES).agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, -(-int(total) // TASK_BYTES))
    rows = groups.join(many, "anchor")
    small = rows.where(F.col("bytes") <= TASK_BYTES).withColumn("task", F.pmod(F.xxhash64("anchor"), F.lit(tasks)))
    found = small.select("task", "anchor", "content", "body").groupBy("task").applyInArrow(
        _spread, f"anchor long, content long, spans {_SPANS}"
    )
    if many.where(F.col("bytes") > TASK_BYTES).isEmpty():
        return found
    k = ANCHORS[level + 1]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            out = []
            for anchor, content, times, body in zip(*(batch.column(c).to_pylist() for c in range(4))):
                for h, low, size in zip(*contexts(np.frombuffer(body, np.uint8), k, roller)):
                    part = body[low : low + size + LENGTH - 1]
                    out.append((int(h.view(np.int64)), _content(body, low, size), anchor, content, int(low), times, part))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                names = ["anchor", "content", "above", "within", "shift", "times", "body"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    large = rows.where(F.col("bytes") > TASK_BYTES).select("anchor", "content", "times", "body")
    parts = large.mapInArrow(
        split, "anchor long, content long, above long, within long, shift int, times long, body binary"
    )
    deeper = saved(
        parts.groupBy("anchor", "content").agg(F.sum("times").alias("times"), F.first("body").alias("body")),
        f"parts-{level}",
    )
    spans = _spans_of(deeper, level + 1).union(
        deeper.where("times > 1").select("anchor", "content", _whole(F.length("body")))
    )
    back = parts.drop("times", "body").join(spans, ["anchor", "content"])
    moved = F.transform("spans", lambda x: F.struct((x.low + F.col("shift")).alias("low"), (x.high + F.col("shift")).alias("high")))
    back = back.select(F.col("above").alias("anchor"), F.col("within").alias("content"), moved.alias("spans"))
    return found.union(
        back.groupBy("anchor", "content").agg(F.flatten(F.collect_list("spans")).cast(_SPANS).alias("spans"))
    )


def _occurrences(df: DataFrame, key: str, text: str) -> DataFrame:
    """(anchor, content, key, row, low, size), one for each context of each row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            at, anchors, contents, rows, lows, sizes = [], [], [], [], [], []
            for i, raw in enumerate(batch.column(1).to_pylist()):
                if not raw or len(raw) < LENGTH:
                    continue
                h, low, size = contexts(np.frombuffer(raw, np.uint8), ANCHORS[0], roller)
                at.append(np.full(len(h), i))
                anchors.append(h.view(np.int64))
                contents += [_content(raw, a, n) for a, n in zip(low.tolist(), size.tolist())]
                rows.append(np.full(len(h), xxhash.xxh3_64_intdigest(raw) - (1 << 63), np.int64))
                lows.append(low)
                sizes.append(size)
            if at:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(anchors)), pa.array(contents, pa.int64()),
                     batch.column(0).take(pa.array(np.concatenate(at))), pa.array(np.concatenate(rows)),
                     pa.array(np.concatenate(lows).astype(np.int32)), pa.array(np.concatenate(sizes).astype(np.int32))],
                    ["anchor", "content", "key", "row", "low", "size"],
                )

    return df.select(F.col(key).alias("key"), F.col(text).cast("binary")).mapInArrow(
        run, f"anchor long, content long, key {kind}, row long, low int, size int"
    )


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, spans, kept), one row for each row of ``df``: the removed byte ranges,
    in order and apart, and what remains as bytes (a cut may fall inside a character).

    Null texts count as empty; texts under 400 bytes are whole. Repeated rows are each
    other's copies. Rows that agree in key and bytes have the same result.
    """
    every = _occurrences(df, key, text)
    where_ = F.min(F.struct(F.col("key").isNull().alias("n"), "key", "row", "low", "size")).alias("at")
    groups = every.groupBy("anchor", "content").agg(F.count("*").alias("times"), where_)
    anchors = groups.groupBy("anchor").agg(F.sum("times").alias("all"), F.count("*").alias("kinds"))
    # An anchor that occurs once has no repeat.
    groups = saved(groups.join(anchors.where("all > 1"), "anchor"), "repeated-contexts")
    wanted = groups.where("kinds > 1").select("anchor", "content", "times", "at.key", "at.row", "at.low", "at.size")
    wanted = wanted.groupBy(F.col("key").alias("k"), F.col("row").alias("r")).agg(
        F.collect_list(F.struct("anchor", "content", "times", "low", "size")).alias("cuts")
    )
    rows = packed_texts(df, key, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for packed, cuts in zip(batch.column("packed").to_pylist(), batch.column("cuts").to_pylist()):
                raw = unzip.decompress(packed)
                out += [(c["anchor"], c["content"], c["times"], raw[c["low"] : c["low"] + c["size"] + LENGTH - 1]) for c in cuts]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["anchor", "content", "times", "body"])

    def same(other: DataFrame) -> Column:
        return rows["key"].eqNullSafe(other["k"]) & (rows["row"] == other["r"])

    bodies = (
        rows.join(wanted, same(wanted)).select("packed", "cuts")
        .mapInArrow(cut, "anchor long, content long, times long, body binary")
        # Rows that agree in key and bytes bring the same contexts.
        .groupBy("anchor", "content").agg(F.first("times").alias("times"), F.first("body").alias("body"))
    )
    spans = _spans_of(bodies, 0).union(
        groups.where("times > 1").select("anchor", "content", _whole(F.col("at.size") + LENGTH - 1))
    )
    placed = every.join(saved(spans, "context-spans"), ["anchor", "content"])
    shifted = F.transform("spans", lambda x: F.struct((x.low + F.col("low")).alias("low"), (x.high + F.col("low")).alias("high")))
    gone = placed.select(F.col("key").alias("k"), F.col("row").alias("r"), F.explode(shifted).alias("span")).groupBy("k", "r").agg(
        F.collect_set("span").alias("gone")
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, spans_, kept = [], [], []
            for packed, found in zip(batch.column("packed").to_pylist(), batch.column("gone").to_pylist()):
                raw, own = unzip.decompress(packed), []
                for low, high in sorted((x["low"], x["high"]) for x in found or []):
                    if own and low <= own[-1]["high"]:
                        own[-1]["high"] = max(high, own[-1]["high"])
                    else:
                        own.append({"low": low, "high": high})
                edges = [0, *(e for s in own for e in (s["low"], s["high"])), len(raw)]
                sizes.append(len(raw))
                spans_.append(own)
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()),
                 pa.array(spans_, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))), pa.array(kept, pa.binary())],
                ["key", "n_bytes", "spans", "kept"],
            )

    kind = df.schema[key].dataType.simpleString()
    done = rows.join(gone, same(gone), "left").select("key", "packed", "gone").mapInArrow(
        apply, f"key {kind}, n_bytes long, spans {_SPANS}, kept binary"
    )
    return done.withColumnRenamed("key", key)

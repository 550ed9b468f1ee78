"""Ranked lexical search over a tree of documents.

Documents are restricted to the terms of the queries. Their term vectors, most frequent
term first, are laid into a prefix tree: documents with the same leading terms share a
path. A node keeps, for all documents below it, the greatest frequency of every term and
the smallest length factor; both together bound every score below. For each item the
tree is walked depth first, the most promising child first, and a subtree whose bound is
under the item's tenth score so far is left out. What remains is scored exactly, in
integers.

Items are taken in blocks of bounded text (``ITEM_BYTES``), each against all documents; only
a block's terms travel to the tasks. Trees are bounded by documents x terms (``CELLS``).
A task walks its trees one after the other, and its thresholds go from tree to tree; it
returns the best of each item, and these meet in a rank-limited window.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemill.llm.common import saved
from tidemill.llm.words import TERMS, Splitter, pieces

TOP = 10
ITEM_BYTES = 1 << 20  # of item text in one block
CELLS = 4 << 20  # documents x terms of one tree
LEAF = 8  # documents that are scored without going further down


def restricted(df: DataFrame, key: str, text: str, terms: np.ndarray) -> DataFrame:
    """(key, n, terms, tfs): all terms of a text by number, and those in ``terms`` (sorted
    hashes) by place with their frequencies."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(TERMS)
        for batch in batches:
            for first, texts in pieces(batch.column(1)):
                words = split(texts)
                place = np.minimum(np.searchsorted(terms, words.hash), max(len(terms) - 1, 0))
                hit = terms[place] == words.hash if len(terms) else np.zeros(len(place), bool)
                cell, tf = np.unique(words.text[hit] * max(len(terms), 1) + place[hit], return_counts=True)
                owner, term = np.divmod(cell, max(len(terms), 1))
                limits = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(np.bincount(words.text, minlength=len(texts)), pa.int64()),
                        pa.ListArray.from_arrays(limits, pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(limits, pa.array(tf, pa.int64())),
                    ],
                    ["key", "n", "terms", "tfs"],
                )

    return df.select(F.col(key).alias("key"), F.col(text).cast("binary")).mapInArrow(
        run, f"key {kind}, n long, terms array<int>, tfs array<long>"
    )


class Tree:
    """A prefix tree over the rows of ``tf`` (documents x terms, most frequent term
    first). Only nodes of at least ``LEAF`` documents are kept; a document belongs to the
    deepest of them."""

    def __init__(self, tf: np.ndarray, m: np.ndarray) -> None:
        has = np.packbits(tf > 0, axis=1)
        # Rows that have an earlier term come first, so rows that share a path are neighbours.
        order = np.lexsort(has.T[::-1])[::-1]
        self.order, self.tf, self.m, has = order, tf[order], m[order], has[order]
        differ = has[1:] != has[:-1]
        byte = differ.argmax(1)
        rows = np.arange(len(byte))
        bit = np.unpackbits((has[1:] ^ has[:-1])[rows, byte][:, None], axis=1).argmax(1)
        # Paths part at the first term that only one of two neighbours has.
        parted = np.where(differ.any(1), byte * 8 + bit, tf.shape[1] + 1)
        n = len(m)
        self.parent: list[int] = []
        low, high = [], []
        todo = [(0, n, -1)]
        while todo:
            a, b, above = todo.pop()
            node = len(low)
            low.append(a), high.append(b), self.parent.append(above)
            if b - a < 2 * LEAF:
                continue
            inner = parted[a : b - 1]
            if inner.min() > tf.shape[1]:
                continue  # all the same terms
            cut = np.concatenate([[a], np.flatnonzero(inner == inner.min()) + a + 1, [b]])
            todo += [(x, y, node) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()) if y - x >= LEAF]
        self.low, self.high = np.array(low), np.array(high)
        self.children: list[list[int]] = [[] for _ in low]
        owner = np.zeros(n, np.int64)
        for node, above in enumerate(self.parent):  # parents come before their children
            owner[low[node] : high[node]] = node
            if above >= 0:
                self.children[above].append(node)
        self.own = [np.zeros(0, np.int64)] * len(low)
        by = np.argsort(owner, kind="stable")
        limits = np.searchsorted(owner[by], np.arange(len(low) + 1))
        self.most, self.least = np.zeros((len(low), tf.shape[1]), tf.dtype), np.zeros(len(low), np.int64)
        for node in reversed(range(len(low))):
            self.own[node] = by[limits[node] : limits[node + 1]]
            parts = [self.most[c] for c in self.children[node]]
            least = [self.least[c] for c in self.children[node]]
            if len(self.own[node]):
                parts.append(self.tf[self.own[node]].max(0))
                least.append(self.m[self.own[node]].min())
            self.most[node] = reduce(np.maximum, parts)
            self.least[node] = min(least)


def scores(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum over the terms of weight * ((10**9 * tf) div (1000 * tf + 8 * m))."""
    tf = tf.astype(np.int64)
    return ((1_000_000_000 * tf) // (1000 * tf + 8 * m[:, None])) @ weight


def walk(tree: Tree, columns: np.ndarray, weight: np.ndarray, floor: int, seen: list[int]) -> list[tuple[int, int]]:
    """(score, row) of all documents that may be among the item's best: those not under the
    tenth score, ``floor`` or one found on the way."""
    bound = scores(tree.most[:, columns], tree.least, weight)
    best = [s for s in seen if s > 0]
    heapq.heapify(best)
    found, todo = [], [0]
    while todo:
        node = todo.pop()
        if bound[node] <= 0 or bound[node] < floor:
            continue
        rows = tree.own[node]
        if len(rows):
            for s, r in zip(scores(tree.tf[rows][:, columns], tree.m[rows], weight).tolist(), rows.tolist()):
                if s > 0 and s >= floor:
                    found.append((s, r))
                    heapq.heappush(best, s)
                    if len(best) > TOP:
                        heapq.heappop(best)
                    if len(best) == TOP:
                        floor = max(floor, best[0])
        todo += sorted(tree.children[node], key=lambda c: bound[c])
    return [(s, r) for s, r in found if s >= floor]


def _best(items: list[tuple[np.ndarray, np.ndarray]], width: int, order: np.ndarray, n_docs: int, n_terms: int):
    """Walks trees over the documents of a task. ``items`` have the places of their terms in
    frequency order and the weights, ``order`` the new place of each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[int, int, object]]] = [[] for _ in items]
        size = max(LEAF, CELLS // max(width, 1))

        def plant(keys: list, n: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
            dense = np.zeros((len(keys), width), np.int32 if not len(tf) or tf.max() < 2**31 else np.int64)
            dense[owner, order[term]] = tf
            tree = Tree(dense, 25 + np.array([75 * int(x) * n_docs // n_terms for x in n], np.int64))
            for kept, (columns, weight) in zip(held, items):
                if not len(columns):
                    continue
                floor = kept[TOP - 1][0] if len(kept) >= TOP else 0
                found = walk(tree, columns, weight, floor, [s for s, *_ in kept[:TOP]])
                if found:
                    kept += [(s, keys[tree.order[r]]) for s, r in found]
                    kept.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                    del kept[TOP:]

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists, tfs = part.column("terms"), part.column("tfs").flatten().to_numpy()
                count = lists.value_lengths().to_numpy()
                plant(
                    part.column("key").to_pylist(), part.column("n").to_numpy(),
                    np.repeat(np.arange(len(count)), count), lists.flatten().to_numpy(), tfs,
                )
        rows = [(i, key, s) for i, kept in enumerate(held) for s, key in kept]
        if rows:
            item, key, score = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(key), pa.array(score, pa.int64())], ["item", "key", "score"]
            )

    return run


def _blocks(items: DataFrame) -> Iterator[list[Row]]:
    block: list[Row] = []
    for row in items.toLocalIterator():
        if block and sum(len(r.text) for r in block) + len(row.text) > ITEM_BYTES:
            yield block
            block = []
        block.append(row)
    if block:
        yield block


def rank_documents(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item, rank, key, score): the 10 best documents of each item with a score above 0.

    Null texts have no terms, in documents and items; such items return nothing. Equal
    scores are ranked by key, null last; rows that repeat a key are ranked one by one. An
    item id with several texts is several items, ranked each for itself; rows that repeat an
    item whole count once. Terms are known by 64-bit hashes.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item).alias("id"), F.col(item_text).cast("binary").alias("text"))
    asked = asked.where("text is not null").distinct().orderBy("id", "text")
    kind = {"key": docs.schema[key].dataType, "id": items.schema[item].dataType}
    results = []
    for block in _blocks(asked):
        words = Splitter(TERMS)([bytes(r.text) for r in block])
        terms = np.unique(words.hash)
        vectors = saved(restricted(docs.select(key, text), key, text, terms).where("n > 0"), "search-vectors")
        total = vectors.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        df = np.zeros(len(terms), np.int64)
        for term, n in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[term] = n
        order = np.empty(len(terms), np.int64)
        order[np.argsort(-df, kind="stable")] = np.arange(len(terms))
        weight = np.array([math.floor(1000 * math.log((2 * total.n + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        asks = []
        for i in range(len(block)):
            own, times = np.unique(np.searchsorted(terms, words.hash[words.text == i]), return_counts=True)
            own, times = own[df[own] > 0], times[df[own] > 0]
            asks.append((order[own], weight[own] * times))
        best = vectors.where(F.size("terms") > 0).mapInArrow(
            _best(asks, len(terms), order, total.n, total.l or 1),
            f"item int, key {kind['key'].simpleString()}, score long",
        )
        names = spark.createDataFrame([(i, r.id) for i, r in enumerate(block)], f"item int, id {kind['id'].simpleString()}")
        results.append(best.join(names, "item").withColumn("block", F.lit(len(results))))
    if not results:
        return spark.createDataFrame([], f"`{item}` {kind['id'].simpleString()}, rank int, `{key}` {kind['key'].simpleString()}, score long")
    first = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = reduce(DataFrame.union, results).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= TOP)
    return ranked.select(F.col("id").alias(item), "rank", F.col("key").alias(key), "score")

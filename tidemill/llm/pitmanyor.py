"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Every context (the word before) is a restaurant whose customers are the words that follow
it, and all of them share one parent: each table of a context's restaurant is a customer of
the root restaurant, whose parent is uniform over the vocabulary and one unknown word. With
c customers of a word at t tables and totals C and T, a restaurant of discount d and strength
s predicts (c - d * t) / (s + C) + (s + d * T) / (s + C) * (the parent's prediction).

Seatings are sampled by Gibbs: all customers of one word in one restaurant leave and sit
down anew, given the other tables there and the parent's prediction. For few customers the
number of tables is drawn from the summed weights of all seatings, for many from a chain of
proposed seatings, accepted by the ratio of their weights. A word that occurs once after a
context has one table for certain. All words of a sweep see the totals of the sweep before,
and contexts see the root's prediction of the round before. Table counts are averaged over
the later sweeps, so the probabilities used are averaged ones.

How Spark shares the work. Documents are read in blocks, each with its own short word
numbers. Every word belongs to an owner (by hash), who counts it and gives it an id; every
word pair to a shard (by its context; frequent contexts are spread by their second word).
Blocks, owners and shards exchange folded lists: a block asks for each of its words and
pairs once, however often they occur. Nothing of the model is collected or broadcast but its
five totals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tidemill.llm.common import mix64, saved
from tidemill.llm.words import SPACED, Splitter, pieces

BLOCK = 8 << 20  # bytes of text in a block
PART = 3_000_000  # tokens for each owner and each shard
HOT = 100_000  # occurrences from which a context is spread over shards
STRENGTH = 1.0
ROUNDS, SWEEPS = 2, 3  # exchanges with the root; sweeps in each
HEAD = 32  # customers up to whose number all seatings are summed; beyond it they are proposed,
STEPS = 8  # so often in each sweep
END = np.uint64(0)
_SENT = "dst long, src long, kind int, a binary, b binary, c binary, x double, y double"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in the fewest bytes, others as single-precision floats; bytes of
    one place together, compressed."""
    if values.dtype.kind == "f":
        values = values.astype("<f4")
    else:
        values = values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return values.dtype.str.encode() + zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:3].decode())
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[3:]), np.uint8)
    values = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)
    return values.astype(np.float64 if kind.kind == "f" else np.int64)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


_ARROW = pa.schema([("dst", pa.int64()), ("src", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("x", pa.float64()), ("y", pa.float64())])


def sent(rows: list[tuple]) -> pa.Table:
    """Rows (dst, src, kind, up to three arrays, two numbers)."""
    full = [(*r[:3], *[pack(v) for v in r[3]], *[None] * (3 - len(r[3])), *(r[4:] or (None, None))) for r in rows]
    return _table(full, _ARROW)


def received(table: pa.Table, kind: int) -> list[tuple]:
    """(src, arrays) of a kind, by src."""
    rows = zip(*(table[c].to_pylist() for c in ("kind", "src", "a", "b", "c")))
    return sorted(((r[1], [unpack(v) for v in r[2:] if v is not None]) for r in rows if r[0] == kind), key=lambda r: r[0])


def spread(rows: DataFrame, key: str = "dst") -> GroupedData:
    """Groups in as many tasks as there are shuffle partitions: their rows are few and small,
    but their work is not."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key).groupBy(key)


def exchange(rows: DataFrame, work: Callable[[pa.Table], pa.Table]) -> DataFrame:
    return spread(rows).applyInArrow(work, _SENT)


# Kinds of rows.
ASK, NAMED, VOCABULARY, CELLS, STATE, MARKS, TABLES, ROOT, PARENT, TOTALS, WORDS, VALUES = range(12)


def read_blocks(df: DataFrame, key: str, text: str, learn: Column) -> DataFrame:
    """One row for each block: its documents, their tokens by the block's word numbers, and
    for each word its hash, the part of it that decides the owner, and its number of
    occurrences to learn from."""
    kind = df.schema[key].dataType.simpleString()

    def block(split: Splitter, at: int, type_: pa.DataType, keys: list, learns: list, texts: list[bytes]) -> pa.RecordBatch:
        hashes, counts = [], []
        for _, some in pieces(pa.array(texts, pa.binary())):
            words = split(some)
            hashes.append(words.hash)
            counts.append(np.bincount(words.text, minlength=len(some)))
        n = np.concatenate(counts) + 1  # and the end
        token = np.full(n.sum(), END)
        inside = np.ones(len(token), bool)
        inside[np.cumsum(n) - 1] = False
        token[inside] = np.concatenate(hashes)
        word, number, count = np.unique(token, return_inverse=True, return_counts=True)
        by = np.argsort(-count, kind="stable")
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        learnt = np.bincount(number, weights=np.repeat(np.array(learns, float), n), minlength=len(word))[by].astype(np.int64)
        arrays = [
            pa.array([at], pa.int64()), pa.array([keys], pa.list_(type_)), pa.array([learns], pa.list_(pa.bool_())),
            *[pa.array([pack(x)], pa.binary()) for x in (n, place[number], (word[by] >> np.uint64(40)).astype(np.int64), learnt)],
            pa.array([word[by].tobytes()], pa.binary()), pa.array([len(token)], pa.int64()),
        ]
        names = ["block", "keys", "learns", "n", "tokens", "owners", "learnt", "hashes", "size"]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, at = Splitter(SPACED), TaskContext.get().partitionId() << 32
        keys, learns, texts, size = [], [], [], 0
        for batch in batches:
            type_ = batch.schema.field(0).type
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if texts and size + len(row[1]) > BLOCK:
                    yield block(split, at, type_, keys, learns, texts)
                    at, keys, learns, texts, size = at + 1, [], [], [], 0
                keys.append(row[0]), texts.append(row[1]), learns.append(row[2])
                size += len(row[1])
        if texts:
            yield block(split, at, type_, keys, learns, texts)

    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"), F.coalesce(learn, F.lit(True)).alias("learn"))
    return rows.mapInArrow(
        run,
        f"block long, keys array<{kind}>, learns array<boolean>, n binary, tokens binary, owners binary, "
        "learnt binary, hashes binary, size long",
    )


def _asks(parts: int):
    """Block to owners: hashes of its words and their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, owners, learnt, hashes in zip(*(c.to_pylist() for c in batch.columns)):
                owner, count, word = unpack(owners) % parts, unpack(learnt), np.frombuffer(hashes, np.uint64)
                by = np.argsort(owner, kind="stable")
                limits = np.searchsorted(owner[by], np.arange(parts + 1))
                rows = [(o, at, ASK, [word[x], count[x]]) for o in range(parts) if len(x := by[limits[o] : limits[o + 1]])]
                yield from sent(rows).to_batches()

    return run


def _name(parts: int):
    """Owner: counts of its words, and ids by falling count; id % parts is the owner. To blocks:
    id + 1 (0: never to learn from) and count of each word asked for."""

    def run(table: pa.Table) -> pa.Table:
        owner, asks = table["dst"][0].as_py(), received(table, ASK)
        word, number = np.unique(np.concatenate([a[0].astype(np.uint64) for _, a in asks]), return_inverse=True)
        count = np.bincount(number, weights=np.concatenate([a[1] for _, a in asks]).astype(float)).astype(np.int64)
        by = np.argsort(-count, kind="stable")
        name = np.empty(len(by), np.int64)
        name[by] = np.arange(len(by)) * parts + owner + 1
        name[count == 0] = 0
        rows, at = [], 0
        for block, (asked, _) in asks:
            own = number[at : at + len(asked)]
            rows.append((block, owner, NAMED, [name[own], count[own]]))
            at += len(asked)
        rows.append((-1, owner, VOCABULARY, [], float((count > 0).sum()), float(count.sum())))
        ones = (-2, owner, VOCABULARY, [], float((count == 1).sum()), float((count == 2).sum()))
        return sent([*rows, ones])

    return run


class Pairs:
    """The distinct word pairs of a block and how they are asked for."""

    def __init__(self, tokens: np.ndarray, n: np.ndarray, name: np.ndarray, count: np.ndarray, parts: int) -> None:
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        last = np.cumsum(n) - 1
        before[np.concatenate([[0], last[:-1] + 1])] = tokens[last[0]]  # a text begins after an end
        code, self.number = np.unique(before * len(name) + tokens, return_inverse=True)
        self.context, self.word = np.divmod(code, len(name))
        u, w = name[self.context], name[self.word]
        spread = np.where(count[self.context] >= HOT, w, 0)
        shard = (mix64((u * 0x9E3779B1 + spread).astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        asked = np.flatnonzero((u > 0) & (w > 0))
        self.asked = asked[np.lexsort((w[asked], u[asked], shard[asked]))]
        self.u, self.w, self.shard = u[self.asked], w[self.asked], shard[self.asked]


def names_of(table: pa.Table, kind: int, owners: np.ndarray) -> list[np.ndarray]:
    """What the owners said of a block's words, by the block's numbers."""
    parts = received(table, kind)
    place = np.argsort(owners, kind="stable")
    out = []
    for k in range(len(parts[0][1])):
        told = np.concatenate([a[k] for _, a in parts])
        values = np.empty(len(told), told.dtype)
        values[place] = told
        out.append(values)
    return out


def _cells(parts: int):
    """Block to shards: its word pairs by id, and how often they are to be learnt from."""

    def run(blocks: pa.Table, named: pa.Table) -> pa.Table:
        if not len(blocks):
            return sent([])
        at, n, tokens, owners, learns = (blocks[c][0].as_py() for c in ("block", "n", "tokens", "owners", "learns"))
        n = unpack(n)
        name, count = names_of(named, NAMED, unpack(owners) % parts)
        pairs = Pairs(unpack(tokens), n, name, count, parts)
        learnt = np.bincount(pairs.number, weights=np.repeat(np.array(learns, float), n), minlength=len(pairs.context))
        learnt = learnt[pairs.asked].astype(np.int64)
        limits = np.searchsorted(pairs.shard, np.arange(parts + 1))
        rows = []
        for s, (low, high) in enumerate(zip(limits[:-1], limits[1:])):
            if high > low:
                rows.append((s, at, CELLS, [np.diff(pairs.u[low:high], prepend=0), pairs.w[low:high], learnt[low:high]]))
        return sent(rows)

    return run


def _gather(table: pa.Table) -> pa.Table:
    """Shard: the seating's state, and for each block which of its pairs are unknown (0),
    single (1) or have several customers (2, with their places in the state)."""
    shard, cells = table["dst"][0].as_py(), received(table, CELLS)
    u, context = np.unique(np.concatenate([np.cumsum(a[0]) for _, a in cells]), return_inverse=True)
    w, word = np.unique(np.concatenate([a[1] for _, a in cells]), return_inverse=True)
    code, number = np.unique(context * len(w) + word, return_inverse=True)
    count = np.bincount(number, weights=np.concatenate([a[2] for _, a in cells]).astype(float)).astype(np.int64)
    context, word = np.divmod(code, len(w))
    several = np.flatnonzero(count > 1)
    place = np.zeros(len(code), np.int64)
    place[several] = np.arange(len(several))
    single = count == 1
    first = [u[context[several]], w[word[several]], count[several]]
    once_u, once_w = np.bincount(context[single], minlength=len(u)), np.bincount(word[single], minlength=len(w))
    some_u, some_w = once_u > 0, once_w > 0
    rows = [
        (shard, 0, STATE, first, float(single.sum()), float((count == 2).sum())),
        (shard, 1, STATE, [u[some_u], once_u[some_u]]),
        (shard, 2, STATE, [w[some_w], once_w[some_w]]),
    ]
    at = 0
    for block, arrays in cells:
        own = number[at : at + len(arrays[0])]
        at += len(own)
        mark = np.minimum(count[own], 2)
        rows.append((shard, block, MARKS, [mark, place[own[mark == 2]]]))
    return sent(rows)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x above 0: Stirling's series, eight further on."""
    ahead = x + 8
    shift = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    return (ahead - 0.5) * np.log(ahead) - ahead + 0.5 * np.log(2 * np.pi) + 1 / (12 * ahead) - 1 / (360 * ahead**3) - shift


@lru_cache(maxsize=8)
def arrangements(d: float) -> np.ndarray:
    """Summed weights, new tables left out, of all ways to seat c customers at t tables one after
    the other (generalised Stirling numbers), in proportion for each c; c and t up to HEAD."""
    out = np.zeros((HEAD + 1, HEAD + 1))
    out[1, 1] = 1.0
    t = np.arange(HEAD + 1)
    for c in range(1, HEAD):
        out[c + 1, 1:] = (out[c] * np.maximum(c - d * t, 0))[1:] + out[c, :-1]
        out[c + 1] /= out[c + 1].max()
    return out


def few(c: np.ndarray, other: np.ndarray, parent: np.ndarray, gain: float, d: float, draw: np.random.Generator) -> np.ndarray:
    """Tables of up to HEAD customers, drawn from the conditional distribution: the first of
    exponential times whose rates are the weights. ``c`` falls."""
    known, whole, falling = arrangements(d), c.astype(np.int64), -c
    weight, t = np.ones(len(c)), np.ones(len(c))
    first = draw.standard_exponential(len(c)) / known[:, 1][whole]
    for n in range(2, int(c[0]) + 1 if len(c) else 2):
        k = np.searchsorted(falling, -n, "right")  # those with n or more
        # Beyond the limit all but surely each customer has a table.
        weight[:k] *= np.minimum((other[:k] + d * (n - 1)) * (parent[:k] + gain * (n - 1)), 1e9)
        with np.errstate(divide="ignore"):
            time = draw.standard_exponential(k) / (weight[:k] * known[:, n][whole[:k]])
        sooner = time < first[:k]
        np.copyto(first[:k], time, where=sooner)
        t[:k][sooner] = n
    return t


def proposals(
    c: np.ndarray, other: np.ndarray, parent: np.ndarray, gain: float, d: float, draw: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """(tables, log weight) of ``c`` customers who sit down in turn.

    A customer after i others at t tables takes a new one with weight
    new(t) = (other + d * t) * (parent + gain * t) and an old one with i - d * t. A new table
    lowers what is left to later ones about as (i / c) ** d, so the proposal opens tables at
    the rate new(t) * i ** (d - 1) / c ** d and passes over all customers up to the next new
    table at once. The log weight is that of the seating, less that of the proposal.
    """
    t, weight, at = np.ones(len(c)), np.zeros(len(c)), np.ones(len(c))
    todo = np.arange(len(c))
    while len(todo):
        n, i, k = c[todo], at[todo], t[todo]
        new = (other[todo] + d * k) * (parent[todo] + gain * k)
        rate = np.maximum(new * n**-d / d, 1e-300)  # of i ** d
        with np.errstate(over="ignore"):
            after = np.floor((i**d + draw.exponential(size=len(todo)) / rate) ** (1 / d))
        after = np.minimum(np.maximum(after, i), n)
        opens = after < n
        weight[todo] += _log_gamma(after - d * k) - _log_gamma(i - d * k) + rate * (after**d - i**d)
        chance = -np.expm1(-rate * ((after + 1) ** d - after**d))
        weight[todo] += np.where(opens, np.log(new) - np.log(np.maximum(chance, 1e-300)), 0.0)
        t[todo] += opens
        at[todo] = after + opens
        todo = todo[after + opens < n]
    return t, weight


def seat(
    c: np.ndarray, other: np.ndarray, parent: np.ndarray, gain: float, d: float, draw: np.random.Generator
) -> np.ndarray:
    """Tables of a word's ``c`` customers, given the rest of the restaurant. ``other`` is the
    strength plus d times the other words' tables, ``parent`` the word's probability at the
    parent without these customers' tables, each of which adds ``gain``. ``c`` falls."""
    many = np.searchsorted(-c, -HEAD, "left")
    rest = slice(many, None)
    small = few(c[rest], other[rest], parent[rest], gain, d, draw)
    # All steps' proposals at once, as none depends on the step before.
    large = (np.tile(x[:many], STEPS) for x in (c, other, parent))
    tables, weights = (x.reshape(STEPS, many) for x in proposals(*large, gain, d, draw))
    t, weight = tables[0], weights[0]
    for s, more in zip(tables[1:], weights[1:]):
        better = np.log(draw.random(many)) < more - weight
        t, weight = np.where(better, s, t), np.where(better, more, weight)
    return np.concatenate([t, small])


def folded(ids: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    name, number = np.unique(np.concatenate(ids), return_inverse=True)
    return name, np.bincount(number, weights=np.concatenate(values).astype(float), minlength=len(name))


def look_up(ids: np.ndarray, name: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of ``ids``; ``name`` is sorted and holds all of them."""
    return values[np.searchsorted(name, ids)] if len(ids) else np.zeros(0)


def joined(told: list[tuple], ids: np.ndarray) -> list[np.ndarray]:
    """What several owners told of ``ids``: their names and further arrays."""
    arrays = [np.concatenate(x) for x in zip(*(a for _, a in told))]
    by = np.argsort(arrays[0])
    return [look_up(ids, arrays[0][by], x[by]) for x in arrays]


def state_of(table: pa.Table) -> list[list[np.ndarray]]:
    return [arrays for _, arrays in received(table, STATE)]


def _tables(parts: int, d: float, totals: tuple[float, ...] | None, round_: int):
    """Shard: seats its customers, given the totals and parents' predictions that the owners
    sent (before the first round, one table for each word). To owners: tables of each dish, as
    they stand, and of each context, on average. To itself: both for each pair."""

    def run(states: pa.Table, told: pa.Table) -> pa.Table:
        if not len(states):
            return sent([])
        shard = states["dst"][0].as_py()
        (u, w, c), once_u, once_w = state_of(states)
        t = mean = np.ones(len(c))
        if totals is not None and len(c):
            mean, t = received(told, VALUES)[0][1]
            size, root_c, root_t, root_d = totals
            _, customers, root = joined(received(told, PARENT), w)
            # Without this pair's tables; a word without other ones has its first table there.
            others = customers - t
            mass = np.where(others > 0, others - root_d * np.maximum(root * others / customers, 1), -root_d)
            parent = (mass + (STRENGTH + root_d * root_t) / (size + 1)) / (STRENGTH + root_c)
            _, tables = joined(received(told, TOTALS), u)  # also of this context's words in other shards
            draw = np.random.default_rng([round_, shard])
            order = np.argsort(-c, kind="stable")
            back = np.empty(len(c), np.int64)
            back[order] = np.arange(len(c))
            context = np.unique(u, return_inverse=True)[1]
            start = tables - np.bincount(context, weights=mean)[context]  # of single words and other shards
            now = np.bincount(context, weights=t)
            mean = np.zeros(len(c))
            for sweep in range(SWEEPS):
                other = STRENGTH + d * np.maximum(start + now[context] - t, 0)
                t = seat(c[order], other[order], parent[order], 1 / (STRENGTH + root_c), d, draw)[back]
                now = np.bincount(context, weights=t)
                mean += t / (SWEEPS - 1) if sweep else 0
        rows = []
        dish, tables = folded([w, once_w[0]], [t, once_w[1]])
        tables = tables.astype(np.int64)
        own, sums = folded([u, once_u[0]], [mean, once_u[1]])
        wanted = np.isin(dish, w), np.isin(own, u)
        for ids, values, asks, part in ((dish, tables, wanted[0], 0), (own, sums, wanted[1], 1)):
            owner = (ids - 1) % parts
            for o in range(parts):
                x = owner == o
                if x.any():
                    rows.append((o, shard * 2 + part, TABLES, [ids[x], values[x], asks[x].astype(np.int64)]))
        rows.append((shard, 0, VALUES, [mean, t.astype(np.int64)]))
        return sent(rows)

    return run


def _root(parts: int, size: float, root_t: float, root_d: float, round_: int):
    """Owner: seats the tables of all contexts as customers of the root. To shards: customers and
    tables there of the words, and tables of the contexts, that they ask for."""

    def run(table: pa.Table) -> pa.Table:
        owner, told = table["dst"][0].as_py(), received(table, TABLES)
        dishes, contexts = [a for s, a in told if s % 2 == 0], [a for s, a in told if s % 2]
        none = [np.zeros(0, np.int64)]
        dish, customers = folded([a[0] for a in dishes] or none, [a[1] for a in dishes] or none)
        context, tables = folded([a[0] for a in contexts] or none, [a[1] for a in contexts] or none)
        by = np.argsort(-customers, kind="stable")
        c = customers[by]
        draw = np.random.default_rng([round_, owner, 7])
        t, mean = np.minimum(c, root_t / max(size, 1)), np.zeros(len(c))
        for sweep in range(SWEEPS):
            other = STRENGTH + root_d * np.maximum(root_t - t, 0)  # tables of the other words
            t = seat(c, other, np.full(len(c), 1 / (size + 1)), 0.0, root_d, draw)
            mean[by] += t / (SWEEPS - 1) if sweep else 0
        mass = customers - root_d * mean
        names = np.union1d(dish, context)
        masses, sums = np.zeros(len(names)), np.zeros(len(names))
        masses[np.searchsorted(names, dish)] = mass
        sums[np.searchsorted(names, context)] = tables
        rows = [(owner, 0, ROOT, [names, masses, sums], customers.sum(), mean.sum())]
        for source, a in told:
            ids = a[0][a[2] > 0]
            if len(ids) and source % 2:
                rows.append((source // 2, owner, TOTALS, [ids, look_up(ids, context, tables)]))
            elif len(ids):
                rows.append((source // 2, owner, PARENT, [ids, look_up(ids, dish, customers).astype(np.int64), look_up(ids, dish, mean)]))
        return sent(rows)

    return run


def _words(table: pa.Table) -> pa.Table:
    """Owner to blocks: of each word its id, count, customers at the root and tables."""
    owner = table["dst"][0].as_py()
    roots = received(table, ROOT)
    names, masses, sums = roots[0][1] if roots else [np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
    rows = []
    for block, (name, count) in received(table, NAMED):
        known = name > 0
        mass, total = np.zeros(len(name)), np.zeros(len(name))
        mass[known], total[known] = look_up(name[known], names, masses), look_up(name[known], names, sums)
        rows.append((block, owner, WORDS, [name, count]))
        rows.append((block, owner, PARENT, [mass, total]))
    return sent(rows)


def _values(d: float):
    """Shard to blocks: of each pair asked for whether it is known and, if it has several
    customers, how many, less discounts."""

    def run(table: pa.Table) -> pa.Table:
        shard = table["dst"][0].as_py()
        count = state_of(table)[0][2]
        values = count - d * received(table, VALUES)[0][1][0]
        return sent([(block, shard, VALUES, [mark, values[place]]) for block, (mark, place) in received(table, MARKS)])

    return run


def _score(parts: int, d: float, totals: tuple[float, ...], learned: float):
    size, root_c, root_t, root_d = totals

    def run(blocks: pa.Table, told: pa.Table) -> pa.Table:
        schema = pa.schema([("key", blocks.schema.field("keys").type.value_type), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        if not len(blocks):
            return _table([], schema)
        keys, n, tokens, owners = (blocks[c][0].as_py() for c in ("keys", "n", "tokens", "owners"))
        n, tokens, owners = unpack(n), unpack(tokens), unpack(owners) % parts
        name, count = names_of(told, WORDS, owners)
        mass, tables = names_of(told, PARENT, owners)
        pairs = Pairs(tokens, n, name, count, parts)
        seated = np.zeros(len(pairs.context))
        answers = received(told, VALUES)
        if answers:
            mark = np.concatenate([a[0] for _, a in answers])
            value = np.where(mark == 1, 1 - d, 0.0)
            value[mark == 2] = np.concatenate([a[1] for _, a in answers])
            seated[pairs.asked] = value
        parent = (mass + (STRENGTH + root_d * root_t) / (size + 1)) / (STRENGTH + root_c)
        total = count[pairs.context]
        chance = (seated + (STRENGTH + d * tables[pairs.context]) * parent[pairs.word]) / (STRENGTH + total)
        chance = np.log10(np.where(total > 0, chance, parent[pairs.word]))[pairs.number]
        base = np.log10((count + 1) / (learned + size + 1))[tokens]
        starts = np.cumsum(n) - n
        known = np.add.reduceat((count > 0)[tokens].astype(np.int64), starts)
        columns = [keys, n, known, np.add.reduceat(base, starts), np.add.reduceat(chance, starts)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def score_texts(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score), one row for each row of
    ``df``. The model learns from rows where ``learn`` (a condition on ``df``) is true or null.

    Tokens are the words between ASCII white space, A-Z in lower case, and one end for each
    text; null texts are empty ones, whose only token is the end. ``base_score`` is the log10
    probability by add-one counts of single words, ``score`` the model's. Rows that repeat a
    key are scored one by one. An empty table returns no rows; if there is nothing to learn from,
    all words are unknown. Words are known by 64-bit hashes.
    """
    kind = df.schema[key].dataType.simpleString()
    blocks = saved(read_blocks(df, key, text, learn), "lm-blocks")
    parts = max(1, (blocks.agg(F.sum("size")).first()[0] or 0) // PART)
    asks = blocks.select("block", "owners", "learnt", "hashes").mapInArrow(_asks(parts), _SENT)
    named = saved(exchange(asks, _name(parts)), "lm-names")
    found = {r.dst: r for r in named.where(F.col("kind") == VOCABULARY).groupBy("dst").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).collect()}
    if not found:
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    size, learned = found[-1].x, found[-1].y

    def discount(ones: float, twos: float) -> float:
        """Of words seen once, the share that the next text is likely to bring again."""
        return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.05

    root_d = discount(found[-2].x, found[-2].y)
    told = named.where(F.col("kind") == NAMED)
    by_block = spread(blocks.select("block", "learns", "n", "tokens", "owners"), "block")
    cells = by_block.cogroup(spread(told)).applyInArrow(_cells(parts), _SENT)
    shards = saved(exchange(cells, _gather), "lm-shards")
    states = shards.where(F.col("kind") == STATE)
    ones = states.agg(F.sum("x"), F.sum("y")).first()
    d = discount(ones[0] or 0.0, ones[1] or 0.0)

    totals, root_t, answers = None, size, named.limit(0)
    for round_ in range(ROUNDS + 1):
        seats = spread(states).cogroup(spread(answers)).applyInArrow(_tables(parts, d, totals, round_), _SENT)
        seats = saved(seats, "lm-tables")
        roots = saved(exchange(seats.where(F.col("kind") == TABLES), _root(parts, size, root_t, root_d, round_)), "lm-root")
        sums = roots.where(F.col("kind") == ROOT).agg(F.sum("x"), F.sum("y")).first()
        root_t = sums[1] or 0.0
        totals, answers = (size, sums[0] or 0.0, root_t, root_d), roots.where(F.col("kind").isin(PARENT, TOTALS))
        answers = answers.union(seats.where(F.col("kind") == VALUES))

    words = exchange(told.withColumns({"dst": F.col("src"), "src": F.col("dst")}).union(roots.where(F.col("kind") == ROOT)), _words)
    values = exchange(shards.where(F.col("kind").isin(STATE, MARKS)).union(seats.where(F.col("kind") == VALUES)), _values(d))
    final = spread(blocks.select("block", "keys", "n", "tokens", "owners"), "block")
    scored = final.cogroup(spread(words.union(values))).applyInArrow(
        _score(parts, d, totals, learned), f"key {kind}, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(
        F.col("key").alias(key), "n_tokens", "n_known", F.lit(int(learned)).cast("long").alias("train_tokens"),
        "base_score", "score",
    )

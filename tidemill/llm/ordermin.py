"""Near-duplicate documents by order MinHash and banded alignment.

A document is its sequence of five-word shingles, each labelled with its occurrence, so
that none repeats. A sketch takes the few shingles with the smallest hashes and keeps
them in text order: equal sketches tell of equal order, not just of equal sets. Pairs
with an equal sketch are candidates; they are aligned inside the band that a
similarity of 0.8 leaves, over shingles both have in the same order. Sketches of texts
with few shingles seldom agree, so these also meet by single shingles: the first ones in
the order of hashes, so many that two texts alike must share one.

Copies with the same words count once, as the one with the smallest key. Candidates are
found in two steps without pairing all members of a group: first every member of a
bucket meets the bucket's centre, the member with the most company in all buckets.
What is then connected needs no more comparing. The other members meet all of the
bucket, block by block, behind a filter of one-permutation MinHash slots; so a large
group is many tasks, and a link between members that both miss the centre is found.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import components, mix64, packed_texts, saved, texts_of

SHINGLE, SIMILAR = 5, 0.8
# Of a pair at 0.8, U shingles in all, the sketches miss (1 - C(0.8 U, 6) / C(U, 6)) ** 32:
# once in 3,700 times at 24 of 30, in 10,900 at 80 of 100, in 16,000 for long texts.
SKETCHES, PICKED = 32, 6
SHORT = 25  # shingles up to which texts also meet by single ones; up to 20, none is missed
SLOTS, SURE_SLOTS, LIKE = 64, 40, 0.55
BLOCK = 1000


def shingles(text: str) -> np.ndarray:
    """Hashes of the labelled shingles in text order; a text of fewer than five words is
    one shingle, one without words has none. Case does not count."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    own = {w: 0 for w in words}
    for w in own:
        own[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    hashes = np.fromiter(map(own.__getitem__, words), np.uint64, len(words))
    n, k = max(1, len(hashes) - SHINGLE + 1), min(SHINGLE, len(hashes))
    rolled = np.full(n, k, np.uint64)
    for i in range(k):
        rolled = mix64(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    order = np.argsort(rolled, kind="stable")
    same = np.r_[False, np.diff(rolled[order].view(np.int64)) == 0]
    if same.any():
        start = np.flatnonzero(~same)
        turn = np.arange(n) - np.repeat(start, np.diff(np.r_[start, n]))
        label = np.empty(n, np.uint64)
        label[order] = turn
        rolled = mix64(rolled ^ (label * np.uint64(0xC2B2AE3D27D4EB4F)))
    return rolled


_SEEDS = mix64(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketches(hashes: np.ndarray) -> np.ndarray:
    """One value for each sketch: its shingles in text order."""
    out, k = np.empty(SKETCHES, np.uint64), min(PICKED, len(hashes))
    step = max(1, 500_000 // len(hashes))
    for at in range(0, SKETCHES, step):
        seeds = _SEEDS[at : at + step]
        mixed = mix64(hashes[None, :] ^ seeds[:, None])
        low = np.sort(np.argpartition(mixed, k - 1, axis=1)[:, :k], axis=1)
        value = seeds.copy()
        for i in range(k):
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + hashes[low[:, i]])
        out[at : at + step] = value
    return out


def shared_singles(hashes: np.ndarray) -> np.ndarray:
    """Of a text with up to ``SHORT`` shingles, the smallest in the order of mixed hashes.
    Two texts at 0.8 or more have 0.8 of either's shingles in common, so with so many
    that fewer than that are left, both have the smallest common one among theirs."""
    n = len(hashes)
    if n > SHORT:
        return hashes[:0]
    return hashes[np.argsort(mix64(hashes), kind="stable")[: n - -(-n * 4 // 5) + 1]]


def slots(hashes: np.ndarray) -> bytes:
    """The smallest hash of each of 64 bins, as 16 bits; 0 for an empty bin."""
    mixed = np.sort(mix64(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    bins = (mixed >> np.uint64(58)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    out = np.zeros(SLOTS, "<u2")
    out[bins[first]] = mixed[first] % np.uint64(65535) + np.uint64(1)
    return out.tobytes()


def alignment(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """Shingles matched in the same order by those of either; 0 where the band says that
    it is below ``least``. The shingles of a text are distinct, so the longest common
    subsequence is the longest increasing run of positions."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    band = int((1 - least) / (1 + least) * (len(a) + len(b))) + 1
    if abs(len(a) - len(b)) > band:
        return 0.0
    _, at, bt = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at - bt) <= band
    at, bt = at[near], bt[near]
    if len(at) < least / (1 + least) * (len(a) + len(b)) - 1e-9:
        return 0.0
    bt = bt[np.argsort(at)]
    if (np.diff(bt) > 0).all():
        matched = len(bt)
    else:
        tails: list[int] = []
        for x in bt.tolist():
            i = bisect_left(tails, x)
            tails[i : i + 1] = [x]
        matched = len(tails)
    return matched / (len(a) + len(b) - matched)


_SKETCH = "key {0}, copy binary, sketches array<long>, slots binary"


def sketched(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, copy, sketches, slots); equal ``copy`` means equal words. Behind the sketches
    stand the single shingles of a short text."""
    kind = df.schema[key].dataType
    schema = T._parse_datatype_string(_SKETCH.format(kind.simpleString()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, values, bins = [], [], []
            for t in texts_of(batch.column(1)):
                own = shingles(t)
                copies.append(xxhash.xxh3_128_digest("\n".join(t.lower().split()).encode("utf-8", "surrogatepass")))
                values.append(np.r_[sketches(own), shared_singles(own)].view(np.int64).tolist() if len(own) else [])
                bins.append(slots(own) if len(own) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(copies, pa.binary()), pa.array(values, pa.list_(pa.int64())), pa.array(bins, pa.binary())],
                ["key", "copy", "sketches", "slots"],
            )

    return df.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text")).mapInArrow(run, schema)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those (a, b) of ``pairs`` that align; ``texts`` has (key, packed)."""
    side = {x: texts.select(F.col("key").alias(x), F.col("packed").alias(f"text_{x}")) for x in "ab"}
    both = pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        last: tuple[bytes | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            good = []
            for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if s != last[0]:
                    last = (s, shingles(unzip.decompress(s).decode("utf-8")))
                good.append(alignment(last[1], shingles(unzip.decompress(t).decode("utf-8"))) >= SIMILAR)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, both.select("a", "b").schema)


def _meet(table: pa.Table) -> pa.Table:
    """The classes that verified links of the left members with others connect. Members
    with like slots are aligned, the likest first, until their classes are connected."""
    texts = table["packed"]
    is_left = table["left"].to_numpy()
    left, right = np.flatnonzero(is_left), np.flatnonzero(~is_left)
    bins = np.frombuffer(b"".join(table["slots"].to_pylist()), "<u2").reshape(-1, SLOTS)
    other = bins[right]
    names, classes = np.unique(table["comp"].to_numpy(), return_inverse=True)
    root = list(range(len(names)))
    unzip = zstandard.ZstdDecompressor()
    known: dict[int, np.ndarray] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    def own(i: int) -> np.ndarray:
        if i not in known:
            known[i] = shingles(unzip.decompress(texts[i].as_py()).decode("utf-8"))
        return known[i]

    links = []
    for i in left.tolist():
        equal = ((bins[i] == other) & (other > 0)).sum(1)
        any_ = ((bins[i] > 0) | (other > 0)).sum(1)
        like = np.flatnonzero((equal >= LIKE * any_) | (any_ < SURE_SLOTS))
        for j in right[like[np.argsort(-equal[like], kind="stable")]].tolist():
            x, y = find(classes[i]), find(classes[j])
            if x != y and alignment(own(i), own(j)) >= SIMILAR:
                root[max(x, y)] = min(x, y)
                links.append((names[classes[i]], names[classes[j]]))
    kind = table.schema.field("comp").type
    return pa.table({"a": pa.array([a for a, _ in links], kind), "b": pa.array([b for _, b in links], kind)})


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, kept), one row for each row of ``df``: ``class_id`` is the smallest
    key of the class, ``kept`` says that the row is the class's first.

    Classes are connected by alignments of at least 0.8, or by equal words. Texts that
    are null, empty or blank are copies of each other. Rows with one key are one
    document, and one of them is kept; a row with a null key is in no class and kept.
    """
    every = saved(sketched(df, key, text), "omh-sketches")
    named = every.where("key is not null")
    firsts = named.groupBy("copy").agg(F.min("key").alias("rep"))
    reps = saved(
        named.join(firsts, "copy").where("key = rep").dropDuplicates(["key"]).select("key", "sketches", "slots"),
        "omh-representatives",
    )
    entries = reps.select("key", F.posexplode("sketches").alias("band", "value"))
    entries = entries.withColumn("band", F.least("band", F.lit(SKETCHES)))  # single shingles have one band
    crowd = entries.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    members = saved(entries.join(crowd, ["band", "value"]), "omh-buckets")
    company = members.groupBy("key").agg(F.sum("n").alias("company"))
    centres = (
        members.join(company, "key").groupBy("band", "value")
        .agg(F.max_by("key", F.struct("company", F.xxhash64("key"))).alias("centre"))
    )
    pairs = (
        members.join(centres, ["band", "value"]).where("key <> centre")
        .select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b")).distinct()
    )
    texts = packed_texts(df, key, text).join(members.select("key").distinct(), "key", "left_semi")
    texts = saved(texts.groupBy("key").agg(F.min("packed").alias("packed")), "omh-texts")
    links = saved(verified(pairs, texts), "omh-links")
    found = saved(components(links, "omh-components"), "omh-classes")

    # Members that are not connected to the centre meet all others of the bucket.
    placed = members.join(found, members["key"] == found["id"], "left").select(
        "band", "value", "n", "key", F.coalesce("component", "key").alias("comp")
    )
    homes = centres.join(found, centres["centre"] == found["id"], "left").select(
        "band", "value", F.coalesce("component", "centre").alias("home")
    )
    placed = placed.join(homes, ["band", "value"])
    open_ = placed.where("comp <> home").groupBy("band", "value").agg(F.count("*").alias("stray"))
    rest = placed.join(open_, ["band", "value"]).join(reps.select("key", "slots"), "key").join(texts, "key")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    spot = F.pmod(F.xxhash64("key"), blocks).cast("int")
    lots = F.sequence(F.lit(0), blocks - 1)
    left = rest.where("comp <> home").select("*", spot.alias("i"), F.explode(lots).alias("j"), F.lit(True).alias("left"))
    right = rest.select("*", F.explode(lots).alias("i"), spot.alias("j"), F.lit(False).alias("left"))
    kind = df.schema[key].dataType.simpleString()
    more = (
        left.union(right).select("band", "value", "i", "j", "left", "comp", "slots", "packed")
        .groupBy("band", "value", "i", "j").applyInArrow(_meet, f"a {kind}, b {kind}")
    )
    more = saved(more, "omh-more-links")
    if not more.isEmpty():
        # Only the classes that got a link are connected anew; the others stay as they are.
        joined = components(more, "omh-components").select(F.col("id").alias("class"), F.col("component").alias("whole"))
        joined = saved(joined, "omh-joined-classes")
        moved = found.join(joined, found["component"] == joined["class"], "left")
        found = moved.select("id", F.coalesce("whole", "component").alias("component")).union(joined)
        found = saved(found, "omh-classes")

    classes = every.join(firsts, "copy", "left").join(found, F.col("rep") == F.col("id"), "left")
    class_id = F.when(F.col("key").isNotNull(), F.coalesce("component", "rep"))
    turn = F.row_number().over(Window.partitionBy("key").orderBy("copy"))
    return classes.withColumn("_turn", turn).select(
        F.col("key").alias(key), class_id.alias("class_id"),
        (F.col("key").isNull() | ((F.col("key") == class_id) & (F.col("_turn") == 1))).alias("kept"),
    )

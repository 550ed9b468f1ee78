"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source has the same expected number of copies. Its whole part is
taken for certain; the fraction is an inclusion probability, which the flight phase
moves to 0 or 1 without changing the source's sums of probabilities and of words: each
step follows the null space of these two constraints. Flights run on chunks of a
source; what stays fractional, at most two documents of a chunk, meets in the next
round's chunks, until one chunk is left for each source. There the landing phase rounds the
last few so that the words miss the target least, gives up the number of documents, and
takes single ones in or out until none brings the words closer.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import positional, saved

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, CEILING = 1.5, 2.0
CHUNK = 2000
_EPS = 1e-9


def word_count(text: str) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, n, target). Sources by code point, null last, have the
    ``weights`` in turn and share 1.5 times all words; no target exceeds twice its
    source, and the excess is shared by weight again until none does.

    The level all other targets reach is found at once: in the order of the words at
    which a source is full, it is the first that the next source doesn't fill below.
    The windows run over one row for each source.
    """
    every = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    every = every.withColumn("weight", weight).withColumn("most", CEILING * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rest = SHARE * F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = rest / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    every = every.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))
    return every.withColumn("level", F.max(fits).over(whole)).select(
        "source", "source_size", "n",
        F.least("most", F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def flight(p: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Moves the probabilities until at most two are between 0 and 1; the sums of
    ``p`` and of ``p * size`` stay."""
    p, open_ = p.astype(float), []
    chance = draw.random(len(p) + 1)
    for k in range(len(p)):
        if not _EPS < p[k] < 1 - _EPS:
            continue
        open_.append(k)
        if len(open_) == 3:
            a, b, c = (float(size[i]) for i in open_)
            step = [b - c, c - a, a - b] if not a == b == c else [1.0, -1.0, 0.0]
        elif len(open_) == 2 and size[open_[0]] == size[open_[1]]:
            step = [1.0, -1.0]
        else:
            continue
        up = min((1 - p[i]) / s if s > 0 else p[i] / -s for i, s in zip(open_, step) if s)
        down = min(p[i] / s if s > 0 else (1 - p[i]) / -s for i, s in zip(open_, step) if s)
        move = up if chance[k] * (up + down) < down else -down
        for i, s in zip(open_, step):
            p[i] += move * s
            p[i] = 0.0 if p[i] < _EPS else 1.0 if p[i] > 1 - _EPS else p[i]
        open_ = [i for i in open_ if _EPS < p[i] < 1 - _EPS]
    return p


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rounds the few open probabilities so that the words differ least, and among those ways
    the numbers. Of equal ways the first counts."""
    open_ = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    change = ways - p[open_]
    words, number = np.abs(change @ size[open_].astype(float)), np.abs(change.sum(1))
    p = p.copy()
    p[open_] = ways[np.lexsort((number, np.round(words, 6)))[0]]
    return p


def _fly(group: pd.DataFrame) -> pd.DataFrame:
    # Large documents first: those that land are small.
    group = group.sort_values(["size", "_order"], ascending=[False, True], kind="stable")
    seed = [int(group["_chunk"].iloc[0]), int(group["_order"].iloc[0]) & (2**63 - 1), len(group)]
    p, size, draw = group["_p"].to_numpy(float), group["size"].to_numpy(), np.random.default_rng(seed)
    if group["_chunks"].iloc[0] > 1:
        return group.assign(_p=flight(p, size, draw))
    # Rows without words change nothing, and are not taken.
    p[(size == 0) & (p < 1 - _EPS)] = 0.0
    flown = flight(p, size, draw)
    landed = np.round(landing(flown, size))
    return group.assign(_p=mend(landed, size, float((landed - p) @ size)))


def mend(taken: np.ndarray, size: np.ndarray, error: float) -> np.ndarray:
    """Takes documents in or out, each time the one or two that bring the words closest, as long
    as that helps: the last open documents may be large, and rounding them miss by much."""
    taken, size = taken.copy(), np.append(size.astype(float), 0.0)  # the last stands for none
    while len(taken):
        change = np.append(np.where(taken > 0.5, -1.0, 1.0), 0.0) * size
        order = np.argsort(change, kind="stable")
        rising = change[order]
        # For each first one the second that comes closest, from either side.
        at = np.clip(np.searchsorted(rising, -(error + change)), 1, len(rising) - 1)
        second = np.stack([order[at - 1], order[at]])
        left = np.abs(error + change + change[second])
        left[second == np.arange(len(change))] = np.inf
        side, first = np.unravel_index(int(left.argmin()), left.shape)
        if left[side, first] >= abs(error) - _EPS:
            break
        for i in (first, second[side, first]):
            if i < len(taken):
                taken[i] = 1 - taken[i]
                error += change[i]
    return taken


def mix_sources(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", chunk: int = CHUNK
) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken), one row for each row.

    ``copies`` is how often the mix takes a document (0, 1 or 2), ``taken`` the words.
    Null texts have no words; rows without words and those of sources without words
    are taken 0 words. The null source is a source. Draws depend on key and size alone,
    so reruns agree; repeated rows are drawn one by one.
    """
    sized = saved(
        df.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(text).alias("size")),
        "mix-sizes",
    )
    goal = targets(sized).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # A bounded table only as long as the sources are few, so Spark decides the join.
    rows = sized.join(goal, sized["source"].eqNullSafe(goal["_source"])).drop("_source").withColumn("_rate", rate)
    sure = F.floor(F.col("_rate") + _EPS)
    rows = rows.withColumns(
        {"_sure": sure, "_p": F.greatest(F.col("_rate") - sure, F.lit(0.0)), "_order": F.xxhash64("key", "size")}
    ).drop("_rate")
    settled, flying = [], rows
    schema = rows.schema
    first = True
    while True:
        if first:
            counts = goal.select("_source", F.col("n").alias("_n"))
        else:
            counts = flying.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("_n"))
        chunks = F.ceil(F.col("_n") / chunk).cast("long")
        counts = counts.withColumn("_chunks", chunks)
        rounds_left = (counts.agg(F.max("_chunks")).first()[0] or 0) > 1
        dealt = flying.join(counts, flying["source"].eqNullSafe(counts["_source"])).drop("_source", "_n")
        dealt = dealt.withColumn("_chunk", F.pmod(F.xxhash64("key", "size", F.lit(7)), F.col("_chunks")))
        flown = saved(dealt.groupBy("source", "_chunk").applyInPandas(_fly, dealt.schema), "mix-flight")
        if not rounds_left:
            settled.append(flown.select(*schema.names))
            break
        open_ = F.col("_p").between(_EPS, 1 - _EPS)
        settled.append(flown.where(~open_).select(*schema.names))
        flying, first = flown.where(open_).select(*schema.names), False
    copies = (F.col("_sure") + F.round("_p")).cast("long")
    return reduce(DataFrame.union, settled).select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def take_copies(df: DataFrame, mixed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, each as often as ``mixed`` says. Rows with equal keys are told
    apart by their sizes; those that also agree in these are interchangeable. Null keys are
    equal, null texts have size 0, and an empty table gives none.

    The texts move once: rows meet what is decided of their key and size, folded to one row,
    and are numbered where they are.
    """
    def place(k: Column, size: Column) -> dict[str, Column]:
        return {"_key": F.coalesce(k.cast("string"), F.lit("")), "_null": k.isNull(), "_size": size}

    spot = ["_key", "_null", "_size"]
    decided = mixed.groupBy(*[c.alias(n) for n, c in place(F.col(key), F.col("size")).items()]).agg(
        F.count_if(F.col("copies") == 1).alias("_once"), F.count_if(F.col("copies") == 2).alias("_twice")
    )
    plain, names = positional(df)
    own = plain.withColumns(place(F.col(names[key]), word_count(names[text])))
    # Numbered by the columns of the join: nothing moves again.
    turn = F.row_number().over(Window.partitionBy(*spot).orderBy(F.lit(0)))
    met = own.join(decided.where("_once + _twice > 0").hint("shuffle_merge"), spot).withColumn("_turn", turn)
    times = F.when(F.col("_turn") <= F.col("_twice"), 2).when(F.col("_turn") <= F.col("_twice") + F.col("_once"), 1)
    copies = F.array_repeat(F.lit(1), F.coalesce(times, F.lit(0)))
    return met.withColumn("_copy", F.explode(copies)).select(*[F.col(c).alias(n) for n, c in names.items()])

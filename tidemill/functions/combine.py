"""Aggregates that can be taken in two steps, passed around as values.

An aggregate over few large groups (panes of a sliding window, sessions of a hot
key) is first folded into small pieces with ``fold`` and the pieces are then
merged with ``merge``. Both steps are built-in aggregates, so each of them is
also combined inside the map tasks before its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Combine:
    """``parts``: name -> aggregate over rows; ``merge``: name -> aggregate over
    the part of that name; ``finish``: the result from the merged parts."""

    parts: dict[str, Callable[[Column], Column]]
    merge: dict[str, Callable[[Column], Column]]
    finish: Callable[[dict[str, Column]], Column]

    def fold(self, value: Column) -> list[Column]:
        return [make(value).alias(name) for name, make in self.parts.items()]

    def merge_parts(self) -> list[Column]:
        return [make(F.col(name)).alias(name) for name, make in self.merge.items()]

    def result(self) -> Column:
        return self.finish({name: F.col(name) for name in self.parts})


# Names the windowed operators use for themselves.
RESERVED = frozenset(
    "_sum _n _rows _rest _limb0 _limb1 _limb2 _limb3 _limb4 _limb5 _limb6 _limb7 _limb8 _limb9 _w _t _us _reading _pane _cell _part _first _last _before _after _starts "
    "_session _edge window_start window_end".split()
)


def refuse_reserved(keys: Sequence[str]) -> None:
    clash = sorted(RESERVED.intersection(k.lower() for k in keys))
    if clash:
        raise ValueError(f"reserved names, rename these keys: {', '.join(clash)}")


# NULL readings are ignored; a group of only NULLs has the mean NULL.
MEAN = Combine(
    parts={"_sum": F.sum, "_n": F.count},
    merge={"_sum": F.sum, "_n": F.sum},
    finish=lambda p: F.when(p["_n"] > 0, p["_sum"].cast("double") / p["_n"]),
)

# A double is a sum of whole multiples of powers of 2**24. Sums of each are exact in 64 bits
# for 2**39 rows, so their order does not matter.
_LIMB = 24
_LIMBS = range(-5, 5)
_RANGE = (2.0 ** (_LIMB * _LIMBS[0] + 53), 2.0 ** (_LIMB * (_LIMBS[-1] + 1)))


def _limb(k: int) -> Callable[[Column], Column]:
    def make(value: Column) -> Column:
        x = value.cast("double")
        # A remainder of doubles is exact; the cast drops what smaller multiples hold.
        digit = ((F.abs(x) * F.lit(2.0 ** (-_LIMB * k))) % F.lit(2.0**_LIMB)).cast("long")
        return F.sum(F.when(_in_range(x), F.when(x < 0, -digit).otherwise(digit)).otherwise(F.lit(0).cast("long")))

    return make


def _in_range(x: Column) -> Column:
    return (x == 0) | (F.abs(x) >= F.lit(_RANGE[0])) & (F.abs(x) < F.lit(_RANGE[1]))


def _limb_name(k: int) -> str:
    return f"_limb{k - _LIMBS[0]}"


def _exact_mean(p: dict[str, Column]) -> Column:
    """Carries the sums of the multiples into each other, the smallest first, and adds them."""
    digits = F.array(*[F.struct(p[_limb_name(k)].alias("v"), F.lit(2.0 ** (_LIMB * k)).alias("unit")) for k in _LIMBS])
    zero = F.struct(F.lit(0).cast("long").alias("carry"), F.lit(0.0).alias("total"))

    def add(acc: Column, x: Column) -> Column:
        v = x["v"] + acc["carry"]
        # From minus half to half, so that a small negative sum has no large parts.
        half = F.lit(1 << (_LIMB - 1))
        low = F.pmod(v + half, F.lit(1 << _LIMB)) - half
        return F.struct(F.shiftright(v - low, _LIMB).alias("carry"), (acc["total"] + low * x["unit"]).alias("total"))

    top = F.lit(2.0 ** (_LIMB * (_LIMBS[-1] + 1)))
    total = F.aggregate(digits, zero, add, lambda acc: acc["total"] + acc["carry"] * top)
    return F.when(p["_n"] > 0, (total + F.coalesce(p["_rest"], F.lit(0.0))) / p["_n"])


# The mean of doubles, the same to the last bit however the rows are dealt out. Values of
# 2**120 and more, those nearer to 0 than 2**-67, and NaN are summed as they come.
EXACT_MEAN = Combine(
    parts={
        **{_limb_name(k): _limb(k) for k in _LIMBS},
        "_rest": lambda v: F.sum(F.when(~_in_range(v.cast("double")), v.cast("double"))),
        "_n": F.count,
    },
    merge={**{_limb_name(k): F.sum for k in _LIMBS}, "_rest": F.sum, "_n": F.sum},
    finish=_exact_mean,
)

COUNT = Combine(
    parts={"_n": lambda _: F.count(F.lit(1))},
    merge={"_n": F.sum},
    finish=lambda p: p["_n"],
)

# Both at once, as a struct: the count is a part of the mean anyway.
MEAN_AND_COUNT = Combine(
    parts={**MEAN.parts, "_rows": lambda _: F.count(F.lit(1))},
    merge={**MEAN.merge, "_rows": F.sum},
    finish=lambda p: F.struct(MEAN.finish(p).alias("mean"), p["_rows"].alias("n")),
)

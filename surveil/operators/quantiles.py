"""Exact quantiles of a whole numeric column by narrowing, without sorting it."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

ACCURACY = 10_000  # of the sketches: the quantiles that they give err by this part of the rows
FEW = 10_000  # rows that are few enough to be listed
SPREAD = (-4, -1, 0, 1, 4)  # cuts around a rank, in units of the sketch's error


@dataclass(frozen=True)
class Open:
    """A rank whose value lies strictly between ``lo`` and ``hi`` (None: no bound), with ``below`` values up to ``lo`` and ``n`` between."""

    rank: int
    lo: object
    hi: object
    below: int
    n: int

    def holds(self) -> Column:
        low = F.lit(True) if self.lo is None else F.col("v") > F.lit(self.lo)
        return low if self.hi is None else low & (F.col("v") < F.lit(self.hi))

    def value(self) -> Column:
        return F.when(self.holds(), F.col("v"))


def _cuts(values: DataFrame, open_: list[Open], accuracy: int) -> list[list]:
    """Per rank a few values around it, by a sketch of what is between its bounds. They may miss it, which costs a round."""
    sketches = []
    for i, o in enumerate(open_):
        at = [min(1.0, max(0.0, (o.rank - o.below) / o.n + k / accuracy)) for k in SPREAD]
        sketches.append(F.percentile_approx(o.value(), F.array(*map(F.lit, at)), F.lit(accuracy)).alias(f"q{i}"))
    row = values.agg(*sketches).first()
    return [sorted(set(row[f"q{i}"])) for i in range(len(open_))]


def _narrowed(values: DataFrame, open_: list[Open], cuts: list[list]) -> list[Open | object]:
    """Exact counts at the cuts: a rank's value is a cut, or lies strictly between two of them."""
    counts = []
    for i, (o, points) in enumerate(zip(open_, cuts)):
        for j, c in enumerate(points):
            counts += [F.count(F.when(o.value() < F.lit(c), 1)).alias(f"lt{i}_{j}"), F.count(F.when(o.value() <= F.lit(c), 1)).alias(f"le{i}_{j}")]
    row = values.agg(*counts).first()
    out: list = []
    for i, (o, points) in enumerate(zip(open_, cuts)):
        lo, below, found = o.lo, o.below, None
        for j, c in enumerate(points):
            less, upto = o.below + row[f"lt{i}_{j}"], o.below + row[f"le{i}_{j}"]
            if o.rank <= less:
                found = Open(o.rank, lo, c, below, less - below)
            elif o.rank <= upto:
                found = c
            if found is not None:
                break
            lo, below = c, upto
        out.append(found if found is not None else Open(o.rank, lo, o.hi, below, o.below + o.n - below))
    return out


def _listed(values: DataFrame, o: Open):
    upto = o.below
    for r in sorted(values.filter(o.holds()).groupBy("v").count().collect(), key=lambda r: r["v"]):
        upto += r["count"]
        if upto >= o.rank:
            return r["v"]
    raise AssertionError("the rank is beyond the values counted")


def values_at(df: DataFrame, c: str, ranks: Sequence[int], n: int, accuracy: int = ACCURACY, few: int = FEW) -> list:
    """The values at ``ranks``, from 1, of the ``n`` values of the column in order, missing ones and NaN left out.

    Per round, a sketch of the open part gives a few cuts around each rank, and an aggregate counts exactly how many
    values lie below and at each cut; the search goes on between two neighbouring cuts. Sketches and counts
    combine on the map side, so a task sends a few numbers. Each round leaves a few rows in ``accuracy``, however
    the values are distributed, and a value that very many rows share is a cut and ends the search. ``few`` rows
    that are left are listed.
    """
    values = _numbers(df, c)
    if any(r < 1 or r > n for r in ranks):
        raise ValueError(f"ranks {sorted(ranks)} of {n} values")
    found: dict[int, object] = {}
    open_ = [Open(r, None, None, 0, n) for r in sorted(set(ranks))]
    while open_:
        found |= {o.rank: _listed(values, o) for o in open_ if o.n <= few}
        open_ = [o for o in open_ if o.n > few]
        if open_:
            results = _narrowed(values, open_, _cuts(values, open_, accuracy))
            found |= {o.rank: r for o, r in zip(open_, results) if not isinstance(r, Open)}
            open_ = [r for r in results if isinstance(r, Open)]
    return [found[r] for r in ranks]


def _numbers(df: DataFrame, c: str) -> DataFrame:
    if not isinstance(df.schema[c].dataType, NumericType):
        raise TypeError(f"{c!r} must be a number")
    return df.select(F.col(f"`{c}`").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double")))


def quantiles(df: DataFrame, c: str, probabilities: Sequence[float], accuracy: int = ACCURACY, few: int = FEW) -> list[float | None]:
    """Exact quantiles, interpolated between the two nearest values (the usual default); None without a value.

    ``df`` is read a few times, so it should be a table. Missing values and NaN are left out.
    """
    n = _numbers(df, c).count()
    if not n:
        return [None] * len(probabilities)
    places = [(n - 1) * p + 1 for p in probabilities]
    ranks = sorted({r for h in places for r in (math.floor(h), math.ceil(h))})
    at = dict(zip(ranks, values_at(df, c, ranks, n, accuracy, few)))
    out = []
    for h in places:
        lower, upper = float(at[math.floor(h)]), float(at[math.ceil(h)])
        out.append(lower if lower == upper else lower + (h - math.floor(h)) * (upper - lower))
    return out


def mean_and_median(df: DataFrame, lag: str) -> DataFrame:
    """Mean and exact median of a numeric lag of any kind, missing lags left out: one row."""
    median, = quantiles(df, lag, [0.5])
    return _numbers(df, lag).agg(F.avg("v").cast("double").alias("mean_lag"), F.lit(median).cast("double").alias("median_lag"))

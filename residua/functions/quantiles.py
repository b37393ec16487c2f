"""Exact interpolated quantiles in a few scans, without a sort of the data, a sketch or an unbounded buffer.

Every wanted rank is followed through ever finer bins of values. A scan counts the rows per bin (with their least
and greatest value), combined in the map tasks, so that a task sends at most one small row per bin; the bin that holds the
rank is the next range. A range that has become small, or one single value, gives the rank.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.columns import no_nan

BINS = 1_024
PICK_ROWS = 200_000


@dataclass
class _Rank:
    """A zero-based rank of a column and the closed range of values that holds it."""

    column: str
    rank: int
    lo: float
    hi: float
    below: int
    inside: int

    @property
    def range(self) -> tuple[str, float, float]:
        return self.column, self.lo, self.hi


def exact_quantiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    probabilities: Sequence[float],
    bins: int = BINS,
    pick_rows: int = PICK_ROWS,
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles per named expression; missing values are skipped, none left gives ``None``."""
    names = {name: f"v{i}" for i, name in enumerate(columns)}
    values = df.select(*[no_nan(columns[n].cast("double")).alias(v) for n, v in names.items()])
    first = values.agg(
        *[f(v).alias(f"{n}_{v}") for v in names.values() for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    ).first()
    sizes = {v: first[f"n_{v}"] for v in names.values()}
    ranks = [
        _Rank(v, r, first[f"lo_{v}"], first[f"hi_{v}"], 0, sizes[v])
        for v in names.values()
        if sizes[v]
        for r in sorted({r for p in probabilities for r in _neighbours(sizes[v], p)})
    ]
    logarithmic = True  # magnitudes first; every other pass cuts a range into equal parts
    while wide := [r for r in ranks if r.lo < r.hi and r.inside > pick_rows]:
        _narrow(values, wide, bins, logarithmic)
        logarithmic = not logarithmic
    _pick(values, [r for r in ranks if r.lo < r.hi])
    found = {(r.column, r.rank): r.lo for r in ranks}
    return {
        name: [_interpolate({r: found[v, r] for r in _neighbours(sizes[v], p)}, sizes[v], p) if sizes[v] else None for p in probabilities]
        for name, v in names.items()
    }


def exact_quantile(df: DataFrame, column: Column | str, probability: float, **options) -> float | None:
    c = F.col(column) if isinstance(column, str) else column
    return exact_quantiles(df, {"value": c}, [probability], **options)["value"][0]


def _neighbours(n: int, p: float) -> list[int]:
    position = (n - 1) * p
    return sorted({math.floor(position), math.ceil(position)})


def _interpolate(at: dict[int, float], n: int, p: float) -> float:
    position = (n - 1) * p
    low, high = math.floor(position), math.ceil(position)
    return at[low] if low == high or at[low] == at[high] else at[low] + (at[high] - at[low]) * (position - low)


def _inside(column: str, lo: float, hi: float) -> Column:
    return F.col(column).between(F.lit(lo), F.lit(hi))


def _magnitude(v: Column) -> Column:
    """Signed logarithm; infinities lie beyond all finite numbers."""
    return F.greatest(F.lit(-1e3), F.least(F.lit(1e3), F.signum(v) * F.log1p(F.abs(v))))


def _bin(v: Column, lo: float, hi: float, bins: int, logarithmic: bool) -> Column:
    """A number from 0 to ``bins`` - 1 that never falls as ``v`` grows, 0 for ``lo`` and the last for ``hi``."""
    if not math.isfinite(hi - lo) or logarithmic:
        a, b, x = _magnitude(F.lit(lo)), _magnitude(F.lit(hi)), _magnitude(v)
    else:
        a, b, x = F.lit(lo), F.lit(hi), v
    share = F.when(b > a, (x - a) / F.when(b > a, b - a)).otherwise(F.when(v > lo, 1.0).otherwise(0.0))
    return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")


def _narrow(values: DataFrame, ranks: list[_Rank], bins: int, logarithmic: bool) -> None:
    """One scan: each rank's range shrinks to the bin that holds the rank."""
    ranges = list(dict.fromkeys(r.range for r in ranks))
    entries = [
        F.when(
            _inside(c, lo, hi),
            F.struct(F.lit(i).alias("range"), _bin(F.col(c), lo, hi, bins, logarithmic).alias("bin"), F.col(c).alias("v")),
        )
        for i, (c, lo, hi) in enumerate(ranges)
    ]
    counted = values.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).groupBy("e.range", "e.bin")
    rows = counted.agg(F.count(F.lit(1)).alias("n"), F.min("e.v").alias("lo"), F.max("e.v").alias("hi")).collect()
    held: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r["range"], r["bin"])):
        held.setdefault(row["range"], []).append(row)
    for r in ranks:
        below = r.below
        for row in held[ranges.index(r.range)]:
            if r.rank < below + row["n"]:
                r.lo, r.hi, r.below, r.inside = row["lo"], row["hi"], below, row["n"]
                break
            below += row["n"]


def _pick(values: DataFrame, ranks: list[_Rank]) -> None:
    """Rank the distinct values inside each small range and read off the wanted ones."""
    if not ranks:
        return
    ranges = list(dict.fromkeys(r.range for r in ranks))
    entries = [
        F.when(_inside(c, lo, hi), F.struct(F.lit(i).alias("range"), F.col(c).alias("v"))) for i, (c, lo, hi) in enumerate(ranges)
    ]
    wanted = F.array(*[F.array(*[F.lit(r.rank - r.below) for r in ranks if r.range == x]) for x in ranges])
    counted = (
        values.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy("e.range", "e.v")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    running = Window.partitionBy("range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("upto", F.sum("c").over(running))
    held = F.filter(F.get(wanted, F.col("range")), lambda r: (r >= F.col("upto") - F.col("c")) & (r < F.col("upto")))
    found = {(row["range"], row["rank"]): row["v"] for row in ranked.select("range", "v", F.explode(held).alias("rank")).collect()}
    for r, i in [(r, ranges.index(r.range)) for r in ranks]:
        r.lo = r.hi = found[i, r.rank - r.below]

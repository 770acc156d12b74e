"""Exact order statistics of many columns at once, by histograms that are refined together.

Every pass is one aggregate over the table for all columns: for each value still searched for, the
counts, least and greatest values of equal bins between the bounds known so far. The bin that holds
the rank gives the next bounds; a bin of one value ends its search. Nothing is sorted, kept or
shuffled but bin counts, and the number of passes depends on the values, not on the number of columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from math import inf

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.literals import name

BINS = 1024
WIDE = 64.0  # bounds further apart than this factor are cut by logarithms


@dataclass(frozen=True)
class Target:
    """The value at ``rank`` (from 0) among the values of ``column`` between ``low`` and ``high``."""

    column: str
    rank: int
    low: float
    high: float

    @property
    def value(self) -> float | None:
        return self.low if self.low == self.high else None


def order_statistics(df: DataFrame, columns: Sequence[str], ranks: Callable[[int], Sequence[int]]) -> dict[str, list[float]]:
    """For each column the values at the ranks that ``ranks`` names for its count; null and NaN are no values.

    ``df`` is read once for the counts and bounds and once a pass; give it a stored table.
    """
    x = {c: F.when(~F.isnan(F.col(name(c)).cast("double")), F.col(name(c)).cast("double")) for c in columns}
    row = df.agg(*(
        f(x[c]).alias(f"{kind}{i}") for i, c in enumerate(columns) for kind, f in (("n", F.count), ("lo", F.min), ("hi", F.max))
    )).first() if columns else []
    wanted = {}
    for i, c in enumerate(columns):
        n, low, high = row[3 * i : 3 * i + 3]
        wanted[c] = [Target(c, r, low, high) for r in ranks(n)] if n else []
    while True:
        # Targets of one column between the same bounds share their histogram.
        open_ = sorted({(t.column, t.low, t.high) for ts in wanted.values() for t in ts if t.value is None})
        if not open_:
            return {c: [t.low for t in ts] for c, ts in wanted.items()}
        bins = _histograms(df, x, open_)
        wanted = {c: [t if t.value is not None else _narrowed(t, bins[t.column, t.low, t.high]) for t in ts] for c, ts in wanted.items()}


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The exact median of each column, the mean of the two middle values where their number is even; None without values."""
    found = order_statistics(df, columns, lambda n: sorted({(n - 1) // 2, n // 2}))
    return {c: sum(v / len(values) for v in values) if values else None for c, values in found.items()}


def _narrowed(target: Target, bins: list[tuple[int, float, float]]) -> Target:
    left = target.rank
    for n, low, high in bins:
        if left < n:
            return replace(target, rank=left, low=low, high=high)
        left -= n
    raise ValueError(f"rank {target.rank} of {target.column} is outside its bounds")


def _histograms(df: DataFrame, x: dict[str, Column], open_: list[tuple[str, float, float]]) -> dict[tuple, list[tuple[int, float, float]]]:
    """The bins (count, least, greatest) of each open range, ascending; at most BINS + 1 rows a range reach the driver."""
    entries = [
        F.when(x[c].between(low, high), F.struct(F.lit(i).alias("t"), _bin(x[c], low, high).alias("b"), x[c].alias("x")))
        for i, (c, low, high) in enumerate(open_)
    ]
    exploded = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
    counted = exploded.groupBy("e.t", "e.b").agg(F.count(F.lit(1)).alias("n"), F.min("e.x").alias("low"), F.max("e.x").alias("high"))
    found: dict[tuple, list] = {key: [] for key in open_}
    for r in sorted(counted.collect(), key=lambda r: (r.t, r.b)):
        found[open_[r.t]].append((r.n, r.low, r.high))
    return found


def _bin(x: Column, low: float, high: float) -> Column:
    """A bin number that never falls while x rises: cut evenly, or by logarithms where the bounds are far apart.

    The least and the greatest value are never in one bin, so every pass narrows.
    """
    if low == -inf or high == inf:  # infinite values have bins of their own
        return F.when(x == -inf, 0).when(x == inf, 2).otherwise(1)
    if low > 0 and high / WIDE > low:
        at, a, b = F.log(x), F.log(F.lit(low)), F.log(F.lit(high))
    elif high < 0 and low / WIDE < high:
        at, a, b = -F.log(-x), -F.log(F.lit(-low)), -F.log(F.lit(-high))
    elif low < 0 < high:
        return F.when(x < 0, 0).when(x > 0, 2).otherwise(1)
    elif high > 1.0 and low == 0.0 or low < -1.0 and high == 0.0:
        at = F.signum(x) * F.log1p(F.abs(x))
        a, b = (F.lit(0.0), F.log1p(F.lit(high))) if low == 0.0 else (-F.log1p(F.lit(-low)), F.lit(0.0))
    else:
        at, a, b = x / 2, F.lit(low / 2), F.lit(high / 2)  # halves, for the difference of large bounds
    place = F.when(b > a, F.floor((at - a) / (b - a) * BINS)).otherwise(F.lit(0)).cast("int")
    return F.when(x == high, BINS + 1).when(x == low, -1).otherwise(F.greatest(F.lit(0), F.least(place, F.lit(BINS))))

"""Frames of preceding rows whose cost grows with the logarithm of their length.

The block of 2n rows that ends at a row is the block of n rows that ends there put together with
the one that ends n rows before. A frame of any length is a chain of such blocks of falling
powers of two, so each power is made once and serves all frames. Nothing is subtracted, so means
and deviations lose no digits over long series, and extremes need no queue. Blocks are reached by
lags, all by the group and in its order: one exchange and one sort of df's own columns serve
everything, and rows with parts only stream through the windows, so nothing wide is sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a frame needs of its blocks, by function; squares are those of distances from the mean.
PARTS = {
    "max": ["max"],
    "min": ["min"],
    "sum": ["sum"],
    "count": ["count"],
    "avg": ["sum", "count"],
    "stddev_samp": ["count", "mean", "squares"],
}


def _of_one(part: str, c: str, row) -> Column:
    """A part of the block that is one row."""
    x = F.col(c)
    if part == "count":
        return F.when(x.isNull(), 0).otherwise(1).cast("long")
    if part == "sum":
        return F.sum(x).over(row)  # of the type that Spark gives sums
    if part == "squares":
        return F.when(x.isNotNull(), F.lit(0.0))
    return x.cast("double") if part == "mean" else x


def _both(part: str, a: dict[str, Column], b: dict[str, Column]) -> Column:
    """A part of two disjoint blocks, of which either may be empty."""
    x, y = a[part], b[part]
    if part in ("max", "min"):
        return F.greatest(x, y) if part == "max" else F.least(x, y)
    if part == "count":
        return F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))
    if part == "sum":
        return F.coalesce(x + y, x, y)
    n, m, apart = a["count"].cast("double"), b["count"].cast("double"), b["mean"] - a["mean"]
    if part == "mean":
        return F.coalesce(x + apart * m / (n + m), x, y)
    return F.coalesce(x + y + apart * apart * n * m / (n + m), x, y)


def _made(function: str, part: dict[str, Column]) -> Column:
    """The function over a frame, of its parts."""
    if function == "count":
        return F.coalesce(part["count"], F.lit(0).cast("long"))
    if function == "avg":
        return part["sum"] / F.nullif(part["count"], F.lit(0))
    if function == "stddev_samp":
        return F.when(part["count"] > 1, F.sqrt(part["squares"] / (part["count"] - 1)))
    return part[function]


def preceding_frames(df: DataFrame, frames: dict[str, tuple[str, str, int]], *, by: list[str], order: list[str]) -> DataFrame:
    """df with frames: name -> (function, column, n), the function over the n rows before the current one, which is in no frame.

    Functions: max, min, sum, count, avg, stddev_samp, with nulls left out as Spark does; the
    order must be unique in a group. Columns of df may have any names but those ending in _part.
    """
    own = Window.partitionBy(*by).orderBy(*order)
    wanted = {n: sorted({(p, c) for f, c, m in frames.values() if m == n for p in PARTS[f]}) for n in sorted({n for _, _, n in frames.values()})}
    block = lambda p, c: f"block_{p}_{c}_part"
    frame = lambda p, c, n: f"frame_{p}_{c}_{n}_part"
    shifted = lambda p, c, k: f"lag_{p}_{c}_{k}_part"
    single = own.rowsBetween(0, 0)
    rows = df.withColumns({block(p, c): _of_one(p, c, single) for p, c in sorted({x for parts in wanted.values() for x in parts})})
    types, size, covered = dict(rows.dtypes), 1, dict.fromkeys(wanted, 0)
    while size <= max(wanted, default=0):
        # Frames of which this power is a part take the block that ends before what they have; then the blocks double, if a longer frame needs it.
        taking = [n for n in wanted if n & size]
        doubled = sorted({x for n, parts in wanted.items() if n >= 2 * size for x in parts})
        back = {(p, c, covered[n] + 1) for n in taking for p, c in wanted[n]} | {(p, c, size) for p, c in doubled}
        rows = rows.withColumns({shifted(p, c, k): F.lag(block(p, c), k).over(own) for p, c, k in sorted(back)})
        made = {}
        for n in taking:
            for p, c in wanted[n]:
                new = {q: F.col(shifted(q, c, covered[n] + 1)) for q, d in wanted[n] if d == c}
                old = {q: F.col(frame(q, c, n)) for q in new}
                made[frame(p, c, n)] = (_both(p, new, old) if covered[n] else new[p]).cast(types[block(p, c)])
            covered[n] += size
        for p, c in doubled:
            new = {q: F.col(shifted(q, c, size)) for q, d in doubled if d == c}
            made[block(p, c)] = _both(p, new, {q: F.col(block(q, c)) for q in new}).cast(types[block(p, c)])
        rest = [frame(p, c, n) for n, parts in wanted.items() if covered[n] and n not in taking for p, c in parts]
        rows = rows.select(*df.columns, *rest, *[x.alias(name) for name, x in made.items()])
        size *= 2
    return rows.select(*df.columns, *[_made(f, {p: F.col(frame(p, c, n)) for p in PARTS[f]}).alias(name) for name, (f, c, n) in frames.items()])


def plain_frames(df: DataFrame, frames: dict[str, tuple[str, str, int]], *, by: list[str], order: list[str]) -> DataFrame:
    """The same by Spark's own frames, which go over all n rows for each row."""
    own = Window.partitionBy(*by).orderBy(*order)
    return reduce(lambda d, x: d.withColumn(x[0], getattr(F, x[1][0])(x[1][1]).over(own.rowsBetween(-x[1][2], -1))), frames.items(), df)

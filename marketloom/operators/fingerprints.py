"""Comparing two large keyed tables by a tree of fingerprints.

A leaf is a month and a range of key hashes; its fingerprint is the number of its rows and two
sums of 64-bit row hashes, so it does not depend on the order of rows. A month's fingerprint is
the sum of its leaves. Fingerprints are made in one pass that combines before the shuffle, may
be stored beside a table, and are the only thing that is compared for parts that agree. Below
unequal nodes the exact join decides; rows there are compared by value, so a fingerprint can at
worst hide a difference (two sums of 64 bits that agree by chance), never make one up. The
exact way without fingerprints is reconcile.key_differences() and what stands beside it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import reconcile
from .merge import MONTH, with_month

LEAF = [*MONTH, "part"]
MARKS = ["n_rows", "mark_1", "mark_2"]
#: Key ranges of a month.
PARTS = 16


def part_of(key: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("part"), *key), F.lit(parts)).cast("int")


def fingerprints(table: DataFrame, key: list[str], columns: list[str], *, parts: int = PARTS) -> DataFrame:
    """(year, month, part, n_rows, mark_1, mark_2) of a table with a date, over key and columns. Nulls and their places count."""
    nulls = F.concat_ws("", *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in [*key, *columns]])  # a hash passes over nulls
    marks = [F.xxhash64(F.lit(seed), nulls, *key, *columns).alias(f"mark_{i}") for i, seed in enumerate(("a", "b"), 1)]
    rows = with_month(table).select(*MONTH, part_of(key, parts).alias("part"), *marks)
    return rows.groupBy(*LEAF).agg(F.count(F.lit(1)).alias("n_rows"), *[_hash_sum(m).alias(m) for m in ("mark_1", "mark_2")])


def _hash_sum(c: str) -> Column:
    """The exact sum of 64-bit hashes, by sums of their halves: a decimal for each row would cost more than the hashes."""
    high, low = F.sum(F.shiftright(c, 32)), F.sum(F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))
    return (high.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(20,0)")).cast("decimal(30,0)")


def month_fingerprints(leaves: DataFrame) -> DataFrame:
    return leaves.groupBy(*MONTH).agg(*[F.sum(c).alias(c) for c in MARKS])


def _same(a: str, b: str, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])


def _unequal(a: DataFrame, b: DataFrame, node: list[str]) -> DataFrame:
    """Nodes of either side whose fingerprints differ or that only one side has; null months (of null dates) are a node."""
    sides = a.select(*node, *MARKS, F.lit(1).alias("sides")).unionByName(b.select(*node, *MARKS, F.lit(1).alias("sides")))
    kinds = sides.groupBy(*node).agg(F.sum("sides").alias("sides"), *[(F.min(c) == F.max(c)).alias(c) for c in MARKS])
    return kinds.where((F.col("sides") < 2) | ~(F.col(MARKS[0]) & F.col(MARKS[1]) & F.col(MARKS[2]))).select(*node)


def unequal_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """The leaves (year, month, part) in which two tables' fingerprints differ: months first, and leaves of unequal months only."""
    months = _unequal(month_fingerprints(a), month_fingerprints(b), MONTH)
    under = lambda x: x.alias("x").join(months.alias("m"), _same("x", "m", MONTH), "left_semi")
    return _unequal(under(a), under(b), LEAF)


def below(table: DataFrame, leaves: DataFrame, months: list[tuple[int | None, int | None]], key: list[str], *, parts: int = PARTS) -> DataFrame:
    """The rows of a table in the leaves. Where year and month are its partition columns, other months are not read."""
    # Looks into sets for each row, however many months there are.
    known = [x for x in months if x[0] is not None]
    inside = F.col("year").isin(sorted({y for y, _ in known})) & F.col("month").isin(sorted({m for _, m in known})) & (F.col("year") * 12 + F.col("month")).isin([y * 12 + m for y, m in known])
    if any(y is None for y, _ in months):
        inside = F.coalesce(inside, F.lit(False)) | F.col("year").isNull()
    rows = with_month(table).where(inside).withColumn("part", part_of(key, parts))
    return rows.alias("t").join(leaves.alias("l"), _same("t", "l", LEAF), "left_semi").drop("part")


class Comparison:
    """Staging against target below their unequal leaves; stored fingerprints of either side spare its pass."""

    def __init__(self, staging: DataFrame, target: DataFrame, key: list[str], columns: list[str], *, parts: int = PARTS, staging_marks: DataFrame | None = None, target_marks: DataFrame | None = None):
        self.key, self.columns = key, columns
        a = fingerprints(staging, key, columns, parts=parts) if staging_marks is None else staging_marks
        b = fingerprints(target, key, columns, parts=parts) if target_marks is None else target_marks
        # Fixed once: no more entries than the tables have months, times parts.
        found = [tuple(r) for r in unequal_leaves(a, b).collect()]
        self.leaves = staging.sparkSession.createDataFrame(found, "year int, month int, part int")
        self.months = sorted({x[:2] for x in found}, key=str)
        side = lambda t: below(t, self.leaves, self.months, key, parts=parts).select(*key, *columns)
        self.staging, self.target = side(staging), side(target)

    def missing(self) -> DataFrame:
        return reconcile.missing_keys(self.staging, self.target, self.key).select(*self.key)

    def extra(self) -> DataFrame:
        return reconcile.extra_keys(self.staging, self.target, self.key).select(*self.key)

    def mismatched(self) -> DataFrame:
        return reconcile.mismatched_rows(self.staging, self.target, self.key, self.columns)

    def counts(self) -> DataFrame:
        return reconcile.key_differences(self.staging, self.target, self.key)

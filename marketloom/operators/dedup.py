"""Deduplication and set operations on keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PRICE_KEY


def latest_rows(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Of each key, the row that comes first in the order."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("place_", place).where("place_ = 1").drop("place_")


def dedup_prices(prices: DataFrame, *, sequence: str = "input_seq", key: list[str] = PRICE_KEY) -> DataFrame:
    """The row with the latest loaded_at of each key; on ties the later input row (largest sequence)."""
    return latest_rows(prices, key, [F.desc("loaded_at"), F.desc(sequence)])


def combine(frames: list[DataFrame], *, sequence: str = "input_seq", key: list[str] = PRICE_KEY) -> DataFrame:
    """Union of frames, deduplicated: later frames count as later input. Within a frame its own sequence column decides, if it has one."""
    ranked = []
    for i, frame in enumerate(frames):
        inner = F.col(sequence) if sequence in frame.columns else F.lit(0).cast("long")
        ranked.append(frame.withColumn("frame_", F.lit(i)).withColumn("inner_", inner).drop(sequence))
    union = reduce(DataFrame.unionByName, ranked)
    return latest_rows(union, key, [F.desc("loaded_at"), F.desc("frame_"), F.desc("inner_")]).drop("frame_", "inner_")


def first_by_key(df: DataFrame, key: list[str], sequence: str = "input_seq") -> DataFrame:
    """Of each key the row with the least sequence, the first of the input; without such a column, the least by the other columns, so that reruns agree."""
    first = [sequence] if sequence in df.columns else []
    orderable = [c for c, kind in df.dtypes if c not in (*key, *first) and "map<" not in kind]
    return latest_rows(df, key, [F.col(f"`{c}`").asc_nulls_last() for c in [*first, *orderable]] or [F.lit(1)])


def key_sets(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """One row of counts: keys in both, only in a, only in b, in either, and whether the sets are equal."""
    sides = a.select(*key).distinct().withColumn("side", F.lit(1)).unionByName(b.select(*key).distinct().withColumn("side", F.lit(2)))
    found = sides.groupBy(*key).agg(F.sum("side").alias("sides"))
    counts = found.agg(F.count_if(F.col("sides") == 3).alias("in_both"), F.count_if(F.col("sides") == 1).alias("only_left"), F.count_if(F.col("sides") == 2).alias("only_right"), F.count(F.lit(1)).alias("in_either"))
    return counts.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def overlap_check(frames: DataFrame, key: list[str] = PRICE_KEY) -> DataFrame:
    """Input rows, distinct keys, and whether new windows keep clear of each other."""
    groups = frames.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("input_rows"), F.count(F.lit(1)).alias("distinct_keys")).withColumn("disjoint", F.col("input_rows") == F.col("distinct_keys"))

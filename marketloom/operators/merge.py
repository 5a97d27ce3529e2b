"""Merging new windows into the affected months of the price table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PRICE_KEY
from .dedup import combine

MONTH = ["year", "month"]


def with_month(prices: DataFrame) -> DataFrame:
    """prices with year and month; partition columns of these names stay, so that scans can be pruned by them."""
    own = {"year": F.year("date"), "month": F.month("date")}
    return prices.withColumns({c: v for c, v in own.items() if c not in prices.columns})


def affected_months(new: DataFrame) -> DataFrame:
    return with_month(new).select(*MONTH).distinct()


def merge_windows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The full new content of the months that new touches; later loads win, and new rows on ties.

    existing carries year and month (partition columns), so other months are not read when it
    is a partitioned scan.
    """
    months = affected_months(new)
    old = with_month(existing).join(months, MONTH, "left_semi").drop(*MONTH)
    return with_month(combine([old, new.drop(*MONTH)]))


def manifest(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Per affected month: rows and keys before, in the new windows, in both, added, and after."""
    months = affected_months(new)
    side = lambda df, name: with_month(df).join(months, MONTH, "left_semi").groupBy(*MONTH, *PRICE_KEY).agg(F.count(F.lit(1)).alias(name))
    both = side(existing, "old_").join(side(new, "new_"), [*MONTH, *PRICE_KEY], "full")
    old, fresh = F.col("old_").isNotNull(), F.col("new_").isNotNull()
    return both.groupBy(*MONTH).agg(
        F.coalesce(F.sum("old_"), F.lit(0)).alias("existing_row_count"),
        F.coalesce(F.sum("new_"), F.lit(0)).alias("new_row_count"),
        F.count_if(old & fresh).alias("overlap_key_count"),
        F.count_if(~old & fresh).alias("inserted_key_count"),
        F.count(F.lit(1)).alias("final_row_count"),
    )


def manifest_totals(made: DataFrame) -> DataFrame:
    return made.agg(F.count(F.lit(1)).alias("affected_months"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("existing_row_count", "new_row_count", "inserted_key_count", "final_row_count")])


def target_state(totals: DataFrame, target_rows: DataFrame) -> DataFrame:
    """One row: whether a target (one row with n_rows) is before, after, or not at the update."""
    rows = totals.withColumn("one_", F.lit(1)).join(F.broadcast(target_rows.select("n_rows", F.lit(1).alias("one_"))), "one_").drop("one_")
    state = F.when(F.col("n_rows") == F.col("existing_row_count"), "pre_update").when(F.col("n_rows") == F.col("final_row_count"), "already_applied").otherwise("unexpected")
    return rows.withColumns({"state": state, "delta_matches": F.col("final_row_count") - F.col("existing_row_count") == F.col("inserted_key_count")})


def preview(report: DataFrame, new: DataFrame) -> DataFrame:
    """One row that says what an update would do: tasks by kind, rows, affected months."""
    counts = report.agg(
        F.count(F.lit(1)).alias("tasks"),
        F.count_if(F.col("status").isin("empty", "existing_empty")).alias("empty_windows"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("reported_rows"),
    ).withColumn("one_", F.lit(1))
    rows = new.agg(F.count(F.lit(1)).alias("new_rows"), F.countDistinct(F.trunc("date", "MM")).alias("affected_months")).withColumn("one_", F.lit(1))
    return counts.join(F.broadcast(rows), "one_").drop("one_")

"""Comparing tables, inventories and reports."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import latest_rows


def date_ranges_predicate(date: Column, ranges: list[tuple[datetime.date, datetime.date]]) -> Column:
    """Whether a date is in one of the half-open ranges."""
    parts = [(date >= F.lit(a)) & (date < F.lit(b)) for a, b in ranges]
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def month_ranges(manifest: DataFrame) -> DataFrame:
    """(range_start, range_end) of a manifest's months, half open."""
    first = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    return manifest.select(first.alias("range_start"), F.add_months(first, 1).alias("range_end")).distinct()


def in_months(df: DataFrame, months: DataFrame) -> DataFrame:
    """The rows of df in the months (year, month): a semi-join, which prunes partitions where df has these as partition columns."""
    if "month" in df.columns:
        return df.join(months.select("year", "month").distinct(), ["year", "month"], "left_semi")
    keyed = df.withColumns({"y_": F.year("date"), "m_": F.month("date")})
    return keyed.join(months.select(F.col("year").alias("y_"), F.col("month").alias("m_")).distinct(), ["y_", "m_"], "left_semi").drop("y_", "m_")


def key_differences(staging: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """One row: missing, extra and mismatched rows; non-key columns of both are compared null-safely."""
    rest = [c for c in staging.columns if c not in key and c in target.columns]
    left = staging.select(*key, F.struct(*rest).alias("a_"), F.lit(1).alias("in_a"))
    right = target.select(*key, F.struct(*rest).alias("b_"), F.lit(1).alias("in_b"))
    both = left.join(right, key, "full")
    here, there = F.col("in_a").isNotNull(), F.col("in_b").isNotNull()
    return both.agg(F.count_if(here & ~there).alias("missing"), F.count_if(~here & there).alias("extra"), F.count_if(here & there & ~F.col("a_").eqNullSafe(F.col("b_"))).alias("mismatched"))


def missing_keys(staging: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    return staging.join(target.select(*key), key, "left_anti")


def extra_keys(staging: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    return target.join(staging.select(*key), key, "left_anti")


def mismatched_rows(staging: DataFrame, target: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Keys in both whose columns differ, with the differing columns' names."""
    both = staging.select(*key, *[F.col(c).alias(f"{c}_a") for c in columns]).join(target.select(*key, *[F.col(c).alias(f"{c}_b") for c in columns]), key)
    names = F.filter(F.array(*[F.when(~F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    return both.select(*key, F.array_join(names, ",").alias("differing")).where("differing <> ''")


def staging_check(staging: DataFrame, ranges: list[tuple[datetime.date, datetime.date]]) -> DataFrame:
    """One row: rows, date bounds, rows outside the ranges."""
    return staging.agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.count_if(~date_ranges_predicate(F.col("date"), ranges)).alias("outside"))


def inventory_diff(local: DataFrame, published: DataFrame, by: list[str]) -> DataFrame:
    """Files (path, size, and the columns of by) compared: per group missing, extra, of other size, and in_sync."""
    a = local.select(*by, "path", F.col("size").alias("size_a"))
    b = published.select(*by, "path", F.col("size").alias("size_b"))
    both = a.join(b, [*by, "path"], "full")
    out = both.groupBy(*by).agg(F.count_if(F.col("size_b").isNull()).alias("missing"), F.count_if(F.col("size_a").isNull()).alias("extra"), F.count_if(F.col("size_a") != F.col("size_b")).alias("size_mismatch"))
    return out.withColumn("in_sync", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("size_mismatch") == 0))


def download_plan(tasks: DataFrame, existing: DataFrame, *, overwrite: bool = False) -> DataFrame:
    """tasks (with path) and what a download would do: fetch or reuse."""
    have = existing.select("path").distinct().withColumn("have_", F.lit(True))
    plan = tasks.join(have, "path", "left")
    action = F.lit("fetch") if overwrite else F.when(F.col("have_"), "reuse").otherwise("fetch")
    return plan.withColumn("planned_action", action).drop("have_")


def payload_check(report: DataFrame, payload: DataFrame, key: list[str]) -> DataFrame:
    """Each window of the report against its payload rows (key, date): counts, and the rule that it breaks, if any."""
    found = payload.groupBy(*key).agg(F.count(F.lit(1)).alias("payload_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.countDistinct("date").alias("dates"), F.count_if(F.col("date").isNull()).alias("bad_dates"))
    rows = report.join(found, key, "left").withColumn("payload_rows", F.coalesce("payload_rows", F.lit(0)))
    done, blank = F.col("status").isin("downloaded", "existing"), F.col("status").isin("empty", "existing_empty")
    problem = (
        F.when(F.col("bad_dates") > 0, "unparsable_date")
        .when(blank & (F.col("payload_rows") > 0), "empty_with_rows")
        .when(done & (F.col("payload_rows") == 0), "success_without_rows")
        .when(F.col("row_count").isNotNull() & (F.col("row_count") != F.col("payload_rows")), "row_count_differs")
        .when((F.col("first_date") < F.col("request_start_date")) | (F.col("last_date") > F.col("request_end_date")), "outside_window")
        .when(F.col("dates") < F.col("payload_rows"), "duplicate_dates")
    )
    return rows.withColumn("problem", problem)


def empty_window_review(report: DataFrame, securities: DataFrame) -> DataFrame:
    """Empty windows with their security's attributes."""
    columns = ["exchange", "asset_type", "end_date", "is_active"]
    known = latest_rows(securities.select("ticker", *columns), ["ticker"], [F.col(c).asc_nulls_last() for c in columns])
    return report.where(F.col("status").isin("empty", "existing_empty")).join(known, "ticker", "left")


def status_summary(results: DataFrame) -> DataFrame:
    """Rows by status and action with counts and sums."""
    return results.groupBy("status", "action").agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if("api_called").alias("api_calls"),
        F.sum(F.coalesce("row_count", F.lit(0))).alias("n_rows"),
    )


def compare_summaries(a: DataFrame, b: DataFrame, key: list[str], measures: list[str]) -> DataFrame:
    """Two grouped frames side by side, and whether they agree in every measure."""
    left = a.select(*key, *[F.col(m).alias(f"{m}_left") for m in measures])
    right = b.select(*key, *[F.col(m).alias(f"{m}_right") for m in measures])
    same = reduce(lambda x, y: x & y, [F.col(f"{m}_left").eqNullSafe(F.col(f"{m}_right")) for m in measures])
    return left.join(right, key, "full").withColumn("matches", same)


def run_summary(results: DataFrame) -> DataFrame:
    """One row for a run: counts by action as a map, calls, uploads, rows, dates and status."""
    actions = results.groupBy("action").agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("action", "n")))).alias("action_counts"), F.lit(1).alias("one_"))
    one = results.agg(
        F.count(F.lit(1)).alias("symbols_count"),
        F.count_if("api_called").alias("api_call_count"),
        F.count_if("uploaded_to_gcs").alias("upload_count"),
        F.count_if(F.col("status") == "empty").alias("empty_window_count"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("ods_records"),
        F.min("requested_start_date").alias("data_start_date"),
        F.max("requested_end_date").alias("data_end_date"),
        F.when(F.count_if(F.col("status") == "failed") > 0, "failed").otherwise("success").alias("pipeline_status"),
        F.lit(1).alias("one_"),
    )
    return one.join(F.broadcast(actions), "one_", "left").drop("one_")


def manifest_check(manifest: DataFrame, table: DataFrame) -> DataFrame:
    """Each month of the manifest with the rows that the table has there."""
    actual = table.groupBy("year", "month").agg(F.count(F.lit(1)).alias("actual_row_count"))
    return manifest.join(actual, ["year", "month"], "left").withColumn("matches", F.col("final_row_count").eqNullSafe(F.col("actual_row_count")))


def gate(sync: DataFrame, differences: DataFrame) -> DataFrame:
    """One row: the end-to-end gate over an inventory diff and key_differences()."""
    a = sync.agg(F.count_if(~F.col("in_sync")).alias("groups_out_of_sync"), F.lit(1).alias("one_"))
    both = a.join(F.broadcast(differences.withColumn("one_", F.lit(1))), "one_").drop("one_")
    every = [F.col(c) == 0 for c in ("groups_out_of_sync", "missing", "extra", "mismatched")]
    return both.withColumn("passed", reduce(lambda x, y: x & y, every))

"""Which windows to ask a vendor for next."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import NULL_TEXTS, parse_boolean, ticker_of
from ..schemas import GAP_KEY
from .dedup import first_by_key, latest_rows


def symbol_keys(df: DataFrame) -> DataFrame:
    """Standard (ticker, security_id): trimmed, ticker in capitals, rows without a key dropped."""
    rows = df.withColumns({"ticker": ticker_of(F.col("ticker")), "security_id": F.trim("security_id")})
    bad = [x.upper() for x in NULL_TEXTS]
    return rows.where(F.col("ticker").isNotNull() & F.col("security_id").isNotNull() & ~F.col("ticker").isin(bad) & ~F.upper("security_id").isin(bad))


def daily_eligibility(tasks: DataFrame, securities: DataFrame, *, anchor: datetime.date, grace_days: int) -> DataFrame:
    """Every distinct task key with eligible_for_daily_update and the reason of an exclusion."""
    if grace_days < 0:
        raise ValueError("grace_days must not be negative")
    cutoff = F.date_sub(F.lit(anchor), grace_days)
    known = first_by_key(symbol_keys(securities), GAP_KEY).select(*GAP_KEY, "end_date", parse_boolean(F.col("is_active")).alias("active_"), F.lit(True).alias("known_"))
    rows = symbol_keys(tasks).select(*GAP_KEY).distinct().join(known, GAP_KEY, "left")
    live = F.coalesce("active_", F.lit(False)) | F.col("end_date").isNull() | (F.col("end_date") >= cutoff)
    missing = F.col("known_").isNull()
    return rows.select(
        *GAP_KEY,
        "end_date",
        (~missing & live).alias("eligible_for_daily_update"),
        F.when(missing, "missing_dim_security").when(~live, "inactive_or_stale_end_date").alias("daily_update_exclusion_reason"),
    )


def latest_dates(prices: DataFrame) -> DataFrame:
    return prices.groupBy(*GAP_KEY).agg(F.max("date").alias("latest_dwd_date"))


def checked_through(status: Column, requested_end: Column, last_success: Column, last_price: Column) -> Column:
    """Until when a symbol's history is known to be complete."""
    return F.when(status == "success", F.greatest(last_success, last_price, requested_end)).when(status.isin("empty", "skipped"), requested_end)


def latest_metadata(results: DataFrame) -> DataFrame:
    """The latest window of each symbol: largest requested end, then latest completion, then largest start."""
    order = [F.desc("requested_end_date"), F.coalesce("completed_at", "updated_at", "created_at").desc_nulls_last(), F.desc("requested_start_date")]
    return latest_rows(results, GAP_KEY, order)


def gap_tasks(tasks: DataFrame, latest: DataFrame, metadata: DataFrame, *, source: str, dataset: str, anchor: datetime.date, complete: datetime.date, max_failed: int = 3) -> DataFrame:
    """Request windows up to the latest complete session, with reasons.

    latest: latest_dates(); metadata: one row per symbol (metadata_status, metadata_requested_start_date,
    metadata_checked_through_date, metadata_attempt_count). A failed window starts again at its own
    start unless the data already passed it; skipped and exhausted ones get no task.
    """
    base = symbol_keys(tasks).select(*GAP_KEY).distinct()
    rows = base.join(latest, GAP_KEY, "left").join(metadata, GAP_KEY, "left")
    status, newest, checked = F.col("metadata_status"), F.col("latest_dwd_date"), F.col("metadata_checked_through_date")
    failed, skipped = status.eqNullSafe("failed"), status.eqNullSafe("skipped")
    spent = failed & (F.coalesce("metadata_attempt_count", F.lit(0)) >= max_failed)
    baseline = F.coalesce(newest, F.lit(anchor))
    own = F.col("metadata_requested_start_date")
    again = F.when(own.isNull(), F.date_add(baseline, 1)).when(newest >= own, F.date_add(newest, 1)).otherwise(own)
    start = F.when(~skipped & ~spent, F.when(failed, again).otherwise(F.date_add(F.greatest(baseline, checked), 1)))
    reason = (
        F.when(spent, "failed_retry_limit_exceeded")
        .when(failed, "retry_failed_window")
        .when(skipped, "metadata_skipped")
        .when(status.eqNullSafe("empty") & checked.isNotNull(), "metadata_empty_checked_through")
        .when(checked.isNotNull() & (newest.isNull() | (checked > newest)), "metadata_checked_through")
        .when(newest.isNull(), "no_dwd_rows")
        .otherwise("dwd_lag")
    )
    made = rows.select(
        F.lit(source).alias("source"),
        F.lit(dataset).alias("dataset_name"),
        *GAP_KEY,
        "latest_dwd_date",
        "metadata_status",
        start.alias("request_start_date"),
        F.lit(complete).alias("request_end_date"),
        reason.alias("reason"),
    )
    return made.where((F.col("request_start_date") <= F.col("request_end_date")) & F.lit(complete > anchor))


def refresh_window(last: DataFrame, *, mode: str, start: datetime.date, lookback_days: int, today: datetime.date) -> DataFrame:
    """(refresh_start, refresh_end) per row of last (last_end_date): all of history, or from some days before the last end."""
    from_last = F.greatest(F.date_sub("last_end_date", lookback_days), F.lit(start))
    first = F.lit(start) if mode == "backfill" else F.coalesce(from_last, F.lit(start))
    return last.withColumns({"refresh_start": first, "refresh_end": F.lit(today)})

"""Operational state as keyed tables that upsert jobs rewrite."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import composite_id, parse_boolean, short_text, status_of, ticker_of
from ..schemas import WINDOW_KEY
from .dedup import first_by_key, latest_rows

COMPLETED = ["success", "empty", "skipped"]


def same_key(a: str, b: str, key: list[str]) -> Column:
    """Whether the keys of two aliased tables are the same; nulls are a value."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in key])


def upsert(current: DataFrame, new: DataFrame, key: list[str], *, keep: tuple[str, ...] = ()) -> DataFrame:
    """current with new rows put over those of the same key (null-safe); columns in keep stay as first stored. new's keys must be unique."""
    on = same_key("c", "n", key)
    both = current.withColumn("is_", F.lit(1)).alias("c").join(new.withColumn("is_", F.lit(1)).alias("n"), on, "full")
    fresh = F.col("n.is_").isNotNull()

    def value(c: str) -> Column:
        old = F.col(f"c.{c}")
        put = F.col(f"n.{c}") if c in new.columns else old
        if c in keep:
            put = F.coalesce(old, put)
        return F.when(fresh, put).otherwise(old).alias(c)

    return both.select(*[value(c) for c in current.columns])


def normalise_results(report: DataFrame) -> DataFrame:
    """A download report as text columns, typed: dates, counts and booleans are null where they do not parse."""
    typed = {c: F.col(c).cast("string").try_cast("date") for c in ("request_start_date", "request_end_date", "first_price_date", "last_price_date") if c in report.columns}
    typed |= {c: parse_boolean(F.col(c)) for c in ("api_called", "uploaded_to_gcs") if c in report.columns}
    typed |= {"row_count": F.col("row_count").cast("string").try_cast("long"), "completed_at_utc": F.try_to_timestamp(F.col("completed_at_utc").cast("string")), "persistent_status": status_of(F.col("status"))}
    if "error_message" in report.columns:
        typed["error_message"] = short_text(F.col("error_message"))
    return report.withColumns(typed)


def upsert_window_results(current: DataFrame, results: DataFrame) -> DataFrame:
    """The log of windows by run: the last write of a (run, window) wins."""
    return upsert(current, results, ["run_id", *WINDOW_KEY])


def upsert_symbol_status(current: DataFrame, results: DataFrame) -> DataFrame:
    """The current state by window.

    A new row counts an attempt if the API was called. A stored row changes only if it has no
    completion time or one not after the result's; its attempts grow by one if the API was
    called by another run. So a run that is replayed changes nothing.
    """
    key = same_key("c", "n", WINDOW_KEY)
    both = current.withColumn("is_", F.lit(1)).alias("c").join(results.withColumn("is_", F.lit(1)).alias("n"), key, "full")
    fresh, stored = F.col("n.is_").isNotNull(), F.col("c.is_").isNotNull()
    newer = F.col("c.last_completed_at").isNull() | (F.col("n.completed_at") >= F.col("c.last_completed_at"))
    put = fresh & (~stored | F.coalesce(newer, F.lit(False)))
    called = F.coalesce(F.col("n.api_called"), F.lit(False)).cast("int")
    other_run = ~F.col("c.last_run_id").eqNullSafe(F.col("n.run_id"))
    attempts = F.when(~stored, called).otherwise(F.col("c.attempt_count") + F.when(other_run, called).otherwise(0))
    new = {
        "status": F.col("n.status"),
        "attempt_count": attempts,
        "last_run_id": F.col("n.run_id"),
        "last_completed_at": F.col("n.completed_at"),
        "last_successful_date": F.when(F.col("n.status") == "success", F.col("n.last_price_date")),
        "last_error_message": F.when(F.col("n.status") == "failed", F.col("n.error_message")),
    }
    keys = [F.coalesce(f"c.{k}", f"n.{k}").alias(k) for k in WINDOW_KEY]
    rest = [F.when(put, new[c] if c in new else F.col(f"n.{c}")).otherwise(F.col(f"c.{c}")).alias(c) for c in current.columns if c not in WINDOW_KEY]
    return both.select(*keys, *rest).select(*current.columns)


def upsert_runs(current: DataFrame, runs: DataFrame) -> DataFrame:
    """Run rows by run_id; the first started_at stays."""
    return upsert(current, runs, ["run_id"], keep=("started_at",))


def seed_tasks(current: DataFrame, tasks: DataFrame, *, reset: bool = False) -> DataFrame:
    """Pending state for new tasks, one row per key (nulls are a value); existing rows stay unless reset."""
    fresh = first_by_key(tasks.select(*WINDOW_KEY, "security_id"), WINDOW_KEY).withColumns({"status": F.lit("pending"), "attempt_count": F.lit(0)})
    without = lambda a, b: a.alias("a").join(b.alias("b"), same_key("a", "b", WINDOW_KEY), "left_anti")
    if reset:
        return without(current, fresh).unionByName(fresh, allowMissingColumns=True)
    return current.unionByName(without(fresh, current), allowMissingColumns=True)


def fold_transitions(events: DataFrame, key: list[str], *, running: str = "running") -> DataFrame:
    """State from an event table (key, status, at, seq): latest status, number of attempts, latest success."""
    order = F.struct("at", "seq")
    return events.groupBy(*key).agg(
        F.max_by("status", order).alias("status"),
        F.max("at").alias("updated_at"),
        F.count_if(F.col("status") == running).alias("attempt_count"),
        F.max(F.when(F.col("status") == "success", F.col("at"))).alias("last_success_at"),
    )


def reset_stale(status: DataFrame, *, now: Column, minutes: int) -> DataFrame:
    """Rows that run for longer than some minutes become failed."""
    stale = (F.col("status") == "running") & (F.col("updated_at") < now - F.make_interval(mins=F.lit(minutes)))
    return status.withColumns({"status": F.when(stale, "failed").otherwise(F.col("status")), "was_stale": F.coalesce(stale, F.lit(False))})


def tasks_to_process(tasks: DataFrame, status: DataFrame, *, max_attempts: int, limit: int | None = None) -> DataFrame:
    """Pending and failed tasks with attempts left, in task order. Tasks without a status row: see missing_status()."""
    rows = tasks.join(status.select("ticker", F.col("status").alias("current_status"), "attempt_count"), "ticker")
    rows = rows.where(F.col("current_status").isin("pending", "failed") & (F.col("attempt_count") < max_attempts))
    return rows.orderBy("task_order").limit(limit) if limit is not None else rows


def missing_status(tasks: DataFrame, status: DataFrame) -> DataFrame:
    return tasks.join(status.select("ticker").distinct(), "ticker", "left_anti")


def demand_status(tasks: DataFrame, status: DataFrame) -> None:
    """Raise if a task has no status row."""
    lost = [r.ticker for r in missing_status(tasks, status).orderBy("ticker").limit(20).collect()]
    if lost:
        raise ValueError(f"tasks without status, such as {lost}")


def demand_unique(rows: DataFrame, key: list[str]) -> None:
    """Raise if a key repeats; resume_split() and upserts want unique keys."""
    twice = rows.groupBy(*key).count().where("count > 1").limit(20).collect()
    if twice:
        raise ValueError(f"repeated keys, such as {[tuple(r)[:-1] for r in twice]}")


def restricted(status: DataFrame, tickers: DataFrame) -> DataFrame:
    """The rows of status of the wanted tickers (a table with the column ticker, in which they may repeat)."""
    return status.join(tickers.select("ticker"), "ticker", "left_semi")


def successful_scope(tasks: DataFrame, status: DataFrame) -> DataFrame:
    return tasks.join(status.where("status = 'success'").select("ticker").distinct(), "ticker", "left_semi")


#: What a task that is done keeps of its earlier result.
PRIOR = ["status", "action", "row_count", "completed_at"]


def result_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """The key's texts trimmed and the ticker in capitals, so that tasks and results meet."""
    texts = dict(df.select(*key).dtypes)
    return df.withColumns({k: ticker_of(F.col(k)) if k == "ticker" else F.trim(k) for k in key if texts[k] == "string"})


def resume_split(tasks: DataFrame, prior: DataFrame, key: list[str]) -> DataFrame:
    """tasks with done (whether a completed result of an earlier try is there) and that result's prior_ columns, as far as prior has them.

    Raises if a key repeats in prior: which result counts would be chance. Failed results and
    keys without one stay open.
    """
    prior, tasks = result_keys(prior, key), result_keys(tasks, key)
    demand_unique(prior, key)
    status = F.lower(F.trim("status"))
    kept = [(status if c == "status" else F.lower(F.trim(c)) if c == "action" else F.col(c)).alias(f"prior_{c}") for c in PRIOR if c in prior.columns]
    done = prior.where(status.isin(COMPLETED)).select(*key, *kept, F.lit(True).alias("done"))
    return tasks.join(done, key, "left").withColumn("done", F.coalesce("done", F.lit(False)))


def status_counts(status: DataFrame, by: list[str] | None = None) -> DataFrame:
    return status.groupBy(*(by or []), "status").agg(F.count(F.lit(1)).alias("n_rows"))


def batch_complete(status: DataFrame) -> DataFrame:
    """One row: open tasks, and whether none is left."""
    return status.agg(F.count_if(F.col("status").isin("pending", "running", "failed")).alias("open_tasks")).withColumn("complete", F.col("open_tasks") == 0)


def last_successful_end(runs: DataFrame, key: list[str]) -> DataFrame:
    return runs.where("status = 'success'").groupBy(*key).agg(F.max("data_end_date").alias("last_end_date"))


def merge_metrics(old: Column, new: Column) -> Column:
    """Two maps of metrics as one; new values win."""
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)


def window_id(*extra: str) -> Column:
    return composite_id(*[F.col(c).cast("string") for c in (*extra, *WINDOW_KEY)])


def latest_per_symbol(results: DataFrame, key: list[str], at: str) -> DataFrame:
    return latest_rows(results, key, [F.col(at).desc_nulls_last()])

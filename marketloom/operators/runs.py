"""A run log of start and end events, the intervals it stands for, and a catalogue of data sets.

The log is append-only: (run_id, pipeline_name, dataset, event, at, seq, and on events row_count,
notes, error_message). event is started, success or failed. Nothing is updated in place; the
present state is folded from the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import short_text
from .state import upsert

STARTED, ENDED = "started", ["success", "failed"]


def run_intervals(log: DataFrame) -> DataFrame:
    """One row per attempt of a run: run_id, attempt, pipeline_name, dataset, started_at, ended_at, outcome, n_events.

    A started event opens an attempt, the first end event after it closes it. outcome: success or
    failed; superseded, if the next attempt began before an end; open, if none has. End events
    that come before any start are attempt 0, with outcome unstarted and no started_at.
    """
    in_order = Window.partitionBy("run_id").orderBy("at", "seq")
    rows = log.withColumn("attempt", F.count_if(F.col("event") == STARTED).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    order, start, end = F.struct("at", "seq"), F.col("event") == STARTED, F.col("event").isin(ENDED)
    tries = rows.groupBy("run_id", "attempt").agg(
        F.min_by("pipeline_name", order).alias("pipeline_name"),
        F.min_by("dataset", order).alias("dataset"),
        F.min(F.when(start, F.col("at"))).alias("started_at"),
        F.min(F.when(end, F.col("at"))).alias("ended_at"),
        F.min_by("event", F.when(end, order)).alias("ending"),
        F.count(F.lit(1)).alias("n_events"),
    )
    last = F.col("attempt") == F.max("attempt").over(Window.partitionBy("run_id"))
    outcome = F.when(F.col("attempt") == 0, "unstarted").when(F.col("ended_at").isNotNull(), F.col("ending")).when(last, "open").otherwise("superseded")
    return tries.withColumn("outcome", outcome).drop("ending")


def folded_runs(log: DataFrame) -> DataFrame:
    """The present row of each run that was started, as a table updated by each event would hold it.

    started_at: the last start; ended_at, row_count: of the last end and the last success; notes:
    the last non-null ones since the last start; error_message: of the last end, if it failed.
    """
    in_order = Window.partitionBy("run_id").orderBy("at", "seq")
    rows = log.withColumn("attempt", F.count_if(F.col("event") == STARTED).over(in_order.rowsBetween(Window.unboundedPreceding, 0))).where("attempt > 0")
    rows = rows.withColumn("attempts", F.max("attempt").over(Window.partitionBy("run_id")))
    order = F.struct("at", "seq")
    end, since = F.col("event").isin(ENDED), F.col("attempt") == F.col("attempts")
    latest = lambda c, when: F.max_by(c, F.when(when, order))
    error = F.when(F.col("event") == "failed", short_text(F.col("error_message")))
    return rows.groupBy("run_id").agg(
        latest("pipeline_name", F.col("event") == STARTED).alias("pipeline_name"),
        latest("dataset", F.col("event") == STARTED).alias("dataset"),
        F.max_by("event", order).alias("status"),
        F.max(F.when(F.col("event") == STARTED, F.col("at"))).alias("started_at"),
        F.max(F.when(end, F.col("at"))).alias("ended_at"),
        latest("row_count", F.col("event") == "success").alias("row_count"),
        latest("notes", since & F.col("notes").isNotNull()).alias("notes"),
        latest(error, end).alias("error_message"),
    )


def running_total(df: DataFrame, value: Column, name: str, *, by: list[str], order: str, bucket: Column) -> DataFrame:
    """df with the sum of value up to and including each row, by groups and in order.

    bucket is a column that does not fall as order rises (a day of an instant). Totals run within
    a bucket and over the buckets' totals, so a group of any size is never one task's to sum;
    order must be unique in a group.
    """
    rows = df.withColumns({"bucket_": bucket, "value_": value})
    before = Window.partitionBy(*by).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*by, "bucket_").agg(F.sum("value_").alias("sum_")).withColumn("offset_", F.coalesce(F.sum("sum_").over(before), F.lit(0))).drop("sum_")
    within = Window.partitionBy(*by, "bucket_").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumn("own_", F.sum("value_").over(within)).alias("r")
    same = F.lit(True)
    for c in [*by, "bucket_"]:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}"))
    return own.join(offsets.alias("o"), same).select(*[F.col(f"r.{c}") for c in df.columns], (F.col("own_") + F.col("offset_")).alias(name))


def concurrency(intervals: DataFrame, *, by: list[str], now: Column) -> DataFrame:
    """(by, at, running): how many intervals run from each instant on at which the number changes.

    Intervals are half open; open ones run until now. Superseded and unstarted ones have no
    length. One row per group and instant, however many begin or end then.
    """
    end = F.when(F.col("outcome") == "open", F.greatest(now, F.col("started_at"))).otherwise(F.col("ended_at"))
    rows = intervals.where(F.col("outcome").isin("open", *ENDED)).select(*by, F.col("started_at").alias("a"), end.alias("b"))
    steps = rows.select(*by, F.inline(F.array(F.struct(F.col("a").alias("at"), F.lit(1).alias("step")), F.struct(F.col("b").alias("at"), F.lit(-1).alias("step")))))
    steps = steps.groupBy(*by, "at").agg(F.sum("step").alias("step")).where("step <> 0")
    return running_total(steps, F.col("step"), "running", by=by, order="at", bucket=F.to_date("at")).drop("step")


def busy_periods(changes: DataFrame, *, by: list[str]) -> DataFrame:
    """(by, busy_from, busy_to, peak) of the stretches in which something runs, from concurrency(): gaps and islands.

    A stretch ends where the number falls to 0; each such instant closes one island, so the
    islands are numbered by the zeros before them.
    """
    zero = F.when(F.col("running") == 0, 1).otherwise(0)
    rows = running_total(changes, zero, "zeros", by=by, order="at", bucket=F.to_date("at"))
    island = F.col("zeros") - zero
    spans = rows.withColumn("island", island).groupBy(*by, "island").agg(F.min("at").alias("busy_from"), F.max("at").alias("busy_to"), F.max("running").alias("peak"))
    return spans.drop("island")


def catalogue(current: DataFrame, entries: DataFrame, *, now: Column) -> DataFrame:
    """The catalogue (dataset_name, layer, storage_path, description, created_at, updated_at) with entries put in; layer and created_at stay as first stored."""
    fresh = entries.withColumns({"created_at": now, "updated_at": now})
    return upsert(current, fresh, ["dataset_name"], keep=("layer", "created_at"))


def dataset_state(catalogued: DataFrame, intervals: DataFrame) -> DataFrame:
    """Each catalogued data set with its runs: attempts, open ones, the last one's outcome, and the last success."""
    order = F.struct("started_at", "run_id", "attempt")
    runs = intervals.where("attempt > 0").groupBy(F.col("dataset").alias("dataset_name")).agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.count_if(F.col("outcome") == "open").alias("open_attempts"),
        F.max_by("outcome", order).alias("last_outcome"),
        F.max("started_at").alias("last_started_at"),
        F.max(F.when(F.col("outcome") == "success", F.col("ended_at"))).alias("last_success_at"),
    )
    joined = catalogued.join(runs, "dataset_name", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_attempts", "open_attempts")})

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.functions import scalars
from marketloom.operators import profile, reconcile, state

D, T0 = dt.date, dt.datetime(2026, 6, 12, 12)
STATUS = "source string, dataset_name string, ticker string, requested_start_date date, requested_end_date date, status string, attempt_count int, last_run_id string, last_completed_at timestamp, last_successful_date date, last_error_message string"
RESULT = "source string, dataset_name string, ticker string, requested_start_date date, requested_end_date date, status string, run_id string, api_called boolean, completed_at timestamp, last_price_date date, error_message string"
KEY = ("v", "d")
W = (D(2026, 6, 1), D(2026, 6, 12))


def stored(spark, *rows):
    return spark.createDataFrame([(*KEY, t, *W, s, n, run, at, None, None) for t, s, n, run, at in rows], STATUS)


def results(spark, *rows):
    return spark.createDataFrame([(*KEY, t, *W, s, run, api, at, D(2026, 6, 11), "boom") for t, s, run, api, at in rows], RESULT)


def test_lost_tasks_and_repeated_keys_are_errors(spark):
    tasks = spark.createDataFrame([("A",), ("B",)], "ticker string")
    state.demand_status(tasks, tasks)
    state.demand_unique(tasks, ["ticker"])
    with pytest.raises(ValueError, match="B"):
        state.demand_status(tasks, tasks.where("ticker = 'A'"))
    with pytest.raises(ValueError, match="A"):
        state.demand_unique(tasks.union(tasks.where("ticker = 'A'")), ["ticker"])


def test_null_keys_are_updated_in_place(spark):
    old = stored(spark, (None, "failed", 1, "r1", T0))
    new = results(spark, (None, "success", "r2", True, T0))
    assert [r.status for r in state.upsert_symbol_status(old, new).collect()] == ["success"]


def test_symbol_status_upsert(spark):
    hour = dt.timedelta(hours=1)
    old = stored(spark, ("A", "failed", 1, "r1", T0), ("B", "success", 2, "r1", T0), ("C", "pending", 0, None, None), ("D", "failed", 1, "r1", T0))
    new = results(spark, ("A", "success", "r2", True, T0 + hour), ("B", "failed", "r2", True, T0 - hour), ("C", "failed", "r2", False, T0), ("E", "empty", "r2", True, T0))
    once = state.upsert_symbol_status(old, new)
    got = {r.ticker: (r.status, r.attempt_count, r.last_run_id, r.last_successful_date, r.last_error_message) for r in once.collect()}
    assert got == {"A": ("success", 2, "r2", D(2026, 6, 11), None), "B": ("success", 2, "r1", None, None), "C": ("failed", 0, "r2", None, "boom"), "D": ("failed", 1, "r1", None, None), "E": ("empty", 1, "r2", None, None)}
    twice = state.upsert_symbol_status(once, new)
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_other_upserts(spark):
    runs = spark.createDataFrame([("r1", T0, "running")], "run_id string, started_at timestamp, status string")
    later = spark.createDataFrame([("r1", T0 + dt.timedelta(1), "success"), ("r2", T0, "running")], runs.schema)
    got = {r.run_id: (r.started_at, r.status) for r in state.upsert_runs(runs, later).collect()}
    assert got == {"r1": (T0, "success"), "r2": (T0, "running")}
    null_key = spark.createDataFrame([(None, T0, "a")], runs.schema)
    assert state.upsert(null_key, null_key.withColumn("status", F.lit("b")), ["run_id"]).collect()[0].status == "b"
    tasks = spark.createDataFrame([(*KEY, t, *W, f"v:{t}") for t in "AB"], "source string, dataset_name string, ticker string, requested_start_date date, requested_end_date date, security_id string")
    current = tasks.where("ticker = 'A'").withColumns({"status": F.lit("success"), "attempt_count": F.lit(3)})
    kept = {r.ticker: (r.status, r.attempt_count) for r in state.seed_tasks(current, tasks).collect()}
    assert kept == {"A": ("success", 3), "B": ("pending", 0)}
    assert {r.status for r in state.seed_tasks(current, tasks, reset=True).collect()} == {"pending"}


def test_transitions_and_selection(spark):
    events = spark.createDataFrame([("A", "running", T0, 1), ("A", "success", T0, 2), ("B", "running", T0, 1), ("C", "running", T0, 1), ("C", "failed", T0 + dt.timedelta(1), 2)], "ticker string, status string, at timestamp, seq long")
    folded = state.fold_transitions(events, ["ticker"])
    assert {r.ticker: (r.status, r.attempt_count) for r in folded.collect()} == {"A": ("success", 1), "B": ("running", 1), "C": ("failed", 1)}
    stale = state.reset_stale(folded, now=F.lit(T0 + dt.timedelta(hours=3)), minutes=60)
    assert {r.ticker: r.status for r in stale.collect()} == {"A": "success", "B": "failed", "C": "failed"}
    tasks = spark.createDataFrame([("C", 1), ("A", 2), ("Z", 3)], "ticker string, task_order int")
    assert [r.ticker for r in state.tasks_to_process(tasks, folded, max_attempts=2, limit=5).collect()] == ["C"]
    assert state.tasks_to_process(tasks, folded, max_attempts=1).count() == 0
    assert [r.ticker for r in state.missing_status(tasks, folded).collect()] == ["Z"]
    assert [r.ticker for r in state.successful_scope(tasks, folded).collect()] == ["A"]
    done = {r.ticker: r.done for r in state.resume_split(tasks, folded, ["ticker"]).collect()}
    assert done == {"C": False, "A": True, "Z": False}
    assert not state.batch_complete(folded).first().complete


def test_scalars(spark):
    row = spark.createDataFrame([(" nan ", "HTTP 404: Not Found", "YES", "2026-06-12T00:00:00.123456Z", "downloaded")], "a string, e string, b string, t string, s string")
    got = row.select(
        scalars.null_like(F.col("a")).alias("a"),
        scalars.failure_action(F.col("e")).alias("e"),
        scalars.parse_boolean(F.col("b")).alias("b"),
        scalars.parse_boolean(F.lit("maybe")).alias("c"),
        scalars.iso_utc(scalars.parse_instant(F.col("t"))).alias("t"),
        scalars.status_of(F.col("s")).alias("s"),
        scalars.next_month(F.lit(D(2026, 12, 31))).alias("m"),
        scalars.weekday(F.lit(D(2026, 6, 14))).alias("w"),
    ).first()
    assert tuple(got) == (None, "skipped", True, None, "2026-06-12T00:00:00.123456Z", "success", D(2027, 1, 1), 0)
    metrics = state.merge_metrics(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3)))
    assert row.select(metrics.alias("m")).first().m == {"a": 1, "b": 3}


def test_reports(spark):
    a = spark.createDataFrame([(2026, "x", 1), (2026, "y", 2), (2026, "z", 3)], "year int, path string, size long")
    b = spark.createDataFrame([(2026, "x", 1), (2026, "y", 9), (2026, "q", 1)], a.schema)
    r = reconcile.inventory_diff(a, b, ["year"]).first()
    assert (r.missing, r.extra, r.size_mismatch, r.in_sync) == (1, 1, 1, False) and reconcile.inventory_diff(a, a, ["year"]).first().in_sync
    report = spark.createDataFrame([("A", "downloaded", 2), ("B", "empty", 0), ("C", "downloaded", 1), ("D", "downloaded", 1)], "ticker string, status string, row_count long").withColumns({"request_start_date": F.lit(D(2026, 6, 1)), "request_end_date": F.lit(D(2026, 6, 30))})
    rows = spark.createDataFrame([("A", D(2026, 6, 1)), ("A", D(2026, 6, 1)), ("B", D(2026, 6, 1)), ("D", D(2026, 7, 1))], "ticker string, date date")
    got = {r.ticker: r.problem for r in reconcile.payload_check(report, rows, ["ticker"]).collect()}
    assert got == {"A": "duplicate_dates", "B": "empty_with_rows", "C": "success_without_rows", "D": "outside_window"}
    gate = reconcile.gate(reconcile.inventory_diff(a, a, ["year"]), reconcile.key_differences(a, a, ["path"])).first()
    assert gate.passed
    assert profile.single_window(a, ["year"]).first().single
    assert profile.value_counts(a, "year", 1).first().n_rows == 3
    assert {r.column: r.n_distinct for r in profile.column_profile(a, ["path", "year"]).collect()} == {"path": 3, "year": 1}


def test_a_null_in_a_window_key_is_seeded_once(spark):
    tasks = spark.createDataFrame([("v", None, "A", dt.date(2026, 1, 1), dt.date(2026, 1, 2), "v:A")] * 2, "source string, dataset_name string, ticker string, requested_start_date date, requested_end_date date, security_id string")
    once = state.seed_tasks(tasks.limit(0).withColumns({"status": F.lit("x"), "attempt_count": F.lit(0)}), tasks)
    assert once.count() == 1 and state.seed_tasks(once, tasks).count() == 1 and state.seed_tasks(once, tasks, reset=True).count() == 1


def test_resume_refuses_repeated_results_and_meets_other_spellings(spark):
    tasks = spark.createDataFrame([("aapl",), ("NEW",), ("FAILME",), ("EMPTY",)], "ticker string")
    prior = spark.createDataFrame([(" AAPL", "Success", " Downloaded", 18), ("FAILME", "failed", "failed", None), ("EMPTY", "empty", "empty", 0)], "ticker string, status string, action string, row_count long")
    got = {r.ticker: (r.done, r.prior_status, r.prior_action, r.prior_row_count) for r in state.resume_split(tasks, prior, ["ticker"]).collect()}
    assert got == {"AAPL": (True, "success", "downloaded", 18), "NEW": (False, None, None, None), "FAILME": (False, None, None, None), "EMPTY": (True, "empty", "empty", 0)}
    with pytest.raises(ValueError, match="repeated keys"):
        state.resume_split(tasks, prior.union(prior), ["ticker"])

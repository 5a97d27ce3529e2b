import datetime as dt

from pyspark.sql import functions as F

from marketloom.operators import runs

T = dt.datetime(2026, 6, 12, 12)
LOG = "run_id string, pipeline_name string, dataset string, event string, at timestamp, seq long, row_count long, notes string, error_message string"


def h(n):
    return T + dt.timedelta(hours=n)


def log(spark):
    e = lambda run, event, at, seq, **x: (run, "p", "d", event, h(at), seq, x.get("rows"), x.get("notes"), x.get("error"))
    return spark.createDataFrame(
        [
            e("r0", "success", 0, 1, rows=9),
            e("r1", "started", 0, 1, notes="n"), e("r1", "failed", 1, 2, error="x" * 3000), e("r1", "started", 2, 3), e("r1", "success", 30, 4, rows=5, notes="m"), e("r1", "failed", 31, 5, error="late"),
            e("r2", "started", 1, 1, notes="keep"), e("r2", "started", 3, 2), e("r2", "success", 3, 3, rows=7),
            e("r3", "started", 40, 1),
        ],
        LOG,
    )


def test_attempts_are_paired(spark):
    got = {(r.run_id, r.attempt): (r.started_at, r.ended_at, r.outcome, r.n_events) for r in runs.run_intervals(log(spark)).collect()}
    assert got == {
        ("r0", 0): (None, h(0), "unstarted", 1),
        ("r1", 1): (h(0), h(1), "failed", 2),
        ("r1", 2): (h(2), h(30), "success", 3),
        ("r2", 1): (h(1), None, "superseded", 1),
        ("r2", 2): (h(3), h(3), "success", 2),
        ("r3", 1): (h(40), None, "open", 1),
    }


def test_folded_runs_are_as_updates_in_place_leave_them(spark):
    got = {r.run_id: r for r in runs.folded_runs(log(spark)).collect()}
    assert set(got) == {"r1", "r2", "r3"}
    r1 = got["r1"]
    assert (r1.status, r1.started_at, r1.ended_at, r1.row_count, r1.notes, r1.error_message) == ("failed", h(2), h(31), 5, "m", "late")
    assert (got["r2"].notes, got["r2"].row_count, got["r2"].error_message) == (None, 7, None) and got["r3"].ended_at is None
    cut = runs.folded_runs(log(spark).where("seq <= 2")).where("run_id = 'r1'").first()
    assert len(cut.error_message) == 2000 and cut.notes == "n"


def test_concurrency_and_busy_periods_over_days(spark):
    made = runs.run_intervals(log(spark))
    changes = runs.concurrency(made, by=["dataset"], now=F.lit(h(45)))
    assert [(r.at, r.running) for r in changes.orderBy("at").collect()] == [(h(0), 1), (h(1), 0), (h(2), 1), (h(30), 0), (h(40), 1), (h(45), 0)]
    rows = [("d", f"a{i}", 1, h(i), h(i + 20), "success") for i in range(0, 60, 7)] + [("e", "b", 1, h(0), None, "open"), (None, "c", 1, h(0), h(1), "failed")]
    many = spark.createDataFrame(rows, "dataset string, run_id string, attempt long, started_at timestamp, ended_at timestamp, outcome string")
    changes = runs.concurrency(many, by=["dataset"], now=F.lit(h(5)))
    for r in changes.where("dataset = 'd'").collect():
        assert r.running == sum(a <= r.at < b for d, _, _, a, b, _ in rows if d == "d")
    got = {(r.dataset, r.busy_from, r.busy_to, r.peak) for r in runs.busy_periods(changes, by=["dataset"]).collect()}
    assert got == {("d", h(0), h(76), 3), ("e", h(0), h(5), 1), (None, h(0), h(1), 1)}


def test_catalogue_keeps_what_was_first_stored(spark):
    none = spark.createDataFrame([], "dataset_name string, layer string, storage_path string, description string, created_at timestamp, updated_at timestamp")
    entry = lambda layer, path: spark.createDataFrame([("d", layer, path, "x")], "dataset_name string, layer string, storage_path string, description string")
    first = runs.catalogue(none, entry("dwd", "a"), now=F.lit(T))
    again = runs.catalogue(first, entry("ods", "b"), now=F.lit(h(1)))
    (r,) = again.collect()
    assert (r.layer, r.storage_path, r.created_at, r.updated_at) == ("dwd", "b", T, h(1))
    (s,) = runs.dataset_state(again, runs.run_intervals(log(spark))).collect()
    assert (s.n_attempts, s.open_attempts, s.last_outcome, s.last_success_at) == (5, 1, "open", h(30))
    assert runs.run_intervals(log(spark).limit(0)).count() == 0

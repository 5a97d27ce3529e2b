import datetime as dt
import random

from pyspark.sql import functions as F

from marketloom.operators import state
from marketloom.streaming import transitions

T0 = dt.datetime(2026, 6, 1)
SCHEMA = "ticker string, status string, at timestamp, seq long"


def test_the_stream_equals_the_fold_and_the_reset(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(f"t{rnd.randint(0, 30)}", rnd.choice(["running", "running", "success", "failed", "pending"]), T0 + dt.timedelta(minutes=rnd.randint(0, 3000)), i) for i in range(400)]
    rows.sort(key=lambda r: r[2] + dt.timedelta(minutes=rnd.randint(0, 200)))  # some come late, none later than the stream waits
    source, root = str(tmp_path / "in"), str(tmp_path / "states")
    (tmp_path / "in").mkdir()
    events, got = spark.readStream.schema(SCHEMA).parquet(source), None
    for k in range(4):
        spark.createDataFrame(rows[k * 100 : k * 100 + 100], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        got = transitions.fold_to(events, root, minutes=60, lateness="4 hours")
    whole = spark.createDataFrame(rows, SCHEMA)
    now = F.lit(max(r[2] for r in rows) - dt.timedelta(hours=4))
    want = state.reset_stale(state.fold_transitions(whole, ["ticker"]), now=now, minutes=60)
    key = lambda r: (r.ticker, r.status, r.updated_at, r.attempt_count, r.last_success_at, r.was_stale)
    assert sorted(map(key, got.collect()), key=str) == sorted(map(key, want.collect()), key=str)
    assert want.where("was_stale").count() > 0
    assert transitions.fold_to(events, root, minutes=60, lateness="4 hours").count() == got.count()  # nothing new

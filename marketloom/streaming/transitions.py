"""Status events as a keyed stream: the state of each ticker, and the reset of tasks that hang.

The state is what state.fold_transitions() folds, updated event by event; its time-out, in event
time, does what state.reset_stale() does: a task that runs for longer than some minutes, as the
watermark goes, is failed. A later event of the ticker puts its own status back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.state import upsert
from ..sources.readers import table_or_empty
from ..sources.writers import remove

STATE = "status string, at_us long, seq long, attempt_count long, success_us long"
STATUS = "ticker string, status string, updated_at timestamp, attempt_count long, last_success_at timestamp, was_stale boolean"


def folded_stream(events: DataFrame, *, minutes: int, lateness: str) -> DataFrame:
    """Changed states (update mode) of a stream (ticker, status, at, seq). Events older than the watermark, the newest at less lateness, are left out."""
    limit = minutes * 60_000_000

    def row(key: tuple, held: tuple, stale: bool) -> pd.DataFrame:
        status, at, _, attempts, success = held
        at, success = (pd.Timestamp(x, unit="us") if x is not None else pd.NaT for x in (at, success))
        return pd.DataFrame({"ticker": [key[0]], "status": ["failed" if stale else status], "updated_at": [at], "attempt_count": [attempts], "last_success_at": [success], "was_stale": [stale]})

    def each(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = tuple(state.get)
            state.update(held)  # the next event may still come
            yield row(key, held, True)
            return
        status, at, seq, attempts, success = tuple(state.get) if state.exists else (None, None, None, 0, None)
        for frame in frames:
            for said, t, n in zip(frame["status"], frame["at_us"], frame["seq"], strict=True):
                attempts += said == "running"
                if said == "success" and (success is None or t > success):
                    success = int(t)
                if at is None or (t, n) > (at, seq):
                    status, at, seq = said, int(t), int(n)
        held = (status, at, seq, int(attempts), success)
        state.update(held)
        stale = False
        if status == "running":
            end, now = (at + limit) // 1000, state.getCurrentWatermarkMs()
            stale = end < now
            if not stale:
                state.setTimeoutTimestamp(max(end, now + 1))
        yield row(key, held, stale)

    keyed = events.withWatermark("at", lateness).select("ticker", "status", "at", F.unix_micros("at").alias("at_us"), "seq")
    return keyed.groupBy("ticker").applyInPandasWithState(each, STATUS, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def latest_states(spark: SparkSession, root: str) -> DataFrame:
    """The states after the last batch that was written; none before the first."""
    last = table_or_empty(spark, root, f"{STATUS}, batch long").agg(F.max("batch").alias("last")).first()["last"]
    return table_or_empty(spark, f"{root}/batch={-1 if last is None else last}", STATUS)


def fold_to(events: DataFrame, root: str, *, minutes: int, lateness: str) -> DataFrame:
    """Run the stream over what has come, and give the states: a table under root, written per batch under the batch's name from the one before, so that a replayed batch is harmless."""

    def put(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        states = upsert(table_or_empty(spark, f"{root}/batch={batch - 1}", STATUS), rows, ["ticker"])
        states.write.mode("overwrite").parquet(f"{root}/batch={batch}")
        remove(spark, f"{root}/batch={batch - 2}")

    stream = folded_stream(events, minutes=minutes, lateness=lateness).writeStream.outputMode("update").foreachBatch(put)
    stream.option("checkpointLocation", f"{root}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return latest_states(events.sparkSession, root)

"""The latest complete trading session at an instant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import market_time


def latest_complete_session(instants: DataFrame, sessions: DataFrame, *, zone: str = "UTC", buffer_minutes: int = 0, days_back: int = 14, instant: str = "now") -> DataFrame:
    """instants with the column latest_session.

    sessions: (session_date, close_at), one row per trading day with its own close in UTC.
    Today counts once its close and the buffer have passed; else the latest session before
    today, whatever its own buffer, at most days_back ago; null if there is none. The join is
    on local dates: distinct dates meet the calendar rows of their last days by equality.
    """
    local = F.to_date(market_time(F.col(instant), zone))
    rows = instants.withColumn("local_date_", local)
    days = rows.select("local_date_").distinct().withColumn("session_date", F.explode(F.sequence(F.date_sub("local_date_", days_back), "local_date_")))
    today = F.col("session_date") == F.col("local_date_")
    near = days.join(sessions.select("session_date", "close_at"), "session_date")
    near = near.groupBy("local_date_").agg(F.max(F.when(~today, F.col("session_date"))).alias("before_"), F.max(F.when(today, F.col("close_at"))).alias("close_"))
    joined = rows.join(near, "local_date_", "left")
    done = F.col(instant) >= F.col("close_") + F.make_interval(mins=F.lit(buffer_minutes))
    return joined.withColumn("latest_session", F.when(done, F.col("local_date_")).otherwise(F.col("before_"))).drop("local_date_", "before_", "close_")

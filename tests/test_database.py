import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.sources import readers

URL = "jdbc:derby:memory:market;create=true"
DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(scope="module")
def stored(spark):
    rows = [(i, f"T{i % 7}", "failed" if i % 3 == 0 else "success", dt.date(2026, 1, 1) + dt.timedelta(i % 50)) for i in range(1000)]
    df = spark.createDataFrame(rows, "seq int, ticker string, status string, day date")
    readers.write_state(df, URL, "window_state", mode="overwrite", createTableColumnTypes="ticker VARCHAR(16), status VARCHAR(16)", **DRIVER)
    return rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_scan_is_split_and_filters_go_to_the_database(spark, stored):
    got = readers.jdbc(spark, URL, "window_state", where=F.col("status") == "failed", split_by="seq", rows_per_part=50, **DRIVER)
    wanted = [r for r in stored if r[2] == "failed"]
    assert got.rdd.getNumPartitions() == 7 and sorted(tuple(r) for r in got.collect()) == sorted(wanted)
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 7 and max(r["count"] for r in sizes) <= 50
    plan = plan_of(got.select("ticker"))
    assert "PushedFilters: [*IsNotNull(status), *EqualTo(status,failed)]" in plan.replace("STATUS", "status").replace("Status", "status")
    assert "ReadSchema: struct<ticker:string>" in plan.replace("TICKER", "ticker")


def test_split_by_dates_and_an_empty_table(spark, stored):
    got = readers.jdbc(spark, URL, "window_state", split_by="day", rows_per_part=250, most_parts=3, **DRIVER)
    assert got.rdd.getNumPartitions() == 3 and got.count() == 1000
    none = readers.jdbc(spark, URL, "window_state", where=F.col("status") == "none", split_by="day", **DRIVER)
    assert none.count() == 0
    assert readers.jdbc(spark, URL, "window_state", **DRIVER).rdd.getNumPartitions() == 1

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators import dedup, quality
from marketloom.schemas import PRICE_SCHEMA, cast_to, empty, select_canonical

T0 = dt.datetime(2026, 6, 12, 12)


def price(**changes):
    row = dict(security_id="v:A", ticker="A", date=dt.date(2026, 6, 12), open=100.0, high=102.0, low=99.0, close=101.0, volume=10, adj_open=100.0, adj_high=102.0, adj_low=99.0, adj_close=101.0, adj_volume=10, div_cash=0.0, split_factor=1.0, source="v", load_id="l", loaded_at=T0)
    return tuple((row | changes).values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), PRICE_SCHEMA)


@pytest.mark.parametrize(
    ("changes", "rule"),
    [
        ({"close": 0.0}, "non_positive_close"),
        ({"adj_close": -1.0}, "invalid_adj_close"),
        ({"adj_close": None}, "null_adj_close"),
        ({"high": 98.0}, "high_below_low"),
        ({"volume": -1}, "negative_volume"),
        ({"adj_volume": -1}, "negative_adj_volume"),
        ({"split_factor": 0.0}, "non_positive_split_factor"),
        ({"date": None}, "null_date"),
        ({"loaded_at": None}, "null_loaded_at"),
    ],
)
def test_each_rule(spark, changes, rule):
    got = {r.rule: r for r in quality.validate_prices(frame(spark, price(), price(ticker="B", security_id="v:B", **changes))).collect()}
    assert got[rule].failed_rows == 1 and not got[rule].passed
    with pytest.raises(ValueError, match=rule):
        quality.demand(quality.validate_prices(frame(spark, price(**changes))))


def test_clean_duplicate_and_empty_tables(spark):
    quality.demand(quality.validate_prices(frame(spark, price(), price(date=dt.date(2026, 6, 15)))))
    got = {r.rule: r.failed_rows for r in quality.validate_prices(frame(spark, price(), price())).collect()}
    assert got["duplicate_key"] == 2 and got["empty_table"] == 0
    got = {r.rule: r.failed_rows for r in quality.validate_prices(empty(spark)).collect()}
    assert got["empty_table"] == 1 and got["duplicate_key"] == 0


def test_examples_are_bounded_and_ordered(spark):
    rows = frame(spark, *[price(ticker=f"T{i:02d}", close=-1.0) for i in range(9)])
    got = quality.examples(rows, quality.price_rules(), ["ticker", "close"], n=5).orderBy("place").collect()
    assert [(r.rule, r.ticker) for r in got] == [("non_positive_close", f"T0{i}") for i in range(5)]


def test_result_rules(spark):
    rows = [("downloaded", 0, None, 1, 2), ("empty", 3, None, 1, 2), ("odd", 1, 1, 2, 1), ("existing", 2, 1, 1, 2)]
    day = lambda i: None if i is None else dt.date(2026, 1, i)
    df = spark.createDataFrame([(s, n, day(x), day(a), day(b)) for s, n, x, a, b in rows], "status string, row_count long, last_price_date date, request_start_date date, request_end_date date")
    got = {r.rule: r.failed_rows for r in quality.report(df, quality.result_rules(["downloaded", "existing", "empty", "failed", "skipped"])).collect()}
    assert got == {"unknown_status": 1, "window_reversed": 1, "empty_with_rows": 1, "success_without_rows": 1, "success_without_last_date": 1, "empty_table": 0}


def test_canonical_projection(spark):
    df = frame(spark, price()).withColumn("extra", F.lit(1))
    assert select_canonical(df).columns == PRICE_SCHEMA.fieldNames()
    with pytest.raises(ValueError, match="adj_close"):
        select_canonical(df.drop("adj_close"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_to(df.withColumn("close", F.lit("x"))).collect()


def test_latest_load_wins_then_later_input(spark):
    rows = frame(spark, price(close=1.0), price(close=2.0, loaded_at=T0 + dt.timedelta(hours=1)), price(close=3.0, loaded_at=T0 + dt.timedelta(hours=1)), price(close=9.0, ticker="B", security_id="v:B"))
    got = dedup.dedup_prices(rows.withColumn("input_seq", F.monotonically_increasing_id())).collect()
    assert sorted(r.close for r in got) == [3.0, 9.0]
    a, b = frame(spark, price(close=1.0)), frame(spark, price(close=2.0))
    assert dedup.combine([a, b]).first().close == 2.0 and dedup.combine([b, a]).first().close == 1.0


def test_key_sets_and_overlap(spark):
    a, b = frame(spark, price(), price(ticker="B", security_id="v:B")), frame(spark, price(close=5.0))
    r = dedup.key_sets(a, b, ["security_id", "date"]).first()
    assert (r.in_both, r.only_left, r.only_right, r.in_either, r.equal) == (1, 1, 0, 2, False)
    assert not dedup.overlap_check(a.unionByName(b)).first().disjoint and dedup.overlap_check(a).first().disjoint
    assert quality.marked_duplicates(a.unionByName(b), ["security_id", "date"]).where("is_duplicate").count() == 2

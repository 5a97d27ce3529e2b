import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from marketloom.operators import features as f

D0 = dt.date(2024, 1, 1)


def series(spark, closes, security="S:1", ticker="1"):
    rows = [(security, ticker, D0 + dt.timedelta(days=i), float(c), 100 + i, 100 + i, 0.0, 1.0) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "security_id string, ticker string, date date, adj_close double, adj_volume long, volume long, div_cash double, split_factor double")


CLOSES = [100 + (i * 37 % 23) - i % 5 for i in range(130)]


def test_returns(spark):
    got = f.returns(series(spark, CLOSES)).orderBy("date").collect()
    for n in f.RETURN_ROWS:
        for i, r in enumerate(got):
            assert r[f"ret_{n}d"] == (pytest.approx(CLOSES[i] / CLOSES[i - n] - 1) if i >= n else None)


def test_zero_price_gives_null(spark):
    got = f.returns(series(spark, [0, 5, 10])).orderBy("date").collect()
    assert [r.ret_1d for r in got] == [None, None, 1.0]


def test_rolling_excludes_the_current_row(spark):
    got = f.features(f.returns(series(spark, CLOSES))).orderBy("date").collect()
    dollars = [c * (100 + i) for i, c in enumerate(CLOSES)]
    assert got[0].avg_dollar_volume_20d_lagged is None and got[0].dollar_volume_zscore_20d_lagged is None
    for i in (5, 40, 129):
        window = dollars[max(0, i - 20) : i]
        assert got[i].avg_dollar_volume_20d_lagged == pytest.approx(statistics.mean(window))
        assert got[i].dollar_volume_zscore_20d_lagged == pytest.approx((dollars[i] - statistics.mean(window)) / statistics.stdev(window))
        assert got[i].close_to_20d_high_lagged == pytest.approx(CLOSES[i] / max(CLOSES[max(0, i - 20) : i]) - 1)
        assert got[i].log_dollar_volume == pytest.approx(math.log1p(dollars[i]))
        assert got[i].ret_5d_lag2 == got[i - 2].ret_5d
    assert got[6].day_of_week == 0 and got[6].month == 1


def test_panel_labels_and_benchmark(spark):
    own, bench = series(spark, CLOSES[:40]), series(spark, CLOSES[50:85], "S:0", "0")
    got = f.panel(own.unionByName(bench), "0").where("ticker = '1'").orderBy("date").collect()
    assert len(got) == 40 and len(f.panel(own, "0").columns) == 43
    for i, r in enumerate(got):
        fwd = CLOSES[i + 20] / CLOSES[i] - 1 if i + 20 < 40 else None
        assert r.fwd_ret_20d == (pytest.approx(fwd) if fwd is not None else None)
        assert r.label_direction_20d == (None if fwd is None else int(fwd > 0))
        spy = CLOSES[50 + i + 20] / CLOSES[50 + i] - 1 if i + 20 < 35 else None
        assert r.fwd_excess_ret_20d == (pytest.approx(fwd - spy) if fwd is not None and spy is not None else None)
    assert f.panel(own, "SPY").where("fwd_excess_ret_20d IS NOT NULL").count() == 0


def test_join_form_equals_window_form(spark):
    prices = series(spark, CLOSES[:40]).select("security_id", "ticker", "date", "adj_close")
    assert sorted(map(str, f.labels(prices).select("date", "fwd_ret_5d").collect())) == sorted(map(str, f.labels_joined(prices).select("date", "fwd_ret_5d").collect()))


def test_one_exchange_for_all_windows(spark):
    plan = f.features(f.returns(series(spark, CLOSES)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_liquid_universe(spark):
    both = series(spark, [10] * 40).unionByName(series(spark, [20] * 40, "S:2", "2"))
    got = f.liquid_universe(both, top=1).orderBy("month").collect()
    assert [r.security_id for r in got] == ["S:2", "S:2"]
    assert both.select(F.col("date")).count() == 80


def test_no_frame_is_gone_over_for_each_row(spark):
    plan = f.features(f.returns(series(spark, CLOSES)))._jdf.queryExecution().optimizedPlan().toString()
    assert "lag(" in plan and "RowFrame, -60, -1" not in plan and "RowFrame, -20, -1" not in plan

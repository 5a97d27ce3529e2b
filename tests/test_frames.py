import math
import random

import pytest

from marketloom.operators import frames

FUNCTIONS = list(frames.PARTS)


@pytest.mark.parametrize("n", [1, 3, 20, 60, 250])
def test_equal_to_spark_frames(spark, n):
    rnd = random.Random(n)
    rows = [(g, i, None if rnd.random() < 0.1 else rnd.uniform(-5, 5) + 1e6, rnd.randint(-9, 9)) for g, size in (("a", 700), ("b", n), ("c", n + 1), ("d", 1), (None, 45)) for i in range(size)]
    df = spark.createDataFrame(rows, "g string, i int, x double, k long").repartition(5)
    wanted = {f"{f}_{c}": (f, c, n) for f in FUNCTIONS for c in ("x", "k")} | {"short": ("max", "x", 2)}
    key = lambda r: (str(r.g), r.i)
    got = sorted(frames.preceding_frames(df, wanted, by=["g"], order=["i"]).collect(), key=key)
    want = sorted(frames.plain_frames(df, wanted, by=["g"], order=["i"]).collect(), key=key)
    assert len(got) == len(want) == len(rows) and got[0].asDict().keys() == want[0].asDict().keys()
    for a, b in zip(got, want):
        for name in wanted:
            x, y = a[name], b[name]
            assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-5 if "stddev" in name else 1e-9)), (name, a, b)
            if name in ("max_x", "min_x", "sum_k", "count_x", "max_k"):
                assert x == y


def test_one_exchange(spark):
    df = spark.createDataFrame([("a", 1, 1.0)], "g string, i int, x double")
    plan = frames.preceding_frames(df, {"m": ("max", "x", 20), "s": ("avg", "x", 60)}, by=["g"], order=["i"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_nothing_wide_is_sorted(spark):
    df = spark.createDataFrame([("a", 1, 1.0)], "g string, i int, x double")
    wanted = {f"{f}_{n}": (f, "x", n) for f in FUNCTIONS for n in (20, 60, 250)}
    plan = frames.preceding_frames(df, wanted, by=["g"], order=["i"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1

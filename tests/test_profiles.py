import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators import profile


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exact_distinct_counts_of_many_columns_copy_no_rows(spark):
    rows = [(i % 7, f"t{i % 5}" if i % 3 else None, [0.0, -0.0, float("nan"), 1.5][i % 4], dt.datetime(2026, 1, 1 + i % 4), dt.date(2026, 1, 1 + i % 6), b"x" * (i % 3), i % 2 == 0, [i % 2, None]) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b string, c double, d timestamp, e date, f binary, g boolean, h array<int>")
    wide = df.select("*", *[(F.col("a") + i).alias(f"a{i}") for i in range(12)])
    made = profile.column_profile(wide, wide.columns)
    assert len(wide.columns) == 20 and "Expand" not in plan_of(made) and "Expand" in plan_of(wide.agg(F.countDistinct("a"), F.countDistinct("b")))
    got = {r["column"]: (r.n_rows, r.missing_ratio, r.n_distinct) for r in made.collect()}
    want = wide.agg(*[F.countDistinct(c).alias(c) for c in wide.columns]).first()
    assert {c: got[c][2] for c in wide.columns} == want.asDict() and want.c == 3
    assert got["b"][:2] == (500, pytest.approx(167 / 500)) and got["a"][1] == 0
    assert profile.distinct_counts(wide, ["a", "b", "c"]).first().asDict() == {"a": 7, "b": 5, "c": 3}
    empty = {r["column"]: (r.n_rows, r.missing_ratio, r.n_distinct) for r in profile.column_profile(df.limit(0), ["a", "b"]).collect()}
    assert empty == {"a": (0, None, 0), "b": (0, None, 0)}


def test_samples_rerun_alike_and_merge(spark):
    rows = [(i, None if i % 4 == 0 else f"v{i % 10}") for i in range(300)] + [(7, "v7")] * 3
    df = spark.createDataFrame(rows, "i int, v string")
    one = [tuple(r) for r in profile.sample_rows(df.repartition(7), 20).collect()]
    assert one == [tuple(r) for r in profile.sample_rows(df.repartition(3), 20).collect()] and len(one) == 20
    a, b = (profile.sample_sketch(df.where(F.col("i") % 2 == k), 20) for k in (0, 1))
    assert [tuple(r)[:2] for r in profile.merge_sketches(a, b, 20).collect()] == one
    assert "TakeOrderedAndProject" in plan_of(profile.sample_rows(df, 20)) and "Sort [" not in plan_of(profile.sample_rows(df, 20))
    assert profile.sample_rows(df, 10_000).count() == 303 and profile.sample_rows(df.limit(0), 5).count() == 0

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from marketloom.operators import fingerprints, reconcile
from marketloom.sources import readers, writers

from .test_quality_and_dedup import frame, price

KEY, COLUMNS = ["security_id", "date"], ["close", "volume", "ticker"]


def rows(df):
    return sorted(map(str, df.collect()))


def test_same_results_as_the_full_join(spark):
    rnd = random.Random(2)
    base = [price(security_id=f"v:{i}", date=dt.date(2026, 1 + m, 1 + d), close=float(i)) for i in range(30) for m in range(4) for d in range(3)]
    changed = []
    for r in base:
        d, x = r[2], rnd.random()
        if d.month == 2 and x < 0.1:
            continue
        changed.append((*r[:1], None, *r[2:]) if d.month == 3 and x < 0.1 else (*r[:7], None, *r[8:]) if d.month == 3 and x < 0.2 else r)
    changed += [price(security_id="v:new", date=dt.date(2026, 5, 1)), price(security_id="v:new", date=dt.date(2026, 3, 9))]
    a, b = frame(spark, *base), frame(spark, *changed)
    made = fingerprints.Comparison(a, b, KEY, COLUMNS)
    assert made.months == [(2026, 2), (2026, 3), (2026, 5)]
    assert rows(made.missing()) == rows(reconcile.missing_keys(a, b, KEY).select(*KEY))
    assert rows(made.extra()) == rows(reconcile.extra_keys(a, b, KEY).select(*KEY))
    assert rows(made.mismatched()) == rows(reconcile.mismatched_rows(a, b, KEY, COLUMNS))
    assert rows(made.counts()) == rows(reconcile.key_differences(a.select(*KEY, *COLUMNS), b.select(*KEY, *COLUMNS), KEY))
    same = fingerprints.Comparison(a, a.repartition(7), KEY, COLUMNS)
    assert same.months == [] and same.counts().first().asDict() == {"missing": 0, "extra": 0, "mismatched": 0}


def test_rows_without_a_date_are_compared(spark):
    a = frame(spark, price(), price(security_id="v:B", date=None))
    b = frame(spark, price(), price(security_id="v:C", date=None))
    made = fingerprints.Comparison(a, b, KEY, COLUMNS)
    assert made.months == [(None, None)] and made.counts().first().asDict() == {"missing": 1, "extra": 1, "mismatched": 0}


def test_a_null_in_another_column_and_repeated_rows_are_seen(spark):
    df = lambda *r: spark.createDataFrame(list(r), "k string, date date, x string, y string")
    d = dt.date(2026, 1, 1)
    for a, b in ((df(("k", d, "v", None)), df(("k", d, None, "v"))), (df(("k", d, "v", "w")), df(*[("k", d, "v", "w")] * 2))):
        assert len(fingerprints.Comparison(a, b, ["k", "date"], ["x", "y"]).months) == 1


def test_only_unequal_months_are_read(spark, tmp_path):
    root = str(tmp_path / "t")
    base = [price(security_id=f"v:{i}", date=dt.date(2026, m, 5)) for i in range(20) for m in range(1, 7)]
    writers.write_months(frame(spark, *base), root)
    table = readers.prices(spark, root)
    marks = fingerprints.fingerprints(table, KEY, COLUMNS)
    staging = frame(spark, *base).withColumn("close", F.when(F.month("date") == 3, F.col("close") + 1).otherwise(F.col("close")))
    made = fingerprints.Comparison(staging, table, KEY, COLUMNS, target_marks=marks)
    scan = [x for x in made.target._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in x][0]
    pruned = re.sub(r"#\d+L?", "", scan.split("PartitionFilters")[1].split("PushedFilters")[0])
    assert made.months == [(2026, 3)] and "(year = 2026)" in pruned and "(month = 3)" in pruned
    assert made.counts().first().mismatched == 20


def test_months_are_looked_up_in_a_set(spark):
    rows = frame(spark, *[price(security_id="v:1", date=dt.date(2000 + i // 12, i % 12 + 1, 5)) for i in range(120)])
    leaves = fingerprints.fingerprints(rows, KEY, COLUMNS).select(*fingerprints.LEAF)
    some = fingerprints.below(rows, leaves, [(2000 + i // 12, i % 12 + 1) for i in range(0, 120, 2)], KEY)
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" INSET ") >= 1 and " OR " not in plan
    assert sorted(r.date.month % 2 for r in some.collect()) == [1] * 60
    assert fingerprints.below(rows, leaves, [], KEY).count() == 0


def test_marks_are_exact_sums_of_hashes(spark):
    rows = frame(spark, *[price(security_id=f"v:{i}", date=dt.date(2026, 3, 5)) for i in range(500)])
    marks = fingerprints.fingerprints(rows, KEY, COLUMNS, parts=1)
    nulls = "0" * len([*KEY, *COLUMNS])
    want = rows.agg(*[F.sum(F.xxhash64(F.lit(s), F.lit(nulls), *KEY, *COLUMNS).cast("decimal(20,0)")) for s in ("a", "b")]).first()
    (got,) = marks.collect()
    assert (got.n_rows, got.mark_1, got.mark_2) == (500, *want) and dict(marks.dtypes)["mark_1"] == "decimal(30,0)"
    plan = marks._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(" not in plan  # a decimal for each row

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketloom.operators import features, merge, normalize, reconcile
from marketloom.schemas import PRICE_COLUMNS, PRICE_SCHEMA, table_contract
from marketloom.sources import readers, writers
from marketloom.streaming.ingest import apply_batch, ingest, merge_batch

from .test_quality_and_dedup import T0, frame, price

D = dt.date


def raw(**changes):
    row = {"date": "2026-06-12T00:00:00.000Z", "open": 100.0, "high": 102.0, "low": 99.0, "close": 101.0, "volume": 1000000, "adjOpen": 50.0, "adjHigh": 51.0, "adjLow": 49.5, "adjClose": 50.5, "adjVolume": 2000000, "divCash": 0.5, "splitFactor": 2.0}
    return {k: v for k, v in (row | changes).items() if v != "absent"}


def landed(root, symbol, payload):
    folder = root / f"source=v/dataset=d/symbol={symbol}/request_start=2026-06-01/request_end=2026-06-30"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "prices.json").write_text(payload if isinstance(payload, str) else json.dumps(payload))


def normalised(spark, root, **options):
    rows = readers.json_payloads(spark, str(root))
    named = rows.withColumns({"ticker": F.col("symbol"), "security_id": F.concat(F.lit("v:"), F.upper("symbol")), "load_id": F.lit("l"), "loaded_at": F.lit(T0)})
    return {(r.ticker, str(r.date)): r for r in normalize.normalise_prices(named, **options).collect()}


def test_normalisation(spark, tmp_path):
    landed(tmp_path, "aaa", [raw(), raw(date="2026-06-15", adjClose="absent", volume=None)])
    bare = {k: "absent" for k in ("adjOpen", "adjHigh", "adjLow", "adjClose", "adjVolume", "divCash", "splitFactor", "volume")}
    landed(tmp_path, "bbb", {"records": [raw(**bare), raw(**bare, date="2026-06-15T00:00:00Z")]})
    landed(tmp_path, "ccc", [raw(adjClose="absent") | {"adj_close": 7.0, "volume": 1.5}, raw(date="nonsense", close=None, adjClose="absent")])
    landed(tmp_path, "ddd", [])
    got = normalised(spark, tmp_path)
    a = got["AAA", "2026-06-12"]
    assert (a.security_id, a.adj_close, a.adj_volume, a.div_cash, a.split_factor, a.input_seq) == ("v:AAA", 50.5, 2000000, 0.5, 2.0, 0)
    second = got["AAA", "2026-06-15"]
    assert second.adj_close == 101.0 and second.volume is None
    b = got["BBB", "2026-06-15"]
    assert (b.adj_open, b.adj_close, b.volume, b.adj_volume, b.div_cash, b.split_factor) == (100.0, 101.0, 0, 0, 0.0, 1.0)
    c = got["CCC", "2026-06-12"]
    assert c.adj_close == 7.0 and c.non_integral and c.volume is None
    assert ("CCC", "None") in got and ("CCC", "None") not in normalised(spark, tmp_path, on_null="drop")
    assert len(got) == 6
    landed(tmp_path, "eee", '{"rows": 1}')
    with pytest.raises(Exception, match="no list of records"):
        normalised(spark, tmp_path)


def test_names_once_per_file(spark, tmp_path):
    landed(tmp_path, "aaa", [raw(), None, raw(adjClose="absent") | {"adj_close": 7.0}])
    landed(tmp_path, "bbb", {"records": [{"date": "2026-06-12"}]})
    landed(tmp_path, "ccc", [])
    landed(tmp_path, "ddd", {"records": []})
    rows = readers.json_payloads(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate posexplode", 1)
    assert "array_distinct" in below and "regexp_extract" in below
    assert "array_distinct" not in above and "regexp_extract" not in above
    assert plan.count("from_json") == 2  # a list, or an object that holds one: each file is parsed once
    got = {(r.symbol, r.seq): r for r in rows.collect()}
    assert got.keys() == {("aaa", 0), ("aaa", 1), ("aaa", 2), ("bbb", 0)} and got["aaa", 1].fields is None
    assert sorted(got["aaa", 1].file_keys) == sorted([*raw(), "adj_close"]) and got["bbb", 0].file_keys == ["date"]


def test_rows_are_compiled(spark, tmp_path):
    landed(tmp_path, "aaa", [raw()])
    named = readers.json_payloads(spark, str(tmp_path)).withColumns({"ticker": F.col("symbol"), "security_id": F.col("symbol"), "load_id": F.lit("l"), "loaded_at": F.lit(T0)})
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(normalize.normalise_prices(named)._jdf.queryExecution().executedPlan())
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < 8000, sizes  # the JVM leaves longer methods to its interpreter


def months(spark, table):
    return {(r.year, r.month): r.n_rows for r in writers.month_counts(spark, table).collect()}


def test_merge_promote_and_rollback(spark, tmp_path):
    target = str(tmp_path / "table")
    old = frame(spark, price(date=D(2026, 5, 4)), price(date=D(2026, 6, 1)), price(date=D(2026, 6, 2)))
    new = frame(spark, price(date=D(2026, 6, 2), close=5.0, loaded_at=T0 + dt.timedelta(1)), price(date=D(2026, 7, 1)))
    writers.write_months(old, target)
    assert (tmp_path / "table/year=2026/month=05").is_dir()
    stored = readers.prices(spark, target)
    made = merge.manifest(stored, new)
    assert {(r.month, r.existing_row_count, r.new_row_count, r.overlap_key_count, r.inserted_key_count, r.final_row_count) for r in made.collect()} == {(6, 2, 1, 1, 0, 2), (7, 0, 1, 0, 1, 1)}
    assert merge.target_state(merge.manifest_totals(made), reconcile.in_months(stored, made).agg(F.count(F.lit(1)).alias("n_rows"))).first().state == "pre_update"
    staging = str(tmp_path / "staging")
    writers.stage(spark, merge.merge_windows(stored, new), made, staging)
    with pytest.raises(FileExistsError):
        writers.stage(spark, merge.merge_windows(stored, new), made, staging)

    def fail():
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        writers.promote(spark, staging, target, str(tmp_path / "a1"), made, check=fail)
    spark.catalog.refreshByPath(target)
    assert months(spark, target) == {(2026, 5): 1, (2026, 6): 2}
    assert readers.price_months(spark, target, [(2026, 6)]).where("close = 5").count() == 0
    writers.promote(spark, staging, target, str(tmp_path / "a2"), merge.manifest(readers.prices(spark, target), new))
    assert months(spark, target) == {(2026, 5): 1, (2026, 6): 2, (2026, 7): 1}
    assert readers.price_months(spark, target, [(2026, 6)]).where("close = 5").count() == 1
    again = readers.prices(spark, target)
    twice = merge.merge_windows(again, new).select(*PRICE_COLUMNS)
    assert sorted(map(str, twice.collect())) == sorted(map(str, readers.price_months(spark, target, [(2026, 6), (2026, 7)]).collect()))
    new.write.parquet(str(tmp_path / "new"))
    chosen = spark.read.parquet(str(tmp_path / "new")).where("close > 0")
    plan = merge.manifest(readers.prices(spark, target), chosen)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "dynamicpruning" in plan  # other months are not read
    writers.recover(spark, str(tmp_path / "a2"), target)
    spark.catalog.refreshByPath(target)
    assert months(spark, target) == {(2026, 5): 1, (2026, 6): 2} and readers.price_months(spark, target, [(2026, 6)]).where("close = 5").count() == 0
    writers.promote(spark, staging, target, str(tmp_path / "a3"), merge.manifest(readers.prices(spark, target), new))
    assert readers.price_ranges(spark, target, [(D(2026, 6, 2), D(2026, 7, 1))]).count() == 1
    assert {r.path.split("/")[1]: r.month for r in readers.inventory(spark, target).collect()}["month=05"] == 5
    assert sum(r.n_rows for r in readers.file_rows(spark, target).collect()) == 4


class Killed(BaseException):
    """A driver that dies: no handler of errors runs."""


@pytest.mark.parametrize("step", ["staged", "planned", "archived", "replaced", "counted"])
def test_a_killed_batch_is_merged_once(spark, tmp_path, step):
    def whole(root):
        spark.catalog.refreshByPath(root)
        return sorted(map(str, readers.prices(spark, root).drop("loaded_at").collect()))

    old = frame(spark, price(date=D(2026, 5, 4)), price(date=D(2026, 6, 1)), price(date=D(2026, 6, 2)))
    new = frame(spark, price(date=D(2026, 6, 2), close=5.0, loaded_at=T0 + dt.timedelta(1)), price(date=D(2026, 7, 1)))
    killed, plain = str(tmp_path / "killed"), str(tmp_path / "plain")
    for root in (killed, plain):
        writers.write_months(old, root)
    assert apply_batch(spark, new, plain, str(tmp_path / "work"), "p")
    want = whole(plain)

    def stop(at):
        if at == step:
            raise Killed

    with pytest.raises(Killed):
        apply_batch(spark, new, killed, str(tmp_path / "work"), 0, after=stop)
    if step == "archived":  # killed while months were replaced: one is gone
        writers.remove(spark, f"{killed}/year=2026/month=06")
    spark.catalog.refreshByPath(killed)
    assert apply_batch(spark, new, killed, str(tmp_path / "work"), 0) == (step != "counted")
    assert whole(killed) == want
    assert not apply_batch(spark, new, killed, str(tmp_path / "work"), 0) and whole(killed) == want
    assert sorted(r.close for r in readers.prices(spark, str(tmp_path / "work/0/archive")).collect()) == [101.0, 101.0]


def test_a_failed_promotion_is_made_again_and_a_record_is_one_promotion(spark, tmp_path):
    target, staging, archive = (str(tmp_path / x) for x in ("t", "s", "a"))
    new = frame(spark, price(date=D(2026, 7, 1)))
    made = merge.manifest(new.limit(0), new)
    writers.stage(spark, merge.merge_windows(new.limit(0), new), made, staging)

    def fail():
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        writers.promote(spark, staging, target, archive, check=fail)
    assert writers.promotion_step(spark, archive) == "archived" and not (tmp_path / "t/year=2026/month=07").exists()
    writers.promote(spark, staging, target, archive)
    assert writers.promotion_step(spark, archive) == "counted" and months(spark, target) == {(2026, 7): 1}
    other = spark.createDataFrame([(2026, 8, 1)], writers.MANIFEST)
    with pytest.raises(ValueError, match="another promotion"):
        writers.promote(spark, staging, target, archive, other)
    (tmp_path / "b").mkdir()
    with pytest.raises(FileExistsError):
        writers.promote(spark, staging, target, str(tmp_path / "b"))


def test_replayed_stream_batches(spark, tmp_path):
    landed(tmp_path / "raw", "aaa", [raw(), raw(date="2026-07-01")])
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(str(tmp_path / "raw")).select(F.col("_metadata.file_path").alias("file"), "value")
    run = merge_batch(str(tmp_path / "table"), str(tmp_path / "work"), source="v")
    for batch in (0, 0, 1, 0, 1):
        run(files, batch)
    assert months(spark, str(tmp_path / "table")) == {(2026, 6): 1, (2026, 7): 1}
    assert {r.load_id for r in readers.prices(spark, str(tmp_path / "table")).collect()} == {"batch-1"}


def test_saved_tables(spark):
    name, staging = "market_prices", "market_prices_staging"
    for t in (name, staging):
        writers.drop_table(spark, t)
    old = frame(spark, price(date=D(2026, 5, 4)), price(date=D(2026, 6, 1)))
    writers.save_bucketed(old, name, buckets=2)
    assert table_contract(spark, name, partitions=["year", "month"], buckets=["security_id"], columns=[*PRICE_COLUMNS, "year", "month"]).where("passed").count() == 3
    writers.stage_table(merge.with_month(frame(spark, price(date=D(2026, 6, 1), close=7.0))), name, staging)
    difference = reconcile.key_differences(spark.table(staging), spark.table(name).where("month = 6"), ["security_id", "date"]).first()
    assert (difference.missing, difference.extra, difference.mismatched) == (0, 0, 1)
    for t in (name, staging):
        writers.drop_table(spark, t)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aliases_of_a_file_need_no_shuffle(spark, tmp_path):
    landed(tmp_path, "aaa", [raw()])
    rows = readers.json_payloads(spark, str(tmp_path)).withColumns({"ticker": F.col("symbol"), "security_id": F.col("symbol"), "load_id": F.lit("l"), "loaded_at": F.lit(T0)})
    assert "Exchange" not in plan_of(normalize.normalise_prices(rows)) and "Exchange" in plan_of(normalize.normalise_prices(rows.drop("file_keys")))
    assert normalize.normalise_prices(rows).collect() == normalize.normalise_prices(rows.drop("file_keys")).collect()


def test_bucketed_table_has_few_files_and_serves_windows_without_an_exchange(spark):
    name = "market_bucketed"
    writers.drop_table(spark, name)
    rows = [price(security_id=f"v:{i}", ticker=f"T{i}", date=D(2026, 1 + k % 3, 1 + k)) for i in range(40) for k in range(9)]
    writers.save_bucketed(frame(spark, *rows).repartition(16), name, buckets=4)
    files = spark.table(name).select("year", "month", F.col("_metadata.file_path").alias("file")).distinct().groupBy("year", "month").count().collect()
    assert len(files) == 3 and all(r["count"] <= 4 for r in files)
    made = features.returns(spark.table(name))
    assert "Exchange" not in plan_of(made) and made.count() == 360
    writers.drop_table(spark, name)


def test_small_sources(spark, tmp_path):
    assert readers.table_or_empty(spark, str(tmp_path / "none"), PRICE_SCHEMA).count() == 0
    (tmp_path / "t.csv").write_text("ticker,n\nNA,1\nB,x\n")
    got = readers.csv(spark, str(tmp_path / "t.csv"), types={"n": "int"}).collect()
    assert [(r.ticker, r.n) for r in got] == [("NA", 1), ("B", None)]
    securities = spark.createDataFrame([("s1", "A", 10.0), ("s2", "B", 20.0)], "security_id string, ticker string, base double")
    sample = readers.sample_prices(spark, start=D(2025, 1, 2), days=5, securities=securities)
    assert [r.close for r in sample.where("ticker = 'A'").orderBy("date").collect()] == [10.0, 11.5, 13.0, 14.5, 16.0] and str(sample.agg(F.max("date")).first()[0]) == "2025-01-08"
    writers.write_report(sample, str(tmp_path / "csv"))
    writers.write_summary(sample.limit(1), str(tmp_path / "json"))
    assert readers.csv(spark, str(tmp_path / "csv")).count() == 10
    assert readers.run_sql(spark, "SELECT count(*) AS n FROM {sample_rows}", {"sample_rows": sample}).first().n == 10


def test_streamed_ingestion(spark, tmp_path):
    landed(tmp_path / "raw", "aaa", [raw(), raw(date="2026-07-01")])
    run = lambda: ingest(spark, str(tmp_path / "raw"), str(tmp_path / "table"), str(tmp_path / "work"), source="v").awaitTermination()
    run()
    landed(tmp_path / "raw", "bbb", [raw(close=9.0)])
    run()
    run()
    assert months(spark, str(tmp_path / "table")) == {(2026, 6): 2, (2026, 7): 1}


def test_tables_are_listed_and_described(spark):
    frame(spark, price()).createOrReplaceTempView("listed_prices")
    (found,) = readers.tables(spark, "listed_pri*").collect()
    assert (found.name, found.temporary) == ("listed_prices", True)
    got = readers.described(spark, "listed_prices").collect()
    assert [(r.column, r.n_rows) for r in got][:2] == [("security_id", 1), ("ticker", 1)] and got[2].type == "date"
    spark.catalog.dropTempView("listed_prices")
    assert readers.tables(spark, "listed_pri*").count() == 0

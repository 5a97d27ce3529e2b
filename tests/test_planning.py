import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators import calendar, dedup, gaps, security_master, universe

D = dt.date


def test_security_master(spark):
    raw = spark.createDataFrame(
        [(" abc ", "NASDAQ", "Stock", "USD", "2010-01-01", "2026-06-10"), ("ABC", "TSX", "Stock", "CAD", "2000-01-01", "2026-06-11"), ("ABC", "NASDAQ", "Stock", "USD", "2012-01-01", "2026-06-09"), ("old", "NYSE", "Stock", "USD", "2001-01-01", "2020-01-01"), ("nan", "NYSE", "Stock", "USD", "", ""), ("ETFX", "NYSE ARCA", "ETF", "USD", "bad", None), ("NA", "NYSE", "Stock", "USD", None, None)],
        "ticker string, exchange string, assetType string, priceCurrency string, startDate string, endDate string",
    )
    ranked = security_master.rank_listings(security_master.collapse_listings(security_master.normalise_listings(raw)))
    dim = {r.ticker: r for r in security_master.dim_security(security_master.canonical_listings(ranked), source="v", grace_days=7).collect()}
    assert set(dim) == {"ABC", "OLD", "ETFX", "NA"}
    abc = dim["ABC"]
    assert (abc.security_id, abc.exchange, abc.start_date, abc.end_date, abc.is_active) == ("v:ABC", "NASDAQ", D(2010, 1, 1), D(2026, 6, 10), True)
    assert not dim["OLD"].is_active and not dim["ETFX"].is_active
    assert {r.exchange for r in security_master.duplicate_report(ranked).collect()} == {"NASDAQ", "TSX"}


FILTERS = universe.Filters(D(2019, 1, 1), D(2026, 6, 12))


def securities(spark):
    rows = [("GOOD", {}), ("ETFA", {"asset_type": "ETF"}), ("CADX", {"price_currency": "CAD"}), ("OTCX", {"exchange": "OTC"}), ("PAST", {"end_date": D(2018, 1, 1)}), ("NOST", {"start_date": None}), ("NOEN", {"end_date": None}), ("AB-WS", {}), ("AB-R", {}), ("BRK-B", {}), ("ABCDU", {}), ("FNDX", {"company_name": "Great UNIT holdings"}), ("UNTD", {"company_name": "United Air"}), (None, {})]
    base = {"exchange": "nasdaq", "asset_type": "stock", "price_currency": "usd", "start_date": D(2010, 1, 1), "end_date": D(2026, 6, 1), "is_active": True, "company_name": None}
    return spark.createDataFrame([(f"v:{t}", t, *(base | c).values()) for t, c in rows], "security_id string, ticker string, exchange string, asset_type string, price_currency string, start_date date, end_date date, is_active boolean, company_name string")


def test_candidate_pool_and_funnel(spark):
    got = universe.candidate_pool(securities(spark), FILTERS)
    assert [r.ticker for r in got.collect()] == ["GOOD"]
    funnel = [r.survivors for r in universe.filter_funnel(securities(spark), FILTERS).orderBy("place").collect()]
    assert funnel == [14, 13, 12, 11, 10, 9, 7, 4, 3, 1]


def test_tasks(spark):
    pool = spark.createDataFrame([(f"v:T{i}", f"T{i}") for i in range(30)], "security_id string, ticker string")
    a, b = (universe.sample_universe(pool.orderBy(F.rand()), limit=10, forced=["T7", "T29"]).collect() for _ in range(2))
    assert a == b and len(a) == 10 and {"T7", "T29"} <= {r.ticker for r in a}
    tasks = universe.task_list(pool, name="pilot", source="v", dataset="d", start=D(2019, 1, 1), end=D(2026, 6, 11))
    assert tasks.where("ticker = 'T3'").first().task_id == "pilot:v:d:T3:2019-01-01:2026-06-11"
    assert universe.select_tasks(tasks, tickers=["t1", "T2 "]).count() == 2
    with pytest.raises(ValueError, match="NOPE"):
        universe.select_tasks(tasks, tickers=["NOPE"])
    assert {r.ticker for r in universe.suspicious_tickers(securities(spark)).collect()} == {"AB-WS", "AB-R"}
    with pytest.raises(ValueError):
        universe.demand_candidates(pool.where("false"))


def test_exchanges_in_order_of_preference(spark):
    """Every major exchange, the last of them too, comes before others; no end date at all is an error."""
    venues = ["OTC", "AMEX", "NYSE MKT", "NYSE ARCA", "NYSE", "NASDAQ"]
    for i in range(2, len(venues) + 1):
        rows = [("A", v, "Stock", "USD", "A", D(2010, 1, 1), D(2026, 1, 1)) for v in venues[:i]]
        listings = spark.createDataFrame(rows, "ticker string, exchange string, asset_type string, price_currency string, source_ticker string, start_date date, end_date date")
        assert security_master.canonical_listings(security_master.rank_listings(listings)).first().exchange == venues[i - 1]
    security_master.demand_end_date(listings)
    with pytest.raises(ValueError):
        security_master.demand_end_date(listings.withColumn("end_date", F.lit(None).cast("date")))


def test_dimension_feeds_the_pool(spark):
    listings = spark.createDataFrame([("A", "AMEX", "Stock", "USD", "a", D(2010, 1, 1), D(2026, 6, 1))], "ticker string, exchange string, asset_type string, price_currency string, source_ticker string, start_date date, end_date date")
    dim = security_master.dim_security(security_master.canonical_listings(security_master.rank_listings(listings)), source="v")
    assert dim.columns == ["security_id", "source", "source_ticker", "ticker", "exchange", "asset_type", "price_currency", "start_date", "end_date", "is_active", "company_name", "source_raw_symbol", "loaded_at"]
    pool = universe.candidate_pool(dim, universe.Filters(D(2019, 1, 1), D(2026, 6, 12), exchanges=["AMEX"]))
    assert [r.security_id for r in pool.collect()] == ["v:A"]


def test_latest_session(spark):
    utc = lambda *a: dt.datetime(*a)
    sessions = spark.createDataFrame([(D(2026, 7, 1), utc(2026, 7, 1, 20)), (D(2026, 7, 2), utc(2026, 7, 2, 20)), (D(2026, 7, 6), utc(2026, 7, 6, 20)), (D(2026, 11, 25), utc(2026, 11, 25, 21)), (D(2026, 11, 27), utc(2026, 11, 27, 18))], "session_date date, close_at timestamp")
    cases = [
        (utc(2026, 7, 2, 20, 30), D(2026, 7, 1)),
        (utc(2026, 7, 2, 23, 0), D(2026, 7, 2)),
        (utc(2026, 7, 3, 23, 0), D(2026, 7, 2)),
        (utc(2026, 7, 6, 1, 0), D(2026, 7, 2)),
        (utc(2026, 11, 27, 20, 30), D(2026, 11, 27)),
        (utc(2026, 11, 27, 19, 30), D(2026, 11, 25)),
        (utc(2027, 3, 1, 12, 0), None),
    ]
    got = calendar.latest_complete_session(spark.createDataFrame([(i, n) for i, (n, _) in enumerate(cases)], "i int, now timestamp"), sessions, zone="America/New_York", buffer_minutes=120)
    assert {r.i: r.latest_session for r in got.collect()} == {i: w for i, (_, w) in enumerate(cases)}


GAP_META = "ticker string, security_id string, metadata_status string, metadata_requested_start_date date, metadata_checked_through_date date, metadata_attempt_count int"


@pytest.mark.parametrize(
    ("latest", "meta", "start", "reason"),
    [
        (None, None, D(2026, 6, 12), "no_dwd_rows"),
        (D(2026, 6, 13), None, D(2026, 6, 14), "dwd_lag"),
        (D(2026, 5, 1), None, D(2026, 5, 2), "dwd_lag"),
        (D(2026, 6, 12), ("empty", None, D(2026, 6, 14), 1), D(2026, 6, 15), "metadata_empty_checked_through"),
        (D(2026, 6, 12), ("success", None, D(2026, 6, 14), 1), D(2026, 6, 15), "metadata_checked_through"),
        (D(2026, 6, 12), ("failed", D(2026, 6, 13), None, 1), D(2026, 6, 13), "retry_failed_window"),
        (D(2026, 6, 15), ("failed", D(2026, 6, 13), None, 1), D(2026, 6, 16), "retry_failed_window"),
        (D(2026, 6, 12), ("failed", D(2026, 6, 13), None, 3), None, None),
        (D(2026, 6, 12), ("skipped", None, D(2026, 6, 13), 1), None, None),
        (D(2026, 6, 18), None, None, None),
    ],
)
def test_gap_tasks(spark, latest, meta, start, reason):
    tasks = spark.createDataFrame([(" a ", "v:A"), ("A", "v:A"), ("", "v:B"), ("nan", None)], "ticker string, security_id string")
    dates = spark.createDataFrame([("A", "v:A", latest)] if latest else [], "ticker string, security_id string, latest_dwd_date date")
    known = spark.createDataFrame([("A", "v:A", *meta)] if meta else [], GAP_META)
    got = gaps.gap_tasks(tasks, dates, known, source="v", dataset="d", anchor=D(2026, 6, 11), complete=D(2026, 6, 17)).collect()
    assert [(r.request_start_date, r.request_end_date, r.reason) for r in got] == ([(start, D(2026, 6, 17), reason)] if start else [])
    assert gaps.gap_tasks(tasks, dates, known, source="v", dataset="d", anchor=D(2026, 6, 11), complete=D(2026, 6, 11)).count() == 0


def test_eligibility_and_checked_through(spark):
    tasks = spark.createDataFrame([(t, f"v:{t}") for t in "ABCD"], "ticker string, security_id string")
    known = spark.createDataFrame([("A", "v:A", None, "false"), ("B", "v:B", D(2020, 1, 1), "False"), ("C", "v:C", D(2020, 1, 1), "TRUE")], "ticker string, security_id string, end_date date, is_active string")
    got = {r.ticker: (r.eligible_for_daily_update, r.daily_update_exclusion_reason) for r in gaps.daily_eligibility(tasks, known, anchor=D(2026, 6, 11), grace_days=7).collect()}
    assert got == {"A": (True, None), "B": (False, "inactive_or_stale_end_date"), "C": (True, None), "D": (False, "missing_dim_security")}
    with pytest.raises(ValueError):
        gaps.daily_eligibility(tasks, known, anchor=D(2026, 6, 11), grace_days=-1)
    last = spark.createDataFrame([(D(2026, 6, 10),), (None,)], "last_end_date date")
    got = {r.last_end_date: r.refresh_start for r in gaps.refresh_window(last, mode="incremental", start=D(2020, 1, 1), lookback_days=5, today=D(2026, 6, 11)).collect()}
    assert got == {D(2026, 6, 10): D(2026, 6, 5), None: D(2020, 1, 1)}


def test_listing_files_of_any_case_and_spelling(spark):
    rows = [(" aapl", "nasdaq", "Stock", "usd", "1990-01-01", "2026-01-01"), ("AAPL", "PINK", "Stock", "USD", "1990-01-01", "2026-01-01"), ("NaN", "NYSE", "Stock", "USD", "", ""), ("b", "nyse arca", "stock", "None", "soon", "2026-01-01")]
    for names in ("symbol string, exchange string, asset_type string, price_currency string, start_date string, end_date string", "ticker string, exchange string, assetType string, priceCurrency string, startDate string, endDate string, symbol2 string"):
        raw = spark.createDataFrame([(*r, "x")[: names.count(",") + 1] for r in rows], names)
        made = security_master.normalise_listings(raw)
        best = {r.ticker: r for r in security_master.canonical_listings(security_master.rank_listings(security_master.collapse_listings(made))).collect()}
        assert (best["AAPL"].exchange, best["AAPL"].price_currency, best["AAPL"].source_ticker, best["AAPL"].ticker_duplicate_count) == ("NASDAQ", "USD", "AAPL", 2)
        assert (best["B"].exchange, best["B"].asset_type, best["B"].price_currency, best["B"].start_date) == ("NYSE ARCA", "stock", None, None) and set(best) == {"AAPL", "B"}
        assert {(r.source_raw_symbol, r.company_name) for r in made.collect()} == {("AAPL", None), ("B", None)}
    with pytest.raises(ValueError, match="ticker"):
        security_master.normalise_listings(raw.drop("ticker"))


def test_the_first_row_of_a_key_stays(spark):
    rows = spark.createDataFrame([("k", 2, "a"), ("k", 1, "z"), ("m", 1, None), ("m", 1, "b")], "id string, input_seq int, v string")
    assert {(r.id, r.v) for r in dedup.first_by_key(rows, ["id"]).collect()} == {("k", "z"), ("m", "b")}
    assert {(r.id, r.v) for r in dedup.first_by_key(rows.drop("input_seq"), ["id"]).collect()} == {("k", "a"), ("m", "b")}

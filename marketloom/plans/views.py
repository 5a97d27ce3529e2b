"""The star-schema test tables seen as market data: domain views, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily series per supplier, in whole units so that sums are exact."""
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"), "l_extendedprice", "l_quantity")
    daily = lines.groupBy("l_suppkey", "date").agg(
        F.floor(F.max("l_extendedprice")).cast("double").alias("close"),
        F.floor(F.min("l_extendedprice")).cast("double").alias("low"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )
    close = F.col("close")
    return daily.select(
        F.concat(F.lit("S:"), F.col("l_suppkey").cast("string")).alias("security_id"),
        F.col("l_suppkey").cast("string").alias("ticker"),
        "date",
        F.col("low").alias("open"),
        close.alias("high"),
        "low",
        close.alias("close"),
        "volume",
        F.col("low").alias("adj_open"),
        close.alias("adj_high"),
        F.col("low").alias("adj_low"),
        close.alias("adj_close"),
        F.col("volume").alias("adj_volume"),
        F.lit(0.0).alias("div_cash"),
        F.lit(1.0).alias("split_factor"),
        F.lit("vendor").alias("source"),
        F.lit("load-1").alias("load_id"),
        F.lit("2026-01-01 00:00:00").cast("timestamp").alias("loaded_at"),
    )


PRICES_SQL = """prices AS (
    SELECT 'S:' || l_suppkey AS security_id, CAST(l_suppkey AS VARCHAR) AS ticker, date, low AS open, close AS high, low, close, volume,
           low AS adj_open, close AS adj_high, low AS adj_low, close AS adj_close, volume AS adj_volume, 0.0::DOUBLE AS div_cash, 1.0::DOUBLE AS split_factor,
           'vendor' AS source, 'load-1' AS load_id, TIMESTAMP '2026-01-01 00:00:00' AS loaded_at
    FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, CAST(floor(max(l_extendedprice)) AS DOUBLE) AS close,
                 CAST(floor(min(l_extendedprice)) AS DOUBLE) AS low, CAST(sum(l_quantity) AS BIGINT) AS volume
          FROM lineitem GROUP BY 1, 2))"""


def new_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load: the rows of months 1 to 3 of 2000 with a new close, and rows 5000 days on for suppliers below 5."""
    base = prices(spark, sf_dir).where((F.year("date") == 2000) & (F.month("date") <= 3))
    changed = base.withColumns({"close": F.col("close") + 1, "load_id": F.lit("load-2"), "loaded_at": F.lit("2026-02-01 00:00:00").cast("timestamp")})
    later = changed.where(F.col("ticker").cast("int") < 5).withColumn("date", F.date_add("date", 5000))
    return changed.unionByName(later)


NEW_PRICES_SQL = """changed AS (
    SELECT * REPLACE (close + 1 AS close, 'load-2' AS load_id, TIMESTAMP '2026-02-01 00:00:00' AS loaded_at)
    FROM prices WHERE year(date) = 2000 AND month(date) <= 3),
new_prices AS (SELECT * FROM changed UNION ALL SELECT * REPLACE (date + 5000 AS date) FROM changed WHERE CAST(ticker AS INTEGER) < 5)"""


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of nations on market segments; dates are the first and last order."""
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = read(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(orders, F.col("c_custkey") == F.col("o_custkey"))
    daily = rows.groupBy("n_name", "c_mktsegment", "c_custkey").agg(F.min("day").alias("start_date"), F.max("day").alias("end_date"))
    kind = F.when(F.col("c_custkey") % 5 == 0, "ETF").otherwise("Stock")
    return daily.select(
        F.col("n_name").alias("source_ticker"),
        F.upper("n_name").alias("ticker"),
        F.col("c_mktsegment").alias("exchange"),
        kind.alias("asset_type"),
        F.when(F.col("c_custkey") % 3 == 0, "CAD").when(F.col("c_custkey") % 7 != 1, "USD").alias("price_currency"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("start_date")).alias("start_date"),
        F.when(F.col("c_custkey") % 13 != 0, F.col("end_date")).alias("end_date"),
    )


LISTINGS_SQL = """listings AS (
    SELECT n_name AS source_ticker, upper(n_name) AS ticker, c_mktsegment AS exchange,
           CASE WHEN c_custkey % 5 = 0 THEN 'ETF' ELSE 'Stock' END AS asset_type,
           CASE WHEN c_custkey % 3 = 0 THEN 'CAD' WHEN c_custkey % 7 <> 1 THEN 'USD' END AS price_currency,
           CASE WHEN c_custkey % 11 <> 0 THEN start_date END AS start_date, CASE WHEN c_custkey % 13 <> 0 THEN end_date END AS end_date
    FROM (SELECT n_name, c_mktsegment, c_custkey, min(CAST(o_orderdate AS DATE)) AS start_date, max(CAST(o_orderdate AS DATE)) AS end_date
          FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2, 3))"""

def listing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings as a vendor's file: texts, one name of the second spelling, venues and currencies in mixed case."""
    odd = F.length("ticker") % 2 == 1
    venue = F.element_at(F.create_map(*[F.lit(x) for kv in LISTED_ON.items() for x in kv]), F.col("exchange"))
    currency = F.coalesce("price_currency", F.lit("nan"))
    return listings(spark, sf_dir).select(
        F.concat(F.lit(" "), F.lower("ticker")).alias("symbol"),
        F.when(odd, F.lower(venue)).otherwise(venue).alias("exchange"),
        F.col("asset_type").alias("assetType"),
        F.when(odd, currency).otherwise(F.when(currency == "nan", currency).otherwise(F.lower(currency))).alias("priceCurrency"),
        F.coalesce(F.col("start_date").cast("string"), F.lit("")).alias("startDate"),
        F.coalesce(F.col("end_date").cast("string"), F.lit("None")).alias("end_date"),
    )


#: What a reader of that file must find, as SQL: every ticker, venue and currency in capitals.
LISTING_FILE_SQL = f"""{LISTINGS_SQL}, listing_file AS (
    SELECT upper(source_ticker) AS source_ticker, upper(ticker) AS ticker,
           upper(map {{'AUTOMOBILE': 'AMEX', 'BUILDING': 'NYSE MKT', 'FURNITURE': 'NYSE', 'MACHINERY': 'PINK', 'HOUSEHOLD': 'NASDAQ'}}[exchange]) AS exchange,
           asset_type, upper(price_currency) AS price_currency, start_date, end_date FROM listings)"""

#: Exchanges that market segments stand for.
LISTED_ON = {"AUTOMOBILE": "AMEX", "BUILDING": "NYSE MKT", "FURNITURE": "NYSE", "MACHINERY": "PINK", "HOUSEHOLD": "NASDAQ"}

#: Preference of exchanges in the listings view.
VENUES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "MACHINERY": 4}


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide security table: customers as securities."""
    customer = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    ticker = F.when(key % 10 == 0, F.concat(F.lit("AB"), key.cast("string"), F.lit("-WS"))).when(key % 10 == 1, F.lit("ABCDU")).otherwise(F.concat(F.lit("t"), key.cast("string")))
    return customer.select(
        F.concat(F.lit("vendor:"), key.cast("string")).alias("security_id"),
        ticker.alias("ticker"),
        F.col("c_mktsegment").alias("exchange"),
        F.when(key % 4 == 0, "ETF").otherwise("Stock").alias("asset_type"),
        F.when(key % 6 != 0, "USD").when(key % 12 == 0, "nan").otherwise("CAD").alias("price_currency"),
        F.when(key % 9 != 0, F.date_add(F.lit("2015-01-01").cast("date"), (key % 2500).cast("int"))).alias("start_date"),
        F.when(key % 17 != 0, F.date_add(F.lit("2018-01-01").cast("date"), (key % 3000).cast("int"))).alias("end_date"),
        F.when(key % 8 == 0, F.lit("Great United Fund")).otherwise(F.col("c_name")).alias("company_name"),
        (key % 2 == 0).alias("is_active"),
    )


SECURITIES_SQL = """securities AS (
    SELECT 'vendor:' || c_custkey AS security_id,
           CASE WHEN c_custkey % 10 = 0 THEN 'AB' || c_custkey || '-WS' WHEN c_custkey % 10 = 1 THEN 'ABCDU' ELSE 't' || c_custkey END AS ticker,
           c_mktsegment AS exchange, CASE WHEN c_custkey % 4 = 0 THEN 'ETF' ELSE 'Stock' END AS asset_type,
           CASE WHEN c_custkey % 6 <> 0 THEN 'USD' WHEN c_custkey % 12 = 0 THEN 'nan' ELSE 'CAD' END AS price_currency,
           CASE WHEN c_custkey % 9 <> 0 THEN DATE '2015-01-01' + CAST(c_custkey % 2500 AS INTEGER) END AS start_date,
           CASE WHEN c_custkey % 17 <> 0 THEN DATE '2018-01-01' + CAST(c_custkey % 3000 AS INTEGER) END AS end_date,
           CASE WHEN c_custkey % 8 = 0 THEN 'Great United Fund' ELSE c_name END AS company_name, c_custkey % 2 = 0 AS is_active
    FROM customer)"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window results: orders as windows of customers."""
    o = read(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    action = F.element_at(F.array(*[F.lit(a) for a in ("downloaded", "existing", "empty", "failed", "skipped", "existing_empty")]), (key % 6 + 1).cast("int"))
    status = F.element_at(F.array(*[F.lit(a) for a in ("success", "success", "empty", "failed", "skipped", "empty")]), (key % 6 + 1).cast("int"))
    rows = F.when(key % 6 < 2, key % 23 + 1).when(key % 6 != 3, F.lit(0)).cast("long")
    return o.select(
        F.concat(F.lit("run-"), (key % 3).cast("string")).alias("run_id"),
        F.lit("vendor").alias("source"),
        F.lit("daily").alias("dataset_name"),
        F.col("o_custkey").cast("string").alias("ticker"),
        F.concat(F.lit("vendor:"), F.col("o_custkey").cast("string")).alias("security_id"),
        day.alias("requested_start_date"),
        F.date_add(day, (key % 30).cast("int")).alias("requested_end_date"),
        status.alias("status"),
        action.alias("action"),
        rows.alias("row_count"),
        F.when(key % 6 < 2, F.date_add(day, (key % 20).cast("int"))).alias("last_price_date"),
        (key % 2 == 0).alias("api_called"),
        (key % 5 == 0).alias("uploaded_to_gcs"),
        F.when(key % 6 == 3, F.when(key % 4 == 1, "404 Not Found").otherwise("timeout")).alias("error_message"),
        F.timestamp_seconds(F.lit(1_600_000_000) + key * 60).alias("completed_at"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("attempt_count"),
        key.alias("seq"),
    )


RESULTS_SQL = """results AS (
    SELECT 'run-' || (o_orderkey % 3) AS run_id, 'vendor' AS source, 'daily' AS dataset_name, CAST(o_custkey AS VARCHAR) AS ticker, 'vendor:' || o_custkey AS security_id,
           CAST(o_orderdate AS DATE) AS requested_start_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS requested_end_date,
           ['success', 'success', 'empty', 'failed', 'skipped', 'empty'][o_orderkey % 6 + 1] AS status,
           ['downloaded', 'existing', 'empty', 'failed', 'skipped', 'existing_empty'][o_orderkey % 6 + 1] AS action,
           CASE WHEN o_orderkey % 6 < 2 THEN o_orderkey % 23 + 1 WHEN o_orderkey % 6 <> 3 THEN 0 END AS row_count,
           CASE WHEN o_orderkey % 6 < 2 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) END AS last_price_date,
           o_orderkey % 2 = 0 AS api_called, o_orderkey % 5 = 0 AS uploaded_to_gcs,
           CASE WHEN o_orderkey % 6 = 3 THEN CASE WHEN o_orderkey % 4 = 1 THEN '404 Not Found' ELSE 'timeout' END END AS error_message,
           make_timestamp(CAST(1600000000 + o_orderkey * 60 AS BIGINT) * 1000000) AS completed_at, CAST(left(o_orderpriority, 1) AS INTEGER) AS attempt_count, o_orderkey AS seq
    FROM orders)"""


def latest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.dedup import latest_rows

    return latest_rows(results(spark, sf_dir), ["ticker", "security_id"], [F.desc("requested_end_date"), F.desc("completed_at"), F.desc("requested_start_date")])


LATEST_RESULTS_SQL = """latest_results AS (
    SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY ticker, security_id ORDER BY requested_end_date DESC, completed_at DESC, requested_start_date DESC) = 1)"""


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status transitions of users: events."""
    return transitions_of(read(spark, sf_dir, "events"))


def transitions_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "view", "running").when(kind == "click", "running").when(kind == "purchase", "success").when(kind == "error", "failed").otherwise("pending")
    return events.select(F.col("user_id").cast("string").alias("ticker"), status.alias("status"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"))


TRANSITIONS_SQL = """transitions AS (
    SELECT CAST(user_id AS VARCHAR) AS ticker, CASE event_type WHEN 'view' THEN 'running' WHEN 'click' THEN 'running' WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'pending' END AS status,
           ts AS "at", event_id AS seq FROM events)"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end events of pipeline runs: events, a run for each user."""
    key = F.col("user_id")
    event = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "error", "failed").otherwise("started")
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), key.cast("string")).alias("run_id"),
        F.concat(F.lit("p"), (key % 3).cast("string")).alias("pipeline_name"),
        F.when(key % 11 != 0, F.concat(F.lit("d"), (key % 7).cast("string"))).alias("dataset"),
        event.alias("event"),
        F.col("ts").cast("timestamp").alias("at"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 1000).alias("row_count"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("n"), (F.col("event_id") % 10).cast("string"))).alias("notes"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("e"), (F.col("event_id") % 5).cast("string"))).alias("error_message"),
    )


RUN_LOG_SQL = """run_log AS (
    SELECT 'run-' || user_id AS run_id, 'p' || (user_id % 3) AS pipeline_name, CASE WHEN user_id % 11 <> 0 THEN 'd' || (user_id % 7) END AS dataset,
           CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'started' END AS event, ts AS "at", event_id AS seq, event_id % 1000 AS row_count,
           CASE WHEN event_id % 3 = 0 THEN 'n' || (event_id % 10) END AS notes, CASE WHEN event_type = 'error' THEN 'e' || (event_id % 5) END AS error_message FROM events),
attempts AS (SELECT *, count(*) FILTER (event = 'started') OVER (PARTITION BY run_id ORDER BY "at", seq ROWS UNBOUNDED PRECEDING) AS attempt FROM run_log),
tries AS (SELECT run_id, attempt, min(pipeline_name) AS pipeline_name, min(dataset) AS dataset, min("at") FILTER (event = 'started') AS started_at, min("at") FILTER (event <> 'started') AS ended_at,
    arg_min(event, ("at", seq)) FILTER (event <> 'started') AS ending, count(*) AS n_events FROM attempts GROUP BY 1, 2),
intervals AS (SELECT * EXCLUDE (ending), CASE WHEN attempt = 0 THEN 'unstarted' WHEN ended_at IS NOT NULL THEN ending WHEN attempt = max(attempt) OVER (PARTITION BY run_id) THEN 'open' ELSE 'superseded' END AS outcome FROM tries)"""


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays around the events, closing at 16:00 (13:00 on Fridays)."""
    days = read(spark, sf_dir, "events").agg(F.date_sub(F.to_date(F.min("ts")), 20).alias("a"), F.to_date(F.max("ts")).alias("b"))
    rows = days.select(F.explode(F.sequence("a", "b")).alias("session_date")).where(F.weekday("session_date") < 5)
    hour = F.when(F.weekday("session_date") == 4, 13).otherwise(16)
    return rows.select("session_date", (F.col("session_date").cast("timestamp") + F.make_interval(hours=hour)).alias("close_at"))


SESSIONS_SQL = """sessions AS (
    SELECT d AS session_date, d + INTERVAL 1 HOUR * CASE WHEN isodow(d) = 5 THEN 13 ELSE 16 END AS close_at
    FROM (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE) - 20, CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM events) WHERE isodow(d) < 6)"""

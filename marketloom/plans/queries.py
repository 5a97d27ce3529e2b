"""The registered queries over the test tables."""

from __future__ import annotations

import datetime
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import calendar, dedup, features, fingerprints, frames, gaps, merge, normalize, profile, quality, reconcile, runs, security_master, state, universe
from ..schemas import PRICE_COLUMNS, PRICE_KEY, WINDOW_KEY, cast_to, table_contract
from ..sources import readers, writers
from ..streaming import ingest
from ..streaming import transitions as status_stream
from . import views

BENCHMARK = "0"
ANCHOR, COMPLETE = datetime.date(2000, 6, 1), datetime.date(2005, 1, 3)
FILTERS = universe.Filters(datetime.date(2019, 1, 1), datetime.date(2021, 6, 1), exchanges=["BUILDING", "MACHINERY", "HOUSEHOLD"])
MONTHS = [(datetime.date(1999, 3, 1), datetime.date(1999, 4, 1)), (datetime.date(2000, 1, 1), datetime.date(2000, 3, 1))]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors see; a session on one machine may do without a setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = root or tempfile.mkdtemp(prefix="marketloom-")
    return f"{root.rstrip('/')}/market/{uuid.uuid4().hex}"


@contextmanager
def saved_tables(spark: SparkSession, *kinds: str):
    """New names of saved tables, which are dropped at the end."""
    names = [f"market_{kind}_{uuid.uuid4().hex}" for kind in kinds]
    try:
        yield names
    finally:
        for name in names:
            writers.drop_table(spark, name)


def kept(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again, so that what it was made from may go."""
    path = f"{shared_folder(df.sparkSession)}/kept"
    writers.write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query
def staging(spark, d):
    return cast_to(views.prices(spark, d))


@query
def returns(spark, d):
    return features.returns(views.prices(spark, d))


def _rounded(df: DataFrame) -> DataFrame:
    """Deviations and what is made from them differ between engines in the last bit."""
    digits = {c: 6 for c in ("volatility_20d_lagged", "volatility_60d_lagged", "dollar_volume_zscore_20d_lagged", "volume_zscore_20d_lagged", "log_dollar_volume")}
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


@query
def rolling_features(spark, d):
    return _rounded(features.features(features.returns(views.prices(spark, d))))


@query
def forward_labels(spark, d):
    return features.labels(views.prices(spark, d).select("security_id", "ticker", "date", "adj_close"))


@query
def research_panel(spark, d):
    return _rounded(features.panel(views.prices(spark, d), BENCHMARK))


@query
def panel_joined(spark, d):
    """Features and labels by join, then the benchmark; the form for keys that repeat."""
    joined = features.labels_joined(views.prices(spark, d).select("security_id", "ticker", "date", "adj_close"))
    bench = features.benchmark_forward(views.prices(spark, d), BENCHMARK)
    return joined.join(bench, "date", "left").select("security_id", "date", "fwd_ret_5d", "label_direction_5d", (F.col("fwd_ret_20d") - F.col("benchmark_fwd_ret_20d")).alias("excess"))


@query
def liquid_universe(spark, d):
    return features.liquid_universe(views.prices(spark, d), top=10)


@query
def inspection_filters(spark, d):
    """Labelled rows since a date."""
    made = features.labels(views.prices(spark, d).select("security_id", "ticker", "date", "adj_close"))
    return made.where((F.col("date") >= "2001-01-01") & F.col("fwd_ret_20d").isNotNull()).select("security_id", "date", "fwd_ret_20d")


@query
def price_quality(spark, d):
    return quality.validate_prices(views.prices(spark, d).unionByName(views.new_prices(spark, d)))


@query
def price_quality_legacy(spark, d):
    return quality.report(views.prices(spark, d), quality.legacy_price_rules(), key=PRICE_KEY)


@query
def quality_examples(spark, d):
    rules = {"low_volume": F.col("volume") < 3, "high_close": F.col("close") > 104_000}
    return quality.examples(views.prices(spark, d), rules, ["security_id", "date"])


@query
def result_quality(spark, d):
    rows = views.results(spark, d).select(F.col("action").alias("status"), F.col("requested_start_date").alias("request_start_date"), F.col("requested_end_date").alias("request_end_date"), "row_count", "last_price_date")
    return quality.report(rows, quality.result_rules(["downloaded", "existing", "empty", "failed", "skipped"]))


@query
def model_not_null(spark, d):
    made = features.returns(views.prices(spark, d))
    return quality.report(made, quality.non_null_rules(["security_id", "date", "adj_close", "ret_1d", "ret_120d"]), non_empty=False)


@query
def model_tests(spark, d):
    """Every model's columns that may not be null."""
    p = views.prices(spark, d)
    made = features.returns(p)
    return quality.validate_models({"staging": cast_to(p), "returns": made, "features": features.features(made), "panel": features.panel(p, BENCHMARK)})


@query
def dimension_quality(spark, d):
    return quality.validate_dimension(views.securities(spark, d))


@query
def result_windows_quality(spark, d):
    """The rules of a download report with those of its windows; of two runs over the same windows."""
    rows = views.results(spark, d).select("ticker", "security_id", F.col("action").alias("status"), F.col("requested_start_date").alias("request_start_date"), F.date_add("requested_end_date", F.when(F.col("seq") % 9 == 0, -20).otherwise(0)).alias("request_end_date"), "row_count", "last_price_date", "seq")
    return quality.validate_results(rows.unionByName(rows.where("seq % 4 = 0")), ["downloaded", "existing", "empty", "failed"])


@query
def task_list_rules(spark, d):
    """A task list with tasks of another list in it, against a list's rules and bounds."""
    tasks = _tasks(spark, d)
    other = tasks.withColumns({"task_list_name": F.lit("other"), "task_id": F.concat_ws(":", "task_id", F.lit("NaN"))})
    return quality.report(tasks.unionByName(other), quality.task_rules(["pending"], "bootstrap"), key=["task_id"], least=1, most=5)


@query
def text_and_integer_rules(spark, d):
    rows = views.securities(spark, d).select("price_currency", "ticker", (F.length("company_name") / 2).alias("half"))
    return quality.report(rows, quality.text_rules(["price_currency", "ticker"]) | quality.integral_rules(["half"]), non_empty=False)


@query
def manifest_quality(spark, d):
    made = merge.manifest(views.prices(spark, d), views.new_prices(spark, d))
    return quality.report(made, quality.manifest_rules(), key=merge.MONTH)


@query
def task_list_quality(spark, d):
    return quality.report(_tasks(spark, d), quality.task_rules(["pending"]), key=["task_id"])


@query
def duplicate_keys(spark, d):
    both = views.prices(spark, d).unionByName(views.new_prices(spark, d))
    return quality.duplicate_keys(both, PRICE_KEY).orderBy(F.desc("n_rows"), *PRICE_KEY)


@query
def marked_duplicates(spark, d):
    both = views.prices(spark, d).unionByName(views.new_prices(spark, d))
    return quality.marked_duplicates(both, PRICE_KEY).select(*PRICE_KEY, "load_id", "is_duplicate")


def _loads(spark, d) -> DataFrame:
    e = views.read(spark, d, "events")
    return e.select(F.col("user_id").cast("string").alias("security_id"), F.to_date("ts").alias("date"), F.col("ts").alias("loaded_at"), F.col("event_id").alias("input_seq"), "value")


@query
def dedup_latest(spark, d):
    return dedup.dedup_prices(_loads(spark, d)).select("security_id", "date", "input_seq", "value")


@query
def combine_frames(spark, d):
    out = dedup.combine([views.prices(spark, d), views.new_prices(spark, d)])
    return out.select(*PRICE_KEY, "close", "load_id")


@query
def key_sets(spark, d):
    return dedup.key_sets(views.prices(spark, d), views.new_prices(spark, d), PRICE_KEY)


@query
def cross_file_uniqueness(spark, d):
    return dedup.overlap_check(views.prices(spark, d).unionByName(views.new_prices(spark, d)))


@query
def merge_windows(spark, d):
    return merge.merge_windows(views.prices(spark, d), views.new_prices(spark, d)).select("year", "month", *PRICE_KEY, "close", "load_id")


@query
def merge_manifest(spark, d):
    return merge.manifest(views.prices(spark, d), views.new_prices(spark, d))


@query
def manifest_state(spark, d):
    base = views.prices(spark, d)
    made = merge.manifest(base, views.new_prices(spark, d))
    target = reconcile.in_months(base, made).agg(F.count(F.lit(1)).alias("n_rows"))
    return merge.target_state(merge.manifest_totals(made), target)


@query
def merge_preview(spark, d):
    report = views.results(spark, d).select(F.col("action").alias("status"), "row_count")
    return merge.preview(report, views.new_prices(spark, d))


def _ranked(spark, d) -> DataFrame:
    return security_master.rank_listings(security_master.collapse_listings(views.listings(spark, d)), exchange_priority=views.VENUES)


@query
def collapsed_listings(spark, d):
    return security_master.collapse_listings(views.listings(spark, d))


@query
def ranked_listings(spark, d):
    return _ranked(spark, d)


@query
def duplicate_listing_report(spark, d):
    return security_master.duplicate_report(_ranked(spark, d)).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_listings"))


@query
def dim_security(spark, d):
    return _dim(spark, d)


def _dim(spark, d) -> DataFrame:
    loaded = F.lit("2026-01-01 00:00:00").cast("timestamp")
    return security_master.dim_security(security_master.canonical_listings(_ranked(spark, d)), source="vendor", grace_days=30, loaded_at=loaded)


@query
def listed_tasks(spark, d):
    """The whole chain: listings, canonical rows with the reference order of exchanges, dimension, pool, task list."""
    venue = F.element_at(F.create_map(*[F.lit(x) for kv in views.LISTED_ON.items() for x in kv]), F.col("exchange"))
    listings = views.listings(spark, d).withColumn("exchange", venue)
    ranked = security_master.rank_listings(security_master.collapse_listings(listings))
    dim = security_master.dim_security(security_master.canonical_listings(ranked), source="vendor", grace_days=30)
    pool = universe.candidate_pool(dim, universe.Filters(datetime.date(1992, 1, 1), datetime.date(2021, 6, 1), exchanges=list(security_master.EXCHANGE_PRIORITY)))
    return universe.task_list(pool, name="bootstrap", source="vendor", dataset="daily", start=datetime.date(1992, 1, 1), end=datetime.date(2026, 6, 11)).join(pool.select("ticker", "exchange"), "ticker")


@query
def normalised_listings(spark, d):
    return security_master.normalise_listings(views.listing_file(spark, d))


@query
def canonical_from_file(spark, d):
    """A listing file of mixed case under alias names, to its canonical rows."""
    ranked = security_master.rank_listings(security_master.collapse_listings(security_master.normalise_listings(views.listing_file(spark, d))))
    return security_master.canonical_listings(ranked).select("ticker", "source_ticker", "exchange", "asset_type", "price_currency", "start_date", "end_date", "ticker_duplicate_count")


@query
def candidate_pool(spark, d):
    return universe.candidate_pool(views.securities(spark, d), FILTERS, loaded_at=F.lit("2026-01-01 00:00:00").cast("timestamp"))


@query
def candidate_funnel(spark, d):
    return universe.filter_funnel(views.securities(spark, d), FILTERS)


@query
def suspicious_tickers(spark, d):
    return universe.suspicious_tickers(views.securities(spark, d).select("security_id", "ticker"))


@query
def sample_universe(spark, d):
    pool = views.securities(spark, d).select("security_id", "ticker")
    return universe.sample_universe(pool, limit=100, forced=["t2", "t3", "t5"])


def _tasks(spark, d) -> DataFrame:
    pool = universe.candidate_pool(views.securities(spark, d), FILTERS)
    return universe.task_list(pool, name="bootstrap", source="vendor", dataset="daily", start=datetime.date(2019, 1, 1), end=datetime.date(2026, 6, 11))


@query
def task_list(spark, d):
    return _tasks(spark, d)


@query
def selected_tasks(spark, d):
    return universe.select_tasks(_tasks(spark, d), limit=20).select("task_id", "ticker")


@query
def latest_session(spark, d):
    instants = views.read(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("now"))
    return calendar.latest_complete_session(instants, views.sessions(spark, d), buffer_minutes=90).select("event_id", "latest_session")


@query
def eligibility(spark, d):
    tasks = views.results(spark, d).select("ticker", "security_id").unionByName(spark.createDataFrame([("x9", "vendor:none")], "ticker string, security_id string"))
    s = views.securities(spark, d).select(F.regexp_replace("security_id", "vendor:", "").alias("ticker"), "security_id", "end_date", "is_active")
    return gaps.daily_eligibility(tasks, s, anchor=datetime.date(2022, 1, 1), grace_days=7)


@query
def latest_dates(spark, d):
    return gaps.latest_dates(views.prices(spark, d))


def _metadata(spark, d) -> DataFrame:
    r = views.latest_results(spark, d)
    through = gaps.checked_through(F.col("status"), F.col("requested_end_date"), F.lit(None).cast("date"), F.col("last_price_date"))
    return r.select(F.upper("ticker").alias("ticker"), F.concat(F.lit("S:"), "ticker").alias("security_id"), F.col("status").alias("metadata_status"), F.col("requested_start_date").alias("metadata_requested_start_date"), through.alias("metadata_checked_through_date"), F.col("attempt_count").alias("metadata_attempt_count"))


@query
def latest_metadata(spark, d):
    rows = views.results(spark, d).withColumns({"updated_at": F.col("completed_at"), "created_at": F.col("completed_at")})
    return gaps.latest_metadata(rows).select("ticker", "security_id", "status", "requested_start_date", "requested_end_date")


@query
def checked_through(spark, d):
    return _metadata(spark, d).select("ticker", "metadata_status", "metadata_checked_through_date")


@query
def gap_tasks(spark, d):
    tasks = views.read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("ticker"), F.concat(F.lit("S:"), F.col("c_custkey").cast("string")).alias("security_id"))
    latest = gaps.latest_dates(views.prices(spark, d))
    return gaps.gap_tasks(tasks, latest, _metadata(spark, d), source="vendor", dataset="daily", anchor=ANCHOR, complete=COMPLETE)


@query
def refresh_window(spark, d):
    runs = views.results(spark, d).select("ticker", "status", F.col("requested_end_date").alias("data_end_date"))
    last = state.last_successful_end(runs, ["ticker"])
    return gaps.refresh_window(last, mode="incremental", start=datetime.date(1995, 1, 1), lookback_days=5, today=COMPLETE)


@query
def normalised_results(spark, d):
    r = views.results(spark, d)
    raw = r.select(F.col("action").alias("status"), F.col("requested_start_date").cast("string").alias("request_start_date"), F.lit("soon").alias("request_end_date"), F.col("row_count").cast("string").alias("row_count"), F.when(F.col("api_called"), "Yes").otherwise("0").alias("api_called"), "seq", F.col("completed_at").cast("string").alias("completed_at_utc"), "error_message")
    out = state.normalise_results(raw)
    return out.select("seq", "status", "persistent_status", "request_start_date", "request_end_date", "row_count", "api_called", scalars.failure_action(F.col("error_message")).alias("failure_action"))


@query
def result_texts(spark, d):
    """Long errors cut for storage, and instants as ISO-8601 texts."""
    r = views.results(spark, d).select("seq", F.col("action").alias("status"), "row_count", F.col("completed_at").cast("string").alias("completed_at_utc"), F.repeat("error_message", F.lit(300)).alias("error_message"))
    out = state.normalise_results(r)
    return out.select("seq", "error_message", scalars.iso_utc(F.col("completed_at_utc")).alias("completed_text"))


def _window_rows(spark, d) -> DataFrame:
    return dedup.latest_rows(views.results(spark, d), WINDOW_KEY, [F.desc("seq")])


#: What is stored and what a load brings: together all windows, and most in both.
STORED, LOADED = "seq % 5 <> 0", "seq % 2 = 0 OR seq % 3 = 0 OR seq % 5 = 0"


@query
def upsert_window_results(spark, d):
    rows = dedup.latest_rows(views.results(spark, d), ["run_id", *WINDOW_KEY], [F.desc("seq")]).select("run_id", *WINDOW_KEY, "status", "row_count", "seq")
    old, new = rows.where(STORED), rows.where(LOADED).withColumn("status", F.lit("replayed"))
    return state.upsert_window_results(old, new)


@query
def upsert_symbol_status(spark, d):
    rows = _window_rows(spark, d)
    old = rows.where(STORED).select(*WINDOW_KEY, "status", "attempt_count", F.col("run_id").alias("last_run_id"), F.when(F.col("seq") % 7 != 0, F.col("completed_at") + F.make_interval(hours=(F.col("seq") % 3 - 1).cast("int"))).alias("last_completed_at"), F.lit(None).cast("date").alias("last_successful_date"), F.lit(None).cast("string").alias("last_error_message"))
    new = rows.where(LOADED).withColumn("run_id", F.when(F.col("seq") % 4 == 0, F.col("run_id")).otherwise("run-new"))
    return state.upsert_symbol_status(old, new)


@query
def upsert_runs(spark, d):
    runs = views.results(spark, d).groupBy("run_id", F.year("requested_start_date").alias("y")).agg(F.min("completed_at").alias("started_at"), F.max("status").alias("status"))
    runs = runs.select(F.concat_ws("-", "run_id", "y").alias("run_id"), "started_at", "status")
    new = runs.where("run_id >= 'run-1'").withColumns({"started_at": F.col("started_at") + F.make_interval(hours=F.lit(1)), "status": F.lit("success")})
    return state.upsert_runs(runs.where("run_id < 'run-2'"), new)


@query
def seed_tasks(spark, d):
    named = F.when(F.col("seq") % 50 != 0, F.col("dataset_name"))  # a null in the key is a value
    tasks = _window_rows(spark, d).withColumn("dataset_name", named).select(*WINDOW_KEY, "security_id")
    current = tasks.where("requested_start_date < DATE '1998-01-01'").withColumns({"status": F.lit("success"), "attempt_count": F.lit(1)})
    return state.seed_tasks(current, tasks).select(*WINDOW_KEY, "security_id", "status", "attempt_count")


@query
def folded_transitions(spark, d):
    return state.fold_transitions(views.transitions(spark, d), ["ticker"])


@query
def reset_stale(spark, d):
    folded = state.fold_transitions(views.transitions(spark, d), ["ticker"])
    now = F.lit("2024-01-30 12:00:00").cast("timestamp")
    return state.reset_stale(folded, now=now, minutes=120).select("ticker", "status", "was_stale")


#: What the stream of status events waits for late ones, and when a running task hangs.
LATENESS, HANGS_AFTER = "2 days", 600


@query
def streamed_transitions(spark, d):
    """Status events as a stream, folded by ticker, with hanging tasks reset by the time-out of the state."""
    schema = views.read(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return status_stream.fold_to(views.transitions_of(stream), f"{shared_folder(spark)}/status", minutes=HANGS_AFTER, lateness=LATENESS)


@query
def tasks_to_process(spark, d):
    tasks = views.read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("ticker"), F.col("c_custkey").alias("task_order"))
    folded = state.fold_transitions(views.transitions(spark, d), ["ticker"])
    return state.tasks_to_process(tasks, folded, max_attempts=30, limit=50)


@query
def tasks_without_status(spark, d):
    tasks = views.read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("ticker"))
    return state.missing_status(tasks, views.transitions(spark, d))


@query
def restricted_status(spark, d):
    """State of the tickers that a list names."""
    wanted = views.read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("ticker"))
    return state.restricted(state.fold_transitions(views.transitions(spark, d), ["ticker"]), wanted).select("ticker", "status", "attempt_count")


@query
def successful_scope(spark, d):
    tasks = views.read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("ticker"))
    return state.successful_scope(tasks, state.fold_transitions(views.transitions(spark, d), ["ticker"]))


@query
def resume_split(spark, d):
    rows = _window_rows(spark, d)
    prior = rows.where("seq % 2 = 0").withColumns({"status": F.upper("status"), "ticker": F.concat(F.lit(" "), "ticker")})
    return state.resume_split(rows.select(*WINDOW_KEY, "seq"), prior, WINDOW_KEY).select("seq", "done", "prior_status", "prior_action", "prior_row_count", "prior_completed_at")


@query
def run_intervals(spark, d):
    return runs.run_intervals(views.run_log(spark, d))


@query
def folded_runs(spark, d):
    return runs.folded_runs(views.run_log(spark, d))


#: Until when open runs are counted.
AS_OF = "2030-01-01 00:00:00"


@query
def busy_periods(spark, d):
    """Stretches in which runs of a data set overlap without a gap, with the most at once."""
    changes = runs.concurrency(runs.run_intervals(views.run_log(spark, d)), by=["dataset"], now=F.lit(AS_OF).cast("timestamp"))
    return runs.busy_periods(changes, by=["dataset"])


@query
def run_concurrency(spark, d):
    return runs.concurrency(runs.run_intervals(views.run_log(spark, d)), by=["pipeline_name"], now=F.lit(AS_OF).cast("timestamp"))


@query
def dataset_state(spark, d):
    """A catalogue of data sets, updated once, with the state of their runs."""
    names = views.read(spark, d, "region").select(F.concat(F.lit("d"), F.col("r_regionkey").cast("string")).alias("dataset_name"), F.lit("dwd").alias("layer"), F.concat(F.lit("/data/"), "r_name").alias("storage_path"), F.col("r_name").alias("description"))
    none = names.limit(0).withColumns({c: F.lit(None).cast("timestamp") for c in ("created_at", "updated_at")})
    first = runs.catalogue(none, names, now=F.lit("2026-01-01 00:00:00").cast("timestamp"))
    moved = names.where("dataset_name <> 'd1'").withColumns({"layer": F.lit("ods"), "storage_path": F.concat("storage_path", F.lit("/v2"))})
    listed = runs.catalogue(first, moved.unionByName(moved.where("dataset_name = 'd0'").withColumn("dataset_name", F.lit("d9"))), now=F.lit("2026-02-01 00:00:00").cast("timestamp"))
    return runs.dataset_state(listed.drop("description"), runs.run_intervals(views.run_log(spark, d)))


@query
def status_counts(spark, d):
    return state.status_counts(views.results(spark, d), ["run_id"])


@query
def batch_complete(spark, d):
    return state.batch_complete(views.results(spark, d))


@query
def last_successful_end(spark, d):
    return state.last_successful_end(views.results(spark, d).withColumnRenamed("requested_end_date", "data_end_date"), ["run_id"])


@query
def merged_metrics(spark, d):
    r = views.results(spark, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("api_called").alias("calls"))
    merged = state.merge_metrics(F.create_map(F.lit("a"), F.col("n"), F.lit("b"), F.lit(1).cast("long")), F.create_map(F.lit("b"), F.col("calls")))
    return r.select("run_id", F.try_element_at(merged, F.lit("a")).alias("a"), F.try_element_at(merged, F.lit("b")).alias("b"))


@query
def table_summary(spark, d):
    return profile.table_summary(views.prices(spark, d))


@query
def range_summary(spark, d):
    p = views.prices(spark, d)
    return profile.table_summary(p.where(reconcile.date_ranges_predicate(F.col("date"), MONTHS)))


@query
def month_ranges(spark, d):
    return reconcile.month_ranges(merge.manifest(views.prices(spark, d), views.new_prices(spark, d)))


@query
def coverage(spark, d):
    return profile.coverage(views.prices(spark, d), {"low_volume_rows": F.col("volume") < 10, "dear_rows": F.col("close") > 50_000})


@query
def value_counts(spark, d):
    return profile.value_counts(views.securities(spark, d), "exchange", 3)


@query
def ticker_prices(spark, d):
    return profile.ticker_prices(views.prices(spark, d), 0)


@query
def panel_summary(spark, d):
    return profile.panel_summary(features.panel(views.prices(spark, d), BENCHMARK)).select("ticker", "n_rows", "min_date", "max_date", "labelled_rows")


@query
def panel_averages(spark, d):
    """The panel's averages by ticker."""
    return profile.panel_summary(features.panel(views.prices(spark, d), BENCHMARK), digits=5).select("ticker", "avg_ret_1d", "share_up_20d")


@query
def audit_join(spark, d):
    tasks = views.securities(spark, d).select(F.regexp_replace("security_id", "vendor:", "").alias("ticker"), "security_id")
    status = state.fold_transitions(views.transitions(spark, d), ["ticker"])
    return profile.audit(tasks, status, profile.coverage(views.prices(spark, d)))


@query
def audit_totals(spark, d):
    return profile.audit_totals(audit_join(spark, d), low=530)


@query
def expected_missing(spark, d):
    wanted = views.read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("ticker"))
    return profile.expected_missing(wanted, views.prices(spark, d))


@query
def window_audit(spark, d):
    return profile.window_audit(views.prices(spark, d).withColumn("year", F.year("date")), ["ticker", "year"])


@query
def single_window(spark, d):
    return profile.single_window(views.results(spark, d), ["source", "dataset_name", "requested_start_date"])


@query
def column_profile(spark, d):
    return profile.column_profile(views.results(spark, d), ["status", "row_count", "last_price_date"])


@query
def described(spark, d):
    return profile.describe(views.prices(spark, d))


@query
def sampled_rows(spark, d):
    """A sample of a relation, made of the sketches of two halves."""
    rows = views.results(spark, d).select("run_id", "ticker", "requested_start_date", "status", "row_count", "api_called", "seq")
    halves = [profile.sample_sketch(rows.where(F.col("seq") % 2 == i), 50) for i in (0, 1)]
    return profile.merge_sketches(*halves, 50)


@query
def wide_profile(spark, d):
    """A profile of twenty columns in one pass."""
    rows = views.prices(spark, d)
    return profile.column_profile(rows.withColumns({"half": F.col("volume") / 2, "maybe": F.when(F.col("volume") % 2 == 0, F.col("ticker"))}), [*PRICE_COLUMNS, "half", "maybe"])


@query
def block_frames(spark, d):
    """Frames of 20, 60 and 250 preceding rows by block aggregates."""
    wanted = {f"{f}_{c}_{n}": (f, c, n) for n in (20, 60, 250) for f, c in (("max", "adj_close"), ("min", "adj_close"), ("avg", "adj_volume"), ("count", "adj_close"), ("stddev_samp", "adj_volume"))}
    made = frames.preceding_frames(views.prices(spark, d).select("security_id", "date", "adj_close", "adj_volume"), wanted, by=["security_id"], order=["date"])
    return made.withColumns({c: F.round(c, 6) for c in wanted if c.startswith(("avg", "stddev"))})


@query
def latest_rows(spark, d):
    return profile.latest(views.prices(spark, d).select("date", "ticker", "close"), 25)


@query
def top_tickers(spark, d):
    return profile.top_tickers(views.prices(spark, d), 10)


@query
def missing_keys(spark, d):
    return reconcile.missing_keys(views.new_prices(spark, d), views.prices(spark, d), PRICE_KEY).select(*PRICE_KEY)


@query
def extra_keys(spark, d):
    return reconcile.extra_keys(views.new_prices(spark, d), views.prices(spark, d), PRICE_KEY).select(*PRICE_KEY)


@query
def mismatched_rows(spark, d):
    return reconcile.mismatched_rows(views.new_prices(spark, d), views.prices(spark, d), PRICE_KEY, ["close", "low", "load_id"])


@query
def key_differences(spark, d):
    return reconcile.key_differences(views.new_prices(spark, d), views.prices(spark, d), PRICE_KEY)


def _compared(spark, d) -> fingerprints.Comparison:
    columns = ["close", "low", "load_id"]
    return fingerprints.Comparison(views.new_prices(spark, d), views.prices(spark, d), PRICE_KEY, columns)


@query
def tree_missing_keys(spark, d):
    """Keys that a target lacks, by fingerprints and the exact join below unequal ones."""
    return _compared(spark, d).missing()


@query
def tree_extra_keys(spark, d):
    return _compared(spark, d).extra()


@query
def tree_mismatched_rows(spark, d):
    return _compared(spark, d).mismatched()


@query
def unequal_months(spark, d):
    """Months in which a table differs from itself with one month restated."""
    p = views.prices(spark, d)
    other = p.withColumn("close", F.when((F.year("date") == 1997) & (F.month("date") == 5), F.col("close") + 1).otherwise(F.col("close")))
    marks = [fingerprints.fingerprints(x, PRICE_KEY, ["close", "low", "volume"]) for x in (p, other)]
    return fingerprints.unequal_leaves(*marks).select("year", "month").distinct()


@query
def staging_check(spark, d):
    return reconcile.staging_check(views.new_prices(spark, d), MONTHS)


@query
def empty_window_review(spark, d):
    s = views.securities(spark, d).withColumn("ticker", F.regexp_replace("security_id", "vendor:", ""))
    r = views.results(spark, d).select("seq", "ticker", F.col("action").alias("status"))
    return reconcile.empty_window_review(r, s)


@query
def status_summary(spark, d):
    return reconcile.status_summary(views.results(spark, d))


@query
def compared_summaries(spark, d):
    r = views.results(spark, d)
    return reconcile.compare_summaries(reconcile.status_summary(r), reconcile.status_summary(r.where("seq % 6 <> 4")), ["status", "action"], ["windows", "api_calls"])


@query
def run_summary(spark, d):
    return reconcile.run_summary(views.results(spark, d)).withColumn("action_counts", F.to_json("action_counts"))


@query
def payload_check(spark, d):
    p = views.prices(spark, d)
    report = views.results(spark, d).select("ticker", F.col("action").alias("status"), F.when(F.col("seq") % 10 == 0, F.col("row_count")).alias("row_count"), F.col("requested_start_date").alias("request_start_date"), F.col("requested_end_date").alias("request_end_date"), "seq")
    return reconcile.payload_check(report, p.select("ticker", "date"), ["ticker"]).select("seq", "payload_rows", "problem")


def _files(spark, d) -> DataFrame:
    p = views.prices(spark, d)
    return p.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.count(F.lit(1)).alias("size")).withColumn("path", F.concat_ws("/", F.col("year").cast("string"), F.col("month").cast("string")))


@query
def inventory_diff(spark, d):
    files = _files(spark, d)
    there = files.where("month <> 5").withColumn("size", F.col("size") + F.when(F.col("month") == 7, 1).otherwise(0))
    return reconcile.inventory_diff(files.where("month <> 9"), there, ["year"])


@query
def download_plan(spark, d):
    tasks = views.results(spark, d).select("seq", F.concat_ws("/", F.year("requested_start_date").cast("string"), F.month("requested_start_date").cast("string")).alias("path"))
    return reconcile.download_plan(tasks, _files(spark, d).where("month <> 5"))


@query
def manifest_check(spark, d):
    base = views.prices(spark, d)
    made = merge.manifest(base, views.new_prices(spark, d)).select("year", "month", "final_row_count")
    return reconcile.manifest_check(made, merge.with_month(base))


@query
def end_to_end_gate(spark, d):
    files = _files(spark, d)
    sync = reconcile.inventory_diff(files, files.where("month <> 5"), ["year"])
    return reconcile.gate(sync, reconcile.key_differences(views.new_prices(spark, d), views.prices(spark, d), PRICE_KEY))


@query
def payload_round_trip(spark, d):
    """Prices as payload texts, read back by the parser and normalised."""
    p = views.prices(spark, d)
    record = F.to_json(F.struct(F.date_format("date", "yyyy-MM-dd'T'00:00:00.000'Z'").alias("date"), "open", "high", "low", "close", "volume", F.col("adj_close").alias("adjClose")))
    files = p.groupBy("ticker", F.year("date").alias("y")).agg(F.array_join(F.array_sort(F.collect_list(record)), ",").alias("all"))
    value = F.when(F.col("y") % 2 == 0, F.concat(F.lit("["), "all", F.lit("]"))).otherwise(F.concat(F.lit('{"records":['), "all", F.lit("]}")))
    files = files.select(F.concat(F.lit("/raw/source=vendor/dataset=daily/symbol="), "ticker", F.lit("/request_start="), F.col("y").cast("string"), F.lit("-01-01/prices.json")).alias("file"), value.alias("value"))
    rows = readers.explode_payloads(files).select("file", "seq", "fields", "file_keys", F.col("symbol").alias("ticker"), F.concat(F.lit("S:"), "symbol").alias("security_id"), "source", F.lit("load-1").alias("load_id"), F.lit("2026-01-01 00:00:00").cast("timestamp").alias("loaded_at"))
    return normalize.normalise_prices(rows).select(*PRICE_COLUMNS)


@query
def stored_ranges(spark, d):
    """Rows in half-open date ranges of a stored table, by pruned months."""
    root = f"{shared_folder(spark)}/table"
    writers.write_months(views.prices(spark, d), root)
    return readers.price_ranges(spark, root, MONTHS).select(*PRICE_KEY, "year", "month", "close")


@query
def stored_months(spark, d):
    """Chosen months of a stored table in one pruned scan."""
    root = f"{shared_folder(spark)}/table"
    writers.write_months(views.prices(spark, d), root)
    return readers.price_months(spark, root, [(1999, 3), (2000, 1), (2050, 1)])


@query
def file_order(spark, d):
    """Of each month of a stored table: rows, and rows that stand before a lesser one of their file."""
    root = f"{shared_folder(spark)}/table"
    writers.write_months(views.prices(spark, d), root)
    rows = spark.read.parquet(root)
    # A file of a month is known by its task and its number in the task's names; whole paths would be most of what is sorted.
    number = lambda pattern: F.regexp_extract("_metadata.file_name", pattern, 1).cast("int")
    rows = rows.select("year", "month", "ticker", "date", number(r"^part-(\d+)-").alias("task"), number(r"\.c(\d+)\.").alias("file"), F.col("_metadata.row_index").alias("place"))
    following = F.lead(F.struct("ticker", "date")).over(Window.partitionBy("year", "month", "task", "file").orderBy("place"))
    rows = rows.withColumn("wrong", F.coalesce(F.struct("ticker", "date") > following, F.lit(False)))
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("wrong").alias("out_of_order"))


@query
def summary_file(spark, d):
    """A run's summary as a JSON file, read back."""
    path = f"{shared_folder(spark)}/summary"
    writers.write_summary(reconcile.run_summary(views.results(spark, d)).drop("action_counts"), path)
    return spark.read.json(path)


@query
def described_view(spark, d):
    """A view by its listed name: columns, types and rows."""
    name = f"market_view_{uuid.uuid4().hex}"
    views.results(spark, d).createOrReplaceTempView(name)
    try:
        (listed,) = readers.tables(spark, name[:-1] + "*").collect()
        return kept(readers.described(spark, listed.name).withColumn("temporary", F.lit(listed.temporary)))
    finally:
        spark.catalog.dropTempView(name)


@query
def saved_contract(spark, d):
    """The contract of a saved price table, and of one whose buckets it does not have."""
    with saved_tables(spark, "prices") as (name,):
        writers.save_bucketed(views.prices(spark, d), name, buckets=2)
        columns = [*PRICE_COLUMNS, "year", "month"]
        wanted = (["security_id"], ["ticker"])
        checks = [table_contract(spark, name, partitions=["year", "month"], buckets=b, columns=columns) for b in wanted]
        n_rows = spark.table(name).count()
        return kept(checks[0].unionByName(checks[1]).select("rule", "passed", F.lit(n_rows).cast("long").alias("n_rows")))


@query
def market_times(spark, d):
    """Instants as the clock of an exchange shows them."""
    at = F.col("ts").cast("timestamp")
    return views.read(spark, d, "events").select("event_id", scalars.market_time(at, "America/New_York").alias("local_time"), F.to_date(scalars.market_time(at, "America/New_York")).alias("local_date"))


@query
def complete_rows(spark, d):
    """Payload rows with a null in a key column dropped."""
    p = views.prices(spark, d)
    fields = F.map_filter(F.create_map(F.lit("date"), F.col("date").cast("string"), F.lit("open"), F.col("open").cast("string"), F.lit("high"), F.col("high").cast("string"), F.lit("low"), F.when(F.col("volume") % 7 != 0, F.col("low")).cast("string"), F.lit("close"), F.when(F.col("volume") % 5 != 0, F.col("close")).cast("string"), F.lit("volume"), F.col("volume").cast("string")), lambda k, v: v.isNotNull())
    rows = p.select(F.col("ticker").alias("file"), F.lit(0).alias("seq"), fields.alias("fields"), "ticker", F.when(F.col("volume") % 11 != 0, F.col("security_id")).alias("security_id"), "source", "load_id", "loaded_at")
    return normalize.normalise_prices(rows, on_null="drop").select(*PRICE_KEY, "open", "high", "low", "close", "volume")


@query
def stored_files(spark, d):
    """Months by the inventory of a stored table's files, rows by their footers."""
    root = f"{shared_folder(spark)}/table"
    writers.write_months(views.prices(spark, d), root)
    months = readers.inventory(spark, root).select("year", "month").distinct().agg(F.count(F.lit(1)).alias("n_months"), F.lit(1).alias("one_"))
    rows = readers.file_rows(spark, root).agg(F.sum("n_rows").alias("n_rows"), F.lit(1).alias("one_"))
    return months.join(rows, "one_").drop("one_")


@query
def csv_round_trip(spark, d):
    """Securities as a CSV report, read back as text with dates and flags typed."""
    path = f"{shared_folder(spark)}/securities"
    writers.write_report(views.securities(spark, d), path)
    return readers.csv(spark, path, types={"start_date": "date", "end_date": "date", "is_active": "boolean"})


@query
def stored_state(spark, d):
    """Failed windows of a stored state table."""
    path, rows = f"{shared_folder(spark)}/state", views.results(spark, d).select(*WINDOW_KEY, "status", "attempt_count", "error_message", "seq")
    writers.write_table(rows, path)
    return readers.state(spark, path, rows.schema, F.col("status") == "failed")


@query
def rebuilt_table(spark, d):
    """A live table rebuilt with a later load, checked, archived and switched; its months and the archive's."""
    root = shared_folder(spark)
    live, archive = f"{root}/live", f"{root}/archive/before"
    writers.write_months(views.prices(spark, d), live)
    whole = dedup.combine([readers.prices(spark, live).drop("year", "month"), views.new_prices(spark, d)])
    writers.rebuild(spark, whole, f"{root}/new", lambda table: quality.demand(quality.validate_prices(table)))
    writers.switch(spark, f"{root}/new", live, archive)
    before = writers.month_counts(spark, archive).withColumnRenamed("n_rows", "archived_rows")
    return writers.month_counts(spark, live).join(before, ["year", "month"], "left")


@query
def landed_payloads(spark, d):
    """A payload file per ticker under the layout of landed files, scanned and normalised."""
    root = f"{shared_folder(spark)}/raw"
    p = views.prices(spark, d)
    record = F.to_json(F.struct(F.date_format("date", "yyyy-MM-dd'T'00:00:00.000'Z'").alias("date"), "open", "high", "low", "close", "volume"))
    files = p.groupBy("ticker").agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(record)), ","), F.lit("]")).alias("value"))
    folders = {"source": "vendor", "dataset": "daily", "request_start": "1992-01-01", "request_end": "1998-12-31"}
    files = files.withColumnRenamed("ticker", "symbol").withColumns({k: F.lit(v) for k, v in folders.items()})
    files.write.partitionBy(*readers.PATH_KEYS).text(root)
    rows = readers.json_payloads(spark, root, pattern="*.txt").select("file", "seq", "fields", "file_keys", F.col("symbol").alias("ticker"), F.concat(F.lit("S:"), "symbol").alias("security_id"), "source", F.lit("load-1").alias("load_id"), F.lit("2026-01-01 00:00:00").cast("timestamp").alias("loaded_at"))
    return normalize.normalise_prices(rows).select(*PRICE_KEY, "source", "open", "high", "low", "close", "volume")


@query
def warehouse_months(spark, d):
    """A saved table, partitioned and bucketed; a staging table with its columns replaces the months that a load touches."""
    with saved_tables(spark, "prices", "staging") as (name, staging_name):
        writers.save_bucketed(views.prices(spark, d), name, buckets=8)
        merged = merge.merge_windows(spark.table(name), views.new_prices(spark, d))
        writers.stage_table(merged, name, staging_name)
        writers.replace_months(spark.table(staging_name), name)
        return kept(spark.table(name).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("close").alias("sum_close")))


@query
def bucketed_returns(spark, d):
    """Returns on a saved table whose buckets hold whole series: the window needs no exchange."""
    with saved_tables(spark, "prices") as (name,):
        writers.save_bucketed(views.prices(spark, d), name, buckets=8)
        return kept(features.returns(spark.table(name)).select("security_id", "date", "ret_1d", "ret_20d", "ret_120d"))


@query
def bucketed_files(spark, d):
    """Rows of each month of a saved table, and whether it has no more files than buckets."""
    with saved_tables(spark, "prices") as (name,):
        writers.save_bucketed(views.prices(spark, d), name, buckets=4)
        files = spark.table(name).groupBy("year", "month", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
        return kept(files.groupBy("year", "month").agg(F.sum("n_rows").alias("n_rows"), (F.count(F.lit(1)) <= 4).alias("bounded")))


@query
def materialised_models(spark, d):
    """Returns as a saved table on a view of the staging model; read back by SQL."""
    sql = "SELECT s.security_id, count(*) AS n_rows, count(r.ret_120d) AS n_returns FROM {s} AS s JOIN {r} AS r ON s.security_id = r.security_id AND s.date = r.date GROUP BY s.security_id"
    with saved_tables(spark, "staging", "returns") as (staging_name, returns_name):
        writers.materialise({staging_name: cast_to(views.prices(spark, d))}, views={staging_name})
        try:
            writers.materialise({returns_name: features.returns(spark.table(staging_name))}, views=set())
            return kept(readers.run_sql(spark, sql, {"s": spark.table(staging_name), "r": spark.table(returns_name)}))
        finally:
            spark.catalog.dropTempView(staging_name)


class _Stopped(BaseException):
    """Stands for a driver that dies."""


@query
def replayed_batches(spark, d):
    """Two batches merged into a stored table; the first is stopped before its count and replayed, the second comes twice."""
    root = shared_folder(spark)
    table, work = f"{root}/table", f"{root}/work"
    writers.write_months(views.prices(spark, d), table)
    new = views.new_prices(spark, d)

    def stop(step: str) -> None:
        if step == "replaced":
            raise _Stopped

    first = new.where(F.month("date") != 2)
    second = new.where(F.month("date") >= 2).withColumns({"close": F.col("close") + 1, "load_id": F.lit("load-3"), "loaded_at": F.lit("2026-03-01 00:00:00").cast("timestamp")})
    try:
        ingest.apply_batch(spark, first, table, work, 0, after=stop)
    except _Stopped:
        ingest.apply_batch(spark, first, table, work, 0)
    for _ in range(2):
        ingest.apply_batch(spark, second, table, work, 1)
    return readers.prices(spark, table).groupBy("year", "month", "load_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("close").alias("sum_close"))


@query
def staged_promotion(spark, d):
    """Write months, stage a merge, promote it, and read the months back."""
    root = shared_folder(spark)
    base, new = views.prices(spark, d), kept(views.new_prices(spark, d))  # new is read by each step
    writers.write_months(base, f"{root}/table")
    stored = readers.prices(spark, f"{root}/table")
    made = merge.manifest(stored, new)
    writers.stage(spark, merge.merge_windows(stored, new), made, f"{root}/staging")
    writers.promote(spark, f"{root}/staging", f"{root}/table", f"{root}/archive")  # by the manifest that was staged
    return writers.month_counts(spark, f"{root}/table").join(readers.prices(spark, f"{root}/table").groupBy("year", "month").agg(F.sum("close").alias("sum_close")), ["year", "month"])

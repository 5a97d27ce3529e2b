"""Candidate universe and backfill task lists."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import any_literal, any_pattern, composite_id, null_like, ticker_of
from .dedup import first_by_key, latest_rows

#: Ticker endings of rights, warrants, units and preferred shares: fixed values.
TICKER_PATTERNS = ["-R$", "-RT$", "-WS$", "-W$", "-WT$", "-U$", "-UN$", "-P-[A-Z]$", "-P[A-Z]$", "^[A-Z]{4}U$", "^[A-Z]{4}W$", "^[A-Z]{4}R$", "^[A-Z]{3,5}WS$", "^[A-Z]{3,5}WT$", "^[A-Z]{3,5}WW$", "/"]
#: What the audit of a finished backfill looks for, a part of the endings above: fixed values.
AUDIT_PATTERNS = ["-R$", "-RT$", "-WS$", "-W$", "-WT$", "-U$", "-UN$", "-P-[A-Z]$", "-P[A-Z]$"]
#: Words in company names that are no common stock: fixed values.
NAME_WORDS = ["ETF", "ETN", "Fund", "Trust", "Warrant", "Unit", "Right", "Preferred", "Notes", "Bond"]


@dataclass(frozen=True)
class Filters:
    """What a candidate must be; today stands for the end of the requested window."""

    window_start: datetime.date
    today: datetime.date
    asset_types: list[str] = field(default_factory=lambda: ["Stock"])
    currencies: list[str] = field(default_factory=lambda: ["USD"])
    exchanges: list[str] = field(default_factory=lambda: ["NASDAQ", "NYSE", "NYSE ARCA", "NYSE MKT"])
    no_hyphen: bool = True
    ticker_patterns: list[str] = field(default_factory=lambda: TICKER_PATTERNS)
    name_words: list[str] = field(default_factory=lambda: NAME_WORDS)


def filter_steps(f: Filters) -> dict[str, Column]:
    """The chain's conditions by name, in order; each is true or false, never null."""

    def known(c: str, values: list[str]) -> Column:
        return F.coalesce(F.upper(c).isin([v.upper() for v in values]), F.lit(False))

    required = [F.col(c).isNotNull() for c in ("security_id", "ticker", "exchange", "asset_type", "price_currency")]
    every = required[0]
    for c in required[1:]:
        every = every & c
    return {
        "required_fields": every & (F.col("ticker") != ""),
        "asset_type": known("asset_type", f.asset_types),
        "currency": known("price_currency", f.currencies),
        "exchange": known("exchange", f.exchanges),
        "start_date": F.coalesce(F.col("start_date") <= F.lit(f.today), F.lit(False)),
        "end_date": F.coalesce(F.col("end_date") >= F.lit(f.window_start), F.lit(False)),
        "no_hyphen": ~F.col("ticker").contains("-") if f.no_hyphen else F.lit(True),
        "ticker_pattern": ~any_pattern(F.upper("ticker"), f.ticker_patterns),
        "name_words": ~any_literal(F.col("company_name"), f.name_words),
    }


def _prepared(securities: DataFrame) -> DataFrame:
    text = ["security_id", "exchange", "asset_type", "price_currency", "company_name"]
    return securities.withColumns({c: null_like(F.col(c)) for c in text} | {"ticker": ticker_of(null_like(F.col("ticker")))})


#: Why a security is in a pool: a fixed value.
CANDIDATE_REASON = "asset_type_in_config;currency_in_config;major_us_exchange;overlaps_requested_backfill_window;hyphen_ticker_excluded;ticker_pattern_not_excluded"


def candidate_pool(securities: DataFrame, filters: Filters, *, name: str = "candidates", loaded_at: Column | None = None) -> DataFrame:
    """Securities that pass every step, one row per security_id: of several, the first in order of the other columns.

    loaded_at: without it, the time of the query.
    """
    rows = _prepared(securities)
    for condition in filter_steps(filters).values():
        rows = rows.where(condition)
    order = [F.col(c).asc_nulls_last() for c in rows.columns if c != "security_id"]
    kept = latest_rows(rows, ["security_id"], order)
    return kept.withColumns({"candidate_pool_name": F.lit(name), "candidate_reason": F.lit(CANDIDATE_REASON), "loaded_at": F.current_timestamp() if loaded_at is None else loaded_at})


def demand_candidates(pool: DataFrame) -> None:
    """Raise if a pool is empty."""
    if pool.isEmpty():
        raise ValueError("the candidate pool is empty")


def filter_funnel(securities: DataFrame, filters: Filters) -> DataFrame:
    """(place, step, survivors): how many rows are left after each step, in one pass."""
    steps = filter_steps(filters)
    passed, sums = F.lit(True), []
    for n, condition in steps.items():
        passed = passed & F.coalesce(condition, F.lit(False))
        sums.append(F.count_if(passed).alias(n))
    counts = _prepared(securities).agg(F.count(F.lit(1)).alias("all_rows"), *sums)
    cells = [F.struct(F.lit(i).alias("place"), F.lit(n).alias("step"), F.col(n).alias("survivors")) for i, n in enumerate(["all_rows", *steps])]
    return counts.select(F.inline(F.array(*cells)))


def suspicious_tickers(symbols: DataFrame, patterns: list[str] = AUDIT_PATTERNS) -> DataFrame:
    return symbols.where(any_pattern(F.upper("ticker"), patterns)).withColumn("suspicious_reason", F.lit("matches_special_security_ticker_pattern"))


def sample_universe(pool: DataFrame, *, limit: int, forced: list[str]) -> DataFrame:
    """A fixed sample: forced tickers first, then the least md5 of the ticker, cut at limit."""
    rows = first_by_key(pool, ["security_id"]).withColumn("forced_", F.col("ticker").isin(forced))
    return rows.orderBy(F.desc("forced_"), F.when(~F.col("forced_"), F.md5("ticker")).asc_nulls_first(), "ticker", "security_id").limit(limit).drop("forced_")


def task_list(universe: DataFrame, *, name: str, source: str, dataset: str, start: datetime.date, end: datetime.date, priority: int = 100) -> DataFrame:
    """One pending task per security with a window that stays as given."""
    fixed = [F.lit(name), F.lit(source), F.lit(dataset)]
    window = [F.lit(start), F.lit(end)]
    tasks = universe.select(
        composite_id(*fixed, F.col("ticker"), *[w.cast("string") for w in window]).alias("task_id"),
        fixed[0].alias("task_list_name"),
        fixed[1].alias("source"),
        fixed[2].alias("dataset_name"),
        "security_id",
        "ticker",
        window[0].alias("requested_start_date"),
        window[1].alias("requested_end_date"),
        F.lit(priority).alias("priority"),
        F.lit("pending").alias("status"),
    )
    return first_by_key(tasks, ["task_id"])


def select_tasks(tasks: DataFrame, *, tickers: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Tasks of the requested tickers (unknown ones are an error), in order, cut at limit."""
    if tickers:
        spark = tasks.sparkSession
        asked = spark.createDataFrame([(t.strip().upper(),) for t in tickers], "ticker string").distinct()
        unknown = [r.ticker for r in asked.join(tasks, "ticker", "left_anti").orderBy("ticker").collect()]
        if unknown:
            raise ValueError(f"unknown tickers: {unknown}")
        tasks = tasks.join(F.broadcast(asked), "ticker", "left_semi")
    return tasks.orderBy("ticker", "security_id").limit(limit) if limit is not None else tasks

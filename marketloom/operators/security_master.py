"""From vendor listings to one canonical row per ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import null_like, ticker_of

LISTING = ["ticker", "exchange", "asset_type", "price_currency"]
#: Order of preference: fixed values.
ASSET_PRIORITY = {"Stock": 1, "ETF": 2, "Mutual Fund": 3}
EXCHANGE_PRIORITY = {"NASDAQ": 1, "NYSE": 2, "NYSE ARCA": 3, "NYSE MKT": 4, "AMEX": 5}


#: Names that a listing file may use for a column, best first: fixed values.
LISTING_NAMES = {
    "ticker": ["ticker", "symbol"],
    "exchange": ["exchange"],
    "asset_type": ["assetType", "asset_type"],
    "price_currency": ["priceCurrency", "price_currency"],
    "start_date": ["startDate", "start_date"],
    "end_date": ["endDate", "end_date"],
}


def _named(raw: DataFrame, column: str) -> Column:
    """The first of a column's names that the file has; case counts, as files of either spelling may hold both."""
    names = LISTING_NAMES[column]
    for name in names:
        if name in raw.columns:
            return null_like(F.col(f"`{name}`").cast("string"))
    raise ValueError(f"a listing file must have one of {names}; it has {raw.columns}")


def normalise_listings(raw: DataFrame) -> DataFrame:
    """A vendor's ticker list as text, typed, without rows that lack a ticker.

    Tickers, exchanges and currencies are in capitals, so that rank_listings() knows them however
    a file writes them; asset types stay. Dates that do not parse are null. A file has no
    company names.
    """
    ticker = ticker_of(_named(raw, "ticker"))
    rows = raw.select(
        ticker.alias("source_ticker"),
        ticker.alias("ticker"),
        F.upper(_named(raw, "exchange")).alias("exchange"),
        _named(raw, "asset_type").alias("asset_type"),
        F.upper(_named(raw, "price_currency")).alias("price_currency"),
        _named(raw, "start_date").try_cast("date").alias("start_date"),
        _named(raw, "end_date").try_cast("date").alias("end_date"),
        ticker.alias("source_raw_symbol"),
        F.lit(None).cast("string").alias("company_name"),
    )
    return rows.where(F.col("ticker").isNotNull())


def collapse_listings(listings: DataFrame) -> DataFrame:
    """Rows of the same listing (nulls are a value) as one: earliest start, latest end, number of rows."""
    return listings.groupBy(*LISTING).agg(
        F.min("source_ticker").alias("source_ticker"),
        F.min("start_date").alias("start_date"),
        F.max("end_date").alias("end_date"),
        F.count(F.lit(1)).alias("raw_listing_row_count"),
    )


def _priority(column: str, table: dict[str, int], fallback: int):
    out = F.lit(fallback)
    for value, place in table.items():
        out = F.when(F.col(column) == value, place).otherwise(out)
    return out


def rank_listings(listings: DataFrame, *, asset_priority: dict[str, int] = ASSET_PRIORITY, exchange_priority: dict[str, int] = EXCHANGE_PRIORITY, currency: str = "USD") -> DataFrame:
    """canonical_rank and ticker_duplicate_count of every listing: ten keys, then the listing's own columns."""
    venue = _priority("exchange", exchange_priority, 99)
    start, end = F.col("start_date"), F.col("end_date")
    order = [
        _priority("asset_type", asset_priority, 99),
        F.coalesce(F.col("price_currency") == currency, F.lit(False)).desc(),
        (venue < 99).desc(),
        venue,
        (start.isNotNull() & end.isNotNull()).desc(),
        end.isNotNull().desc(),
        end.desc_nulls_last(),
        F.coalesce(F.datediff(end, start), F.lit(-1)).desc(),
        start.asc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in LISTING[1:]],
    ]
    own = Window.partitionBy("ticker")
    return listings.withColumns({"canonical_rank": F.row_number().over(own.orderBy(*order)).cast("int"), "ticker_duplicate_count": F.count(F.lit(1)).over(own)})


def canonical_listings(ranked: DataFrame) -> DataFrame:
    return ranked.where("canonical_rank = 1")


def duplicate_report(ranked: DataFrame) -> DataFrame:
    """All listings of tickers that have more than one."""
    return ranked.where("ticker_duplicate_count > 1")


def latest_end_date(listings: DataFrame) -> DataFrame:
    """One row: the latest end date; demand it with first()."""
    return listings.agg(F.max("end_date").alias("latest_end_date"))


def demand_end_date(listings: DataFrame) -> None:
    """Raise if no listing has an end date, from which activity is told."""
    if latest_end_date(listings).first()["latest_end_date"] is None:
        raise ValueError("no listing has an end date")


def dim_security(canonical: DataFrame, *, source: str, grace_days: int = 7, loaded_at: Column | None = None) -> DataFrame:
    """The dimension: security_id, and is_active if the end date is within grace_days of the latest one.

    company_name is null where the listings have none; loaded_at: without it, the time of the query.
    """
    name = F.col("company_name") if "company_name" in canonical.columns else F.lit(None)
    cutoff = F.date_sub(F.max("latest_end_date"), grace_days)
    latest = latest_end_date(canonical).agg(cutoff.alias("cutoff")).withColumn("one_", F.lit(1))  # one row
    return canonical.withColumn("one_", F.lit(1)).join(F.broadcast(latest), "one_").select(
        F.concat(F.lit(f"{source}:"), "ticker").alias("security_id"),
        F.lit(source).alias("source"),
        "source_ticker",
        "ticker",
        "exchange",
        "asset_type",
        "price_currency",
        "start_date",
        "end_date",
        F.coalesce(F.col("end_date") >= F.col("cutoff"), F.lit(False)).alias("is_active"),
        name.cast("string").alias("company_name"),
        F.col("source_ticker").alias("source_raw_symbol"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at"),
    )

"""Raw vendor payloads to the canonical price table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import parse_instant, ticker_of
from ..schemas import PRICE_COLUMNS

#: Names that a payload may use for a column, best first: fixed values.
ALIASES = {
    "adj_open": ["adjOpen", "adj_open"],
    "adj_high": ["adjHigh", "adj_high"],
    "adj_low": ["adjLow", "adj_low"],
    "adj_close": ["adjClose", "adj_close"],
    "adj_volume": ["adjVolume", "adj_volume"],
    "div_cash": ["divCash", "div_cash"],
    "split_factor": ["splitFactor", "split_factor"],
}
PLAIN = ["open", "high", "low", "close", "volume"]


#: All names that are looked up as numbers.
NAMES = [*PLAIN, *[n for names in ALIASES.values() for n in names]]


def _numbers(fields: Column) -> Column:
    """A row's values under the names. One small function goes over them: written out for each column, a row's code is too long for the JVM to compile."""
    return F.transform(F.array(*map(F.lit, NAMES)), lambda n: F.try_element_at(fields, n).try_cast("double"))


def _of(name: str) -> Column:
    return F.col("numbers_")[NAMES.index(name)]


def _by_file(names: list[str]) -> Column:
    """The value under the first name that any row of the file has."""
    out = F.lit(None).cast("double")
    for n in reversed(names):
        out = F.when(F.array_contains("file_keys", n), _of(n)).otherwise(out)
    return out


def normalise_prices(rows: DataFrame, *, file_columns: tuple[str, ...] = ("file",), on_null: str = "keep") -> DataFrame:
    """Canonical rows and input_seq from exploded payload rows.

    rows: file (or other file_columns), seq, fields (map of texts), ticker, security_id, source,
    load_id, loaded_at, and file_keys, as explode_payloads() gives it (without it, all names of a
    file are gathered by a shuffle). Aliases are chosen by file, not by row; a volume column that the file
    lacks means 0, a null volume stays null; adjusted values fall back to raw ones, dividends
    to 0 and the split factor to 1. on_null='drop' drops rows with nulls in key columns.
    """
    if "file_keys" not in rows.columns:
        keys = F.collect_set(F.map_keys("fields")).over(Window.partitionBy(*file_columns))
        rows = rows.withColumn("file_keys", F.array_distinct(F.flatten(keys)))
    f = F.col("fields")
    rows = rows.withColumn("numbers_", _numbers(f))
    raw = {c: _of(c) for c in PLAIN}
    raw["volume"] = F.when(F.array_contains("file_keys", "volume"), raw["volume"]).otherwise(F.lit(0.0))
    adj = {c: F.coalesce(_by_file(names), raw[c[4:]]) for c, names in ALIASES.items() if c.startswith("adj_")}
    made = rows.select(
        "security_id",
        ticker_of(F.col("ticker")).alias("ticker"),
        F.to_date(parse_instant(F.try_element_at(f, F.lit("date")))).alias("date"),
        *[raw[c].alias(c) for c in PLAIN],
        *[v.alias(c) for c, v in adj.items()],
        F.coalesce(_by_file(ALIASES["div_cash"]), F.lit(0.0)).alias("div_cash"),
        F.coalesce(_by_file(ALIASES["split_factor"]), F.lit(1.0)).alias("split_factor"),
        "source",
        "load_id",
        F.col("loaded_at").cast("timestamp").alias("loaded_at"),
        F.col("seq").alias("input_seq"),
    )
    whole = {c: F.when(F.col(c) % 1 == 0, F.col(c)).cast("long") for c in ("volume", "adj_volume")}
    bad = [F.coalesce(F.col(c) % 1 != 0, F.lit(False)) for c in whole]
    made = made.withColumn("non_integral", bad[0] | bad[1]).withColumns(whole)
    made = made.select(*PRICE_COLUMNS, "input_seq", "non_integral")
    return made.dropna(subset=["security_id", "ticker", "date", "open", "high", "low", "close"]) if on_null == "drop" else made

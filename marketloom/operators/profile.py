"""Summaries, coverage and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_text(df: DataFrame, column: str) -> Column:
    """A value as text, one text for each value that counts as distinct."""
    value, kind = F.col(f"`{column}`"), dict(df.dtypes)[column]
    if kind in ("double", "float"):
        return (value + F.lit(0.0).cast(kind)).cast("string")  # 0 and -0 are one value
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp")).cast("string")
    if kind == "binary":
        return F.hex(value)
    return value.cast("string") if not kind.startswith(("array", "struct", "map")) else F.to_json(value, {"ignoreNullFields": "false"})


def value_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(place, value, n_rows): how often each value of each column occurs, null included.

    A row becomes a narrow pair per column, which is counted before the shuffle; counting distinct
    values of k columns by one aggregation each would copy every row k times over, all k columns
    wide.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("place"), _as_text(df, c).alias("value")) for i, c in enumerate(columns)])
    return df.select(F.inline(pairs)).groupBy("place", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the exact number of distinct values of each column, nulls left out, under its own name."""
    found = value_pairs(df, columns)
    return found.agg(*[F.count_if((F.col("place") == i) & F.col("value").isNotNull()).alias(c) for i, c in enumerate(columns)])


def table_summary(df: DataFrame) -> DataFrame:
    """Rows, tickers, securities and date span. The two distinct counts are taken over the pairs of both, which are few."""
    keys = df.groupBy("ticker", "security_id").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("a"), F.max("date").alias("b"))
    return keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.countDistinct("ticker").alias("n_tickers"),
        F.countDistinct("security_id").alias("n_securities"),
        F.min("a").alias("min_date"),
        F.max("b").alias("max_date"),
    )


def coverage(prices: DataFrame, conditions: dict[str, Column] | None = None) -> DataFrame:
    """Per ticker: rows, date span, and rows that meet each condition."""
    made = conditions or {"zero_volume_rows": F.col("volume") == 0, "dividend_rows": F.col("div_cash") != 0, "split_rows": F.col("split_factor") != 1}
    return prices.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("min_date"), F.max("date").alias("max_date"), *[F.count_if(c).alias(n) for n, c in made.items()])


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), F.col("value").asc_nulls_last()).limit(n) if n is not None else counts


def ticker_prices(prices: DataFrame, digits: int = 2) -> DataFrame:
    return prices.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("close"), digits).alias("avg_close"), F.round(F.max("close"), digits).alias("max_close"), F.round(F.min("close"), digits).alias("min_close"))


def panel_summary(panel: DataFrame, digits: int = 6) -> DataFrame:
    return panel.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count("fwd_ret_20d").alias("labelled_rows"),
        F.round(F.avg("ret_1d"), digits).alias("avg_ret_1d"),
        F.round(F.avg("label_direction_20d"), digits).alias("share_up_20d"),
    )


def audit(tasks: DataFrame, status: DataFrame, covered: DataFrame) -> DataFrame:
    """Tasks with their status and price coverage; tickers without rows have 0."""
    rows = tasks.select("ticker", "security_id").join(status.select("ticker", "status", "attempt_count"), "ticker", "left")
    return rows.join(covered.select("ticker", "n_rows", "min_date", "max_date"), "ticker", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def audit_totals(audited: DataFrame, low: int) -> DataFrame:
    return audited.agg(
        F.count(F.lit(1)).alias("tasks"),
        F.count_if(F.col("status") == "success").alias("successes"),
        F.count_if(F.col("status").isin("failed", "skipped")).alias("failed_or_skipped"),
        F.count_if(F.col("status").isNull()).alias("without_status"),
        F.count_if(F.col("n_rows") < low).alias("low_coverage"),
    )


def expected_missing(expected: DataFrame, prices: DataFrame) -> DataFrame:
    """Expected tickers that the data lack."""
    return expected.select("ticker").distinct().join(prices.select("ticker").distinct(), "ticker", "left_anti")


def window_audit(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_price_date"), F.max("date").alias("last_price_date"))


def single_window(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: distinct values of each column, and whether all are one."""
    return distinct_counts(df, columns).withColumn("single", reduce(lambda a, b: a & b, [F.col(c) == 1 for c in columns]))


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_rows, missing_ratio, n_distinct) in one pass, whatever the number of columns; of an empty table the ratio is null."""
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "place int, column string")
    counts = value_pairs(df, columns).groupBy("place").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n_rows")).otherwise(0)).alias("missing"),
        F.count("value").alias("n_distinct"),
    )
    rows = F.coalesce("n_rows", F.lit(0))
    return names.join(counts, "place", "left").select("column", rows.alias("n_rows"), F.try_divide("missing", "n_rows").alias("missing_ratio"), F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))


def describe(df: DataFrame) -> DataFrame:
    """(place, column, type, n_rows) of any relation."""
    cells = [F.struct(F.lit(i).alias("place"), F.lit(n).alias("column"), F.lit(t).alias("type"), F.col("n_rows")) for i, (n, t) in enumerate(df.dtypes)]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(F.array(*cells)))


SAMPLE_HASH = "sample_hash"


def row_text(df: DataFrame) -> Column:
    """A row as text, from all of its columns in order; null is told from an empty text."""
    return F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), _as_text(df, c)), F.lit("~")) for c in df.columns])


def sample_sketch(df: DataFrame, n: int) -> DataFrame:
    """n rows of any relation with sample_hash, those of least md5 of their content: a sample that reruns alike.

    Each task keeps its n least rows and only these move (no sort of the table). Equal rows have
    one hash, so of them either all or as many as fit are in; ties are equal rows, so it does not
    matter which.
    """
    return df.withColumn(SAMPLE_HASH, F.md5(row_text(df))).orderBy(SAMPLE_HASH).limit(n)


def merge_sketches(a: DataFrame, b: DataFrame, n: int) -> DataFrame:
    """The sketch of both tables from the sketches of each (of n rows at least)."""
    return a.unionByName(b).orderBy(SAMPLE_HASH).limit(n)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    return sample_sketch(df, n).drop(SAMPLE_HASH)


def latest(df: DataFrame, n: int) -> DataFrame:
    """The newest n rows by date, then ticker."""
    return df.orderBy(F.desc("date"), "ticker").limit(n)


def top_tickers(prices: DataFrame, n: int) -> DataFrame:
    return prices.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), "ticker").limit(n)

"""Returns, lagged rolling features, forward labels and the research panel.

Every window is by security in order of date, so the chain needs one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import guarded_ratio, weekday
from .frames import preceding_frames

RETURN_ROWS = (1, 2, 5, 10, 20, 60, 120)
FORWARD_ROWS = (1, 5, 20)
RETURN_INPUTS = ["security_id", "ticker", "date", "adj_close", "adj_volume", "volume", "div_cash", "split_factor"]
#: Frames of the rows before the current one: (function, column, rows).
ROLLED = {
    "avg_dollar_volume_20d_lagged": ("avg", "dollar_volume", 20),
    "avg_dollar_volume_60d_lagged": ("avg", "dollar_volume", 60),
    "std_dollar_volume": ("stddev_samp", "dollar_volume", 20),
    "avg_volume_20d_lagged": ("avg", "adj_volume", 20),
    "std_volume": ("stddev_samp", "adj_volume", 20),
    "volatility_20d_lagged": ("stddev_samp", "ret_1d", 20),
    "volatility_60d_lagged": ("stddev_samp", "ret_1d", 60),
    "max_ret_20d_lagged": ("max", "ret_1d", 20),
    "min_ret_20d_lagged": ("min", "ret_1d", 20),
    "high_20d": ("max", "adj_close", 20),
    "low_20d": ("min", "adj_close", 20),
    "high_60d": ("max", "adj_close", 60),
    "low_60d": ("min", "adj_close", 60),
}


def _by_date():
    return Window.partitionBy("security_id").orderBy("date")


def returns(prices: DataFrame) -> DataFrame:
    """Returns over 1 to 120 rows; null at the start of a series and after a zero price."""
    close = F.col("adj_close")
    return prices.select(*RETURN_INPUTS, *[(guarded_ratio(close, F.lag(close, n).over(_by_date())) - 1).alias(f"ret_{n}d") for n in RETURN_ROWS])


def _zscore(x: str, mean: str, spread: Column) -> Column:
    return guarded_ratio(F.col(x) - F.col(mean), spread)


def features(returned: DataFrame) -> DataFrame:
    """Lagged returns, liquidity, volatility and price position; the current row is in no frame."""
    dollars = F.col("adj_close") * F.col("adj_volume")
    base = returned.withColumns({"dollar_volume": dollars, "log_dollar_volume": F.ln(1 + dollars)})
    # Spark's own frames would go over all 20 or 60 rows again for each row.
    rolled = preceding_frames(base, ROLLED, by=["security_id"], order=["date"]).withColumns(
        {
            "ret_1d_lag1": F.lag("ret_1d", 1).over(_by_date()),
            "ret_1d_lag2": F.lag("ret_1d", 2).over(_by_date()),
            "ret_5d_lag1": F.lag("ret_5d", 1).over(_by_date()),
            "ret_5d_lag2": F.lag("ret_5d", 2).over(_by_date()),
            "ret_20d_lag1": F.lag("ret_20d", 1).over(_by_date()),
        }
    )
    position = lambda c: guarded_ratio(F.col("adj_close"), F.col(c)) - 1
    kept = [*RETURN_INPUTS, *[f"ret_{n}d" for n in RETURN_ROWS], "ret_1d_lag1", "ret_1d_lag2", "ret_5d_lag1", "ret_5d_lag2", "ret_20d_lag1"]
    kept += ["dollar_volume", "log_dollar_volume", "avg_dollar_volume_20d_lagged", "avg_dollar_volume_60d_lagged", "avg_volume_20d_lagged"]
    return rolled.select(
        *kept,
        _zscore("dollar_volume", "avg_dollar_volume_20d_lagged", F.col("std_dollar_volume")).alias("dollar_volume_zscore_20d_lagged"),
        _zscore("adj_volume", "avg_volume_20d_lagged", F.col("std_volume")).alias("volume_zscore_20d_lagged"),
        "volatility_20d_lagged",
        "volatility_60d_lagged",
        "max_ret_20d_lagged",
        "min_ret_20d_lagged",
        position("high_20d").alias("close_to_20d_high_lagged"),
        position("low_20d").alias("close_to_20d_low_lagged"),
        position("high_60d").alias("close_to_60d_high_lagged"),
        position("low_60d").alias("close_to_60d_low_lagged"),
        weekday(F.col("date")).alias("day_of_week"),
        F.month("date").cast("long").alias("month"),
    )


def _direction(c: str) -> Column:
    return F.when(F.col(c).isNull(), None).when(F.col(c) > 0, 1).otherwise(0).cast("int")


def labels(prices: DataFrame) -> DataFrame:
    """prices with forward returns and direction labels on the same rows."""
    close = F.col("adj_close")
    ahead = prices.withColumns({f"fwd_ret_{n}d": guarded_ratio(F.lead(close, n).over(_by_date()), close) - 1 for n in FORWARD_ROWS})
    return ahead.withColumns({f"label_direction_{n}d": _direction(f"fwd_ret_{n}d") for n in (5, 20)})


def benchmark_forward(prices: DataFrame, ticker: str) -> DataFrame:
    """(date, benchmark_fwd_ret_20d) of the benchmark's series alone; the filter comes first, so its series is all that is sorted."""
    close = F.col("adj_close")
    series = prices.where(F.col("ticker") == ticker).select("security_id", "date", "adj_close")
    return series.select("date", (guarded_ratio(F.lead(close, 20).over(_by_date()), close) - 1).alias("benchmark_fwd_ret_20d"))


def panel(prices: DataFrame, benchmark: str, *, excess: str = "fwd_excess_ret_20d") -> DataFrame:
    """Features, labels and the excess forward return against a benchmark ticker (null on dates it does not have).

    (security_id, date) must be unique, which the quality rules check; then labels need no join.
    """
    labelled = labels(features(returns(prices)))
    # One row per date of one series: a few thousand rows, so Spark broadcasts it by its size.
    joined = labelled.join(benchmark_forward(prices, benchmark), "date", "left")
    return joined.withColumn(excess, F.col("fwd_ret_20d") - F.col("benchmark_fwd_ret_20d")).drop("benchmark_fwd_ret_20d")


def labels_joined(featured: DataFrame) -> DataFrame:
    """The join form of features and labels, for keys that repeat."""
    made = labels(featured.select("security_id", "date", "adj_close")).drop("adj_close")
    return featured.join(made, ["security_id", "date"], "left")


def liquid_universe(prices: DataFrame, *, top: int) -> DataFrame:
    """Of each month, the ``top`` securities by mean dollar volume."""
    month = F.trunc("date", "MM")
    means = prices.groupBy(month.alias("month"), "security_id").agg(F.avg(F.col("adj_close") * F.col("adj_volume")).alias("avg_dollar_volume"))
    place = F.row_number().over(Window.partitionBy("month").orderBy(F.desc("avg_dollar_volume"), "security_id"))
    return means.withColumn("liquidity_rank", place.cast("int")).where(F.col("liquidity_rank") <= top)

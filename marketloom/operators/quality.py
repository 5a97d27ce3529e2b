"""Data quality: a list of rules becomes one aggregation and a report with a row per rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import BLANK_METADATA
from ..schemas import PRICE_KEY, REQUIRED

Rules = dict[str, Column]
#: Rows that break a rule are first cut to examples in so many parts.
PARTS = 256
#: Columns of the models that may not be null: fixed values.
MODEL_COLUMNS = {
    "staging": ["security_id", "ticker", "date", "adj_close", "source"],
    "returns": ["security_id", "ticker", "date", "adj_close"],
    "features": ["security_id", "ticker", "date", "adj_close"],
    "panel": ["security_id", "ticker", "date", "adj_close"],
}
#: What names a window in a download report: fixed values.
REPORT_KEY = ["ticker", "security_id", "request_start_date", "request_end_date"]


def price_rules() -> Rules:
    """Conditions that break a rule of the canonical price table."""
    rules = {f"null_{c}": F.col(c).isNull() for c in REQUIRED}
    return rules | {
        "non_positive_close": F.col("close") <= 0,
        "invalid_adj_close": F.col("adj_close").isNull() | (F.col("adj_close") <= 0),
        "high_below_low": F.col("high") < F.col("low"),
        "negative_volume": F.col("volume") < 0,
        "negative_adj_volume": F.col("adj_volume") < 0,
        "non_positive_split_factor": F.col("split_factor") <= 0,
    }


def legacy_price_rules() -> Rules:
    """The older subset: keys and prices present, positive close, high not below low."""
    return {f"null_{c}": F.col(c).isNull() for c in ("security_id", "date", "close")} | {k: v for k, v in price_rules().items() if k in ("non_positive_close", "high_below_low", "negative_volume")}


def non_null_rules(columns: list[str]) -> Rules:
    return {f"null_{c}": F.col(c).isNull() for c in columns}


def text_rules(columns: list[str]) -> Rules:
    return {f"blank_{c}": F.lower(F.trim(c)).isin(BLANK_METADATA) for c in columns}


def integral_rules(columns: list[str]) -> Rules:
    return {f"non_integral_{c}": F.col(c) % 1 != 0 for c in columns}


def result_rules(statuses: list[str]) -> Rules:
    """Rules of a download report (status, row_count, request_start_date, request_end_date, last_price_date)."""
    blank, done = F.col("status").isin("empty", "existing_empty"), F.col("status").isin("downloaded", "existing")
    return {
        "unknown_status": ~F.col("status").isin(statuses) | F.col("status").isNull(),
        "window_reversed": F.col("request_start_date") > F.col("request_end_date"),
        "empty_with_rows": blank & (F.coalesce("row_count", F.lit(0)) != 0),
        "success_without_rows": done & (F.coalesce("row_count", F.lit(0)) <= 0),
        "success_without_last_date": done & F.col("last_price_date").isNull(),
    }


def manifest_rules() -> Rules:
    return {"month_out_of_range": ~F.col("month").between(1, 12), "no_rows": F.col("final_row_count") < 1}


def task_rules(statuses: list[str], name: str | None = None) -> Rules:
    """Rules of a task list; name: the one list that all tasks must be of."""
    needed = ["task_id", "ticker", "security_id", "requested_start_date", "requested_end_date", "status"]
    rules = non_null_rules(needed) | {"status_not_allowed": ~F.col("status").isin(statuses)}
    if name is not None:
        rules |= {"task_id_of_nan": F.lower("task_id").contains("nan"), "other_list": ~F.col("task_list_name").eqNullSafe(F.lit(name))}
    return rules


def report(df: DataFrame, rules: Rules, *, key: list[str] | None = None, non_empty: bool = True, unique: dict[str, list[str]] | None = None, least: int | None = None, most: int | None = None) -> DataFrame:
    """(rule, failed_rows, passed) for every rule, a non-empty table and a unique key; one pass over the rows, one over keys.

    unique: further keys by the name of their rule. least, most: bounds of the number of rows;
    what is missing or too much counts as failed.
    """
    counts = df.agg(F.count(F.lit(1)).alias("rows_"), *[F.count_if(c).alias(n) for n, c in rules.items()])
    cells = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed_rows")) for n in rules]
    if non_empty:
        cells.append(F.struct(F.lit("empty_table").alias("rule"), F.when(F.col("rows_") == 0, 1).otherwise(0).cast("long").alias("failed_rows")))
    if least is not None:
        cells.append(F.struct(F.lit("too_few_rows").alias("rule"), F.greatest(F.lit(least) - F.col("rows_"), F.lit(0)).cast("long").alias("failed_rows")))
    if most is not None:
        cells.append(F.struct(F.lit("too_many_rows").alias("rule"), F.greatest(F.col("rows_") - F.lit(most), F.lit(0)).cast("long").alias("failed_rows")))
    out = counts.select(F.explode(F.array(*cells)).alias("r")).select("r.*")
    for name, columns in (({"duplicate_key": key} if key else {}) | (unique or {})).items():
        twice = duplicate_keys(df, columns).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failed_rows"))
        out = out.unionByName(twice.select(F.lit(name).alias("rule"), "failed_rows"))
    return out.withColumn("passed", F.col("failed_rows") == 0)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys found more than once and their numbers of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def marked_duplicates(df: DataFrame, key: list[str], name: str = "is_duplicate") -> DataFrame:
    """All copies of a repeated key are marked."""
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*key)) > 1)


def examples(df: DataFrame, rules: Rules, columns: list[str], *, n: int = 5) -> DataFrame:
    """The first n offending rows of each rule in order of the columns: rule, place, and the columns as text.

    One scan for all rules. A rule that many rows break is cut to its first n in parts of the
    rows before the parts meet, so no task gets all of them.
    """
    broken = F.filter(F.array(*[F.when(c, F.lit(r)) for r, c in rules.items()]), lambda r: r.isNotNull())
    rows = df.select(F.explode(broken).alias("rule"), F.struct(*columns).alias("by_"))
    rows = rows.withColumn("part_", F.pmod(F.xxhash64("by_"), F.lit(PARTS)))
    for keys in (["rule", "part_"], ["rule"]):
        rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("by_")).cast("int")).where(F.col("place") <= n)
    return rows.select("rule", "place", *[F.col(f"by_.{c}").cast("string").alias(c) for c in columns])


def demand(checked: DataFrame) -> None:
    """Raise with the broken rules of a report (a row per rule)."""
    broken = checked.where(~F.col("passed")).collect()
    if broken:
        raise ValueError("; ".join(f"{r.rule}: {r.failed_rows} rows" for r in broken))


def validate_prices(prices: DataFrame) -> DataFrame:
    return report(prices, price_rules(), key=PRICE_KEY)


def validate_dimension(dim: DataFrame) -> DataFrame:
    """security_id and ticker of a dimension: never null, and each unique by itself."""
    return report(dim, non_null_rules(["security_id", "ticker"]), unique={"duplicate_security_id": ["security_id"], "duplicate_ticker": ["ticker"]}, non_empty=False)


def validate_results(rows: DataFrame, statuses: list[str]) -> DataFrame:
    """A download report: the rules of its rows, and no window twice."""
    return report(rows, result_rules(statuses), unique={"duplicate_window": REPORT_KEY})


def validate_models(models: dict[str, DataFrame]) -> DataFrame:
    """(model, rule, failed_rows, passed): the columns of each model of MODEL_COLUMNS that may not be null; one pass over a model."""
    parts = [report(df, non_null_rules(MODEL_COLUMNS[name]), non_empty=False).withColumn("model", F.lit(name)) for name, df in models.items()]
    return reduce(DataFrame.unionByName, parts).select("model", "rule", "failed_rows", "passed")

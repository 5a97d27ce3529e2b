"""The canonical price table and checks of table contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: The canonical daily price table, in column order: fixed values.
PRICE_SCHEMA = T.StructType(
    [
        T.StructField("security_id", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("adj_open", T.DoubleType()),
        T.StructField("adj_high", T.DoubleType()),
        T.StructField("adj_low", T.DoubleType()),
        T.StructField("adj_close", T.DoubleType()),
        T.StructField("adj_volume", T.LongType()),
        T.StructField("div_cash", T.DoubleType()),
        T.StructField("split_factor", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)
PRICE_COLUMNS = PRICE_SCHEMA.fieldNames()
PRICE_KEY = ["security_id", "date"]
REQUIRED = ["security_id", "ticker", "date", "adj_close", "source", "load_id", "loaded_at"]
GAP_KEY = ["ticker", "security_id"]
WINDOW_KEY = ["source", "dataset_name", "ticker", "requested_start_date", "requested_end_date"]


def select_canonical(df: DataFrame, schema: T.StructType = PRICE_SCHEMA) -> DataFrame:
    """The schema's columns in order: extra ones are dropped, missing ones rejected."""
    missing = [c for c in schema.fieldNames() if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*schema.fieldNames())


def cast_to(df: DataFrame, schema: T.StructType = PRICE_SCHEMA) -> DataFrame:
    """Strict cast projection: bad text raises under ANSI mode."""
    return select_canonical(df, schema).select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])


def empty(spark: SparkSession, schema: T.StructType | str = PRICE_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def table_contract(spark: SparkSession, name: str, *, partitions: list[str], buckets: list[str], columns: list[str]) -> DataFrame:
    """One row per rule of a saved table's contract: rule, expected, found, passed."""
    found = spark.catalog.listColumns(name)
    facts = {
        "partition columns": (partitions, [c.name for c in found if c.isPartition]),
        "bucket columns": (buckets, [c.name for c in found if c.isBucket]),
        "column set": (sorted(columns), sorted(c.name for c in found)),
    }
    rows = [(rule, ",".join(want), ",".join(have), want == have) for rule, (want, have) in facts.items()]
    return spark.createDataFrame(rows, "rule string, expected string, found string, passed boolean")

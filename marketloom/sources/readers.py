"""Scans: price partitions, single tables, CSV, raw JSON payloads, state, file inventories."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators.profile import describe
from ..operators.reconcile import date_ranges_predicate
from ..schemas import PRICE_SCHEMA, cast_to, empty

PAYLOAD_TYPE = "array<map<string,string>>"
#: Parts of a payload's path and the columns they become: fixed layout.
PATH_KEYS = ["source", "dataset", "symbol", "request_start", "request_end"]


def prices(spark: SparkSession, root: str) -> DataFrame:
    """The whole partitioned price table; year and month come from the folders."""
    schema = T.StructType([*PRICE_SCHEMA.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
    return spark.read.schema(schema).option("basePath", root).parquet(root)


def price_months(spark: SparkSession, root: str, months: list[tuple[int, int]]) -> DataFrame:
    """Chosen months in one pruned scan, as canonical columns."""
    inside = F.lit(False)
    for y, m in months:
        inside = inside | ((F.col("year") == y) & (F.col("month") == m))
    return cast_to(prices(spark, root).where(inside))


def price_ranges(spark: SparkSession, root: str, ranges: list[tuple[datetime.date, datetime.date]]) -> DataFrame:
    """Rows in half-open date ranges; the folders outside are not read."""
    table, keep = prices(spark, root), F.lit(False)
    at = F.col("year") * 12 + F.col("month")
    for a, b in ranges:
        keep = keep | at.between(a.year * 12 + a.month, b.year * 12 + b.month)
    return table.where(keep & date_ranges_predicate(F.col("date"), ranges))


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table, or no rows where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return empty(spark, schema)


def csv(spark: SparkSession, path: str, columns: list[str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """A CSV file with header as text (a ticker NA stays a ticker); some columns typed, null where they do not parse."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path).withColumns({c: F.col(c).try_cast(t) for c, t in (types or {}).items()})


def _payload(value: Column) -> Column:
    """The records of a payload: a list of objects, or an object that holds such a list as records."""
    listed = F.from_json(value, PAYLOAD_TYPE)
    held = F.from_json(F.get_json_object(value, "$.records"), PAYLOAD_TYPE)
    return F.when(F.ltrim(value).startswith("["), listed).otherwise(held)


def json_payloads(spark: SparkSession, path: str, *, strict: bool = True, pattern: str = "*.json") -> DataFrame:
    """(file, seq, fields, file_keys, and the columns of the path) of landed payload files.

    seq: the place in the file. Files of another shape raise when strict, else give no rows.
    """
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    return explode_payloads(files.select(F.col("_metadata.file_path").alias("file"), "value"), strict=strict)


def explode_payloads(files: DataFrame, *, strict: bool = True) -> DataFrame:
    """A row per record of files (file, value). file_keys: all names that the file's records use, taken from the array before it is exploded, so that nothing is shuffled for them.

    What belongs to a file (its names, the columns of its path) is a column of its own below the
    explosion: beside it in one select Spark would compute it again for each record, over all of them.
    The outer explosion spares the filter of empty lists, which Spark would infer and for which it
    would parse each file again.
    """
    records = _payload(F.col("value"))
    if strict:
        records = F.coalesce(records, F.raise_error(F.concat(F.lit("no list of records: "), F.col("file"))).cast(PAYLOAD_TYPE))
    listed = files.select("file", records.alias("records"))
    names = F.array_distinct(F.flatten(F.transform(F.filter("records", lambda r: r.isNotNull()), F.map_keys)))
    listed = listed.select("file", names.alias("file_keys"), *path_columns(F.col("file")), "records")
    rows = listed.select("file", "file_keys", *PATH_KEYS, F.posexplode_outer("records").alias("seq", "fields"))
    return rows.where("seq IS NOT NULL").select("file", F.col("seq").cast("long").alias("seq"), "fields", "file_keys", *PATH_KEYS)


def path_columns(file: Column) -> list[Column]:
    """Values that the path encodes as key=value; null where it has none."""
    found = {k: F.regexp_extract(file, rf"(?:^|/){k}=([^/]+)/", 1) for k in PATH_KEYS}
    return [F.when(v != "", v).alias(k) for k, v in found.items()]


def payload_path(root: str) -> Column:
    """The path of a window's payload, from its columns."""
    parts = [F.concat(F.lit(f"{k}="), F.col(c).cast("string")) for k, c in zip(PATH_KEYS, ["source", "dataset_name", "ticker", "request_start_date", "request_end_date"], strict=True)]
    return F.concat_ws("/", F.lit(root), *parts, F.lit("prices.json"))


def state(spark: SparkSession, path: str, schema: T.StructType | str, where: Column | None = None) -> DataFrame:
    """A state table (or none yet), restricted."""
    table = table_or_empty(spark, path, schema)
    return table if where is None else table.where(where)


def jdbc(spark: SparkSession, url: str, table: str, *, where: Column | None = None, split_by: str | None = None, rows_per_part: int = 100_000, most_parts: int = 64, **options: str) -> DataFrame:
    """The same state from a database: where is pushed into its query, and only the columns that are used are asked for.

    split_by: a number, date or timestamp column by whose range the scan is split, so that no
    connection reads more than about rows_per_part rows and no more than most_parts run; its
    bounds and the number of rows come from one aggregate that the database computes. Rows with
    a null there are in the first part; an empty table is one part.
    """
    base = {"url": url, "dbtable": table, "pushDownAggregate": "true", **options}
    load = lambda **more: spark.read.format("jdbc").options(**base, **more).load()
    rows = load()
    parted = rows
    if split_by is not None:
        asked = rows if where is None else rows.where(where)
        low, high, n = asked.agg(F.min(split_by), F.max(split_by), F.count(F.lit(1))).first()
        parts = min(most_parts, -(-n // rows_per_part))
        if low is not None and parts > 1:
            parted = load(partitionColumn=split_by, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return parted if where is None else parted.where(where)


def write_state(df: DataFrame, url: str, table: str, *, mode: str = "append", **options: str) -> None:
    """Rows put into a database's table, by one connection per partition."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def inventory(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, size, year, month) of files below root; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    inner = F.regexp_extract("path", r"((?:[^/=]+=[^/]+/)*[^/]+)$", 1)
    month = lambda k: F.regexp_extract("path", rf"/{k}=(\d+)/", 1).try_cast("int").alias(k)
    return files.select(inner.alias("path"), F.col("length").alias("size"), month("year"), month("month"))


def file_rows(spark: SparkSession, root: str) -> DataFrame:
    """(file, n_rows): an empty projection, so only file footers are decoded."""
    return spark.read.parquet(root).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))


def run_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    """SQL in which {name} stands for a table; the session's own views of such names stay as they are."""
    return spark.sql(sql, **tables)


def tables(spark: SparkSession, like: str | None = None) -> DataFrame:
    """(name, kind, temporary) of the session's tables and views; like: a pattern of names such as "price*"."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(pattern=like)]
    return spark.createDataFrame(sorted(rows), "name string, kind string, temporary boolean")


def described(spark: SparkSession, name: str) -> DataFrame:
    """(place, column, type, n_rows) of a registered table."""
    return describe(spark.table(name))


def sample_prices(spark: SparkSession, *, start: datetime.date, days: int, securities: DataFrame) -> DataFrame:
    """A fixture: close = base + 1.5 i on business days, for securities (security_id, ticker, base)."""
    dates = F.sequence(F.lit(start), F.date_add(F.lit(start), 2 * days + 4))
    weekdays = F.slice(F.filter(dates, lambda d: F.weekday(d) < 5), 1, days)
    rows = securities.select("security_id", "ticker", "base", F.posexplode(weekdays).alias("i", "date"))
    close = F.col("base") + 1.5 * F.col("i")
    return rows.select("security_id", "ticker", "date", close.alias("close"), (close + 1).alias("high"), (close - 1).alias("low"))

"""Helpers that several training-data operators use: table loading and tables written to the shared folder."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all contracts here: space and the ASCII controls 9 to 13.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a session on one machine without one (tests) gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="marketloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Paths that written() made inside each scratch().
_scopes: list[list[str]] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/marketloom/{label}-{uuid.uuid4().hex}"
    for scope in _scopes[-1:]:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that written() makes inside go at the end; what was made of them must be written by then, outside of another scratch()."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is written inside reaches Python workers in batches of so many rows, as long texts need."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: A row's number: 30 bits of its file, 33 of its place in it.
FILE_BITS, PLACE_BITS = 30, 33


def _scan_of_files(df: DataFrame) -> bool:
    """Whether df is columns of Parquet files and nothing else, so that a file and a place name one row."""
    plan = df._jdf.queryExecution().analyzed() if hasattr(df, "_jdf") else None
    while plan is not None and plan.getClass().getSimpleName() == "Project":
        plan = plan.child()
    if plan is None or plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = plan.relation()
    return relation.getClass().getSimpleName() == "HadoopFsRelation" and relation.fileFormat().getClass().getSimpleName() == "ParquetFileFormat"


def numbered(df: DataFrame) -> DataFrame:
    """(row_id, row) of every row of df: a number of its own, and its columns as a struct.

    Every scan of the result gives a row the same number, however Spark splits the files: of a
    scan of files it is made from the file and the place in it (by a hash of the paths that
    is first seen to keep them apart), other tables are written with their numbers.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    if _scan_of_files(df):
        at = df.metadataColumn("_metadata")
        files = df.select(at["file_path"].alias("path")).distinct()
        number = lambda path, seed: F.pmod(F.xxhash64(F.lit(seed), path), F.lit(1 << FILE_BITS))
        paths, *apart = files.agg(F.count(F.lit(1)), *[F.count_distinct(number(F.col("path"), seed)).alias(f"s{seed}") for seed in range(4)]).first()
        if paths in apart:
            return df.select((F.shiftleft(number(at["file_path"], apart.index(paths)), PLACE_BITS) + at["row_index"]).alias("row_id"), row)
    return written(df.select(F.monotonically_increasing_id().alias("row_id"), row), "numbered")


#: Rows that are surely not in a set of rows are told by a broadcast of no more than 2 ** ID_BITS hash values.
ID_BITS = 20


def _hash_bit(col: str):
    return F.pmod(F.xxhash64(col), F.lit(1 << ID_BITS))


def surely_not(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows whose row_id surely isn't in ids, and the rest. What is broadcast: distinct hash values, no more than 2 ** ID_BITS."""
    bits = F.broadcast(ids.select(_hash_bit("row_id").alias("bit_")).distinct())
    at = _hash_bit("row_id") == F.col("bit_")
    return rows.join(bits, at, "left_anti"), rows.join(bits, at, "left_semi")


def text_of(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


_held: dict = {}


def worker_state(key, make: Callable):
    """What a Python worker keeps for one operator; Spark's workers outlive stages, so the last operator's state goes first."""
    if key not in _held:
        _held.clear()
        gc.collect()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):
            pass  # a C library without it keeps the memory
        _held[key] = make()
    return _held[key]

"""Sinks: month partitions, staging and promotion with rollback, reports, saved tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import with_month
from ..schemas import PRICE_COLUMNS, select_canonical
from .readers import prices as read_prices


def write_months(prices: DataFrame, root: str, *, mode: str = "error", partition_mode: str = "static") -> None:
    """Canonical columns under year=/month= folders (months of two digits), sorted by ticker and date in each file.

    A month's rows meet in one task only if there are few: large months are split by Spark's
    rebalancing, which keeps files of even size.
    """
    rows = select_canonical(prices).withColumns({"year": F.year("date"), "month": F.date_format("date", "MM")})
    out = rows.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", "ticker", "date")
    out.write.mode(mode).option("partitionOverwriteMode", partition_mode).partitionBy("year", "month").parquet(root)


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_report(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_summary(row: DataFrame, path: str, mode: str = "error") -> None:
    row.write.mode(mode).json(path)


def month_counts(spark: SparkSession, root: str) -> DataFrame:
    return read_prices(spark, root).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, fs = _hadoop(spark, path)
    return fs.exists(where)


def _demand_counts(spark: SparkSession, root: str, expected: DataFrame, what: str) -> None:
    """Raise if the months of expected (year, month, final_row_count) have other numbers of rows under root."""
    wrong = expected.join(month_counts(spark, root), ["year", "month"], "left").where(~F.col("final_row_count").eqNullSafe(F.col("n_rows")))
    bad = wrong.limit(5).collect()
    if bad:
        raise ValueError(f"{what}: row counts differ in {[(r.year, r.month) for r in bad]}")


def _mark(spark: SparkSession, path: str) -> None:
    """An empty file: there, or not."""
    where, fs = _hadoop(spark, path)
    fs.create(where, True).close()


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _hadoop(spark, path)
    fs.delete(where, True)


MANIFEST_SUFFIX, STAGED = "-manifest", "_STAGED"
MANIFEST = "year int, month int, final_row_count long"


def is_staged(spark: SparkSession, staging_root: str) -> bool:
    """Whether a staging root is whole: its months were counted and its manifest is beside it."""
    return path_exists(spark, f"{staging_root}{MANIFEST_SUFFIX}/{STAGED}")


def staged_manifest(spark: SparkSession, staging_root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{staging_root}{MANIFEST_SUFFIX}")


def stage(spark: SparkSession, merged: DataFrame, manifest: DataFrame, staging_root: str, *, overwrite: bool = False) -> None:
    """Write the affected months to a staging root, count them again, and put the manifest beside it; an existing root is refused unless overwrite."""
    if not overwrite and path_exists(spark, staging_root):
        raise FileExistsError(staging_root)
    remove(spark, f"{staging_root}{MANIFEST_SUFFIX}")
    write_months(merged, staging_root, mode="overwrite" if overwrite else "error")
    rows = manifest.select(*[F.col(c).cast(t).alias(c) for c, t in (x.split() for x in MANIFEST.split(", "))])
    rows.coalesce(1).write.parquet(f"{staging_root}{MANIFEST_SUFFIX}")
    _demand_counts(spark, staging_root, staged_manifest(spark, staging_root), "staging")
    _mark(spark, f"{staging_root}{MANIFEST_SUFFIX}/{STAGED}")


#: A promotion's record beside its archive: the plan, and a mark for each step that is over.
PLAN, RECORD_SUFFIX = "year int, month int, archived boolean, final_row_count long", "-promotion"
STEPS = ["planned", "archived", "replaced", "counted"]


@dataclass(frozen=True)
class Promotion:
    """Where a promotion keeps the months it replaces."""

    archive_root: str
    new_months: list[tuple[int, int]]


def promotion_step(spark: SparkSession, archive_root: str) -> str | None:
    """The last step of a promotion that is over; None if it has no plan yet."""
    done = [x for x in STEPS if path_exists(spark, f"{archive_root}{RECORD_SUFFIX}/{x}")]
    return done[-1] if done else None


def _plan(spark: SparkSession, archive_root: str) -> list:
    return spark.read.schema(PLAN).parquet(f"{archive_root}{RECORD_SUFFIX}/plan").orderBy("year", "month").collect()


def promote(spark: SparkSession, staging_root: str, target_root: str, archive_root: str, manifest: DataFrame | None = None, *, check=None, after=None) -> Promotion:
    """Archive the affected months of the target, replace only these, and count again.

    The archive root names the promotion. Its record beside it says which steps are over, so a
    call that finds a record goes on from there, whatever ended the call before it: nothing is
    archived once months may have been replaced, staging stays as it is, and a promotion that is
    over changes nothing. A manifest (by default the one beside the staging root) that does not
    fit a record's plan is refused.

    On an error in the replacing or counting the archived months are written back and months
    that did not exist before are removed; the next call replaces again. check(): called before
    the count, for further gates; after(step): called when a step is over.
    """
    record = f"{archive_root}{RECORD_SUFFIX}"
    over = after or (lambda step: None)

    def done(step: str) -> bool:
        return path_exists(spark, f"{record}/{step}")

    def end(step: str) -> None:
        _mark(spark, f"{record}/{step}")
        over(step)

    manifest = staged_manifest(spark, staging_root) if manifest is None else manifest
    # One row per month, fixed before the files from which the manifest may be made are replaced.
    expected = sorted((r.year, r.month, r.final_row_count) for r in manifest.select("year", "month", "final_row_count").collect())
    if not done("planned"):
        if not done("archived") and path_exists(spark, archive_root):
            raise FileExistsError(archive_root)
        before = set()
        if path_exists(spark, target_root):
            rows = _in(read_prices(spark, target_root), [(y, m) for y, m, _ in expected])
            before = {(r.year, r.month) for r in rows.select("year", "month").distinct().collect()}
        plan = [(y, m, (y, m) in before, n) for y, m, n in expected]
        spark.createDataFrame(plan, PLAN).coalesce(1).write.mode("overwrite").parquet(f"{record}/plan")
        end("planned")
    plan = _plan(spark, archive_root)
    if [(r.year, r.month, r.final_row_count) for r in plan] != expected:
        raise ValueError(f"{record} is the record of another promotion")
    old = [(r.year, r.month) for r in plan if r.archived]
    made = Promotion(archive_root, [(r.year, r.month) for r in plan if not r.archived])
    if not done("archived"):  # the target is as it was
        if old:
            rows = _in(read_prices(spark, target_root), old)
            write_months(rows.select(*PRICE_COLUMNS), archive_root, mode="overwrite")
            _demand_counts(spark, archive_root, rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("final_row_count")), "archive")
        end("archived")
    try:
        if not done("replaced"):
            write_months(read_prices(spark, staging_root).select(*PRICE_COLUMNS), target_root, mode="overwrite", partition_mode="dynamic")
            end("replaced")
        if not done("counted"):
            if check is not None:
                check()
            _demand_counts(spark, target_root, spark.createDataFrame(expected, MANIFEST), "promotion")
            end("counted")
    except Exception:
        rollback(spark, made, target_root, bool(old))
        raise
    return made


def recover(spark: SparkSession, archive_root: str, target_root: str) -> None:
    """Roll back a promotion of which only the archive and its record are left."""
    plan = _plan(spark, archive_root)
    rollback(spark, Promotion(archive_root, [(r.year, r.month) for r in plan if not r.archived]), target_root, any(r.archived for r in plan))


def rollback(spark: SparkSession, made: Promotion, target_root: str, archived: bool = True) -> None:
    """The target as it was before a promotion, which may then be made again."""
    for step in ("counted", "replaced"):
        remove(spark, f"{made.archive_root}{RECORD_SUFFIX}/{step}")
    if archived:
        write_months(read_prices(spark, made.archive_root).select(*PRICE_COLUMNS), target_root, mode="overwrite", partition_mode="dynamic")
    for y, m in made.new_months:
        remove(spark, f"{target_root}/year={y}/month={m:02d}")


def _in(table: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    keep = F.lit(False)
    for y, m in months:
        keep = keep | ((F.col("year") == y) & (F.col("month") == m))
    return table.where(keep)


def rebuild(spark: SparkSession, prices: DataFrame, new_root: str, validate) -> DataFrame:
    """A full rebuild under a new root: written, validated by validate(df) (which raises), then handed over to switch to."""
    write_months(prices, new_root)
    table = read_prices(spark, new_root)
    validate(table.select(*PRICE_COLUMNS))
    return table


def switch(spark: SparkSession, new_root: str, live_root: str, archive_root: str) -> None:
    """Put a rebuilt table in the place of the live one, which moves to the archive root; on an error it moves back."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(live_root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def move(a: str, b: str) -> None:
        if fs.exists(path(b)) or not fs.rename(path(a), path(b)):
            raise OSError(f"cannot move {a} to {b}")

    there = fs.exists(path(live_root))
    fs.mkdirs(path(archive_root).getParent())
    if there:
        move(live_root, archive_root)
    try:
        move(new_root, live_root)
    except Exception:
        if there:
            move(archive_root, live_root)
        raise
    spark.catalog.refreshByPath(live_root)


def save_bucketed(prices: DataFrame, name: str, *, buckets: int = 64, mode: str = "error") -> None:
    """A saved table by month, bucketed and sorted by security: windows by security on it need no exchange.

    Rows are dealt by month and bucket as the table's own buckets are, so a month has no more
    files than buckets, however many tasks write. A task that reads a bucket reads one part in
    buckets of the table (or of the months that a filter leaves), so buckets grow with the data.
    """
    rows = with_month(prices)
    own = F.pmod(F.hash("security_id"), F.lit(buckets))
    rows = rows.repartition("year", "month", own)
    rows.write.mode(mode).partitionBy("year", "month").bucketBy(buckets, "security_id").sortBy("security_id", "date").saveAsTable(name)


def replace_months(prices: DataFrame, name: str) -> None:
    """Replace just the months that prices has in a saved table partitioned by year and month."""
    spark, key = prices.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    rows, before = with_month(prices).select(*spark.table(name).columns), spark.conf.get(key)
    spark.conf.set(key, "dynamic")  # an insert into a saved table heeds the session's setting, not an option
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(key, before)


def stage_table(df: DataFrame, like: str, name: str) -> None:
    """A staging table with another table's columns; whatever it held goes."""
    df.select(*df.sparkSession.table(like).columns).write.mode("overwrite").saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def materialise(models: dict[str, DataFrame], *, views: set[str], mode: str = "overwrite") -> None:
    """Models by name: some as temporary views, the rest as saved tables."""
    for name, df in models.items():
        if name in views:
            df.createOrReplaceTempView(name)
        else:
            df.write.mode(mode).saveAsTable(name)

"""Landed payload files as a stream: each micro-batch is merged into the affected months."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import manifest, merge_windows
from ..operators.normalize import normalise_prices
from ..schemas import PRICE_COLUMNS, PRICE_SCHEMA
from ..sources.readers import explode_payloads, table_or_empty
from ..sources.writers import is_staged, promote, promotion_step, stage


def payload_stream(spark: SparkSession, path: str, *, files_per_batch: int = 1000) -> DataFrame:
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    files = reader.option("maxFilesPerTrigger", files_per_batch).load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), "value")


def apply_batch(spark: SparkSession, new: DataFrame, target_root: str, work_root: str, batch: int | str, *, after=None) -> bool:
    """Merge a batch of canonical rows into the affected months, once: False if the batch was merged before.

    A batch's name is the name of its folders. A call that follows one which did not end goes on
    from what is there: with the staged months once they are whole (new is not read then), with
    the promotion's record from its plan on. after(step): called when a step is over.
    """
    folder = f"{work_root}/{batch}"
    if promotion_step(spark, f"{folder}/archive") == "counted":
        return False
    if not is_staged(spark, f"{folder}/staging"):
        new.select(*PRICE_COLUMNS).write.mode("overwrite").parquet(f"{folder}/new")
        new = spark.read.schema(PRICE_SCHEMA).parquet(f"{folder}/new")
        old = table_or_empty(spark, target_root, PRICE_SCHEMA)
        stage(spark, merge_windows(old, new), manifest(old, new), f"{folder}/staging", overwrite=True)
        if after is not None:
            after("staged")
    promote(spark, f"{folder}/staging", target_root, f"{folder}/archive", after=after)
    return True


def merge_batch(target_root: str, work_root: str, *, source: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: normalise, merge, stage and promote under folders of the batch's own; a replayed batch is merged once."""

    def run(files: DataFrame, batch: int) -> None:
        spark = files.sparkSession
        rows = explode_payloads(files, strict=False)
        if rows.isEmpty():
            return
        named = rows.withColumns({"ticker": F.col("symbol"), "security_id": F.concat(F.lit(f"{source}:"), F.upper("symbol")), "source": F.lit(source), "load_id": F.lit(f"batch-{batch}"), "loaded_at": F.current_timestamp()})
        apply_batch(spark, normalise_prices(named).where("NOT non_integral"), target_root, work_root, batch)

    return run


def ingest(spark: SparkSession, path: str, target_root: str, work_root: str, *, source: str):
    """Run the stream over what has landed and stop."""
    stream = payload_stream(spark, path).writeStream.foreachBatch(merge_batch(target_root, work_root, source=source))
    return stream.option("checkpointLocation", f"{work_root}/checkpoint").trigger(availableNow=True).start()

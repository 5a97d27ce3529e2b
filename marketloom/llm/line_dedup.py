"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of line hashes, dealt to buckets by hash and sorted in each. A batch of
documents groups its own keys the same way and meets every run by a sort-merge anti-join
that shuffles no run: keys that no run holds are new, and the batch sets their keeper; of
the others it adds counts only. Its rows become a run of the lowest level. When a level has
``fanout`` runs they are compacted into one of the next level. Batches come in descending
order of doc_id, so a key is new in the batch that holds its largest doc_id.

A hash is the first 128 bits of SHA-256 of the key, as good as the key itself.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import numbered, shared_dir, surely_not, written

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCHES = 4
FANOUT = 3
#: Batches are cut at quantiles of so many doc_ids, those of least hash.
CUT_SAMPLE = 1000


class LineRuns:
    """Levels of sorted runs (h, n_docs, keeper, new) in the shared folder; the driver holds only their handles.

    A key is new in one run, which holds its keeper; other runs only count its documents. A
    run has two handles: as a bucketed table, for joins, and as plain files, for unions
    (Spark 4.1 takes a union of bucketed tables for grouped by bucket, and then scans files).
    """

    def __init__(self, fanout: int = FANOUT):
        self.fanout, self.levels = fanout, []

    def runs(self) -> list[DataFrame]:
        return [bucketed for level in self.levels for bucketed, _ in level]

    def _write(self, rows: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        spark, name = rows.sparkSession, f"marketloom_run_{uuid.uuid4().hex}"
        buckets, path = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{shared_dir(spark)}/marketloom/{name}"
        rows.write.bucketBy(buckets, "h").sortBy("h").option("path", path).saveAsTable(name)
        self.levels[level].append((spark.table(name), spark.read.schema(rows.schema).parquet(path)))
        spark.sql(f"DROP TABLE {name}")  # only the name goes: files with a path of their own stay
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._compacted(full), level + 1)

    @staticmethod
    def _compacted(runs: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
        keeper = F.any_value(F.when(F.col("new"), F.struct("keeper")), ignoreNulls=True)["keeper"]
        return reduce(DataFrame.unionByName, [files for _, files in runs]).groupBy("h").agg(F.sum("n_docs").alias("n_docs"), keeper.alias("keeper"), F.bool_or("new").alias("new"))

    def merged(self) -> DataFrame | None:
        """One row per key over all runs."""
        return self._compacted([run for level in self.levels for run in level]) if self.levels else None

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of keys whose line is in no run."""
        return reduce(lambda rows, run: rows.join(run.select("h"), "h", "left_anti"), self.runs(), keys)

    def add(self, keys: DataFrame) -> None:
        """keys: (h, doc_id), any number of rows per document, of documents that no earlier batch held."""
        own = keys.groupBy("h", "doc_id").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
        # One pass: a run's key is marked by the left join, and what no run marks is new.
        marks = [f"in_{i}" for i in range(len(self.runs()))]
        for mark, run in zip(marks, self.runs(), strict=True):
            own = own.join(run.select("h", F.lit(True).alias(mark)), "h", "left")
        new = reduce(lambda a, m: a & F.col(m).isNull(), marks, F.lit(True))
        self._write(own.select("h", "n_docs", F.when(new, F.col("keeper")).alias("keeper"), new.alias("new")), 0)


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(row_id, doc_id, pos, h) of every line whose key has min_chars code points or more."""
    whole = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    rows = docs.select("row_id", "doc_id", F.posexplode(F.split(whole, "\n", -1)).alias("pos", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.length("line") >= min_chars)
    return rows.select("row_id", "doc_id", "pos", F.substring(F.unhex(F.sha2("line", 256)), 1, 16).alias("h"))


def _cuts(docs: DataFrame, batches: int) -> list:
    """doc_ids, of any type, that cut docs into batches of about the same size; found on a bounded sample."""
    if batches < 2:
        return []
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id")).limit(CUT_SAMPLE)
    ids = sorted(r.doc_id for r in ids.collect())
    return sorted({ids[len(ids) * i // batches] for i in range(1, batches)}) if ids else []


def _batch_of(doc_id: Column, cuts: list) -> Column:
    return reduce(lambda a, c: a + F.when(doc_id > F.lit(c), 1).otherwise(0), cuts, F.lit(0))


def dedup_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """docs with the columns line_text, line_total and line_dropped added (a docs column of such a name goes).

    Lines whose key (stripped of the six ASCII spaces, A-Z lower-cased) has min_chars code
    points and is found in min_docs documents go, except from the document with the largest
    doc_id (of any type that has an order). Null and empty texts are one empty line. Rows
    that share a doc_id count as one document; a null doc_id is one document, smaller than
    all. Other columns may have any names. Empty tables give no rows.
    """
    docs = docs.drop("line_text", "line_total", "line_dropped")
    rows = numbered(docs)
    lines = written(line_keys(rows.select("row_id", "row.doc_id", "row.text"), min_chars), "line-keys")
    cuts = _cuts(rows.select("row.doc_id"), batches)
    runs, place = LineRuns(fanout), _batch_of(F.col("doc_id"), cuts)
    for i in range(len(cuts), -1, -1):
        runs.add(lines.where(place == i).select("h", "doc_id"))
    repeated = written(runs.merged().where(F.col("n_docs") >= min_docs).select("h", "keeper"), "repeated")
    gone = lines.join(repeated, "h").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = written(gone.groupBy("row_id").agg(F.collect_set("pos").alias("gone")), "gone")

    # Only rows that may lose lines are shuffled; what goes grows with the input, so it is not broadcast at any size.
    sure, some = surely_not(rows, gone)
    some = some.join(gone.hint("merge"), "row_id", "left")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    left = F.array_except(F.sequence(F.lit(0), F.size(F.split(text, "\n", -1)) - 1), F.col("gone"))
    cut = F.transform(F.array(F.split(text, "\n", -1)), lambda lines: F.array_join(F.transform(left, lambda i: lines[i]), "\n"))[0]
    total = F.size(F.split(text, "\n", -1)).cast("long").alias("line_total")
    sure = sure.select("row", text.alias("line_text"), total, F.lit(0).cast("long").alias("line_dropped"))
    some = some.select("row", F.when(F.col("gone").isNull(), text).otherwise(cut).alias("line_text"), total, F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("line_dropped"))
    return sure.unionByName(some).select("row.*", "line_text", "line_total", "line_dropped")

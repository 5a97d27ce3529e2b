"""Exact duplicate detection by deterministic block naming, with DataFrame operations only.

Every text is cut into blocks of ``block`` code points. Distinct blocks are named by
integers: their places in one sorted order. Then adjacent names are paired and the
distinct pairs named in the same way, level by level, until one name is left per
document. Two documents have the same (level, name) exactly if their texts are equal.

Blocks travel as a pair of 64-bit hashes. Before these stand for the blocks, a job
groups the block contents themselves and proves that no two different blocks share a
pair; if two do, naming starts again with the next seed. Names of pairs are made from
integers alone and need no proof.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

BLOCK = 4096
BUCKETS = 4096


def _hashes(block, seed: int, bits: int):
    pair = [F.xxhash64(F.lit(2 * seed + i), block) for i in (0, 1)]
    if bits < 64:
        pair = [F.pmod(h, F.lit(1 << bits)) for h in pair]
    return F.struct(pair[0].alias("h1"), pair[1].alias("h2"))


def sorted_names(keys: DataFrame, cols: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Dense integer names of the distinct keys, in the order of (hash bucket, key).

    Each bucket is ranked by itself; the offsets come from one row for each bucket, so the
    broadcast table never has more than ``buckets`` rows.
    """
    keys = keys.distinct().withColumn("bucket", F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keys.groupBy("bucket").count().select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*cols))
    ranked = keys.withColumn("place", rank)
    return ranked.join(F.broadcast(offsets), "bucket").select(*cols, (F.col("first") + F.col("place") - 1).alias("name"))


def block_names(docs: DataFrame, *, text: str = "text", block: int = BLOCK, hash_bits: int = 64) -> DataFrame:
    """One row per row of docs: row_id, doc_id, text_sha256, n_blocks, level, name.

    Null text counts as empty; an empty text is one empty block. Rows are told apart by
    row_id, so repeated and null doc_ids are fine. Equal (level, name): equal texts.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    cut = F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    cut = F.when(whole == "", F.array(F.lit(""))).otherwise(cut)
    seed = 0
    while True:
        base = written(
            docs.select(
                F.monotonically_increasing_id().alias("row_id"),
                "doc_id",
                F.sha2(whole, 256).alias("text_sha256"),
                F.transform(cut, lambda b: _hashes(b, seed, hash_bits)).alias("blocks"),
            ),
            "block-hashes",
        )
        contents = docs.select(F.explode(cut).alias("content")).select(_hashes(F.col("content"), seed, hash_bits).alias("h"), "content")
        clashes = contents.groupBy("h", "content").agg(F.lit(1).alias("one")).groupBy("h").count().where("count > 1")
        if clashes.isEmpty():
            break
        seed, hash_bits = seed + 1, 64

    base = base.withColumn("n_blocks", F.size("blocks"))
    items = base.select("row_id", "n_blocks", F.posexplode("blocks").alias("pos", "h")).select("row_id", "n_blocks", "pos", F.col("h.h1").alias("a"), F.col("h.h2").alias("b"))
    longest = base.agg(F.max("n_blocks")).first()[0] or 1
    done, level = None, 0
    while True:
        names = sorted_names(items.select("a", "b"), ["a", "b"])
        named = written(items.join(names, ["a", "b"]).select("row_id", "n_blocks", "pos", "name"), f"names-{level}")
        ended = named.where("n_blocks = 1").select("row_id", F.lit(level).alias("level"), "name")
        done = ended if done is None else done.unionByName(ended)
        if longest <= 1:
            break
        odd = F.col("pos") % 2 == 1
        items = (
            named.where("n_blocks > 1")
            .groupBy("row_id", F.shiftright("pos", 1).alias("pos"))
            .agg(
                F.ceil(F.max("n_blocks") / 2).cast("int").alias("n_blocks"),
                F.max(F.when(~odd, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("b"),
            )
        )
        level, longest = level + 1, (longest + 1) // 2
    return base.select("row_id", "doc_id", "text_sha256", "n_blocks").join(done, "row_id")


def exact_dedup(docs: DataFrame, *, text: str = "text", block: int = BLOCK, hash_bits: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, level, name, row_id.

    Of equal texts the row with the largest doc_id stays (null is smallest); of repeated
    rows with that doc_id, the one that is read first. An empty table gives no rows.
    """
    named = block_names(docs, text=text, block=block, hash_bits=hash_bits)
    best = F.max(F.struct(F.col("doc_id"), (-F.col("row_id")).alias("neg")))
    groups = written(named.groupBy("level", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    return named.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == -F.col("best.neg")).alias("kept"),
        "text_sha256",
        "level",
        "name",
        "row_id",
    )

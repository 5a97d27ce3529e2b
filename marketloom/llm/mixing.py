"""Mixing sources to target weights by blocks of words.

1. Every source is one stream of words: its documents in a pseudorandom order, end to end.
   The stream is cut into blocks of ``block`` words (the last may be shorter).
2. A source's target in whole words gives its number of slots. For each output shard the
   counts of the sources are drawn: a source's slots fall multinomially on the shards, so
   that every shard's counts vary and each source's total is exact.
3. Slot j of a pass over a source takes block permutation(j); the permutation of the indexes
   of whole blocks is a keyed bijection, computed and never stored. The short block comes
   last in each pass, and the last slot takes the words that remain of the target, so what
   is taken is the target rounded to a word.
4. Blocks are joined to slots by (source, index).

All draws come from the seed and the names of sources, so reruns agree. No step holds all
sources, all shards or all slots in one task. Null and empty texts have no words; a null
source is one source, the last; empty tables give empty results; a document is one row,
whether its doc_id repeats or is null; other columns do not matter here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import SPACE_CLASS, numbered, written

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_PASSES = 2
BLOCK = 256
SLOTS_PER_SHARD = 4096
#: Documents of a source are dealt to so many parts, whose sums give the offsets of the stream.
PARTS = 256
SEED = 20


def word_count(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text; null: 0."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, f"{SPACE_CLASS}+"))).cast("long")


def _placed(totals: DataFrame) -> DataFrame:
    """totals with the place of each source from 0, in code point order, null last: places within ranges, and the ranges' offsets."""
    order = [F.col("source").isNull(), F.col("source")]
    ranges = written(totals.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "sources")
    sums = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("members"))  # a row for each range, no more than shuffle partitions
    before = F.sum("members").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("range", F.coalesce(before, F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return ranges.withColumn("own", own).join(sums, "range").select("source", "source_size", (F.col("own") + F.col("offset")).alias("place"))


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code point order, null last, take the weights in turn. Together they get
    share_percent of all sizes; a target stops at max_passes times its source's size and the
    excess goes to the others by weight until none is above: sources below the water level
    (words per weight) take their caps, and the level of the rest is found again from two
    sums, until no source is newly below it. One row per source.
    """
    rows = _placed(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = written(rows.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(max_passes)).alias("cap")), "weights")
    full, level = F.lit(False), None
    while True:
        state = rows.agg(F.sum("source_size"), F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not state[2]:  # every source stops at its cap, or there is none
            break
        found = ((state[0] or 0) * (share_percent / 100.0) - (state[1] or 0.0)) / state[2]
        if found == level:
            break
        level = found
        full = F.col("cap") <= F.lit(level) * F.col("weight")
    return rows.select("source", "source_size", F.when(full, F.col("cap")).otherwise(F.lit(level or 0.0) * F.col("weight")).alias("target"))


def _key(*parts) -> int:
    return int.from_bytes(hashlib.sha256(repr(parts).encode()).digest()[:8], "little")


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed bijection of 0..n-1: four Feistel rounds on the next even number of bits, walked until inside."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask, x = np.uint64((1 << half) - 1), index.astype(np.uint64)

    def once(x):
        left, right = x >> np.uint64(half), x & mask
        with np.errstate(over="ignore"):
            for i in range(4):
                f = (right + np.uint64((key + i * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
                f = (f ^ (f >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((f >> np.uint64(29)) & mask)
        return (left << np.uint64(half)) | right

    x = once(x)
    while (out := x >= np.uint64(n)).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


def shard_draws(targets: DataFrame, *, block: int = BLOCK, slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> DataFrame:
    """(source, shard, first_slot, n_slots, source_size, words): the counts of each source in each output shard; words: its whole target."""
    words = F.round("target").cast("long")
    passes = F.floor(words / F.col("source_size"))
    slots = passes * F.ceil(F.col("source_size") / block) + F.ceil((words - passes * F.col("source_size")) / block)
    rows = targets.where("source_size > 0").select("source", "source_size", words.alias("words"), slots.cast("long").alias("slots"))
    total = rows.agg(F.sum("slots")).first()[0] or 0
    n_shards = max(1, -(-total // slots_per_shard))

    def counts_of(source, slots: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.Generator(np.random.PCG64(_key(seed, "draw", source)))
        if slots < n_shards:  # the same law, by single draws
            return np.unique(rng.integers(0, n_shards, slots), return_counts=True)
        counts = rng.multinomial(slots, np.full(n_shards, 1 / n_shards))
        return np.flatnonzero(counts), counts[counts > 0]

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for source, size, words, slots in frame.itertuples(index=False):
                shards, counts = counts_of(source, int(slots))
                first = np.cumsum(counts) - counts
                for i in range(0, len(counts), 10_000):
                    part = slice(i, i + 10_000)
                    yield pd.DataFrame({"source": source, "shard": shards[part], "first_slot": first[part], "n_slots": counts[part], "source_size": int(size), "words": int(words)}).astype({"source": object})

    return rows.mapInPandas(draw, "source string, shard long, first_slot long, n_slots long, source_size long, words long")


def slots(draws: DataFrame, *, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(source, shard, slot, pass, block_index, slot_words): one row per block of the mix, with the words that it takes of its block."""
    # A given number of partitions is kept: by their bytes the draws would be put in one task.
    draws = draws.repartition(int(draws.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source", "shard")

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for source, shard, first, count, size, words in frame.itertuples(index=False):
                whole, blocks = int(size) // block, -(-int(size) // block)
                j = np.arange(int(first), int(first) + int(count))
                turn, at = j // blocks, j % blocks
                index = at.copy()
                if (inner := at < whole).any():
                    index[inner] = permuted(at[inner], whole, _key(seed, "order", source))
                taken = np.minimum(np.minimum(block, int(size) - at * block), int(words) - turn * int(size) - at * block)
                yield pd.DataFrame({"source": source, "shard": shard, "slot": np.arange(len(j)), "pass": turn, "block_index": index, "slot_words": taken}).astype({"source": object})

    return draws.mapInPandas(fill, "source string, shard long, slot long, pass long, block_index long, slot_words long")


def streams(rows: DataFrame, *, seed: int = SEED, parts: int = PARTS) -> DataFrame:
    """(row_id, doc_id, source, size, start) of numbered() rows: where each row's words begin in its source's stream.

    Order: hash of doc_id and text, so it does not depend on files. A source is dealt to parts
    by that hash; offsets within a part and of parts are summed apart, so no source is in one task.
    """
    order = F.xxhash64(F.lit(seed), "row.doc_id", "row.text")
    rows = rows.select("row_id", "row.doc_id", "row.source", word_count(F.col("row.text")).alias("size"), order.alias("order"))
    rows = written(rows.withColumn("part", F.pmod("order", F.lit(parts)).cast("int")), "stream-sizes")
    before = Window.partitionBy("source", "part").orderBy("order", "doc_id", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("of"), F.col("part").alias("in_part"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    joined = rows.join(sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")))
    return joined.select("row_id", "doc_id", "source", "size", (F.col("offset") + F.col("inside")).alias("start"))


def segments(stream: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(row_id, source, block_index, first_word, in_block, n_words): the parts of rows in blocks; rows without words have none.

    first_word: the part's first word in its row; in_block: in its block.
    """
    end = F.col("start") + F.col("size")
    rows = stream.where("size > 0").withColumn("block_index", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    low, high = F.greatest(F.col("start"), F.col("block_index") * block), F.least(end, (F.col("block_index") + 1) * block)
    return rows.select("row_id", "source", "block_index", (low - F.col("start")).alias("first_word"), (low - F.col("block_index") * block).alias("in_block"), (high - low).alias("n_words"))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, max_passes: int = MAX_PASSES, block: int = BLOCK, slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """mix_of() the rows of docs, numbered."""
    return mix_of(numbered(docs), weights=weights, share_percent=share_percent, max_passes=max_passes, block=block, slots_per_shard=slots_per_shard, seed=seed)


def mix_of(rows: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, max_passes: int = MAX_PASSES, block: int = BLOCK, slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of numbered() rows as (stream, targets, uses).

    stream: streams() of rows; targets: source_targets(); uses: one row per block segment and
    slot, (row_id, source, shard, slot, pass, block_index, first_word, in_block, n_words): in
    order of shard, slot and in_block, these are the words of the mix.
    """
    stream = written(streams(rows, seed=seed), "streams")
    targets = written(source_targets(stream, weights=weights, share_percent=share_percent, max_passes=max_passes), "targets")
    # Written, so that Spark knows its size: the few rows that it comes from would have it broadcast.
    filled = written(slots(shard_draws(targets, block=block, slots_per_shard=slots_per_shard, seed=seed), block=block, seed=seed), "slots")
    filled = filled.withColumnRenamed("source", "of").withColumnRenamed("block_index", "index")
    parts = segments(stream, block=block)
    uses = parts.join(filled, (F.col("block_index") == F.col("index")) & F.col("source").eqNullSafe(F.col("of")) & (F.col("in_block") < F.col("slot_words")))
    return stream, targets, uses.withColumn("n_words", F.least("n_words", F.col("slot_words") - F.col("in_block"))).drop("of", "index", "slot_words")


def mixed_blocks(docs: DataFrame, **options) -> DataFrame:
    """(shard, slot, source, pass, block_index, n_words, words) of every slot of the mix: the packed blocks themselves.

    words: the block's words in order, BLOCK of them unless the block is its source's short
    one or its target ends in it. A shard is read in order of source and slot.
    """
    rows = numbered(docs)
    _, _, uses = mix_of(rows, **options)
    words = F.split(F.btrim("row.text", F.lit(" \t\n\x0b\x0c\r")), f"{SPACE_CLASS}+")
    parts = rows.select("row_id", "row.text", words.alias("of_row")).drop("text").join(uses, "row_id")
    parts = parts.withColumn("part", F.struct("in_block", F.slice("of_row", F.col("first_word").cast("int") + 1, F.col("n_words").cast("int")).alias("words")))
    packed = parts.groupBy("shard", "source", "slot", "pass", "block_index").agg(F.sum("n_words").alias("n_words"), F.sort_array(F.collect_list("part")).alias("parts"))
    return packed.select("shard", "slot", "source", "pass", "block_index", "n_words", F.flatten(F.col("parts.words")).alias("words"))


def taken_words(stream: DataFrame, targets: DataFrame, uses: DataFrame) -> DataFrame:
    """Per row of the stream: row_id, doc_id, size, source_size, target, taken."""
    taken = uses.groupBy("row_id").agg(F.sum("n_words").alias("taken"))
    named = targets.withColumnRenamed("source", "of")
    rows = stream.join(taken, "row_id", "left").join(named, F.col("source").eqNullSafe(F.col("of")), "left")
    return rows.select("row_id", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


@F.pandas_udf(T.StringType())
def _words_of(texts: pd.Series, runs: pd.Series) -> pd.Series:
    """The text's stretches of words, each from its first to its last word's end, with the white space between them kept."""
    import re

    find = re.compile(r"[^\x20\x09-\x0D]+").finditer

    def cut(text, parts):
        spans, out = [m.span() for m in find(text)], []
        for low, high in sorted((int(p["first_word"]), int(p["first_word"] + p["n_words"])) for p in parts):
            if out and out[-1][1] == low:
                out[-1][1] = high
            else:
                out.append([low, high])
        if out == [[0, len(spans)]]:
            return text
        return "\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in out)

    return pd.Series([cut(t, p) for t, p in zip(texts, runs, strict=True)], dtype=object)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs as the mix takes them: a row for each pass over it, its text cut to the words taken in that pass.

    Other columns stay (n_chars, where there is one, follows the new text). Rows of which nothing is taken go.
    """
    rows = numbered(docs)
    _, _, uses = mix_of(rows, **options)
    runs = uses.groupBy("row_id", "pass").agg(F.collect_list(F.struct("first_word", "n_words")).alias("runs"))
    cut = rows.join(runs, "row_id").select("row", _words_of(F.col("row.text"), F.col("runs")).alias("cut"))
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    return cut.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])

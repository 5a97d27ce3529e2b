"""A corpus pipeline over documents: quality rules, line dedup, near-duplicate join, mixing, BPE encoding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import bpe, jaccard_join, line_dedup, mixing, quality_rules
from marketloom.llm.entries import fertility_files, tokenizer_path
from marketloom.llm.shared import scratch, shared_dir, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.passing(docs, **fertility_files())


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat across documents; n_chars follows the text. Columns of any names keep their values."""
    new = {"text": F.col("line_text"), "n_chars": F.length("line_text").cast("long")}
    own = {c: f"{c} of the document" for c in docs.columns if c.lower().startswith("line_")}
    cut = line_dedup.dedup_lines(docs.withColumnsRenamed(own))
    return cut.select(*[(new[c] if c in new else F.col(f"`{own.get(c, c)}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles at 0.8 hold together."""
    return jaccard_join.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each pass over a document."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of what they decode to."""
    codec = bpe.Bpe(spark, tokenizer_path("byte_bpe_50k.json"))
    rows = docs.select("doc_id", "lang", "source", codec.encode(F.col("text")).alias("ids"))
    rows = rows.withColumn("decoded", codec.decode(F.col("ids")))
    return rows.select("doc_id", "lang", "source", bpe.n_tokens(F.col("ids")).alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", encoded),
]

#: The mix's draws are not for SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of the mixed corpus. A stage's intermediate tables go when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            path = f"{shared_dir(spark)}/marketloom/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

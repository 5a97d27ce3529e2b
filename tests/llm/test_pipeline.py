import collections
import hashlib
import os

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from marketloom.llm import entries, jaccard_join, line_dedup, mixing, quality_rules  # noqa: E402
from marketloom.llm.shared import _scan_of_files, shared_dir  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


WORDS = """river stone garden window morning letter engine winter market silver bridge village shoulder
question doctor minute travel kitchen mountain summer number company picture station evening teacher building
paper island corner forest harbour captain library museum student kingdom machine pattern blanket candle
chimney hammer lantern meadow needle orchard pebble saddle tunnel valley wagon yellow narrow gentle quiet
sudden wooden broken hidden frozen distant ancient modern simple famous empty heavy bright clever honest
nervous patient careful remember wander listen follow gather borrow carry whisper travelled answered opened
closed painted counted measured between against without beneath towards behind because although whenever""".split()


def words(i, n):
    return " ".join(WORDS[int(hashlib.md5(f"{i} {k}".encode()).hexdigest(), 16) % len(WORDS)] for k in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    shared = "This line of more than forty characters stands in many of the documents."
    rows = [(i, f"{words(i, 120)}\n{shared if i < 6 else ''}\n{words(1000 + i, 40)}", "en", f"s{i % 4}", 5) for i in range(24)]
    rows += [(50, rows[9][1], "en", "s1", 5), (51, "too short", "en", "s2", 9), (52, None, None, None, None), (53, "same " * 200, "en", "s1", 1)]
    root = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{root}/documents.parquet")
    return root


def test_stages_one_by_one(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == seen[0].columns, name
        seen.append(docs)
    start, rules, lines, near, mixed, ids = ({} for _ in range(6)), *[d.collect() for d in seen[1:]]
    kept = {r.doc_id for r in quality_rules.quality_rules(seen[0], **entries.fertility_files()).collect() if r.kept}
    assert {r.doc_id for r in rules} == kept and 51 not in kept and 53 not in kept and len(kept) >= 20
    cut = {r.doc_id: r.line_text for r in line_dedup.dedup_lines(seen[1]).collect()}
    assert {r.doc_id: r.text for r in lines} == cut
    assert all(r.n_chars == len(r.text) for r in lines)
    assert sum("stands in many" in r.text for r in lines) <= 1
    groups = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(seen[2]).collect()}
    assert sorted(r.doc_id for r in near) == sorted(set(groups.values())) and not {9, 50} <= set(groups.values())
    taken = collections.Counter()
    for r in mixing.taken_words(*mixing.mix(seen[3])).collect():
        taken[r.doc_id] += r.taken
    got = collections.Counter()
    for r in mixed:
        got[r.doc_id] += len(r.text.split())
    assert got == +taken
    assert sorted(r.decoded_sha256 for r in ids) == sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in mixed)


def test_run_gives_the_same_rows(spark, folder):
    a, b = (sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()) for _ in range(2))
    assert a == b and a


def test_intermediate_tables_go(spark, folder):
    root = f"{shared_dir(spark)}/marketloom"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    kept = corpus_pipeline.run(spark, folder)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before if not x.startswith("marketloom_run_")}
    assert left == {name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES[:-1]} and kept.count() > 0


def test_plain_scans_are_numbered_without_a_copy(spark, folder):
    """Row numbers come from files and places for tables as they are registered; a new Spark whose plans look different fails here."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert _scan_of_files(docs) and _scan_of_files(docs.select("doc_id", "text")) and not _scan_of_files(docs.distinct())


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_extra_columns_of_clashing_names_keep_their_values(spark, folder, tmp_path):
    names = ["line_text", "line_total", "row_id", "row", "kept", "size", "taken", "n_words", "n_shingles", "component_id", "place", "h", "gone", "shard", "slot"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names]).write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        for r in docs.collect():
            assert all(r[n] == f"{n} {r.doc_id}" for n in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count() > 0

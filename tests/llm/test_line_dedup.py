from marketloom.llm.line_dedup import LineRuns, dedup_lines, line_keys

A, B = "A line that is long enough to count as repeated, twice", "another line that is long enough to count, surely yes"


def brute(rows, min_chars, min_docs):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))

    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(d)
    low = lambda d: (d is not None, d or 0)
    gone = {k: max(v, key=low) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if key(x) not in gone or gone[key(x)] == d]
        out.append((d, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def check(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, keeper string")
    got = dedup_lines(docs, **options).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    found = sorted([(r.doc_id, r.line_text, r.line_total, r.line_dropped) for r in got], key=key)
    assert found == sorted(brute(rows, options.get("min_chars", 40), options.get("min_docs", 5)), key=key)


ROWS = [(i, f"{A if i % 2 else '  ' + A.upper() + chr(9)}\nown {i}\n\n{B if i > 4 else ''}") for i in range(9)]
ODD = [(20, None), (21, ""), (22, "\n\n"), (23, "é" * 39), (24, A), (24, A), (24, "else"), (None, A + "\n" + B), (25, "x" * 100_000 + "\n" + A)]


def test_against_brute_force(spark):
    check(spark, ROWS + ODD)


def test_batches_and_levels_do_not_matter(spark):
    for batches, fanout in ((1, 2), (7, 2), (3, 9)):
        check(spark, ROWS + ODD, batches=batches, fanout=fanout)


def test_short_thresholds_and_ties(spark):
    check(spark, [(1, "a\nb"), (2, "a\na"), (3, "c\na"), (3, "b")], min_chars=1, min_docs=2)


def test_empty_table(spark):
    check(spark, [])


def test_clashing_names_and_text_ids(spark):
    names = ["gone", "of_doc", "of_hash", "line_hash_", "h", "pos", "row", "row_id", "keeper", "bit_"]
    rows = [(f"d{i}", t, *range(len(names))) for i, (_, t) in enumerate(ROWS)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, " + ", ".join(f"{n} int" for n in names))
    got = dedup_lines(docs, batches=3)
    assert got.columns == [*docs.columns, "line_text", "line_total", "line_dropped"]
    found = sorted((r.doc_id, r.line_text, r.line_dropped, tuple(r[2 : 2 + len(names)])) for r in got.collect())
    assert found == sorted((d, t, n, tuple(range(len(names)))) for d, t, _, n in brute([(d, t) for d, t, *_ in rows], 40, 5))


def test_a_long_document_that_loses_many_lines(spark):
    many = "\n".join(f"{A} number {k}" for k in range(30_000))
    check(spark, [(i, many) for i in range(5)] + [(9, "x")])


def runs_of(spark):
    keys = lambda rows: line_keys(spark.createDataFrame([(0, *r) for r in rows], "row_id long, doc_id long, text string"), 1).select("h", "doc_id")
    return LineRuns(fanout=2), keys


def test_runs_tell_seen_from_new(spark):
    runs, keys = runs_of(spark)
    runs.add(keys([(9, "a\nb")]))
    assert runs.unseen(keys([(8, "b\nc\nd")])).count() == 2
    runs.add(keys([(8, "b\nc")]))
    runs.add(keys([(7, "b")]))
    assert sorted((r.n_docs, r.keeper) for r in runs.merged().collect()) == [(1, 8), (1, 9), (3, 9)]
    assert [len(x) for x in runs.levels] == [1, 1]


def test_keepers_come_from_the_batch_that_was_first(spark):
    """Not from the largest doc_id: a later batch cannot take a key that a run holds."""
    runs, keys = runs_of(spark)
    runs.add(keys([(3, "a")]))
    runs.add(keys([(8, "a\nb")]))
    runs.add(keys([(None, "c")]))
    assert {(r.n_docs, r.keeper) for r in runs.merged().collect()} == {(2, 3), (1, 8), (1, None)}


def test_no_run_is_shuffled_for_a_batch(spark):
    runs, keys = runs_of(spark)
    runs.add(keys([(9, "a\nb")]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = runs.unseen(keys([(8, "b\nc")]).groupBy("h").count())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan

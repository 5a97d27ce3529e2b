import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import entries, vector_search

SCHEMA = "vec_id long, embedding array<float>, label int, dim string, block string"


def brute(rows, every, k=20):
    """{(query row, rank): (vec_id, score)} by all inner products."""
    rows = [(i, v, np.array(e, float)) for i, (v, e, *_) in enumerate(rows) if v is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    out = []
    for i, v, q in rows:
        if v % every == 0:
            near = sorted((-float((x * q).sum()), w) for j, w, x in rows if j != i and len(x) == len(q))[:k]
            out += [(v, r, w, -s) for r, (s, w) in enumerate(near, 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def recall(got, want):
    """Share of the wanted scores that were found; ties may be met by other vectors."""
    a, b = {}, {}
    for rows, to in ((got, a), (want, b)):
        for q, _, _, s in rows:
            to.setdefault(q, []).append(s)
    hit = sum(sum(s >= min(b[q]) - 1e-12 for s in a.get(q, [])) for q in b)
    return hit / sum(map(len, b.values()))


def clustered(n, dim, seed, scale=False):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((12, dim))
    x = centres[rnd.integers(0, 12, n)] * 0.7 + rnd.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x * (rnd.uniform(0.2, 3, (n, 1)) if scale else 1)


@pytest.mark.parametrize("scale", [False, True])
def test_recall_over_many_blocks(spark, scale):
    x = clustered(3000, 32, 4, scale)
    rows = [(i, [float(np.float32(v)) for v in e], 0, "x", "y") for i, e in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = found(vector_search.search_all(df, F.col("vec_id") % 20 == 0, block=500, part=64, sample=300))
    want = brute(rows, 20)
    assert len(got) == len(want) and recall(got, want) >= 0.95
    exact = {(q, w): s for q, _, w, s in want}
    assert all(abs(exact[q, w] - s) < 1e-12 for q, _, w, s in got if (q, w) in exact)
    assert [(q, r) for q, r, *_ in got] == [(q, r) for q, r, *_ in want]


def test_it_is_a_filter(spark):
    """Most rows of a block are never verified."""
    x = clustered(4000, 64, 5)
    search = vector_search.Search(20, vector_search.FUNCTIONS, vector_search.THRESHOLD, vector_search.REACH, 1)
    row = type("Row", (), search.index_row(np.arange(4000), np.arange(4000), x, 1.0))
    tried = []
    block = search.block(row)
    plain = vector_search.scores
    vector_search.scores = lambda rows, q: tried.append(len(rows)) or plain(rows, q)
    try:
        q = x[::200]
        at = np.c_[q, np.zeros(20)] @ vector_search.functions_of(64, vector_search.FUNCTIONS, 1)
        bounds = np.sort(np.sqrt(np.maximum(0, 2 - 2 * q @ x.T)), axis=1)[:, 21]
        search.nearest(block, q, np.arange(0, 4000, 200), at, bounds, 1.0)
    finally:
        vector_search.scores = plain
    assert sum(tried) < 0.4 * 20 * 4000


def test_odd_rows_copies_and_lengths(spark):
    rnd = np.random.default_rng(6)
    odd = [(0, None), (20, []), (40, [0.0, 0.0, 0.0]), (60, [1.0, None, 2.0]), (80, [float("nan"), 1.0, 1.0]), (100, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    odd += [(i, [1.0, 2.0, 3.0]) for i in range(200, 290)] + [(200, [1.0, 2.0, 3.0])] + [(i, [float(np.float32(v)) for v in rnd.standard_normal(3)]) for i in range(300, 380)]
    odd += [(i, [1.0, float(i)]) for i in range(400, 405)] + [(420, [5.0])]
    rows = [(v, e, 0, "x", "y") for v, e in odd]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(vector_search.search_all(df, F.col("vec_id") % 20 == 0, block=40, sample=1)) == brute(rows, 20)
    got = found(vector_search.search_all(df, F.col("vec_id") % 20 == 0))
    assert recall(got, brute(rows, 20)) >= 0.95 and [x for x in got if x[0] in (220, 240)] == [x for x in brute(rows, 20) if x[0] in (220, 240)]


def test_empty_table(spark):
    assert vector_search.search_all(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


def test_registered_query_against_all_pairs(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got, want = found(entries.QUERIES["op13_vector_search"](spark, "/root/testdata/sf0.01")), brute(rows, 20)
    assert len(got) == len(want) and recall(got, want) >= 0.95

import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from marketloom.llm import line_crf as c


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 5, 2])
    logits, tr = rng.normal(size=lengths.sum()) * 3, rng.normal(size=(2, 2))
    got, pairs, total = c.marginals(logits, lengths, tr)
    at, want, counts, logz = 0, [], np.zeros((2, 2)), 0.0
    for n in lengths:
        e = logits[at : at + n]
        scores = {y: sum((e[i] if y[i] else -e[i]) / 2 for i in range(n)) + sum(tr[a, b] for a, b in zip(y, y[1:])) for y in itertools.product((0, 1), repeat=int(n))}
        z = sum(np.exp(s) for s in scores.values())
        want += [sum(np.exp(s) for y, s in scores.items() if y[i]) / z for i in range(n)]
        for y, s in scores.items():
            for a, b in zip(y, y[1:]):
                counts[a, b] += np.exp(s) / z
        logz += np.log(z)
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, counts) and np.isclose(total, logz)


def made(n=240):
    rows = []
    for i in range(n):
        good = i % 3 > 0
        line = "Plain words make up this line of text, number" if good else "W### a$$$ &&& b*** c%%% x|||"
        rows.append((i, "\n".join(f"{line} {i} {k}" for k in range(1 + i % 7)), int(good)))
    return rows


def test_learns_from_rows_that_are_not_held_out(spark):
    rows = made()
    docs = spark.createDataFrame([(i, t, "src", 0.5) for i, t, _ in rows], "doc_id long, text string, source string, score double")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    flipped = labels.withColumn("quality", F.when(c.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    field, other = c.train(docs, labels), c.train(docs, flipped)
    assert np.array_equal(field.weights, other.weights)
    got = {r.doc_id: r.score for r in c.score(docs, field).collect()}
    held = [(i, q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 30 and np.mean([(got[i] >= 0.7) == q for i, q in held]) > 0.95


def test_odd_texts_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "\n\n"), (3, "x" * 200_000), (None, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    field = c.train(docs, none)
    got = c.score(docs, field).collect()
    assert len(got) == 5 and all(abs(r.score - 0.5) < 1e-9 for r in got)
    assert c.score(docs.limit(0), field).collect() == []
    assert c.train(docs.limit(0), none).weights.sum() == 0


def test_held_out_rule(spark):
    got = spark.range(100).select("id", c.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(c.held_out(F.col("id")).alias("h")).first().h is False


def test_score_is_the_weighted_mean_of_enumerated_marginals(spark):
    rows = made()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    field = c.train(docs, spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int"))
    texts = [rows[0][1], rows[5][1], "Plain words\nW### a$$$\n\nx|| and more words of some length\nend", "one line", "", None]
    want = []
    for text in texts:
        x, w = c.line_features(text)
        e, tr = field._inputs(x, np.array([len(x)])) @ field.weights, field.transitions
        good, z = np.zeros(len(x)), 0.0
        for y in itertools.product((0, 1), repeat=len(x)):
            p = np.exp(sum(e[i] * (y[i] - 0.5) for i in range(len(x))) + sum(tr[a, b] for a, b in zip(y, y[1:])))
            good, z = good + p * np.array(y), z + p
        want.append((good / z * w).sum() / w.sum())
    assert np.allclose(field.scores(texts), want)
    x, w = c.line_features("a long line of several words\nshort")
    assert w[0] > w[1] > 0


def test_a_run_sees_its_true_neighbours():
    x = np.arange(40.0).reshape(10, 4)
    for place in (0, 1, 5, 6, 7, -3, 2**62):
        got, before, after = c.run_of(x, place, 4)
        start = place % 7
        assert (before, after) == (start > 0, start < 6)
        assert np.array_equal(got[int(before) :][:4], x[start : start + 4]) and len(got) == 4 + before + after
    got, *flags = c.run_of(x, 3, 10)
    assert got is x and flags == [False, False]


def test_a_neighbour_only_line_has_no_part_in_the_fit():
    """Rounds of the fit on inner lines alone, whose neighbours are those of the whole text."""
    rng = np.random.default_rng(1)
    whole = rng.normal(size=(6, c.N_BASE))
    field = c.LineField().fit([(whole, 1, True, True), (whole + 2, 0, False, False)], rounds=1)
    inner = np.vstack([whole[1:-1], whole + 2])
    assert np.allclose(field.mean, inner.mean(axis=0))
    z = (whole - field.mean) / field.spread
    seen = c.with_neighbours(z, *c._bounds(np.array([6])))[1:-1]
    assert not seen[:, -3:-1].any() and np.allclose(seen[0, c.N_BASE : 2 * c.N_BASE], z[0])


def test_what_comes_late_in_a_long_text_is_learned(spark):
    """Texts alike in their first lines; only what follows tells the labels apart."""
    same = ["The same plain line of words stands here."] * 30
    rows = [(i, "\n".join(same + (["W### a$$$ &&& b*** c%%% x|||"] * 90 if i % 2 else same * 3)), 1 - i % 2) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(4, "again"), (4, "again")], "doc_id long, text string")
    field = c.train(docs, spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int"), sample_lines=20)
    good, bad = field.scores([rows[0][1], rows[1][1]])
    assert good > 0.8 and bad < 0.5

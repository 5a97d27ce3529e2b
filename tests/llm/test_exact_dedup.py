import hashlib

import pytest

from marketloom.llm.exact_dedup import block_names, exact_dedup

LONG = "ab\n" * 40


def rows_of(spark, rows, schema="doc_id long, text string, name string, level int"):
    return spark.createDataFrame([(*r, "x", 9) for r in rows], schema)


CASES = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, LONG), (6, LONG), (7, LONG + "x"), (8, "x" + LONG), (9, "é😀"), (9, "é😀"), (9, "other"), (None, "a"), (10, "ab" * 7), (11, "ab" * 8), (12, "ab" * 7)]


@pytest.mark.parametrize(("block", "bits"), [(4096, 64), (4, 64), (2, 64), (3, 1), (4, 2)])
def test_against_brute_force(spark, block, bits):
    got = exact_dedup(rows_of(spark, CASES), block=block, hash_bits=bits).collect()
    groups = {}
    for d, t in CASES:
        groups.setdefault(t or "", []).append(d)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(got) == len(CASES)
    names = {}
    for r in got:
        ids = by_hash[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max(i for i in ids if i is not None)
        names.setdefault((r.level, r.name), set()).add(r.text_sha256)
    assert all(len(x) == 1 for x in names.values()) and len(names) == len(by_hash)
    assert sum(r.kept for r in got) == len(by_hash)


def test_names_are_dense_integers(spark):
    got = block_names(rows_of(spark, [(i, str(i % 5)) for i in range(20)])).collect()
    assert sorted({r.name for r in got}) == list(range(5))


def test_empty_table(spark):
    assert exact_dedup(rows_of(spark, [])).collect() == []


def test_very_long_text(spark):
    text = "word " * 200_000
    got = exact_dedup(rows_of(spark, [(1, text), (2, text), (3, text + "!")])).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got) == [(1, 2), (2, 2), (3, 3)]

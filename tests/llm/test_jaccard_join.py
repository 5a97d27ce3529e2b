import random

import numpy as np
import pytest

from marketloom.llm import jaccard_join as j


def brute(rows, percent=80):
    sets = []
    for d, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\v\f\r":
            low = low.replace(c, " ")
        w = [x for x in low.split(" ") if x]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] & sets[k])
            if sets[i] and 100 * both >= percent * (len(sets[i] | sets[k])) and both:
                a, b = group[i], group[k]
                group = [min(a, b) if g in (a, b) else g for g in group]
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if group[k] == group[i] and rows[k][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return out


def made_rows(seed, n=60):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(40)]
    rows = []
    for f in range(n // 6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(6, 120))] + (common if f % 2 else [])
        for k in range(6):
            words = list(base)
            for _ in range(rng.randint(0, 1 + k)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10_000)}"
            rows.append((f * 10 + k, rng.choice([" ", "\n", "\t "]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    rng.shuffle(rows)
    return rows


ODD = [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE two"), (905, "one two three"), (906, "a b c d e"), (906, "a b c d e"), (None, "a b c d E"), (None, "alone here"), (907, "é É"), (908, "é é")]


def check(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, row_id int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in j.near_duplicates(docs, **options).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_against_brute_force(spark):
    check(spark, made_rows(1) + ODD)


@pytest.mark.parametrize("sample", [1, 3, 50])
def test_small_lists_and_other_samples(spark, sample):
    check(spark, made_rows(2, 36), list_block=3, orders=2, sample=sample)


def test_long_texts_and_a_passage_in_all(spark):
    """Texts of 3000 words and near copies of them, and short texts of which a common passage is most."""
    rng = random.Random(4)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for f in range(4):
        base = [f"w{rng.randrange(100_000)}" for _ in range(3000)]
        for k in range(3):
            words = list(base)
            for _ in range(40 + 25 * k):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10_000)}"
            rows.append((f * 10 + k, " ".join(words + passage)))
    for k in range(80):
        own = [f"o{rng.randrange(30)}" for _ in range(rng.randint(5, 20))]
        rows.append((1000 + k, " ".join(passage + own if k % 2 else own[:4] + passage + own[4:])))
    check(spark, rows, list_block=16)


def test_star_without_hub(spark):
    """Siblings that link only through a document that is not the first of any list."""
    base = [f"b{i}" for i in range(200)]
    rows = []
    for k in range(8):
        words = list(base)
        for i in range(3):
            words[(k * 23 + i * 9) % 200] = f"x{k}{i}"
        rows.append((k, " ".join(words)))
    rows.append((50, " ".join(base)))
    check(spark, rows)


def test_empty_table(spark):
    check(spark, [])


def test_one_of_each_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "s"), (2, "a b c d e f", "s"), (3, None, "t"), (3, None, "t")], "doc_id long, text string, comp string")
    got = j.one_of_each(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 3, 3]


def test_rows_keep_their_numbers_when_splits_change(spark, tmp_path, monkeypatch):
    """Sets are made from other splits of the files than what reads them later, as when cores come or go."""
    rows = made_rows(5, 36) + ODD
    spark.createDataFrame(rows, "doc_id long, text string").repartition(9).write.parquet(str(tmp_path / "docs"))
    docs, real = spark.read.parquet(str(tmp_path / "docs")), j.written
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")

    def other_splits(df, label):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700b" if label == "sets" else "1g")
        return real(df, label)

    monkeypatch.setattr(j, "written", other_splits)
    try:
        got = [(r.doc_id, r.n_shingles, r.component_id) for r in j.near_duplicates(docs).collect()]
        kept = [r.doc_id for r in j.one_of_each(docs).collect()]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    # ODD has two rows of 906, and two without an id that link with it and with nothing.
    assert sorted(map(str, kept)) == sorted([str(d) for d in {c for _, n, c in brute(rows) if n} | {900, 901, 902} if d is not None] + ["None"])


@pytest.mark.parametrize("percent", [60, 80, 95])
@pytest.mark.parametrize("sample", [1, 4])
def test_prefixes_of_similar_sets_meet_in_every_order(percent, sample):
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 900))
        a = np.unique(rng.integers(1, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(1, 2**63, int(rng.integers(0, 6))).astype(np.uint64)]))
        common = np.intersect1d(a, b)
        both = len(common)
        # Counted tokens that several sets have: all common ones, and here and there another.
        ranks = {int(t): np.uint64(j.UNCOUNTED + 1 + int(t) % 3) for t in np.concatenate([common, a[::7]])}
        kept = []
        for x in (a, b):
            seen = x[j.counted(x, sample) & np.isin(x, np.fromiter(ranks, np.uint64))]
            kinds = j.classes(x, seen, np.array([ranks[int(t)] for t in seen], np.uint64), sample)
            kept.append(j.prefixes(x, kinds, 3, percent))
        if both and 100 * both >= percent * (len(a) + len(b) - both):
            for x, y in zip(*kept, strict=True):
                assert len(np.intersect1d(x, y))
        x, y = (j.parity_bitmap(s) for s in (a, b))
        size = min(len(x), len(y))
        assert int(np.bitwise_count((j.folded(x, size) ^ j.folded(y, size)).view(np.uint64)).sum()) <= len(a) + len(b) - 2 * both


def test_words_of_structured_letters_differ(spark):
    """Words that polynomial hashes modulo a power of two take for each other."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    assert len(set(map(int, j.word_hashes(f"{word} {other} {word.upper()}".encode())))) == 2
    check(spark, [(1, word[:512]), (2, other[:512]), (3, word), (4, other), (5, word.upper())])


def test_bitmaps_tell_long_sets_apart_and_fold():
    rng = np.random.default_rng(1)
    for n in (600, 3000, 5000, 20000):
        a, b = (np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(2))
        x, y = j.parity_bitmap(a), j.parity_bitmap(b)
        allowed = (len(a) + len(b)) * 20 / 180
        assert np.bitwise_count((x ^ y).view(np.uint64)).sum() > 1.5 * allowed
        near = np.union1d(a[: int(0.9 * n)], b[: int(0.1 * n)])
        z = j.parity_bitmap(near)
        same = min(len(x), len(z))
        assert np.bitwise_count((j.folded(x, same) ^ j.folded(z, same)).view(np.uint64)).sum() <= (len(a) + len(near)) - 2 * len(np.intersect1d(a, near))
    half = j.folded(j.parity_bitmap(a), len(x) // 2)
    bits = np.bincount((j.mixed(a, 4) >> np.uint64(20)).astype(np.int64) & (len(half) * 64 - 1), minlength=len(half) * 64) & 1
    assert (half == np.packbits(bits.astype(np.uint8)).view(np.int64)).all()


def test_long_documents_that_share_a_passage(spark):
    """Of ten long documents with one passage, no pair of different ones is emitted; near copies of one of them are found."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(600)]
    rows = [(d, " ".join([*passage, *(f"w{d}x{i}" for i in range(4400))])) for d in range(10)]
    words = rows[3][1].split()
    rows += [(20 + k, " ".join(w if rng.random() > 0.005 else f"n{k}" for w in words)) for k in range(3)]
    check(spark, rows)

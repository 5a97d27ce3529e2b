import collections
import random

import numpy as np
import pytest

from marketloom.llm import mixing as m


def brute_targets(sizes, weights=(5, 2, 1), percent=150, passes=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, free = sum(sizes.values()) * percent / 100, {}, set(names)
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > passes * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = passes * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")


def made(seed=1, n=120):
    rng = random.Random(seed)
    rows = [(i, " ".join(f"w{k}" for k in range(rng.randint(0, 400))), rng.choice(["a", "a", "a", "b", "c", "Z", None, "é", "dd"])) for i in range(n)]
    return rows + [(500, None, "a"), (501, "", "b"), (502, " \n", "only-empty"), (7, "dup row here", "a"), (7, "dup row here", "a"), (None, "no id", "c"), (600, "long " * 60_000, "big")]


@pytest.mark.parametrize("block", [16, 256])
def test_targets_and_taken(spark, block):
    rows = made()
    stream, targets, uses = m.mix(docs_of(spark, rows), block=block, slots_per_shard=64)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    for r in targets.collect():
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + r.target)
    got = m.taken_words(stream, targets, uses).collect()
    assert len(got) == len(rows) and sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _, _ in rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    by = collections.Counter()
    source = {r.row_id: r.source for r in stream.collect()}
    for r in got:
        by[source[r.row_id]] += r.taken
    for s, t in want.items():
        assert abs(by[s] - t) <= 0.5 + 1e-6
    again = m.taken_words(*m.mix(docs_of(spark, rows), block=block, slots_per_shard=64)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_slots_fill_blocks_once_in_a_pass(spark):
    _, _, uses = m.mix(docs_of(spark, made()), block=16, slots_per_shard=64)
    rows = uses.collect()
    assert len({(r.row_id, r.block_index, r["pass"]) for r in rows}) == len(rows)
    assert {r["pass"] for r in rows} <= {0, 1}
    filled = collections.Counter((r.source, r.shard, r.slot) for r in rows for _ in range(r.n_words))
    assert max(filled.values()) <= 16


def test_small_sources_get_their_target_to_a_word(spark):
    rows = [(i, " ".join(["w"] * n), f"s{n:04d}") for i, n in enumerate([*range(1, 30), 100, 255, 256, 257, 300, 511, 512, 513, 699, 700])]
    stream, targets, uses = m.mix(docs_of(spark, rows))
    want = brute_targets({s: len(t.split()) for _, t, s in rows})
    got = m.taken_words(stream, targets, uses).join(stream.select("row_id", "source"), "row_id").collect()
    assert len(got) == len(rows) and all(abs(r.taken - want[r.source]) <= 0.5 + 1e-6 and r.taken <= 2 * r["size"] for r in got)


def test_sources_are_placed_in_order_over_ranges(spark):
    names = [f"n{i % 97}" for i in range(150)] + [None, "", "Z", "é", "a"]
    got = {r.source: r.place for r in m._placed(spark.createDataFrame([(s, 1) for s in set(names)], "source string, source_size long")).collect()}
    want = sorted((s for s in set(names) if s is not None), key=lambda s: s.encode()) + [None]
    assert sorted(got, key=got.get) == want and sorted(got.values()) == list(range(len(want)))


def test_packed_blocks(spark):
    """Blocks hold the words of their source's stream, whole but for the short one and the last slot."""
    rows = [(i, " ".join(f"d{i}_{k}" for k in range(n)), "ab"[i % 2]) for i, n in enumerate([5, 40, 0, 17, 333, 64, 1, 90])]
    got = m.mixed_blocks(docs_of(spark, rows), block=16, slots_per_shard=8).collect()
    stream, _, uses = m.mix(docs_of(spark, rows), block=16, slots_per_shard=8)
    words = collections.defaultdict(list)
    for r in sorted(stream.collect(), key=lambda r: r.start):
        words[r.source] += (rows[r.doc_id][1] or "").split()
    short = collections.Counter()
    for r in got:
        whole = words[r.source][r.block_index * 16 : r.block_index * 16 + 16]
        assert r.words == whole[: r.n_words] and len(r.words) == r.n_words
        short[r.source] += r.n_words < 16
    assert all(n <= 3 for n in short.values())
    assert sum(r.n_words for r in got) == sum(r.n_words for r in uses.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection(n):
    assert sorted(m.permuted(np.arange(n), n, 12345)) == list(range(n))
    assert n < 7 or list(m.permuted(np.arange(n), n, 1)) != list(m.permuted(np.arange(n), n, 2))


def test_mixed_documents(spark):
    rows = made(3, 60)
    docs = docs_of(spark, rows)
    got = m.mixed_documents(docs, block=16)
    assert got.columns == docs.columns
    stream, targets, uses = m.mix(docs, block=16)
    taken = collections.Counter()
    for r in m.taken_words(stream, targets, uses).collect():
        taken[r.doc_id] += r.taken
    words = collections.Counter()
    for r in got.collect():
        words[r.doc_id] += len(r.text.split())
    assert words == +taken
    whole = collections.defaultdict(set)
    for d, t, _ in rows:
        whole[d] |= set((t or "").split())
    assert all(set(r.text.split()) <= whole[r.doc_id] for r in got.collect())


def test_empty_table(spark):
    stream, targets, uses = m.mix(docs_of(spark, []))
    assert m.taken_words(stream, targets, uses).collect() == [] and m.mixed_documents(docs_of(spark, [])).collect() == []

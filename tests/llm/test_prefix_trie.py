import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from marketloom.llm import entries, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, owner string"


def brute(rows, base=lambda c: c, head=lambda c: 0):
    """Nodes by whole prefixes as keys."""
    convs = {}
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(conv_id, []).append((turn is not None, turn or 0, role, digest, text))
    for turns in convs.values():
        turns.sort()
    made = {c: [(r, x) for *_, r, _, x in convs.get(base(c), [])[: head(c)] + turns[head(c) :]] for c, turns in convs.items()}
    members, ends = {}, {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = set()
    for node, cs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) > len(x) and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        out.add((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children), len(leaves), saved, sha))
    return out


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    rows = [tuple(r) for r in df.select(*NAMES).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_whole_prefixes(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-20, 9000), 60):
        for t in range(rnd.randint(1, 6)):
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "bé", ""]), "x", "y"))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(prefix_trie.trie(df)) == brute(rows)
    base, head = F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    cut = lambda c: c - (abs(c) % 5) * (1 if c >= 0 else -1)
    assert found(prefix_trie.trie(df, base=base, head=head)) == brute(rows, cut, lambda c: zlib.crc32(str(c).encode()) % 9)


def test_nulls_ties_repeats_and_a_hot_conversation(spark):
    rows = [(None, 0, "user", "lost", "", ""), (1, None, None, None, "", ""), (1, 0, "user", "hi", "", ""), (1, 0, "user", "hi", "", ""), (1, 0, "assistant", "hi", "", "")]
    rows += [(c, t, "user", f"q{t}", "", "") for c in range(100, 5300, 2) for t in range(2)]
    rows += [(7, t, "user", "long " * (t % 3), "", "") for t in range(700)]
    assert found(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_turnless_conversation_ends_at_the_root(spark):
    rows = [(3, 0, "user", "own turn that goes", "", ""), (5, 0, "user", "x", "", "")]
    got = found(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), base=F.lit(99).cast("long"), head=F.lit(1)))
    assert got == {(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,5").hexdigest())}


def test_registered():
    assert "op11_prefix_trie" in entries.QUERIES and "op11_prefix_trie" in entries.SQL

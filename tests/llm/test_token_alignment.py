import collections
import hashlib
import random

import pytest

from marketloom.llm import token_alignment
from marketloom.llm.entries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, chunk string, slot string"


@pytest.fixture(scope="module")
def sides():
    return token_alignment.ByteLevel(A), token_alignment.Pieces(B)


def brute(docs, sides):
    """Every document by itself: whole texts encoded, all pairs of tokens whose bytes overlap."""
    a, b = sides
    spans = lambda side, ids: [(sum(map(len, x[:i])), len(x[i])) for x in [[side.pieces[j].as_py() for j in ids]] for i in range(len(ids))]
    made, counts = [], collections.Counter()
    for doc_id, text in docs:
        if not text:
            made.append((doc_id, None))
            continue
        whole = " " + text
        ia, ib = a.encode_many([whole])[0], b.model.encode(text)
        said = [b"".join(side.pieces[j].as_py() for j in ids) for side, ids in ((a, ia), (b, ib))]
        if said != [whole.encode()] * 2:
            made.append((doc_id, None))
            continue
        sa, sb = spans(a, ia), spans(b, ib)
        links = [(i, j) for i, (x, n) in enumerate(sa) for j, (y, m) in enumerate(sb) if x < y + m and y < x + n]
        counts.update((ia[i], ib[j]) for i, j in links)
        ends = sorted({x + n for x, n in sa} & {y + m for y, m in sb})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(t) for t, (x, n) in zip(ids, s) if low < x + n <= e) for ids, s in ((ia, sa), (ib, sb))))
            low = e
        made.append((doc_id, (ia, ib, links, groups)))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for doc_id, x in made:
        if x is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        ia, ib, links, groups = x
        ns = [(counts[ia[i], ib[j]], best[ib[j]]) for i, j in links]
        out.append((doc_id, len(ia), len(ib), len(groups), len(links), sum(n == m for n, m in ns), sum(n for n, _ in ns), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = ["", None, " ", "   ", "\n", "a", " a", "a ", "a  b   c\n\n d\t e ", "don't we'll it's", "<|endoftext|> </s> <s>", "x▁y ▁", " a  b　 c", "é   é", "日本語のテキスト 漢字", "😀 👩‍👩‍👧 x", "a\x00b \x00", "\u0085 x   y", "12345 3.14159", "word\n next\r\n  more", "ß" * 300, "<0x41> <unk>", " ​ a"]


def test_odd_texts(spark, sides):
    docs = list(enumerate([*ODD, *ODD[3:9]]))
    df = spark.createDataFrame([(i, t, None, "x", "y") for i, t in docs], SCHEMA)
    assert found(token_alignment.align(df, A, B)) == brute(docs, sides)


def test_random_texts_in_small_chunks(spark, sides):
    rnd = random.Random(3)
    alphabet = ["the", "Haus", " ", " ", " ", "\n", "ing", "é", "über", "1", "23", ".", ",", " ", " ", "я", "字", "-", "'s", "\t", "of"]
    docs = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    docs += [(7, docs[7][1]), (None, "no id"), (500, "again and again " * 300)]
    df = spark.createDataFrame([(i, t, "en", "x", "y") for i, t in docs], SCHEMA).repartition(3)
    want = brute(docs, sides)
    assert found(token_alignment.align(df, A, B, chunk_bytes=700)) == want
    assert found(token_alignment.align(df, A, B)) == want


def test_tables(spark):
    none = token_alignment.align(spark.createDataFrame([], SCHEMA), A, B)
    assert none.collect() == []
    only = token_alignment.align(spark.createDataFrame([(1, None, "en", "x", "y"), (2, "", "en", "x", "y")], SCHEMA), A, B)
    assert found(only) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_pieces_are_encoded_as_in_their_texts(sides):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice([" ", " ", "\n", "a", "bc", "é", " ", "'t", "7", "!", " "]) for _ in range(rnd.randint(1, 40))) for _ in range(2000)]
    pieces, first = token_alignment.pieces_of(texts)
    ids = [token_alignment.encode_pieces(s, pieces) for s in sides]
    for side, (flat, at, _) in zip(sides, ids):
        whole = side.encode_many([" " + t for t in texts])
        assert [list(flat[at[first[i]] : at[first[i + 1]]]) for i in range(len(texts))] == whole

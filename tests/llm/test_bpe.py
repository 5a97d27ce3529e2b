import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketloom.llm import bpe
from marketloom.llm.entries import tokenizer_path


@pytest.fixture(scope="module")
def both():
    path = tokenizer_path("byte_bpe_50k.json")
    return bpe.Codec(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)


PARTS = ["a", "aa", "é", "ß", " ", "  ", "\n", "\t", "'s", "'ll", "the", "1", "23", "***", "\x85", "\xa0", "\x1c", "中文", "😀", "<|endoftext|>", "<|endof", "\r\n", "İ", "ing", "\x00", "　", "x" * 30, "=", "===", "é", "﻿", "ſ", "½", "_"]


def same(both, text):
    codec, library = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert list(bpe.id_array(codec.encode(text))) == ids
    assert codec.decode(codec.encode(text)) == library.decode(ids, skip_special_tokens=False) == text


def test_joined_parts(both):
    rng = random.Random(4)
    for _ in range(4000):
        same(both, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    same(both, text)


def test_small_caches(both, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 4)
    monkeypatch.setattr(bpe, "MAX_WORDS", 4)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 2)
    codec = bpe.Codec(open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8").read())
    for _ in range(2):
        same((codec, both[1]), "Thousands of different words go through caches that hold almost nothing, again and again.")


def test_every_token_is_sound(both):
    assert len(both[0].whole) == 50256


def test_columns(spark, both):
    texts = [None, "", "hello world", "hello world", "x" * 5000, "é " * 20_000, "<|endoftext|>a"]
    docs = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(texts)], "doc_id long, text string, ids binary")
    codec = bpe.Bpe(spark, tokenizer_path("byte_bpe_50k.json"))
    made = docs.select("doc_id", codec.encode(F.col("text")).alias("e"))
    got = made.select("doc_id", "e", codec.decode(F.col("e")).alias("d"), bpe.n_tokens(F.col("e")).alias("n")).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        ids = both[1].encode(t or "", add_special_tokens=False).ids
        assert np.array_equal(bpe.id_array(bytes(r.e)), ids) and r.d == (t or "") and r.n == len(ids)
    assert docs.limit(0).select(codec.encode(F.col("text"))).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="pre_tokenizer"):
        bpe.Codec(open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8").read())
    spec = json.loads(open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8").read())
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}, {"model": spec["model"] | {"ignore_merges": True}}, {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}):
        with pytest.raises(ValueError, match="byte-level"):
            bpe.demand_byte_level(spec | change)
    bpe.demand_byte_level(spec)

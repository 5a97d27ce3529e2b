"""Exact byte-level BPE by dynamic programming over prefixes, and its decoding.

Every prefix of a pre-token has one last token: the longest suffix of the prefix that is
a token and that may stand after the last token of what is before it. An automaton over
the vocabulary (with suffix links) gives the tokens that end at each place; a pair test
on the merge tree says which two tokens stay apart when merges run in order of rank. The
back-pointers from the whole pre-token then give its ids. A worker keeps the ids of
pre-tokens, and of what stands between spaces, in caches of bounded size.
"""

from __future__ import annotations

import json

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .shared import worker_state

#: White space of the pre-tokenizer's pattern (Unicode White_Space), and the pattern itself: fixed values.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"

#: Bounds of a worker's caches.
MAX_PIECES, MAX_WORDS, MAX_PAIRS = 400_000, 600_000, 300_000
#: What often ends a word; none is white space, a letter or a number.
ENDINGS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, the rest follow from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Irregular(Exception):
    """A piece whose pre-tokens depend on its neighbours."""


class TwoAges(dict):
    """A cache that forgets what was not asked for since it was last half full."""

    def __init__(self, make, most: int):
        self.make, self.half, self.old = make, most // 2, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


def demand_byte_level(spec: dict) -> None:
    """Raise if a vocabulary file asks for anything but plain byte-level BPE, which it would be encoded wrongly by."""
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    wrong = [name for name in ("normalizer",) if spec.get(name)]
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        wrong.append("pre_tokenizer")
    if (spec.get("decoder") or {}).get("type") != "ByteLevel":
        wrong.append("decoder")
    if model.get("type", "BPE") != "BPE":
        wrong.append("model")
    wrong += [name for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(name)]
    wrong += [f"{name} of {token['content']!r}" for token in spec.get("added_tokens", []) for name in ("single_word", "lstrip", "rstrip", "normalized") if token.get(name)]
    if wrong:
        raise ValueError(f"not a plain byte-level BPE vocabulary: {', '.join(wrong)}")


class Codec:
    """Encoder and decoder of a byte-level BPE vocabulary file's content (JSON of the tokenizers library)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        demand_byte_level(spec)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of = {i: raw(s) for s, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        size = max(self.bytes_of) + 1
        self.table = [self.bytes_of.get(i, b"") for i in range(size)]
        self.sizes = list(map(len, self.table))
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.made, self.left, self.right, self.rank = [-1] * size, [0] * size, [0] * size, {}
        for r, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.made[k], self.left[k], self.right[k], self.rank[i, j] = r, i, j, r
        self.apart: dict[int, bool] = {}
        # Tokens that their own bytes do not lead to never occur.
        sound = {i for s, i in vocab.items() if len(raw(s)) == 1}
        for _, k in sorted((r, k) for k, r in enumerate(self.made) if r >= 0):
            a, b = self.left[k], self.right[k]
            if a in sound and b in sound and self._stay_apart(a, b, self.made[k]):
                sound.add(k)
        self.whole = {self.bytes_of[i].decode("latin-1"): i for i in sound}
        self.ends = ahocorasick.Automaton()
        for s, i in self.whole.items():
            self.ends.add_word(s, (len(s), i))
        self.ends.make_automaton()
        self.space = regex.compile(f"[{WHITE}]")
        self.find = regex.compile(PRETOKEN).findall
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = TwoAges(self.word_ids, MAX_WORDS)
        self.pieces = TwoAges(self.piece_ids, MAX_PIECES)

    def _stay_apart(self, a: int, b: int, limit: float = float("inf")) -> bool:
        """Whether no merge across the border of a and b comes before the merges that made them.

        Undo the later of the two tokens' merges, again and again; of equal merges the left
        one runs first. limit: the rank below which a merge across would have run.
        """
        made = self.made
        while True:
            if self.rank.get((a, b), limit) < limit:
                return False
            if made[a] > made[b]:
                limit, a = made[a], self.right[a]
            elif made[b] < 0:
                return True
            else:
                limit, b = made[b] + 1, self.left[b]

    def word_ids(self, word: str) -> bytes:
        """Ids of one pre-token, packed."""
        word = word.encode().decode("latin-1")
        one = self.whole.get(word)
        if one is not None:
            return self.packed[one]
        apart, n, known = self.apart, len(word), 0
        if len(apart) > MAX_PAIRS:
            apart.clear()
        last = [0] * (n + 1)  # the last token of each prefix
        for end, (size, token) in self.ends.iter(word):  # longest first at each end
            if end < known:
                continue
            if size <= end:
                pair = last[end + 1 - size] << 32 | token
                ok = apart.get(pair)
                if ok is None:
                    ok = apart[pair] = self._stay_apart(pair >> 32, token)
                if not ok:
                    continue
            known = end + 1
            last[known] = token
        out, sizes, packed = [], self.sizes, self.packed
        while n:
            token = last[n]
            out.append(packed[token])
            n -= sizes[token]
        out.reverse()
        return b"".join(out)

    def piece_ids(self, piece: str) -> bytes:
        """Packed ids of what stands between two single spaces, with the first space."""
        stem = piece.rstrip(ENDINGS)
        if stem.isalpha():
            ids = self.words[" " + stem]
            return ids + self.words[piece[len(stem) :]] if len(stem) < len(piece) else ids
        if not piece or self.space.match(piece):
            raise Irregular
        return self.pattern_ids(" " + piece)

    def pattern_ids(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.find(text)))

    def _plain_ids(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            return self.pattern_ids(first) + b"".join(map(self.pieces.__getitem__, rest))
        except Irregular:
            return self.pattern_ids(text)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.at_special is not None and any(s in text for s in self.special):
            parts = self.at_special.split(text)
            return b"".join(self.packed[self.special[p]] if p in self.special else self._plain_ids(p) for p in parts)
        return self._plain_ids(text)

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", errors="replace")


def _codec(content) -> Codec:
    """The worker's codec of a broadcast vocabulary."""
    key, text = content.value
    return worker_state(("bpe", key), lambda: Codec(text))


class Bpe:
    """Columns that encode and decode with the vocabulary file at path, which the driver reads (a file of fixed size)."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as f:
            content = f.read()
        demand_byte_level(json.loads(content))
        self.content = spark.sparkContext.broadcast((hash(content), content))

    def encode(self, text: Column) -> Column:
        """Token ids as little-endian unsigned 32-bit integers in one binary value. Null text: no ids."""
        content = self.content

        @F.pandas_udf("binary")
        def encode(texts: pd.Series) -> pd.Series:
            codec = _codec(content)
            return pd.Series(list(map(codec.encode, texts)), dtype=object)

        return encode(text)

    def decode(self, ids: Column) -> Column:
        """The text of encode()'s binary values; bytes that are no UTF-8 become U+FFFD. Null: null."""
        content = self.content

        @F.pandas_udf("string")
        def decode(values: pd.Series) -> pd.Series:
            codec = _codec(content)
            return pd.Series([None if v is None else codec.decode(v) for v in values], dtype=object)

        return decode(ids)


def n_tokens(ids: Column) -> Column:
    return (F.length(ids) / 4).cast("long")


def id_array(ids: np.ndarray | bytes) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u4")

"""Quality rules from tokeniser fertility: how well public vocabularies fit a text.

Measures of a whole text: characters per token of a byte-level BPE, entropy of its token
counts, and the share of its UTF-8 bytes that a vocabulary with byte fallback can only
write byte by byte. That share is by the vocabulary's set of characters: a text is not
encoded by it, and the six ASCII spaces count as known though some are written as bytes,
so that a text of many lines is not rejected for its line ends. Bands for each language (by its script where the language is not
listed) say which values pass. The counting rules of the base come first.
"""

from __future__ import annotations

import base64
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import worker_state

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_PIECES = 300_000


@dataclass(frozen=True)
class Band:
    """Least and most characters per token, most byte fallback; bounds are inclusive."""

    chars_low: float
    chars_high: float
    fallback_high: float


#: Bands by language, then by script. Prose in a language that the vocabulary knows little of
#: comes to about two characters a token; text of symbols, codes or broken encodings to less.
LANGUAGE_BANDS = {
    "en": Band(2.30, 8.0, 0.2),
    "de": Band(2.12, 8.0, 0.2),
    "fr": Band(1.93, 8.0, 0.2),
    "es": Band(1.87, 8.0, 0.2),
}
SCRIPT_BANDS = {
    "latin": Band(1.7, 9.0, 0.3),
    "cyrillic": Band(0.8, 6.0, 0.3),
    "other": Band(0.25, 9.0, 0.9),
}
#: (tokens from, least entropy in bits): short texts have fewer different tokens.
ENTROPY_FLOORS = ((100, 5.3), (400, 5.8), (1000, 6.15))

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, n_tokens long, chars_per_token double, byte_fallback_share double, token_entropy double, kept boolean"
COLUMNS = [x.split()[0] for x in MEASURES.split(", ")]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, upto = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(i, upto)
            upto = i + 3
    return total


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    words = text.encode().split()  # bytes split at exactly the six ASCII spaces
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


class Vocabularies:
    """The worker's tokenisers: a rank file for fertility and entropy, a byte-fallback model for coverage."""

    def __init__(self, ranks: bytes, pattern: str, model: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("fertility", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.known = {c for i in range(pieces.get_piece_size()) if not pieces.is_byte(i) for c in pieces.id_to_piece(i)} | set(SPACES)
        self.seen: dict[str, bytes] = {}
        self.irregular = regex.compile(r"\s\s|^\s|\s$| \n").search

    def token_ids(self, text: str) -> np.ndarray:
        """As encode_ordinary; what stands between single spaces is looked up, each piece with the space before it."""
        encode, seen = self.encoding.encode_ordinary, self.seen
        if self.irregular(text):
            return np.array(encode(text), dtype=np.uint32)
        if len(seen) > MAX_PIECES:
            seen.clear()
        first, *rest = text.split(" ")
        for piece in set(rest).difference(seen):
            seen[piece] = array("I", encode(" " + piece)).tobytes()
        return np.frombuffer(array("I", encode(first)).tobytes() + b"".join(map(seen.__getitem__, rest)), dtype=np.uint32)

    def fallback_bytes(self, text: str) -> int:
        return sum(text.count(c) * len(c.encode()) for c in set(text) - self.known)


def _band(lang: str | None, text: str) -> Band:
    if lang in LANGUAGE_BANDS:
        return LANGUAGE_BANDS[lang]
    letters = len(regex.findall(r"\p{L}", text)) or 1
    for script in ("latin", "cyrillic"):
        if 2 * len(regex.findall(rf"\p{{Script={script}}}", text)) > letters:
            return SCRIPT_BANDS[script]
    return SCRIPT_BANDS["other"]


def measure(text: str | None, lang: str | None, vocabularies: Vocabularies) -> tuple:
    """The row of MEASURES for one text. Null is empty; without tokens the method has no say and entropy is 0."""
    text = text or ""
    words, word_chars, symbols, dup_lines, repeats = base_counts(text)
    failed = words < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * words
    counts = np.unique(vocabularies.token_ids(text), return_counts=True)[1]
    n = int(counts.sum())
    shares = counts / max(n, 1)
    entropy = float(-(shares * np.log2(shares)).sum()) if n else 0.0
    chars = len(text) / n if n else 0.0
    fallback = vocabularies.fallback_bytes(text) / max(1, len(text.encode()))
    kept = not failed
    if kept:
        band = _band(lang, text)
        floor = max((bits for least, bits in ENTROPY_FLOORS if n >= least), default=0.0)
        kept = band.chars_low <= chars <= band.chars_high and fallback <= band.fallback_high and entropy >= floor
    return words, word_chars, symbols, dup_lines, repeats, failed, n, chars, fallback, entropy, kept


def measures(spark: SparkSession, text: Column, lang: Column, *, ranks: str, pattern: str, model: str) -> Column:
    """A struct column of MEASURES. ranks, model: paths of vocabulary files (of fixed size) that the driver reads."""
    with open(ranks, "rb") as f, open(model, "rb") as g:
        files = f.read(), pattern, g.read()
    content = spark.sparkContext.broadcast((hash(files), files))

    @F.pandas_udf(MEASURES)
    def measured(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        key, parts = content.value
        held = worker_state(("fertility", key), lambda: Vocabularies(*parts))
        return pd.DataFrame([measure(t, x, held) for t, x in zip(texts, langs, strict=True)], columns=COLUMNS)

    return measured(text, lang)


def quality_rules(docs: DataFrame, *, ranks: str, pattern: str, model: str) -> DataFrame:
    """doc_id and the measures of every row; rows of repeated or null doc_ids each have their own."""
    column = measures(docs.sparkSession, F.col("text"), F.col("lang"), ranks=ranks, pattern=pattern, model=model)
    return docs.select("doc_id", column.alias("measured")).select("doc_id", "measured.*")


def passing(docs: DataFrame, *, ranks: str, pattern: str, model: str) -> DataFrame:
    """The rows of docs that are kept, with their columns."""
    column = measures(docs.sparkSession, F.col("text"), F.col("lang"), ranks=ranks, pattern=pattern, model=model)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), column.alias("measured")).where("measured.kept").select("row.*")

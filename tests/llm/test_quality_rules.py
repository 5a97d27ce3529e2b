import collections
import math
import re
import unicodedata

import numpy as np
import pytest
import sentencepiece
import tiktoken

from marketloom.llm import quality_rules as q
from marketloom.llm.entries import fertility_files


@pytest.fixture(scope="module")
def files():
    return fertility_files()


TEXTS = [
    None,
    "",
    " \n\t",
    "one",
    "the cat sat on the mat " * 12,
    "word\x1cword\x85 nbsp\xa0word " * 30,
    "\n".join(["Same line here.", "Same line here.", "  ", "  ", "Same line here. "] * 3),
    "#*$%&|<> a|b <tag> 100% $5 " * 20,
    " ".join(f"w{i} of many" for i in range(60)),
    "Ünïcödé 中文 😀 слово " * 20,
    "a b c a b c x y z " + " ".join(f"t{i}" for i in range(60)),
    " ".join(f"distinct{i}" for i in range(30_000)),
]


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def test_base_counts():
    for t in TEXTS:
        assert q.base_counts(t or "") == brute_base(t)


def test_measures_against_the_libraries(spark, files):
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, kept int")
    got = {r.doc_id: r for r in q.quality_rules(docs, **files).collect()}
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(files["ranks"], "rb"))}
    enc = tiktoken.Encoding("t", pat_str=files["pattern"], mergeable_ranks=ranks, special_tokens={})
    sp = sentencepiece.SentencePieceProcessor(model_file=files["model"])
    for i, t in enumerate(TEXTS):
        r, ids = got[i], enc.encode_ordinary(t or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_base(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.n_tokens == len(ids)
        counts = collections.Counter(ids).values()
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts) if ids else 0
        assert abs(r.token_entropy - entropy) < 1e-9
        assert abs(r.chars_per_token - (len(t) / len(ids) if ids else 0)) < 1e-12
        unknown = sum(len(c.encode()) for c in t or "" if c not in q.SPACES and any(sp.is_byte(x) for x in sp.encode(c)))
        assert abs(r.byte_fallback_share - unknown / max(1, len((t or "").encode()))) < 1e-12
        assert not (r.base_failed and r.kept)


GOOD = "The quick brown fox jumps over the lazy dog while seven wizards boldly mix strange potions near an old stone bridge, and nobody in town quite remembers who built it or why the river turned away from the mill one winter night long before the railway came to this quiet valley in the north."


def test_bands(files):
    v = q.Vocabularies(open(files["ranks"], "rb").read(), files["pattern"], open(files["model"], "rb").read())
    assert q.measure(GOOD, "en", v)[-1]
    assert q.measure(GOOD, None, v)[-1]
    assert not q.measure(" ".join(f"{w}###" for w in GOOD.split()).replace("e", "$%"), "en", v)[-1]


def test_passing_keeps_rows_and_columns(spark, files):
    docs = spark.createDataFrame([(1, GOOD, "en", 5), (2, "short", "en", 6)], "doc_id long, text string, lang string, measured int")
    got = q.passing(docs, **files)
    assert got.columns == docs.columns and [(r.doc_id, r.measured) for r in got.collect()] == [(1, 5)]
    assert q.passing(docs.limit(0), **files).count() == 0


def brute_band(lang, text):
    if lang in q.LANGUAGE_BANDS:
        return q.LANGUAGE_BANDS[lang]
    letters = [c for c in text if unicodedata.category(c).startswith("L")]
    for script in ("LATIN", "CYRILLIC"):
        if 2 * sum(unicodedata.name(c, "").startswith(script) for c in letters) > max(1, len(letters)):
            return q.SCRIPT_BANDS[script.lower()]
    return q.SCRIPT_BANDS["other"]


def test_verdict_against_brute_force(spark, files):
    good = [GOOD, GOOD.upper(), GOOD[::-1], GOOD.replace(" ", "  "), " ".join(f"Привет мир номер {i} далеко" for i in range(40)), " ".join("".join(chr(0x4E00 + (37 * i + j) % 4000) for j in range(5)) for i in range(80))]
    texts = [(t, lang) for t in [*TEXTS, *good] for lang in ("en", "de", "xx", None)]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string")
    verdicts = set()
    for r in q.quality_rules(docs, **files).collect():
        text, lang = texts[r.doc_id]
        band = brute_band(lang, text or "")
        floor = 6.15 if r.n_tokens >= 1000 else 5.8 if r.n_tokens >= 400 else 5.3 if r.n_tokens >= 100 else 0
        fits = band.chars_low <= r.chars_per_token <= band.chars_high and r.byte_fallback_share <= band.fallback_high and r.token_entropy >= floor
        assert r.kept == (not r.base_failed and fits)
        verdicts.add((r.base_failed, r.kept))
    assert verdicts == {(True, False), (False, False), (False, True)}


class Fixed:
    """A vocabulary that gives a set number of tokens, of different kinds, and of bytes without a piece."""

    def __init__(self, n, kinds, unknown=0):
        self.ids, self.unknown = np.arange(n) % kinds, unknown

    def token_ids(self, text):
        return self.ids

    def fallback_bytes(self, text):
        return self.unknown


def test_bounds_are_inclusive():
    text = " ".join(f"word{i:05d}" for i in range(230)) + "."
    assert len(text) == 2300
    kept = lambda lang, *v: q.measure(text, lang, Fixed(*v))[-1]
    assert kept("en", 1000, 1000) and not kept("en", 1001, 1001)
    assert kept("en", 1000, 1000, 460) and not kept("en", 1000, 1000, 461)
    assert kept("en", 320, 40) and not kept("en", 320, 32) and not kept("en", 287, 287)
    assert kept("es", 512, 64) and not kept("es", 1024, 64) and kept("es", 1024, 128)

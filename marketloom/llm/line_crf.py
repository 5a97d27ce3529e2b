"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own and its neighbours' features; forward and
backward passes give each line's marginal, and a document's score is the mean of P(good)
weighted by line length. Labels are known for whole documents only; in training, every
line of a document has its document's label.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The field is fitted on so many labelled documents at most, those of least hash, and on a run of so many lines of each at most.
SAMPLE_DOCS = 2000
SAMPLE_LINES = 256
ROUNDS = 250
L2 = 1e-3

_CLASSES = [b"#*$%&|<>", b"!?", b".,;:", b"0123456789", bytes(range(65, 91)), bytes(range(128, 256)), b" \t\n\v\f\r", b"-_/\\=+~^@(){}[]\"'"]
N_BASE = len(_CLASSES) + 8


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) of the lines of a text: one row per line. Null and empty texts are one empty line."""
    lines = [x.encode() for x in (text or "").split("\n")]
    times = Counter(lines)
    rows, weights = [], []
    for b in lines:
        n = len(b)
        words = b.split()
        k = len(words)
        shares = [(n - len(b.translate(None, c))) / n for c in _CLASSES] if n else [0.0] * len(_CLASSES)
        rows.append(
            (
                *shares,
                min(n, 2000) ** 0.5 / 45,
                float(n == 0),
                len(set(words)) / k if k else 1.0,
                min(k, 400) ** 0.5 / 20,
                min((n - k + 1) / k, 20) / 20 if k else 0.0,
                float(b[-1:] in (b".", b"!", b"?")),
                float(times[b] > 1 and k > 0),
                float(k < 3),
            )
        )
        weights.append(n + 1.0)
    return np.array(rows, dtype=np.float64), np.array(weights)


def with_neighbours(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features and a one; first, last: flags of lines that have no neighbour there."""
    before, after = np.roll(x, 1, axis=0), np.roll(x, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.hstack([x, before, after, first[:, None], last[:, None], np.ones((len(x), 1))])


def _padded(logits: np.ndarray, lengths: np.ndarray):
    """Documents by falling length, lines along the other axis; places to get back."""
    order = np.argsort(-lengths, kind="stable")
    starts = np.cumsum(lengths) - lengths
    return order, starts[order], lengths[order]


def marginals(logits: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of chains laid end to end: P(good) of each line, expected transition counts, and the sum of log normalisers.

    logits: score of good less that of bad. Chains run side by side, each step over those long enough.
    """
    order, starts, sizes = _padded(logits, lengths)
    top = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(top), side="left")  # chains with more than t lines
    e = np.stack([-logits / 2, logits / 2], axis=1)
    peak = e.max(axis=1, keepdims=True)
    p = np.exp(e - peak)
    m = np.exp(transitions - transitions.max())
    alpha, scale = np.zeros((len(logits), 2)), np.zeros(len(logits))
    for t in range(top):
        at = starts[: active[t]] + t
        a = p[at] if t == 0 else (alpha[at - 1] @ m) * p[at]
        s = a.sum(axis=1)
        alpha[at], scale[at] = a / s[:, None], s
    beta, pairs = np.ones((len(logits), 2)), np.zeros((2, 2))
    for t in range(top - 1, 0, -1):
        at = starts[: active[t]] + t
        b = p[at] * beta[at] / scale[at][:, None]
        pairs += (alpha[at - 1].T @ b) * m
        beta[at - 1] = b @ m.T
    gamma = alpha * beta
    total = float(np.log(scale).sum() + peak.sum() + transitions.max() * (lengths - 1).sum())
    return gamma[:, 1] / gamma.sum(axis=1), pairs, total


def _bounds(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, ends = int(lengths.sum()), np.cumsum(lengths)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[ends - lengths], last[ends - 1] = True, True
    return first, last


class LineField:
    """Weights over with_neighbours() of standardised features, and 2 x 2 transition scores."""

    def __init__(self):
        self.mean, self.spread = np.zeros(N_BASE), np.ones(N_BASE)
        self.weights, self.transitions = np.zeros(3 * N_BASE + 3), np.zeros((2, 2))

    def _inputs(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return with_neighbours((x - self.mean) / self.spread, *_bounds(lengths))

    def fit(self, docs: list[tuple[np.ndarray, int, bool, bool]], rounds: int = ROUNDS) -> LineField:
        """docs: (line features, label, whether the first and the last line are there as neighbours only).

        Without documents of both labels the weights stay zero or tend to the one label.
        """
        if not docs:
            return self
        x, lengths, labels = np.vstack([d[0] for d in docs]), np.array([len(d[0]) for d in docs]), [d[1] for d in docs]
        before, after = (np.array([d[i] for d in docs], dtype=bool) for i in (2, 3))
        ends, own = np.cumsum(lengths), np.ones(len(x), bool)
        own[(ends - lengths)[before]], own[ends[after] - 1] = False, False
        self.mean, self.spread = x[own].mean(axis=0), x[own].std(axis=0) + 1e-3
        x = self._inputs(x, lengths)[own]
        lengths = lengths - before - after
        y = np.repeat(np.array(labels, dtype=float), lengths)
        steps = np.repeat(labels, lengths - 1)
        seen = np.diag([float((steps == 0).sum()), float((steps == 1).sum())])
        theta = np.zeros(x.shape[1] + 4)
        m, v, n = np.zeros_like(theta), np.zeros_like(theta), len(docs)
        for i in range(1, rounds + 1):
            w, tr = theta[:-4], theta[-4:].reshape(2, 2)
            good, pairs, _ = marginals(x @ w, lengths, tr)
            grad = np.concatenate([x.T @ (good - y), (pairs - seen).ravel()]) / n + L2 * theta
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            theta = theta - 0.1 * (1 - i / (rounds + 1)) * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
        self.weights, self.transitions = theta[:-4], theta[-4:].reshape(2, 2)
        return self

    def scores(self, texts) -> np.ndarray:
        """The length-weighted mean of P(good) over the lines of each text."""
        out, part, size = [], [], 0
        for text in texts:
            part.append(line_features(text))
            size += len(part[-1][1])
            if size > 200_000:
                out.append(self._scored(part))
                part, size = [], 0
        out.append(self._scored(part))
        return np.concatenate(out)

    def _scored(self, part) -> np.ndarray:
        if not part:
            return np.empty(0)
        lengths = np.array([len(w) for _, w in part])
        good, _, _ = marginals(self._inputs(np.vstack([x for x, _ in part]), lengths) @ self.weights, lengths, self.transitions)
        w, at = np.concatenate([w for _, w in part]), np.cumsum(lengths) - lengths
        return np.clip(np.add.reduceat(good * w, at) / np.add.reduceat(w, at), 0, 1)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text, mod 4, is 2. Null: false."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def run_of(x: np.ndarray, place: int, most: int) -> tuple[np.ndarray, bool, bool]:
    """A run of ``most`` lines, chosen by place, with the lines before and after it; and whether there are such lines."""
    if len(x) <= most:
        return x, False, False
    start = place % (len(x) - most + 1)
    before, after = start > 0, start + most < len(x)
    return x[start - before : start + most + after], before, after


def train(docs: DataFrame, labels: DataFrame, *, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES, rounds: int = ROUNDS) -> LineField:
    """Fit on a bounded sample of labelled rows that are not held out.

    Rows without a label 0 or 1 are left out; a doc_id with both labels counts as good. Of
    documents that share a doc_id one is learned from. A document of more than sample_lines
    lines gives a run of so many, anywhere in it, whose first and last lines see their true
    neighbours.
    """
    chosen = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    place = F.xxhash64("doc_id")
    chosen = chosen.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(place, "doc_id").limit(sample_docs)

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            runs = [run_of(line_features(t)[0], p, sample_lines) for p, t in zip(frame["place"], frame["text"], strict=True)]
            made = pd.DataFrame([(x.tobytes(), before, after) for x, before, after in runs], columns=["x", "before", "after"])
            yield pd.concat([frame[["place", "quality"]].reset_index(drop=True), made], axis=1)

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(place.alias("place"), F.col("quality").cast("int").alias("quality"), "text")
    rows = rows.mapInPandas(features, "place long, quality int, x binary, before boolean, after boolean")
    rows = rows.groupBy("place").agg(F.max(F.struct("x", "quality", "before", "after")).alias("run")).orderBy("place").select("run.*").toPandas()
    runs = zip(rows["x"], rows["quality"], rows["before"], rows["after"], strict=True)
    return LineField().fit([(np.frombuffer(x, dtype=np.float64).reshape(-1, N_BASE), q, before, after) for x, q, before, after in runs], rounds)


def score(docs: DataFrame, field: LineField) -> DataFrame:
    """doc_id and score (0 to 1) of every row; only the text is read for it."""
    held = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.scores(texts))

    return docs.select("doc_id", scored(F.col("text")).alias("score"))

"""Nearest neighbours by largest inner product: collision-counting hashing with query-centred windows.

Largest inner product is least distance once vectors are divided by the largest norm M and get
one coordinate more that makes their norm 1: |q - x|^2 = 2 - 2 <q, x> / (|q| M). A hash function
is one Gaussian projection of that; it has no buckets.

Index: rows are dealt over blocks of ``BLOCK``; a block holds for each of ``FUNCTIONS`` functions
its projections as a sorted array, and each row's rank in it. Every row is indexed; the sample
of ``SAMPLE`` rows (of least hash) is only used for a first bound: a query's k-th nearest
neighbour is no farther than its k-th nearest in the sample.

Search: queries in parts of ``PART`` meet every block. In each array a window around the query's
own projection has the half width ``REACH`` times the radius; a row collides where its rank is
inside. Rows with at least ``THRESHOLD`` collisions are verified by exact inner products in double
precision. The radius is widened (virtual rehashing: same arrays, wider windows) until the k-th
best verified row is within it, or the bound is reached. Nothing is
capped: all rows over the threshold are verified. A function collides with probability 0.77 for
a row at the bound and more for nearer ones: 6 in 100 rows at the bound itself are missed, 2 in
100 at 0.96 of it, hardly any at 0.9. (On vectors without any clusters, where a 20th neighbour
is at 0.8 of the mean distance, about 18 in 100 rows are verified.)

Where a sample has fewer than k other rows there is no bound, and windows widen to all rows.
Vectors that are null, empty, zero, or hold null or non-finite components, and rows without a
vec_id, take no part. A query is compared with vectors of its own length only. Repeated rows
are rows of their own; a query excludes its own row alone. Ties go to the smaller vec_id. Other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import batches_of, written

FUNCTIONS, THRESHOLD, REACH = 192, 139, 1.2
#: Rows of a block (ranks are of 16 bits), queries of a part, rows of the sample: all fixed sizes.
BLOCK, PART, SAMPLE = 8192, 512, 2048
#: Windows grow by this factor, so many times up to the bound.
WIDEN, LEVELS = 1.25, 2
#: Room for rounding in projections and distances.
SLACK = 1e-5


def usable(vectors: DataFrame) -> DataFrame:
    """(row_id, vec_id, vector, dim, norm) of the vectors that take part, written."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).where(F.exists("vector", lambda x: x != 0))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    return written(rows.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", "vector", F.size("vector").alias("dim"), norm.alias("norm")), "vectors")


def scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal rows have equal ones, wherever they stand."""
    return np.add.reduce(rows * query, axis=1)


def distances(score: np.ndarray, norm: float, largest: float) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * score / (norm * largest)))


def functions_of(dim: int, functions: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim + 1, functions))


def lifted(rows: np.ndarray, largest: float) -> np.ndarray:
    scaled = rows / largest
    rest = np.sqrt(np.maximum(0.0, 1 - np.add.reduce(scaled * scaled, axis=1)))
    return np.concatenate([scaled, rest[:, None]], axis=1)


class Search:
    def __init__(self, k: int, functions: int, threshold: int, reach: float, seed: int):
        self.k, self.functions, self.threshold, self.reach, self.seed = k, functions, threshold, reach, seed

    def index_row(self, ids: np.ndarray, vec_ids: np.ndarray, rows: np.ndarray, largest: float) -> dict:
        """A block: its rows, each function's projections sorted, and the rows' ranks in that order."""
        made = (lifted(rows, largest) @ functions_of(rows.shape[1], self.functions, self.seed)).T
        order = np.argsort(made, axis=1, kind="stable")
        ranks = np.empty(made.shape, np.uint16)
        np.put_along_axis(ranks, order, np.arange(len(ids), dtype=np.uint16)[None, :], axis=1)
        arrays = {"ids": ids, "vec_ids": vec_ids, "rows": rows, "sorted": np.take_along_axis(made, order, axis=1), "ranks": ranks}
        return {"n": len(ids), "dim": rows.shape[1]} | {c: np.ascontiguousarray(x).tobytes() for c, x in arrays.items()}

    def block(self, row) -> tuple[np.ndarray, ...]:
        sort = np.frombuffer(row.sorted).reshape(self.functions, row.n)
        ranks = np.frombuffer(row.ranks, np.uint16).reshape(self.functions, row.n)
        return np.frombuffer(row.ids, np.int64), np.frombuffer(row.vec_ids, np.int64), np.frombuffer(row.rows).reshape(row.n, row.dim), sort, ranks

    def nearest(self, block, queries: np.ndarray, own: np.ndarray, at: np.ndarray, bounds: np.ndarray, largest: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the places and scores in a block of what may be among its k nearest; at: its projections."""
        ids, vec_ids, rows, sort, ranks = block
        norms = np.sqrt((queries * queries).sum(axis=1))
        best = [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
        verified = [np.empty(0, np.int64) for _ in queries]
        going = np.arange(len(queries))
        place, inside = np.empty_like(ranks), np.empty(ranks.shape, bool)
        for level in range(LEVELS):
            radius = bounds[going] / WIDEN ** (LEVELS - 1 - level)
            reach = self.reach * radius + SLACK
            low = np.stack([np.searchsorted(s, x - reach) for s, x in zip(sort, at[going].T, strict=True)])
            high = np.stack([np.searchsorted(s, x + reach, "right") for s, x in zip(sort, at[going].T, strict=True)])
            first, width = low.astype(np.uint16), (high - low).astype(np.uint16)
            left = []
            for i, q in enumerate(going):
                np.subtract(ranks, first[:, i, None], out=place)  # a rank below the window wraps round to a large number
                np.less(place, width[:, i, None], out=inside)
                count = np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8 if self.functions < 256 else np.int64)
                over = count >= self.threshold
                over[verified[q]] = False
                fresh = np.flatnonzero(over)
                verified[q] = np.concatenate([verified[q], fresh])
                fresh = fresh[ids[fresh] != own[q]]
                found, score = np.concatenate([best[q][0], fresh]), np.concatenate([best[q][1], scores(rows[fresh], queries[q])])
                if len(found) > self.k:
                    most = np.lexsort((vec_ids[found], -score))[: self.k]
                    found, score = found[most], score[most]
                best[q] = found, score
                if len(found) < self.k or distances(score[-1:], norms[q], largest)[0] > radius[i]:
                    left.append(q)
            going = np.array(left, np.int64)
            if not len(going):
                break
        return best


def build(rows: DataFrame, norms: dict[int, float], search: Search, block: int) -> DataFrame:
    """(block, dim, n, ids, vec_ids, rows, sorted, ranks): every row of rows in one block, blocks of no more than ``block`` rows."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        number = TaskContext.get().partitionId()

        def put(dim: int) -> pd.DataFrame:
            ids, vec_ids, vectors = zip(*held.pop(dim), strict=True)
            return pd.DataFrame([{"block": number} | search.index_row(np.array(ids), np.array(vec_ids), np.array(vectors), norms[dim])])

        for frame in frames:
            for row_id, vec_id, vector, dim in zip(frame["row_id"], frame["vec_id"], frame["vector"], frame["dim"], strict=True):
                held.setdefault(dim, []).append((row_id, vec_id, vector))
                if len(held[dim]) == block:
                    yield put(dim)
        for dim in list(held):
            yield put(dim)

    dealt = rows.select("row_id", "vec_id", "vector", "dim").repartition(max(1, -(-rows.count() // block)))
    return written(dealt.mapInPandas(each, "block int, n int, dim int, ids binary, vec_ids binary, rows binary, sorted binary, ranks binary"), "vector-index")


def query_parts(queries: DataFrame, sample: dict[int, tuple[np.ndarray, np.ndarray]], norms: dict[int, float], k: int, part: int) -> DataFrame:
    """(dim, queries, ids, vec_ids, rows, bounds): queries in parts, with the distance that the k-th nearest cannot exceed."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}

        def put(dim: int) -> pd.DataFrame:
            ids, vec_ids, vectors = (np.array(x) for x in zip(*held.pop(dim), strict=True))
            known, rows = sample.get(dim, (np.empty(0, np.int64), np.empty((0, dim))))
            bounds = []
            for i, q in zip(ids, vectors, strict=True):
                near = np.sort(distances(scores(rows[known != i], q), float(np.sqrt((q * q).sum())), norms[dim]))
                bounds.append(near[k - 1] + SLACK if len(near) >= k else np.inf)
            return pd.DataFrame([{"dim": dim, "n_queries": len(ids), "q_ids": ids.tobytes(), "q_vec_ids": vec_ids.tobytes(), "q_rows": vectors.tobytes(), "bounds": np.array(bounds).tobytes()}])

        for frame in frames:
            for row_id, vec_id, vector, dim in zip(frame["row_id"], frame["vec_id"], frame["vector"], frame["dim"], strict=True):
                held.setdefault(dim, []).append((row_id, vec_id, vector))
                if len(held[dim]) == part:
                    yield put(dim)
        for dim in list(held):
            yield put(dim)

    return written(queries.mapInPandas(each, "dim int, n_queries int, q_ids binary, q_vec_ids binary, q_rows binary, bounds binary"), "query-parts")


FOUND = "query_row long, query_id long, vec_id long, row_id long, score double"


def search_all(vectors: DataFrame, queries: Column, *, k: int = 20, functions: int = FUNCTIONS, threshold: int = THRESHOLD, reach: float = REACH, block: int = BLOCK, part: int = PART, sample: int = SAMPLE, seed: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of vectors (vec_id, embedding) that the column queries chooses by vec_id, the k other rows of largest inner product, nearest first."""
    if block > 65_535:
        raise ValueError("a block has 65,535 rows at most")
    rows = usable(vectors)
    norms = {r.dim: r.largest for r in rows.groupBy("dim").agg(F.max("norm").alias("largest")).collect()}
    search = Search(k, functions, threshold, reach, seed)
    index = build(rows, norms, search, block)
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    least = rows.orderBy(F.xxhash64("row_id", "vec_id"), "row_id").limit(sample).select("row_id", "vector", "dim").toPandas()
    for dim, frame in least.groupby("dim"):
        known[int(dim)] = frame["row_id"].to_numpy(np.int64), np.stack(frame["vector"].to_numpy())
    parts = query_parts(rows.where(queries), known, norms, k, part)
    last = index.agg(F.max("block").alias("last")).first()["last"]
    if last is None:
        last = 0

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                block, largest = search.block(row), norms[row.dim]
                ids, vec_ids, bounds = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.q_vec_ids, np.int64), np.frombuffer(row.bounds)
                asked = np.frombuffer(row.q_rows).reshape(row.n_queries, row.dim)
                unit = np.concatenate([asked / np.sqrt((asked * asked).sum(axis=1))[:, None], np.zeros((len(asked), 1))], axis=1)
                at = unit @ functions_of(row.dim, search.functions, search.seed)
                found = search.nearest(block, asked, ids, at, bounds, largest)
                place, score = (np.concatenate(x) for x in zip(*found, strict=True))
                count = [len(x) for x, _ in found]
                yield pd.DataFrame({"query_row": np.repeat(ids, count), "query_id": np.repeat(vec_ids, count), "vec_id": block[1][place], "row_id": block[0][place], "score": score})

    asked = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("block"))
    # A row of either side is a block; the query set is stated and meets the index block by block.
    met = asked.join(index, ["block", "dim"]).mapInPandas(each, FOUND)
    with batches_of(rows.sparkSession, 1):
        found = written(met, "found")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

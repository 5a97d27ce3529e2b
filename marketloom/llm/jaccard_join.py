"""Set similarity join on word shingles by prefix filters under several global orders.

Two sets with Jaccard similarity t share one of the first n - ceil(t n) + 1 tokens under
every global order of all tokens. Only one of equal sets takes part, so a token of one
document is in one set. An order puts tokens first that are in one set only: they fill
prefixes and are candidates of nothing. To know them, one token in ``SAMPLE`` (by its value)
is counted exactly over all documents; the others, uncounted, stand among the rare ones.
Among tokens of one class each order has its own hash.

1. Counted tokens that several sets have go back to their documents. A document whose
   single tokens fill its prefix links with nothing and is done.
2. The other (open) documents list their prefix tokens under the first order. A pair in one
   list is a candidate if it also shares prefix tokens under every other order, and if
   parity bitmaps of the sets do not differ in more bits than similar sets do in tokens.
3. Candidates are verified on the whole sets, which move for them only.

Connected components are asked for, so lists are not expanded into pairs: first a list's
first member is paired with the others (one pair per member) and components of the links
are formed; then, in lists that still hold several components, pairs across components are
tried, by ranges of set size, and only those are emitted that the bitmaps allow: at first
each row's closest one, which joins most of what belongs together, then all that are still
across. Lists of the same members are tried once. Every link between different components
is so found: whoever shares a prefix token is either in one component already or tried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, numbered, surely_not, worker_state, written

WIDTH = 5
PERCENT = 80
ORDERS = 3
#: One token in so many is counted over all documents. A prefix at 80 percent holds a fifth of a set, so a quarter can fill it.
SAMPLE = 4
#: Class of a counted token: log2 of its count, one more from UNCOUNTED on; and of all other tokens.
UNCOUNTED, TOP_CLASS = 3, 31
#: Bits of a parity bitmap: the next power of two from the set's size on, within these bounds.
LEAST_BITS, MOST_BITS = 512, 1 << 17
#: Texts reach a worker in batches of so many.
TEXT_BATCH = 1000
#: Lists longer than this are tried in pairs of blocks of this size.
LIST_BLOCK = 2048

_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]


def mixed(x: np.ndarray, k: int) -> np.ndarray:
    """A bijection of 64-bit integers for each k."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(_ODD[k % len(_ODD)] | 1)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(_ODD[(k + 3) % len(_ODD)] | 1)
        return x ^ (x >> np.uint64(32))


#: Bytes with A-Z lower-cased.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes (xxh3) of the words of a UTF-8 text, A-Z lower-cased. Bytes are split at the ASCII white space of the contract."""
    words = data.translate(_LOWER).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; with fewer words the whole sequence is one."""
    h = word_hashes((text or "").encode())
    if not len(h):
        return h
    size = min(width, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - size + 1, np.uint64(size), dtype=np.uint64)
        for i in range(size):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(_ODD[i % len(_ODD)]) + h[i : i + len(out)]
    return np.unique(mixed(out, 5))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def counted(tokens: np.ndarray, sample: int) -> np.ndarray:
    """Which tokens are counted over all documents."""
    return tokens % np.uint64(sample) == 0


def classes(tokens: np.ndarray, repeated: np.ndarray, ranks: np.ndarray, sample: int) -> np.ndarray:
    """Class of each token of a sorted set; 0: in this set only. repeated: its counted tokens that other sets have too."""
    out = np.where(counted(tokens, sample), np.uint64(0), np.uint64(UNCOUNTED))
    out[np.searchsorted(tokens, repeated)] = ranks
    return out


def prefixes(tokens: np.ndarray, kinds: np.ndarray, orders: int, percent: int) -> list[np.ndarray]:
    """A set's prefix under each order, without the tokens that no other set has."""
    left = prefix_length(len(tokens), percent) - int((kinds == 0).sum())
    if left <= 0:
        return [tokens[:0]] * orders
    shared = tokens[kinds > 0]
    places = [(kinds[kinds > 0] << np.uint64(58)) | (mixed(shared, k) >> np.uint64(6)) for k in range(orders)]
    return [shared[np.argpartition(x, left - 1)[:left]] if left < len(shared) else shared for x in places]


def parity_bitmap(tokens: np.ndarray) -> np.ndarray:
    """Bit i: parity of the tokens that hash to i. Two sets' bitmaps of one length differ in no more bits than the sets in tokens.

    Its length grows with the set, so that sets without common tokens differ in more bits than
    similar sets may; a bitmap folded in half is the one of half the length.
    """
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (max(1, len(tokens)) - 1).bit_length()))
    bits = np.bincount((mixed(tokens, 4) >> np.uint64(20)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """The bitmap with size numbers."""
    while len(bitmap) > size:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] ^ bitmap[half:]
    return bitmap


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of all nodes in links (a, b): comp is the smallest node that links reach.

    Labels of neighbours are minimised and then followed one step, until none changes; every
    round is written to the shared folder. A node's links are never gathered in one place.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    labels = written(labels.select("node", F.least("node", "low").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("via"))
        hop = labels.select(F.col("node").alias("via"), F.col("comp").alias("next"))
        new = written(step.join(hop, "via").select("node", F.col("next").alias("comp"), (F.col("next") != F.col("old")).alias("moved")), "labels")
        labels = new.select("node", "comp")
        if new.where("moved").isEmpty():
            return labels


class Join:
    """The join's steps over docs (row_id, place, text); row_id must come out alike in every scan, as numbered() makes it."""

    def __init__(self, docs: DataFrame, *, width: int, percent: int, orders: int, sample: int, list_block: int):
        self.docs, self.width, self.percent, self.orders, self.sample, self.list_block = docs, width, percent, orders, sample, list_block

    def sets(self) -> DataFrame:
        """(row_id, place, n, s1, s2, counted) of every row: the set's size, its 128-bit hash and its tokens that are counted."""
        width, sample = self.width, self.sample

        def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            worker_state("jaccard", dict)  # what other operators left in this worker goes
            for frame in frames:
                rows = []
                for row_id, place, text in zip(frame["row_id"], frame["place"], frame["text"], strict=True):
                    s = shingles(text, width)
                    h = xxhash.xxh3_128_digest(s.tobytes())
                    rows.append((row_id, place, len(s), int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), s[counted(s, sample)].view(np.int64)))
                yield pd.DataFrame(rows, columns=["row_id", "place", "n", "s1", "s2", "counted"])

        rows = self.docs.select("row_id", "place", "text").mapInPandas(each, "row_id long, place long, n int, s1 long, s2 long, counted array<long>")
        with batches_of(rows.sparkSession, TEXT_BATCH):
            return written(rows, "sets")

    def open_rows(self, sets: DataFrame, copies: DataFrame) -> DataFrame:
        """(row_id, n, place, text, prefix, others, bitmap) of the sets, one of equal ones, whose prefixes other sets may share.

        copies: row_id of the sets that are equal to another and take no part.
        """
        width, percent, orders, sample = self.width, self.percent, self.orders, self.sample
        sure, rest = surely_not(sets.where("n > 0"), copies)
        single = sure.unionByName(rest.join(copies, "row_id", "left_anti"))
        tokens = single.select("row_id", F.explode("counted").alias("token"))
        counts = written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("count")).where("count > 1"), "token-counts")
        rank = F.least(F.floor(F.log2("count")), F.lit(TOP_CLASS - 1)).cast("int")
        rank = F.when(rank >= UNCOUNTED, rank + 1).otherwise(rank)
        repeated = tokens.join(counts.select("token", rank.alias("rank")), "token")
        repeated = repeated.groupBy("row_id").agg(F.collect_list("token").alias("tokens"), F.collect_list("rank").alias("ranks"))
        need = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
        known = single.select("row_id", "place", "n", F.size("counted").alias("n_counted")).join(repeated, "row_id", "left")
        opened = written(known.where((F.col("n_counted") - F.coalesce(F.size("tokens"), F.lit(0))) < need).drop("n_counted"), "open")

        def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = []
                for text, tokens, ranks in zip(frame["text"], frame["tokens"], frame["ranks"], strict=True):
                    s = shingles(text, width)
                    tokens = np.empty(0, np.int64) if tokens is None else np.asarray(tokens, np.int64)
                    kinds = classes(s, tokens.view(np.uint64), np.empty(0, np.uint64) if ranks is None else np.asarray(ranks, np.uint64), sample)
                    first, *others = prefixes(s, kinds, orders, percent)
                    others = [(mixed(x, 6) >> np.uint64(32)).astype(np.uint32).view(np.int32) for x in others]
                    rows.append((first.view(np.int64), others, parity_bitmap(s)))
                out = frame[["row_id", "n", "place", "text"]].reset_index(drop=True)
                yield pd.concat([out, pd.DataFrame(rows, columns=["prefix", "others", "bitmap"])], axis=1)

        _, maybe = surely_not(self.docs.select("row_id", "text"), opened)
        rows = maybe.join(opened, "row_id").select("row_id", "n", "place", "text", "tokens", "ranks")
        rows = rows.mapInPandas(each, "row_id long, n int, place long, text string, prefix array<long>, others array<array<int>>, bitmap array<long>")
        with batches_of(rows.sparkSession, TEXT_BATCH):
            return written(rows, "open-rows")

    def candidates(self, pairs: DataFrame, rows: DataFrame) -> DataFrame:
        """The pairs (a, b) that share prefix tokens under every other order and whose bitmaps allow a link."""
        own = lambda k: rows.select(F.col("row_id").alias(k), F.col("n").alias(f"n{k}"), F.col("others").alias(f"o{k}"), F.col("bitmap").alias(f"m{k}"))
        out = pairs.join(own("b"), "b").join(own("a"), "a")
        for i in range(self.orders - 1):
            out = out.where(F.arrays_overlap(F.col("oa")[i], F.col("ob")[i]))
        # Sizes are within reach of each other, so bitmaps are of one length or of twice that.
        half = lambda m: F.zip_with(F.slice(m, 1, (F.size(m) / 2).cast("int")), F.slice(m, (F.size(m) / 2 + 1).cast("int"), (F.size(m) / 2).cast("int")), lambda x, y: x.bitwiseXOR(y))
        like = lambda m, other: F.when(F.size(m) > F.size(other), half(m)).otherwise(F.col(m))
        differ = F.aggregate(F.zip_with(like("ma", "mb"), like("mb", "ma"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
        return written(out.where(differ * (100 + self.percent) <= (F.col("na") + F.col("nb")) * (100 - self.percent)).select("a", "b"), "candidates")

    def similar(self, candidates: DataFrame, rows: DataFrame) -> DataFrame:
        """The candidates (a, b) that are similar on the whole sets."""
        width = self.width
        ids = candidates.select(F.col("a").alias("row_id")).union(candidates.select("b")).distinct()

        def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield pd.DataFrame({"row_id": frame["row_id"], "tokens": [shingles(x, width).view(np.int64) for x in frame["text"]]})

        sets = rows.select("row_id", "text").join(ids, "row_id", "left_semi").mapInPandas(each, "row_id long, tokens array<long>")
        with batches_of(rows.sparkSession, TEXT_BATCH):
            sets = written(sets, "candidate-sets")
        own = lambda k: sets.select(F.col("row_id").alias(k), F.col("tokens").alias(f"t{k}"))
        out = candidates.join(own("b"), "b").join(own("a"), "a")
        common = F.size(F.array_intersect("ta", "tb")).cast("long")
        return written(out.where(common * 100 >= (F.size("ta") + F.size("tb") - common) * self.percent).select("a", "b"), "similar")

    def lists(self, rows: DataFrame) -> DataFrame:
        """(token, row_id, n, hub, hub_n) of every token that several rows have in their first prefix; hub: the list's first member."""
        # Copies mostly have larger ids than what they copy, so the least place is a good first partner for a list.
        postings = rows.select(F.explode("prefix").alias("token"), "row_id", "n", "place")
        ends = postings.groupBy("token").agg(F.min(F.struct("place", "row_id", "n")).alias("first"), F.min("row_id").alias("low"), F.max("row_id").alias("high"))
        ends = ends.where("low < high").select("token", F.col("first.row_id").alias("hub"), F.col("first.n").alias("hub_n"))
        return written(postings.drop("place").join(ends, "token"), "lists")

    def across(self, lists: DataFrame, bitmaps: DataFrame, closest: bool) -> DataFrame:
        """Pairs (a, b) of different components in lists (token, row_id, n, comp) whose bitmaps allow a link; closest: one for each row."""
        percent, block = self.percent, self.list_block
        same = [F.bit_xor(F.xxhash64(F.lit(i), "row_id")).alias(f"x{i}") for i in range(2)]
        mixes = lists.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("members"), *same).where("low < high")
        mixes = written(mixes.groupBy("members", "x0", "x1").agg(F.min("token").alias("token")).select("token", "members"), "mixed-lists")
        # Sets of similar sizes are in one range or in neighbouring ones; group g holds the pairs of range g, and of it with g + 1.
        span = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) - 1e-9).cast("int") if percent < 100 else F.col("n")
        rows = lists.join(mixes, "token").withColumn("span", span)
        rows = rows.withColumn("k", F.ceil(F.col("members") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("row_id"), F.col("k")).cast("int"))
        rows = rows.withColumn("g", F.explode(F.array("span", F.col("span") - 1))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        rows = rows.select("token", "g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "span", "row_id", "n", "comp")
        rows = rows.join(bitmaps.select("row_id", "bitmap"), "row_id")
        keys = ["token", "g", "i", "j"]

        def pairs_of(frame: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
            """All groups of a frame, those whose bitmaps are of one length at once: every row with the row d places on, for d up to the largest group."""
            size = np.array([len(x) for x in frame["bitmap"]])
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            least = np.repeat(np.minimum.reduceat(size, starts), np.diff(np.append(starts, len(size))))
            found = [pairs_of_length(frame[least == x], group[least == x], x) for x in np.unique(least)]
            return pd.DataFrame(np.concatenate(found), columns=["a", "b"]).drop_duplicates()

        def pairs_of_length(frame: pd.DataFrame, group: np.ndarray, size: int) -> np.ndarray:
            bits = np.stack([folded(x, size) for x in frame["bitmap"]]).view(np.uint64)
            ids, n, comp, own, i, j, g, span = (frame[c].to_numpy(np.int64) for c in ("row_id", "n", "comp", "own", "i", "j", "g", "span"))
            found, best, mate = [np.empty((0, 2), np.int64)], np.full(len(ids), np.inf), np.zeros(len(ids), np.int64)
            for d in range(1, len(group)):
                left = np.flatnonzero(group[d:] == group[:-d])
                if not len(left):
                    break
                right = left + d
                small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
                tried = (comp[left] != comp[right]) & (small * 100 >= large * percent) & ((i[left] == j[left]) | (own[left] != own[right])) & ((span[left] == g[left]) | (span[right] == g[right]))
                left, right = left[tried], right[tried]
                differ = np.bitwise_count(bits[left] ^ bits[right]).sum(axis=1, dtype=np.int64)
                ok = differ * (100 + percent) <= (n[left] + n[right]) * (100 - percent)
                left, right, ratio = left[ok], right[ok], differ[ok] / (n[left[ok]] + n[right[ok]])
                if closest:
                    for one, other in ((left, right), (right, left)):
                        less = ratio < best[one]
                        best[one[less]], mate[one[less]] = ratio[less], other[less]
                else:
                    found.append(np.stack([ids[left], ids[right]], axis=1))
            some = np.flatnonzero(best < np.inf)
            found.append(np.stack([ids[some], ids[mate[some]]], axis=1))
            return np.sort(np.concatenate(found), axis=1)

        def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rest = None
            for frame in frames:
                frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
                key = frame[keys].to_numpy(np.int64)
                group = np.cumsum(np.r_[0, (key[1:] != key[:-1]).any(axis=1)])
                whole = int(np.searchsorted(group, group[-1]))  # the last group may go on in the next frame
                if whole:
                    yield pairs_of(frame.iloc[:whole], group[:whole])
                rest = frame.iloc[whole:]
            if rest is not None and len(rest):
                yield pairs_of(rest, np.zeros(len(rest), np.int64))

        return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(stream, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT, orders: int = ORDERS, sample: int = SAMPLE, list_block: int = LIST_BLOCK) -> DataFrame:
    """(row_id, doc_id, n_shingles, component_id, first_row) of every row of docs (doc_id, text).

    component_id: the smallest doc_id that links reach, the row's own included; first_row: the
    smallest row_id of the component's rows with that doc_id. Rows without words link with
    nothing. Repeated rows are one component; a null doc_id is never a component_id unless all
    of a component are null.
    """
    return joined(numbered(docs), width=width, percent=percent, orders=orders, sample=sample, list_block=list_block)


def joined(rows: DataFrame, *, width: int = WIDTH, percent: int = PERCENT, orders: int = ORDERS, sample: int = SAMPLE, list_block: int = LIST_BLOCK) -> DataFrame:
    """near_duplicates() of rows that numbered() gave."""
    place = F.coalesce(F.col("row.doc_id").try_cast("long"), F.lit(2**63 - 1))
    docs = rows.select("row_id", "row.doc_id", place.alias("place"), "row.text")
    job = Join(docs, width=width, percent=percent, orders=orders, sample=sample, list_block=list_block)
    sets = job.sets()
    groups = sets.where("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("place", "row_id")).alias("first"), F.min("row_id").alias("low"), F.max("row_id").alias("high"))
    groups = written(groups.where("low < high").select("s1", "s2", F.col("first.row_id").alias("rep")), "equal-sets")
    copies = written(sets.where("n > 0").join(groups, ["s1", "s2"]).where("row_id <> rep").select("row_id", "rep"), "copies")

    opened = job.open_rows(sets, copies.select("row_id"))
    lists = job.lists(opened)
    a, b = F.least("hub", "row_id").alias("a"), F.greatest("hub", "row_id").alias("b")
    in_reach = (F.col("n") * 100 >= F.col("hub_n") * percent) & (F.col("hub_n") * 100 >= F.col("n") * percent)
    pairs = lists.where((F.col("hub") != F.col("row_id")) & in_reach).select(a, b).distinct()
    links = job.similar(job.candidates(pairs, opened), opened)
    comps = components(links)
    for closest in (True, False):
        named = lists.join(comps.withColumnRenamed("node", "row_id"), "row_id", "left").select("token", "row_id", "n", F.coalesce("comp", "row_id").alias("comp"))
        pairs = written(job.across(named, opened, closest), "pairs")
        if pairs.isEmpty():
            break
        more = job.similar(job.candidates(pairs, opened), opened)
        if not more.isEmpty():
            links = links.union(more)
            comps = components(links)

    rest, some = surely_not(sets.select("row_id", "n"), copies)
    whole = rest.withColumn("rep", F.col("row_id")).unionByName(some.join(copies, "row_id", "left").select("row_id", "n", F.coalesce("rep", "row_id").alias("rep")))
    whole = whole.join(comps, whole["rep"] == comps["node"], "left").select("row_id", "n", F.coalesce("comp", "rep").alias("comp"))
    whole = written(whole.join(docs.select("row_id", "doc_id"), "row_id"), "components")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")).alias("least")
    ends = written(whole.groupBy("comp").agg(least), "ends")
    return whole.join(ends, "comp").select("row_id", "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("least.doc_id").alias("component_id"), F.col("least.row_id").alias("first_row"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that have the smallest doc_id of their component (one of repeated rows), with their columns."""
    rows = numbered(docs)
    gone = written(joined(rows, **options).where("row_id <> first_row").select("row_id"), "gone")
    # Only rows that may have gone are shuffled for the exact check.
    sure, maybe = surely_not(rows, gone)
    return sure.select("row").union(maybe.join(gone, "row_id", "left_anti").select("row")).select("row.*")

"""Alignment of the tokens of two tokenizers over the same bytes, as an Arrow-native pipeline.

A text is read with a space before it. It is cut before each space that follows something
other than white space: no token of either vocabulary crosses such a place, so equal pieces
have equal tokens, and a piece is a small document whose tokens are aligned once per chunk.

In a task, for each chunk of rows (``CHUNK_BYTES`` of text, or one longer text):

1. pieces are the flattened list of all documents with parent indices, dictionary-encoded;
2. distinct pieces are encoded; segmented cumulative sums of token lengths give every token's
   end, and (piece, end) is its key;
3. an Acero full outer hash join of both sides' keys gives one row for each end. Filled
   backwards, a row is a link: one pair of tokens that overlap. Rows with both ends close a group;
4. ``Table.group_by`` counts the chunk's id pairs and each document's.

Spark then merges the chunks' partial counts, finds each B id's highest one, and gives them
back to the chunks, which look them up by slot. Only numbers move between tasks: a chunk's
distinct pairs, and its documents' slots.

Null and empty texts, and texts whose tokens of either side do not spell space + text, have
zeros and an empty digest. Repeated rows count like any rows. Other columns are not read. An
empty table gives no rows. A text may be of any length that a string cell may have; a longer
one than a chunk is a chunk of its own.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import batches_of, worker_state, written

#: Bytes of text that are aligned together.
CHUNK_BYTES = 8_000_000
#: Bytes of joined pieces that an encoder gets at once.
JOINED_BYTES = 200_000
#: Texts reach a worker in batches of so many.
TEXT_BATCH = 500

_ASCII_SPACES = np.zeros(256, bool)
_ASCII_SPACES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: UTF-8 of the white space beyond ASCII, by length: fixed values.
_WIDE_SPACES = {2: ["\x85", "\xa0"], 3: [" ", *map(chr, range(0x2000, 0x200B)), " ", " ", " ", " ", "　"]}
_MARK = "▁"


def _byte_letters() -> dict[str, int]:
    """The letters that a byte-level vocabulary writes bytes with: visible Latin-1 characters stand for themselves, others follow from 256 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (32, 0xA0, 0xAD)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """One side: encode_many(texts), and the bytes of each id."""

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _keep(self, pieces: list[bytes]) -> None:
        self.pieces = pa.array(pieces, pa.large_binary())
        self.lengths = np.array([len(p) for p in pieces], np.int64)


class ByteLevel(Vocabulary):
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_truncation()
        self.model.no_padding()
        letters = _byte_letters()
        pieces = [b""] * self.model.get_vocab_size()
        for token, i in self.model.get_vocab().items():
            pieces[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self._keep(pieces)

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch(texts, add_special_tokens=False)]


class Pieces(Vocabulary):
    """A vocabulary of pieces with byte fallback, which puts a space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.whole = any(re.search(f"[^{_MARK}]{_MARK}", p) for p in names if len(p) > 1)
        self.space = self.model.encode("a ")[len(self.model.encode("a")) :]  # no space goes before an empty text
        self._keep([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(names)])

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        return [self.space if t == " " else ids for t, ids in zip(texts, self.model.encode([t[1:] for t in texts], num_threads=1), strict=True)] if texts else []


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places of the spaces in UTF-8 bytes that follow something other than white space."""
    at = np.flatnonzero((data[1:] == 32) & ~_ASCII_SPACES[data[:-1]]) + 1
    wide = at[data[at - 1] >= 0x80]
    drop = np.zeros(len(data) + 1, bool)
    for size, spaces in _WIDE_SPACES.items():
        codes = [int.from_bytes(s.encode(), "big") for s in spaces]
        far = wide[wide >= size]
        code = np.zeros(len(far), np.int64)
        for k in range(size, 0, -1):
            code = code << 8 | data[far - k]
        drop[far[np.isin(code, codes)]] = True
    return at[~drop[at]]


def pieces_of(texts: list[str], whole: bool = False) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The pieces of the texts (each with a space before it), flattened, and the index of each text's first one; whole: texts are not cut."""
    data = "".join(" " + t for t in texts).encode()
    starts = np.cumsum([0, *(len(t.encode()) + 1 for t in texts)])
    cuts = np.empty(0, np.int64) if whole else cut_places(np.frombuffer(data, np.uint8))
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = edge[cuts] = True
    edges = np.flatnonzero(edge)
    pieces = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(data))
    return pieces, np.searchsorted(edges, starts)


def sizes_of(pieces: pa.Array) -> np.ndarray:
    return pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)


def _bytes(values: pa.Array) -> np.ndarray:
    """All bytes of an array of large strings or binaries without nulls."""
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else [0, 0]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... of each of the runs that counts gives."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def encode_pieces(side: Vocabulary, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, right) of distinct pieces: the tokens of piece i are ids[offsets[i]:offsets[i + 1]]; right: whether they spell it.

    Pieces are encoded joined, many at a time; where a token crosses a seam, one by one.
    """
    texts, size = pieces.to_pylist(), sizes_of(pieces)
    alone = np.array([p[-1:].isspace() or _MARK in p for p in texts], bool)
    joined = np.flatnonzero(~alone)
    cuts = np.flatnonzero(np.diff(np.cumsum(size[joined]) // JOINED_BYTES)) + 1
    order, parts, counts, singles = [], [], [], [np.flatnonzero(alone)]
    for run in np.split(joined, cuts) if len(joined) else []:
        got = np.array(side.encode_many(["".join([texts[i] for i in run])])[0], np.int64)
        ends, reached = np.cumsum(size[run]), np.cumsum(side.lengths[got])
        seams = np.searchsorted(reached, ends)
        if len(reached) and reached[-1] == ends[-1] and (reached[seams] == ends).all():
            order.append(run)
            parts.append(got)
            counts.append(np.diff(seams, prepend=-1))
        else:
            singles.append(run)
    rest = np.concatenate(singles)
    got = side.encode_many([texts[i] for i in rest])
    order = np.concatenate([*order, rest])
    parts = np.concatenate([*parts, *(np.array(x, np.int64) for x in got), np.empty(0, np.int64)])
    counts = np.concatenate([*counts, np.array([len(x) for x in got], np.int64)])
    tokens = np.zeros(len(texts), np.int64)
    tokens[order] = counts
    offsets = np.concatenate([[0], np.cumsum(tokens)])
    flat = np.empty(len(parts), np.int64)
    flat[np.repeat(offsets[order], counts) + _within(counts)] = parts

    total = np.concatenate([[0], np.cumsum(side.lengths[flat])])
    right = np.diff(total[offsets]) == size
    spelled = side.pieces.take(pa.array(flat))
    said, want = _bytes(spelled), _bytes(pieces)
    said, want = said[np.repeat(right, np.diff(total[offsets]))], want[np.repeat(right, size)]
    wrong = np.concatenate([[0], np.cumsum(said != want)])[np.concatenate([[0], np.cumsum(size * right)])]
    right &= np.diff(wrong) == 0
    return flat, offsets, right


def token_ends(side: Vocabulary, ids: np.ndarray, offsets: np.ndarray, base: np.ndarray, name: str) -> pa.Table:
    """(end, name): each token's (piece, end) key as one number, the piece's base plus a cumulative sum of lengths within the piece."""
    total = np.cumsum(side.lengths[ids])
    before = np.concatenate([[0], total])[offsets[:-1]]
    count = np.diff(offsets)
    return pa.table({"end": total + np.repeat(base - before, count), name: pa.array(ids, pa.int64())})


def _joined(values: pa.Array, offsets: np.ndarray, mark: str) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), values), pa.scalar(mark, pa.large_string()))


class Aligner:
    """Aligns the texts of a chunk; one for each worker."""

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a), Pieces(b)

    def pieces(self, distinct: pa.Array) -> dict:
        """Of distinct pieces: links (a, b) with the offsets of each piece's, group texts, and counts."""
        a, a_at, a_right = encode_pieces(self.a, distinct)
        b, b_at, b_right = encode_pieces(self.b, distinct)
        right = a_right & b_right
        for_all = lambda ids, at: (ids[np.repeat(right, np.diff(at))], np.concatenate([[0], np.cumsum(np.diff(at) * right)]))
        (a, a_at), (b, b_at) = for_all(a, a_at), for_all(b, b_at)
        size = sizes_of(distinct) * right
        base = np.concatenate([[0], np.cumsum(size)])
        left, other = token_ends(self.a, a, a_at, base[:-1], "a"), token_ends(self.b, b, b_at, base[:-1], "b")
        links = left.join(other, "end", join_type="full outer", use_threads=False).sort_by("end")
        both = pc.and_(pc.is_valid(links["a"]), pc.is_valid(links["b"]))
        end = links["end"].to_numpy()
        close = end[both.to_numpy()]
        link_at, group_at = np.searchsorted(end, base, "right"), np.searchsorted(close, base, "right")
        parts = []
        for table in (left, other):
            cuts = np.concatenate([[0], np.searchsorted(table["end"].to_numpy(), close, "right")])
            parts.append(_joined(pc.cast(table[table.column_names[1]], pa.large_string()).combine_chunks(), cuts, ","))
        groups = pc.binary_join_element_wise(*parts, pa.scalar("|", pa.large_string()))
        return {
            "right": right,
            "a": pc.fill_null_backward(links["a"]).to_numpy(),
            "b": pc.fill_null_backward(links["b"]).to_numpy(),
            "link_at": link_at,
            "n_a": np.diff(a_at),
            "n_b": np.diff(b_at),
            "n_groups": np.diff(group_at),
            "groups": _joined(groups, group_at, ";"),
        }

    def chunk(self, texts: list[str | None]) -> tuple[pa.Table, pa.Table]:
        """(documents, pairs) of a chunk. A document's slots and times say how often it has which of the pairs."""
        pieces, first = pieces_of([t for t in texts if t], self.b.whole)
        coded = pieces.dictionary_encode()
        index, made = coded.indices.to_numpy(), self.pieces(coded.dictionary)
        n = len(first) - 1
        parent = np.repeat(np.arange(n), np.diff(first))
        fine = np.ones(n, bool)
        fine[parent[~made["right"][index]]] = False
        kept = fine[parent]
        index, parent = index[kept], parent[kept]
        first = np.concatenate([[0], np.cumsum(np.bincount(parent, minlength=n))]).astype(np.int64)
        summed = lambda values: np.diff(np.concatenate([[0], np.cumsum(values[index])])[first])
        text = _joined(made["groups"].take(pa.array(index)), first, ";").to_pylist()

        width = np.diff(made["link_at"])
        pairs = pa.table({"a": made["a"], "b": made["b"], "piece": np.repeat(np.arange(len(width)), width)})
        slots = pa.table({"a": made["a"], "b": made["b"]}).group_by(["a", "b"], use_threads=False).aggregate([])
        slots = slots.append_column("slot", pa.array(np.arange(slots.num_rows)))
        slot = pairs.append_column("at", pa.array(np.arange(pairs.num_rows))).join(slots, ["a", "b"], use_threads=False).sort_by("at")["slot"].to_numpy()
        count = width[index]
        at = np.repeat(made["link_at"][:-1][index], count) + _within(count)
        own = pa.table({"doc": np.repeat(parent, count), "slot": slot[at]}).group_by(["doc", "slot"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc")
        total = own.group_by("slot", use_threads=False).aggregate([("count_all", "sum")])
        counts = np.zeros(slots.num_rows, np.int64)
        counts[total["slot"].to_numpy()] = total["count_all_sum"].to_numpy()
        edges = np.searchsorted(own["doc"].to_numpy(), np.arange(n + 1))
        lists = lambda c: pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pc.cast(own[c], pa.int32()).combine_chunks())
        docs = {
            **{c: summed(made[c]) for c in ("n_a", "n_b", "n_groups")},
            "n_links": summed(width),
            "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if ok else "" for t, ok in zip(text, fine, strict=True)],
            "slots": lists("slot"),
            "times": lists("count_all"),
        }
        docs, some = pa.table(docs), np.array([bool(t) for t in texts], bool)
        place = np.where(some, np.cumsum(some) - 1, -1)
        docs = docs.take(pa.array(place, mask=place < 0))
        used = counts > 0
        return docs, pa.table({"slot": np.flatnonzero(used), "a": slots["a"].to_numpy()[used], "b": slots["b"].to_numpy()[used], "n": counts[used]})


DOC_COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, slots array<int>, times array<int>"
CHUNK_ROWS = f"kind string, chunk long, {DOC_COLUMNS}, slot int, a int, b int, n long"


def _schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def chunks(docs: DataFrame, a: str, b: str, chunk_bytes: int) -> DataFrame:
    """Rows of two kinds: a chunk's documents, and its pairs with their partial counts."""
    schema = _schema(docs.sparkSession, CHUNK_ROWS)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_state(("align", a, b), lambda: Aligner(a, b))
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            docs, pairs = aligner.chunk(table["text"].to_pylist())
            docs = docs.append_column("doc_id", table["doc_id"])
            for kind, part in (("docs", docs), ("pairs", pairs)):
                part = part.append_column("kind", pa.array([kind] * part.num_rows)).append_column("chunk", pa.array([task << 32 | made] * part.num_rows, pa.int64()))
                full = pa.table([pc.cast(part[f.name], f.type) if f.name in part.column_names else pa.nulls(part.num_rows, f.type) for f in schema], schema=schema)
                yield from full.combine_chunks().to_batches(max_chunksize=20_000)

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
            start = 0
            for i, s in enumerate(sizes):
                if size + s > chunk_bytes and (held or i > start):
                    held.append(batch.slice(start, i - start))
                    yield from rows()
                    made, held, size, start = made + 1, [], 0, i
                size += s
            held.append(batch.slice(start))
        if held and sum(x.num_rows for x in held):
            yield from rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each, CHUNK_ROWS)


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, a: str, b: str, *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of docs (doc_id, text).

    a: a byte-level vocabulary's JSON file; b: a model file of pieces with byte fallback. n_best:
    links whose id pair is as often linked, corpus-wide, as any of its B id; count_sum: the sum
    of the links' corpus-wide counts.
    """
    spark = docs.sparkSession
    with batches_of(spark, TEXT_BATCH):
        rows = written(chunks(docs, a, b, chunk_bytes), "alignment")
    pairs = rows.where("kind = 'pairs'").select("chunk", "slot", "a", "b", "n")
    counts = written(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    best = counts.groupBy("b").agg(F.max("count").alias("highest"))  # a row for each id of B's vocabulary at most
    scored = counts.join(F.broadcast(best), "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    scored = pairs.join(scored, ["a", "b"]).select("chunk", "slot", "count", "best")
    names = [c.split()[0] for c in DOC_COLUMNS.split(", ")]
    schema = _schema(spark, RESULT)

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        slots, times = left["slots"].combine_chunks(), left["times"].combine_chunks()
        value = np.zeros((2, max([0, *right["slot"].to_pylist()]) + 1), np.int64)
        place = right["slot"].to_numpy()
        value[0, place], value[1, place] = right["best"].to_numpy(), right["count"].to_numpy()
        parent, slot, time = slots.value_parent_indices().to_numpy(), slots.flatten().to_numpy(), times.flatten().to_numpy()
        sums = []
        for v in value:
            total = pa.table({"doc": parent, "v": v[slot] * time}).group_by("doc", use_threads=False).aggregate([("v", "sum")])
            out = np.zeros(n, np.int64)
            out[total["doc"].to_numpy()] = total["v_sum"].to_numpy()
            sums.append(out)
        zero = lambda c: pc.fill_null(left[c], 0)
        columns = [left["doc_id"], zero("n_a"), zero("n_b"), zero("n_groups"), zero("n_links"), pa.array(sums[0]), pa.array(sums[1]), pc.fill_null(left["groups_sha256"], "")]
        return pa.table(columns, schema=schema)

    own = rows.where("kind = 'docs'").select(F.col("chunk").alias("own_chunk"), *names)
    return own.groupBy("own_chunk").cogroup(scored.groupBy("chunk")).applyInArrow(each, RESULT)

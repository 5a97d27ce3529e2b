"""Prefix trie of conversations by whole-sequence collapse.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first d
turns. Texts never move: a turn is its SHA-256 digest, and a prefix is the running SHA-256 of
its turns' digests, taken in one pass over the sorted turns.

1. Identical conversations collapse into one weighted sequence: its number of conversations,
   its smallest conv_id and its end list. Copies are counted before the shuffle.
2. An anti-join of the sequences with the proper prefixes leaves the trie's leaves.
3. Prefixes of the weighted sequences are aggregated to nodes. A node belongs to the sequence
   with its smallest conv_id (its owner), which owns the lower part of its own path; so the
   sum of any value over the nodes below a node is a sum over the sequences that pass through
   it, and no pairs of a node and its ancestors are made.

Rows without a conv_id belong to no conversation. Turns are in order of turn (null first),
ties by role and digest; a repeated row is a turn again. Null role or text is empty. An empty
table has no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Turns of a conversation that others may begin with, at most.
MOST_SHARED = 8
#: log2 of the range of conv_ids whose end list is made in one piece.
PIECE_BITS = 12
#: Nodes on more than a part of all path rows in so many are heavy, so there are no more than these.
HEAVY = 4096


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, n_bytes) of every turn; place: from 1 in the conversation's order."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.unhex(F.sha2(whole, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.select("conv_id", F.row_number().over(order).alias("place"), "digest", "n_bytes")


def sharing_heads(turns: DataFrame, base, head) -> DataFrame:
    """turns with each conversation's first head (a column, MOST_SHARED at most) turns taken from the conversation base.

    Every conversation has one row more, of place 0, so that turnless ones stay.
    """
    convs = turns.where("place = 1").select("conv_id", base.alias("base"), head.cast("int").alias("head"))
    own = turns.withColumns({"base": base, "head": head}).where("place > head")
    first = turns.where(F.col("place") <= MOST_SHARED).groupBy(F.col("conv_id").alias("base")).agg(F.collect_list(F.struct("place", "digest", "n_bytes")).alias("turns"))
    taken = convs.join(first, "base").select("conv_id", "head", F.inline("turns")).where("place <= head")
    names = ["conv_id", "place", "digest", "n_bytes"]
    root = convs.select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n_bytes"))
    return own.select(*names).unionByName(taken.select(*names)).unionByName(root)


def paths_of(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, n_bytes, upto, last) of every prefix; upto: bytes of all turns so far. turns has a row of place 0 for each conversation."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, depth, upto, sha, held = None, 0, 0, None, None
        for frame in frames:
            rows = []
            for conv_id, digest, n_bytes in zip(frame["conv_id"], frame["digest"], frame["n_bytes"], strict=True):
                if held is not None:
                    rows.append((*held, conv_id != conv))
                if conv_id != conv:
                    conv, depth, upto, sha = conv_id, 0, 0, hashlib.sha256()
                else:
                    depth, upto = depth + 1, upto + n_bytes
                    sha.update(digest)
                held = (conv_id, depth, sha.copy().digest(), n_bytes, upto)
            yield pd.DataFrame(rows, columns=["conv_id", "depth", "node", "n_bytes", "upto", "last"])
        if held is not None:
            yield pd.DataFrame([(*held, True)], columns=["conv_id", "depth", "node", "n_bytes", "upto", "last"])

    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "digest", "n_bytes")
    return rows.mapInPandas(each, "conv_id long, depth int, node binary, n_bytes long, upto long, last boolean")


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations (node, conv_id) end: of their ids, ascending, joined by commas.

    Ids are first joined by ranges of conv_id; a node's pieces then pass through one task in
    order, a batch at a time, so a list may be of any length.
    """
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    pieces = ends.groupBy("node", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, sha = None, None
        for frame in frames:
            rows = []
            for n, ids in zip(frame["node"], frame["ids"], strict=True):
                if n == node:
                    sha.update(b",")
                else:
                    if node is not None:
                        rows.append((node, sha.hexdigest()))
                    node, sha = n, hashlib.sha256()
                sha.update(ids.encode())
            yield pd.DataFrame(rows, columns=["node", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(node, sha.hexdigest())], columns=["node", "ends_sha256"])

    return pieces.repartition("node").sortWithinPartitions("node", "piece").select("node", "ids").mapInPandas(each, "node binary, ends_sha256 string")


def with_owner(rows: DataFrame, owners: DataFrame, heavy: int) -> DataFrame:
    """rows joined by node with owners (node, owner, n_paths). Nodes of more than heavy paths meet their rows by a broadcast; heavy bounds their number."""
    few = F.broadcast(owners.where(F.col("n_paths") > heavy).select("node", "owner"))
    rest = owners.where(F.col("n_paths") <= heavy).select("node", "owner")
    return rows.join(few, "node").unionByName(rows.join(few, "node", "left_anti").join(rest, "node"))


def trie(conversations: DataFrame, *, base=None, head=None) -> DataFrame:
    """Every node of the conversations' trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    base, head: columns of conv_id; with them, a conversation's first head turns are those of
    the conversation base. conv_id: the smallest member; parent_conv_id: of the parent (null for
    the root); n_leaves: childless nodes at or below; saved_tokens: over the nodes at or below,
    the bytes of a node's last text times its members but one.
    """
    nobody = F.lit(0)
    turns = sharing_heads(written(turns_of(conversations), "turns"), F.col("conv_id") if base is None else base, nobody if head is None else head)
    paths = written(paths_of(turns), "paths")

    ends = paths.where("last")
    sequences = written(ends.groupBy("node").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"), F.max("upto").alias("total")), "sequences")
    inner = written(paths.where("NOT last").select("node").distinct(), "proper-prefixes")
    leaves = sequences.join(inner, "node", "left_anti").withColumn("leaf", F.lit(1))
    others = sequences.join(inner, "node", "left_semi").withColumn("leaf", F.lit(0))
    weighted = leaves.unionByName(others).drop("node")

    rows = written(paths.drop("last").join(weighted, "conv_id"), "weighted-prefixes")
    owners = written(rows.groupBy("node").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_paths")), "owners")
    owned = with_owner(rows, owners, max(1, rows.count() // HEAVY))
    path = Window.partitionBy("conv_id")
    before = F.coalesce(F.max(F.when(F.col("owner") != F.col("conv_id"), F.col("upto"))).over(path.orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0))
    owned = owned.withColumns({"parent": F.lag("owner").over(path.orderBy("depth")), "own_bytes": F.col("total") - before})
    mine, above = F.col("owner") == F.col("conv_id"), F.col("upto") - F.col("n_bytes")
    nodes = owned.groupBy("node").agg(
        F.min("owner").alias("conv_id"),
        F.min("depth").cast("long").alias("depth"),
        F.max(F.when(mine, F.col("parent"))).alias("parent_conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * (F.col("total") - above)).alias("said"),
        F.sum(F.when(mine, F.col("total") - above).otherwise(F.col("own_bytes"))).alias("stored"),
    )
    nodes = written(nodes.join(end_digests(ends.select("node", "conv_id")), "node", "left").drop("node"), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    return nodes.join(children, ["conv_id", "depth"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves",
        (F.col("said") - F.col("stored")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )

"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, merged where neighbours have
the same role, and joined to one string with markers:

    <|im_start|>role<|im_role|>text<|im_next|>text of a merged turn<|im_end|>

Control strings (these markers and those of other common templates) inside roles and texts
are broken up by a backslash after their first character; backslashes are doubled first.
So markers stand only where the template puts them, and unescape() gives back every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, ROLE, NEXT, END = "<|im_start|>", "<|im_role|>", "<|im_next|>", "<|im_end|>"
#: What follows the first character of a control string, by that character: fixed values.
AFTER_ANGLE = ["\\|", "/?s>", "</?SYS>>", "/?SYS>>", "start_of_turn>", "end_of_turn>"]
AFTER_SQUARE = ["/?INST\\]"]
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    broken = F.regexp_replace(doubled, f"<(?={'|'.join(AFTER_ANGLE)})", "<\\\\")
    return F.regexp_replace(broken, f"\\[(?={'|'.join(AFTER_SQUARE)})", "[\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)\\\\(.)", "$1")


def _let(value: Column, body) -> Column:
    """body of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _sums_before(sizes: Column) -> Column:
    """For each item of an array of sizes the sum of those before it, over chunks of the root of the length: no array grows item by item."""
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    width = lambda s: F.ceil(F.sqrt(F.size(s))).cast("int")
    chunks = lambda s: F.transform(F.sequence(F.lit(1), F.size(s), width(s)), lambda i: F.slice(s, i, width(s)))
    inside = lambda c, start: F.transform(c, lambda _, i: start + total(F.slice(c, 1, i)))
    placed = lambda cs, sums: F.flatten(F.transform(cs, lambda c, k: _let(total(F.slice(sums, 1, k)), lambda start: inside(c, start))))
    return _let(sizes, lambda s: _let(chunks(s), lambda cs: _let(F.transform(cs, total), lambda sums: placed(cs, sums))))


def format_chats(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of rows (conv_id, turn, role, text).

    loss_spans: array of (first, length) in UTF-8 bytes of formatted, counted from 1, one
    for each text of an assistant. Turns are ordered by turn, then role and text (nulls
    first); repeated rows stay. Null text is empty, null role the empty role; a null conv_id
    is one conversation. Empty tables give no rows. Time is linear in the text, and in the
    turns but for their running sums (power 1.5).
    """
    parts = rows.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    )
    turns = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def piece(ts: Column, t: Column, i: Column) -> Column:
        """A turn begins or ends a block of its role as its neighbours say."""
        begins = F.coalesce(F.get(ts, i - 1)["role"] != t["role"], F.lit(True))
        ends = F.coalesce(F.get(ts, i + 1)["role"] != t["role"], F.lit(True))
        return F.struct(
            F.when(begins, F.concat(F.lit(START), escape(t["role"]), F.lit(ROLE))).otherwise(F.lit(NEXT)).alias("before"),
            escape(t["text"]).alias("text"),
            F.when(ends, F.lit(END + "\n")).otherwise(F.lit("")).alias("after"),
            (t["role"] == LOSS_ROLE).alias("loss"),
        )

    pieces = turns.select("conv_id", _let(F.col("turns"), lambda ts: F.transform(ts, lambda t, i: piece(ts, t, i))).alias("pieces"))
    size = lambda p: (F.octet_length(p["before"]) + F.octet_length(p["text"]) + F.octet_length(p["after"])).cast("long")
    first = lambda starts, p, i: F.get(starts, i) + F.octet_length(p["before"]) + 1
    spans = _let(
        _sums_before(F.transform("pieces", size)),
        lambda starts: F.transform("pieces", lambda p, i: F.struct(first(starts, p, i).alias("first"), F.octet_length(p["text"]).alias("length"), p["loss"].alias("loss"))),
    )
    return pieces.select(
        "conv_id",
        F.array_join(F.flatten(F.transform("pieces", lambda p: F.array(p["before"], p["text"], p["after"]))), "").alias("formatted"),
        F.transform(F.filter(spans, lambda x: x["loss"]), lambda x: F.struct(x["first"].cast("int").alias("first"), x["length"].alias("length"))).alias("loss_spans"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """format_chats() read back: conv_id, turns (array of role, text), loss_text, formatted."""
    block = F.split(F.col("formatted"), f"{START}".replace("|", "\\|"), -1)
    blocks = F.transform(F.slice(block, 2, F.greatest(F.size(block) - 1, F.lit(0))), lambda b: F.substring_index(b, END, 1))

    def turns(b: Column) -> Column:
        role = unescape(F.substring_index(b, ROLE, 1))
        body = F.substring_index(b, ROLE, -1)
        return F.transform(F.split(body, NEXT.replace("|", "\\|"), -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    under = _let(F.col("formatted").cast("binary"), lambda data: F.transform("loss_spans", lambda s: unescape(F.substring(data, s["first"], s["length"]).cast("string"))))
    return formatted.select("conv_id", F.flatten(F.transform(blocks, turns)).alias("turns"), F.array_join(under, "").alias("loss_text"), "formatted")

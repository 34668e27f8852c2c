"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of
one role become one block, and the blocks are concatenated.  The template:

    <|im|>role<|says|>text<|next|>text<|done|>

``<|next|>`` parts the merged turns of a block, so that the rows can be read back.
Inside roles and texts ``\\`` is written ``\\b`` and ``<|`` is written ``\\c``; no
control string can then appear in them, and reading reverses both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SAYS, NEXT, DONE = "<|im|>", "<|says|>", "<|next|>", "<|done|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\c"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\c"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def _literal(mark: str) -> str:
    return "\\Q" + mark + "\\E"


def _merge(done: Column, turn: Column) -> Column:
    """Append a turn to the list of blocks, or to its last block if the role is the same."""
    last = F.element_at(done, -1)
    joined = F.struct(last["role"].alias("role"), F.concat(last["body"], F.lit(NEXT), turn["body"]).alias("body"))
    same = (F.size(done) > 0) & (last["role"] == turn["role"])
    return F.when(same, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(turn)))


def format_conversations(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: the key, ``formatted`` and ``loss_spans``.

    A conversation is one row, hence as large as the conversation itself.  Rows are
    sorted by ``order`` (nulls first); ties and repeated rows by role and text, each
    kept.  Null text and null role are empty strings; rows of a null key form one
    conversation.  ``loss_spans`` holds start and length (code points, from 0) of
    every assistant text in ``formatted``.  Other columns are ignored.
    """
    rows = turns.select(
        F.col(f"`{key}`").alias("key"),
        F.struct(
            F.col(f"`{order}`").alias("at"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    sorted_turns = F.transform(
        F.sort_array(F.collect_list("said")), lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("body"))
    )
    none = F.array().cast("array<struct<role:string,body:string>>")
    grouped = rows.groupBy("key").agg(F.aggregate(sorted_turns, none, _merge).alias("blocks"))
    block = lambda b: F.concat(F.lit(OPEN), b["role"], F.lit(SAYS), b["body"], F.lit(DONE))
    formatted = grouped.select("key", F.concat_ws("", F.transform("blocks", block)).alias("formatted"))
    return formatted.select(F.col("key").alias(key), "formatted", loss_spans(F.col("formatted")).alias("loss_spans"))


def loss_spans(formatted: Column) -> Column:
    """Start and length of each assistant text, found in the formatted string itself."""
    pieces = F.split(formatted, f"(?<={_literal(DONE)})|(?<={_literal(SAYS)})|(?<={_literal(NEXT)})")
    # A piece ends with its mark; a text is a piece that ends with NEXT or DONE.
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("on"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        head = piece.endswith(F.lit(SAYS))
        body = F.regexp_replace(piece, f"({_literal(NEXT)}|{_literal(DONE)})$", "")
        span = F.struct(state["at"].alias("start"), F.length(body).alias("length"))
        return F.struct(
            (state["at"] + F.length(piece)).alias("at"),
            F.when(head, piece == F.lit(OPEN + LOSS_ROLE + SAYS)).otherwise(state["on"]).alias("on"),
            F.when(state["on"] & ~head & (piece != ""), F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(pieces, start, step)["spans"]


def read_back(formatted: Column) -> Column:
    """The rows of a formatted conversation: array of role and text."""
    blocks = F.filter(F.split(formatted, _literal(DONE)), lambda b: b != "")
    def rows(block: Column) -> Column:
        sides = F.split(block, _literal(SAYS))
        role = unescape(F.replace(sides[0], F.lit(OPEN), F.lit("")))
        return F.transform(F.split(sides[1], _literal(NEXT)), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, rows))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))))

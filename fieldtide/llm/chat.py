"""Chat formatting with a reversible template and a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEXT = "<|im_start|>", "<|im_end|>", "<|im_next|>"


def escaped(text: Column, line: bool = False) -> Column:
    """No control string survives: backslashes are doubled and "<|" becomes "<\\|"; with ``line`` also line feeds."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if line else out


def unescaped(text: Column, line: bool = False) -> Column:
    """Undo ``escaped``: what stands between doubled backslashes holds only single ones."""

    def part(p: Column) -> Column:
        p = F.replace(p, F.lit("\\|"), F.lit("|"))
        return F.replace(p, F.lit("\\n"), F.lit("\n")) if line else p

    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 learned: str = "assistant") -> DataFrame:
    """(conv, formatted, loss): one row per conversation.

    The turns of a conversation are collected as structs and sorted. Adjacent turns of one role share a block
    ``<|im_start|>role LF text <|im_next|> text ... <|im_end|> LF``. ``loss`` lists the (start, length) of each learned
    text in ``formatted``, in characters from 0. Null roles and texts count as empty, a null turn sorts first, ties go by
    role and text, repeated rows stay, a null conversation is one conversation; an empty table gives no rows.
    One conversation is one output row and so has to fit into a task; other columns are ignored.
    """
    one = F.struct(
        F.col(turn).alias("turn"), escaped(F.coalesce(F.col(role), F.lit("")), True).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("raw"),
    )
    got = turns.groupBy(F.col(conv).alias(conv)).agg(F.sort_array(F.collect_list(one)).alias("_turns"))
    head = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"))
    before = lambda t, i: F.when(i == 0, head(t)).when(F.get("_turns", i - 1)["role"] == t["role"], F.lit(NEXT)).otherwise(
        F.concat(F.lit(END + "\n"), head(t)))
    # A piece is what stands before a text, then the text.
    got = got.withColumn("_pieces", F.transform("_turns", lambda t, i: F.struct(
        before(t, i).alias("lead"), escaped(t["raw"]).alias("body"), (t["role"] == learned).alias("learn"))))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    spans = F.aggregate("_pieces", empty, lambda s, p: F.struct(
        (s["at"] + F.length(p["lead"]) + F.length(p["body"])).alias("at"),
        F.when(p["learn"], F.array_append(s["spans"], F.struct(
            (s["at"] + F.length(p["lead"])).alias("start"), F.length(p["body"]).alias("length")))).otherwise(s["spans"]).alias("spans"),
    ))["spans"]
    whole = F.concat(F.array_join(F.transform("_pieces", lambda p: F.concat(p["lead"], p["body"])), ""), F.lit(END + "\n"))
    return got.select(conv, whole.alias("formatted"), spans.alias("loss"))


def parse_chats(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns, learned, formatted): read the turns (role, text) and the learned texts back from the format."""
    blocks = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda b: b != "")
    opened = F.transform(blocks, lambda b: F.substring(b, F.lit(len(START) + 1), F.length(b)))

    def block(b: Column) -> Column:
        role = unescaped(F.substring_index(b, "\n", 1), True)
        texts = F.split(F.substring(b, F.instr(b, "\n") + 1, F.length(b)), r"<\|im_next\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    turns = F.flatten(F.transform(opened, block))
    learned = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return chats.select(conv, turns.alias("turns"), learned.alias("learned"), "formatted")

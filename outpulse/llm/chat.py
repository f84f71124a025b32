"""Conversations as training text, with Spark expressions only.

Template: ``<|im_start|>role\\n`` + texts of adjacent turns of that role, set
apart by ``<|im_sep|>`` + ``<|im_end|>\\n``.  In texts and roles a backslash is
doubled and ``<|`` becomes ``<\\|``, so no text can hold a control string; in
roles a line end becomes ``\\n`` as well.  Reading back reverses this.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    # a doubled backslash is set aside as a line end, which an escaped role cannot hold
    kept = F.replace(F.replace(role, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\n\n"))
    return F.replace(F.replace(F.replace(kept, F.lit("\\n"), F.lit("\r\n\r")), F.lit("\n\n"), F.lit("\\")), F.lit("\r\n\r"), F.lit("\n"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``segments`` (text, under the loss mask or not) per conversation.

    The segments joined are the formatted text.  Turns go by ``turn`` (nulls
    first); equal turns go by role, then text, and each counts.  A null text or
    role is empty, a null conv_id is a conversation of its own; an empty table
    gives no row; other columns are ignored.  A conversation is one output
    value, so its turns meet in one row; conversations are spread by id.
    """
    clean = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("t"),
    )
    whole = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    role = lambda i: F.get("t", i)["role"]
    # where a block of equal roles begins, and one past the last turn
    whole = whole.withColumn("begins", F.filter(F.sequence(F.lit(0), F.size("t") - 1), lambda i: (i == 0) | (role(i) != role(i - 1))))
    blocks = whole.withColumn("blocks", F.transform("begins", lambda b, k: F.slice("t", b + 1, F.coalesce(F.get("begins", k + 1), F.size("t")) - b)))

    def segments(block: Column) -> Column:
        first = F.concat(F.lit(START), escaped_role(F.get(block, F.lit(0))["role"]), F.lit("\n"))
        trained = F.get(block, F.lit(0))["role"] == TRAINED
        inner = F.transform(block, lambda t, i: F.array(_segment(F.when(i == 0, first).otherwise(F.lit(SEP)), F.lit(False)), _segment(escaped(t["text"]), trained)))
        return F.concat(F.flatten(inner), F.array(_segment(F.lit(END), F.lit(False))))

    out = blocks.withColumn("segments", F.flatten(F.transform("blocks", segments)))
    return out.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def _segment(text: Column, trained: Column) -> Column:
    return F.struct(text.alias("text"), trained.alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns, as array of (role, text), from a formatted text."""

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        body = F.substr(block, F.length(head) + 2, F.length(block) - F.length(head) - 1 - len(END))
        return F.transform(F.split(body, r"<\|im_sep\|>", -1), lambda t: F.struct(unescaped_role(head).alias("role"), unescaped(t).alias("text")))

    blocks = F.split(formatted, r"<\|im_start\|>", -1)
    return F.flatten(F.transform(F.slice(blocks, 2, F.size(blocks)), turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped: assistant texts in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, as counts and digests."""
    told = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(all_turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )

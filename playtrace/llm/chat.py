"""Chat formatting by prefix-target expansion: every assistant turn is an example with all earlier turns as its context.

A turn is written as ``### role: text</turn>`` and a line feed. Inside roles and texts the characters that could form such
a mark are written as two: ``\\`` as ``\\b``, ``<`` as ``\\l``, ``#`` as ``\\h``, ``:`` (roles only) as ``\\c``. No raw
``#`` or ``<`` is left in them, so splitting at ``</turn>`` is safe and replacing the pairs restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
_PAIRS = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))


def escape(value: Column) -> Column:
    for raw, pair in _PAIRS:
        value = F.replace(value, F.lit(raw), F.lit(pair))
    return value


def unescape(value: Column) -> Column:
    for raw, pair in reversed(_PAIRS):
        value = F.replace(value, F.lit(pair), F.lit(raw))
    return value


def examples(
        conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
        target: str = "assistant") -> DataFrame:
    """One row per example: ``conv_id, example, text, loss_start, loss_length, last`` (code points from 0).

    ``text`` holds all turns up to and with the target turn; only the reply's text is under the loss. ``last`` marks the
    row that closes its conversation: the last example, or, if turns follow it or no turn is a target, one more row of
    all turns without a loss (start and length null). Turns go by number; equal numbers (repeated rows included) by role,
    then text. Null turn numbers come first, null roles and texts are empty, a null id is a conversation of its own.
    """
    turns = conversations.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")))).alias("turns"))

    def written(t: Column) -> Column:
        own = F.replace(escape(t["role"]), F.lit(":"), F.lit("\\c"))
        head, body = F.concat(F.lit(OPEN), own, F.lit(COLON)), escape(t["text"])
        return F.struct(
            (t["role"] == target).alias("hit"), F.length(head).alias("head"), F.length(body).alias("body"),
            F.concat(head, body, F.lit(CLOSE)).alias("written"))

    parts = turns.select("conv_id", F.transform("turns", written).alias("parts"))
    parts = parts.select("conv_id", "parts", F.array_join("parts.written", "").alias("whole"))
    # ends and targets in one fold over the turns: (code points so far, examples)
    state = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS ARRAY<STRUCT<at: INT, length: INT, end: INT>>)").alias("found")),
        lambda s, p: F.struct(
            (s["at"] + p["head"] + p["body"] + len(CLOSE)).alias("at"),
            F.when(p["hit"], F.concat(s["found"], F.array(F.struct(
                (s["at"] + p["head"]).alias("at"), p["body"].alias("length"),
                (s["at"] + p["head"] + p["body"] + len(CLOSE)).alias("end"))))).otherwise(s["found"]).alias("found")))
    spans = parts.select("conv_id", "whole", state.alias("s"))
    rest = F.struct(F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("length"), F.col("s.at").alias("end"))
    closed = F.coalesce(F.try_element_at(F.col("s.found.end"), F.lit(-1)) == F.col("s.at"), F.lit(False))
    found = F.when(closed, F.col("s.found")).otherwise(F.concat("s.found", F.array(rest)))
    rows = spans.select("conv_id", "whole", F.col("s.at").alias("size"), F.posexplode(found).alias("example", "e"))
    return rows.select(
        "conv_id", "example", F.left("whole", F.col("e.end")).alias("text"), F.col("e.at").alias("loss_start"),
        F.col("e.length").alias("loss_length"), (F.col("e.end") == F.col("size")).alias("last"))


def loss_text(row_text: str = "text") -> Column:
    """The original reply, cut from an example by its loss span; null without one."""
    return unescape(F.substring(F.col(row_text), F.col("loss_start") + 1, F.col("loss_length")))


def read_turns(row_text: str | Column) -> Column:
    """The turns ``array<struct<role, text>>`` read back from a formatted text."""
    marks = F.split(row_text, CLOSE)

    def read(part: Column) -> Column:
        own = F.substring_index(part, COLON, 1)
        return F.struct(
            unescape(F.replace(F.substr(own, F.lit(len(OPEN) + 1)), F.lit("\\c"), F.lit(":"))).alias("role"),
            unescape(F.substr(part, F.length(own) + len(COLON) + 1)).alias("text"))

    return F.transform(F.slice(marks, 1, F.size(marks) - 1), read)


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns, the text under the loss, and the code points written."""
    turns = F.transform(read_turns("text"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    own = rows.select(
        "conv_id", "example", loss_text().alias("reply"), F.length("text").alias("size"),
        F.when(F.col("last"), turns).alias("turns"))
    one = own.groupBy("conv_id").agg(
        F.max("turns").alias("turns"), F.sum("size").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply")))).alias("replies"))
    loss = F.array_join("replies.reply", "")
    return one.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))

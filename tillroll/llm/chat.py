"""Chat formatting with Spark expressions only: turns are sorted structs, templates are array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings of the template.
TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "<|end|>"
#: Control strings of this and of other templates, as what may follow their first character.
_CONTROL = r"([<\[])(?=\||/?s>|/?INST\]|/?SYS)"


def escape(text: Column) -> Column:
    """Put a backslash inside every control string of ``text``, and double its backslashes."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    """Undo :func:`escape`."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: ``turns`` (sorted), ``messages`` (adjacent turns of a role merged),
    ``formatted`` and ``loss_spans`` (start and length, in code points, of each assistant text).

    Turns are sorted by turn, then role, then text, so ties and repeated rows have one order; null
    turns come first. A null role or text is empty; rows with a null conv_id are one conversation;
    other columns are not read; an empty table gives an empty result.
    """
    turn = F.struct("turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sorted_turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def opens(t: Column, i: Column) -> Column:
        """Whether a turn begins a message: the first one, or the role has changed."""
        return (i == 0) | (t["role"] != F.get("turns", i - 1)["role"])

    def mark(t: Column, i: Column) -> Column:
        close = F.when(i == 0, "").otherwise(END)
        return F.when(opens(t, i), F.concat(close, F.lit(TURN), escape(t["role"]), F.lit(TEXT))).otherwise(MORE)

    pieces = F.transform(
        "turns", lambda t, i: F.struct(mark(t, i).alias("mark"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss"))
    )
    laid_out = sorted_turns.withColumn("pieces", pieces)
    text = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["body"])), ""), F.lit(END))
    no_span = F.array().cast("array<struct<start: int, length: int>>")
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), no_span.alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p["mark"]) + F.length(p["body"])).alias("at"),
            F.when(p["loss"], F.concat(s["spans"], F.array(F.struct((s["at"] + F.length(p["mark"])).alias("start"), F.length(p["body"]).alias("length"))))).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    starts = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: opens(F.get("turns", i), i))
    messages = F.transform(
        starts,
        lambda a, k: F.struct(
            F.get("turns", a)["role"].alias("role"),
            F.slice("turns", a + 1, F.coalesce(F.get(starts, k + 1), F.size("turns")) - a)["text"].alias("texts"),
        ),
    )
    return laid_out.select("conv_id", "turns", messages.alias("messages"), text.alias("formatted"), spans.alias("loss_spans"))


def read_turns(text: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    blocks = F.slice(F.split(text, r"<\|turn\|>", -1), 2, 1 << 30)

    def turns(block: Column) -> Column:
        body = F.substring_index(block, END, 1)
        role = unescape(F.substring_index(body, TEXT, 1))
        texts = F.split(body.substr(F.length(F.substring_index(body, TEXT, 1)) + len(TEXT) + 1, F.length(body)), r"<\|more\|>", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(text.substr(s["start"] + 1, s["length"]))), "")

"""Chat logs folded into conversations and rendered with a loss mask, in DataFrame functions only.

A log holds events of a conversation in order of ``seq``: ``message`` (or an
unknown or null kind) sets a message's text, ``delta`` appends to it, ``edit``
replaces it, ``regenerate`` discards it so that later deltas build it anew.

Edge cases: null texts and roles count as empty; a null conversation id is a
conversation of its own; a conversation is one group and one row, so it must fit a task;
events with equal seq are folded in the order of kind,
role and text; a repeated row is an event again; an empty log gives no rows;
columns that are not named here are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed strings of the template. All control strings begin with "<|".
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """One more backslash between < and | wherever only backslashes stand between them."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def reconstruct(events: DataFrame) -> DataFrame:
    """conv_id and its final messages, array<struct<seq, message_id, role, text>>, from
    events with columns conv_id, seq, message_id, kind, role, text."""
    event = F.struct("seq", "kind", "role", "text")
    reset = F.max(F.when(~F.col("kind").eqNullSafe("delta"), F.struct("seq", "kind", "role", "text")))
    messages = events.select("conv_id", "seq", "message_id", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    messages = messages.groupBy("conv_id", "message_id").agg(F.min("seq").alias("seq"), F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "kind", "role"))).alias("role"), reset.alias("base"), F.collect_list(F.when(F.col("kind") == "delta", event)).alias("deltas"))
    later = F.filter(F.array_sort("deltas"), lambda d: F.col("base").isNull() | F.col("base.seq").isNull() | (d["seq"] > F.col("base.seq")))
    start = F.when(F.col("base.kind").eqNullSafe("regenerate"), "").otherwise(F.coalesce("base.text", F.lit("")))
    text = F.concat(start, F.array_join(F.transform(later, lambda d: d["text"]), ""))
    final = F.struct("seq", "message_id", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    return messages.select("conv_id", final.alias("message")).groupBy("conv_id").agg(F.sort_array(F.collect_list("message")).alias("messages"))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, the formatted text, and its pieces as array<struct<piece, loss>>.

    The pieces joined are the formatted text; those with loss are what a trainer
    learns: the (escaped) texts of assistant messages.
    """
    piece = lambda text, loss: F.struct(text.alias("piece"), loss.alias("loss"))
    turn = lambda m: F.array(piece(F.concat(F.lit(TURN), escape(m["role"]), F.lit(TEXT)), F.lit(False)), piece(escape(m["text"]), m["role"] == LOSS_ROLE), piece(F.lit(END), F.lit(False)))
    pieces = conversations.select("conv_id", F.flatten(F.transform("messages", turn)).alias("pieces"))
    return pieces.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "pieces")


def parse(formatted: Column) -> Column:
    """Read a formatted text back into array<struct<role, text>>."""
    quoted = lambda s: "\\Q" + s + "\\E"
    turns = F.slice(F.split(formatted, quoted(TURN)), 2, 1 << 30)
    sides = F.transform(turns, lambda t: F.split(t, quoted(TEXT)))
    return F.transform(sides, lambda s: F.struct(unescape(s[0]).alias("role"), unescape(F.substring(s[1], F.lit(1), F.length(s[1]) - len(END))).alias("text")))


def learned(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["piece"])), "")

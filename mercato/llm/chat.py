"""Operator 9, chat formatting: relational, Spark expressions only.

Turns are collected as structs, sorted, adjacent turns of one role merged with
array functions, and concatenated.

Template (one line break after each turn)::

    ### User: text</turn>
    ### Assistant: first text<and/>second text</turn>

``<and/>`` stands between the texts of merged turns.  A control string inside
a text gets one more backslash than it has (``</turn>`` becomes ``<\\/turn>``,
``### `` becomes ``###\\ ``), so no text can end a turn or open another, and
one backslash fewer restores it.  Roles beyond system, user and assistant are
shown as ``Other`` and the role, percent-encoded where it holds ``%:<#`` or a
line break.

Edge cases: a null text is an empty text, a null role an empty role; turns are
ordered by (turn, role, text), nulls first, so ties and repeated rows have one
order and every row is kept; rows with a null conversation id form one
conversation; an empty table gives no rows; other columns are ignored.  A
conversation is one output row by definition, so its turns meet in one task;
texts of any length are kept whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_END = "</turn>\n"
BETWEEN = "<and/>"
ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
LEARNED_ROLE = "assistant"

# pattern, replacement: one backslash more, one backslash fewer
_ESCAPE = ((r"<(\\*)(/turn|and/)>", r"<\\$1$2>"), (r"###(\\*) ", r"###\\$1 "))
_UNESCAPE = ((r"<\\(\\*)(/turn|and/)>", r"<$1$2>"), (r"###\\(\\*) ", r"###$1 "))
_ROLE_CODES = (("%", "%25"), (":", "%3A"), ("<", "%3C"), ("#", "%23"), ("\n", "%0A"))


def escape(text: Column) -> Column:
    return reduce(lambda t, rule: F.regexp_replace(t, *rule), _ESCAPE, text)


def unescape(text: Column) -> Column:
    return reduce(lambda t, rule: F.regexp_replace(t, *rule), _UNESCAPE, text)


def _shown(role: Column) -> Column:
    other = reduce(lambda r, code: F.replace(r, F.lit(code[0]), F.lit(code[1])), _ROLE_CODES, role)
    return reduce(lambda c, kv: F.when(role == kv[0], kv[1]).otherwise(c), ROLES.items(),
                  F.concat(F.lit("Other "), other))


def _role(shown: Column) -> Column:
    other = F.substring(shown, len("Other ") + 1, 1 << 30)
    other = reduce(lambda r, code: F.replace(r, F.lit(code[1]), F.lit(code[0])), reversed(_ROLE_CODES), other)
    return reduce(lambda c, kv: F.when(shown == kv[1], kv[0]).otherwise(c), ROLES.items(), other)


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """``conv_id, formatted, loss, n_turns, n_merged``: one row per conversation.

    ``loss`` holds (start, length) in code points of ``formatted``: exactly the
    escaped assistant texts, neither headers nor what stands between texts.
    """
    rows = turns.select(F.col(conv).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        turns_, n = F.col("turns"), F.size("turns")
        opens = (i == 0) | (F.get(turns_, i - 1)["role"] != t["role"])
        closes = (i == n - 1) | (F.get(turns_, i + 1)["role"] != t["role"])
        return F.struct(
            F.when(opens, F.concat(F.lit("### "), _shown(t["role"]), F.lit(": "))).otherwise(BETWEEN).alias("before"),
            escape(t["text"]).alias("body"),
            F.when(closes, TURN_END).otherwise("").alias("after"),
            (t["role"] == LEARNED_ROLE).alias("learned"), opens.alias("opens"))

    def add_span(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["before"])
        end = start + F.length(p["body"])
        span = F.struct(start.alias("start"), F.length(p["body"]).alias("length"))
        return F.struct((end + F.length(p["after"])).alias("at"),
                        F.when(p["learned"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
                        .alias("spans"))

    cut = sorted_turns.withColumn("pieces", F.transform("turns", piece))
    no_spans = F.lit(None).cast("array<struct<start:int,length:int>>")
    return cut.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["body"], p["after"])), "")
        .alias("formatted"),
        F.aggregate("pieces", F.struct(F.lit(0).alias("at"), F.coalesce(no_spans, F.array().cast(
            "array<struct<start:int,length:int>>")).alias("spans")), add_span)["spans"].alias("loss"),
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["opens"])).cast("long").alias("n_merged"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), merged turns apart again."""
    closed = F.split(formatted, TURN_END)
    segments = F.slice(closed, 1, F.size(closed) - 1)

    def turns_of(segment: Column) -> Column:
        shown = F.substring(F.substring_index(segment, ": ", 1), len("### ") + 1, 1 << 30)
        body = segment.substr(F.length(shown) + len("### ") + len(": ") + 1, F.length(segment))
        return F.transform(F.split(body, BETWEEN), lambda t: F.struct(
            _role(shown).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(segments, turns_of))


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(
        loss, lambda s: unescape(formatted.substr(s["start"] + 1, s["length"]))), "")

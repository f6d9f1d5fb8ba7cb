"""Chat formatting from an event log, in DataFrame functions only.

A conversation is what its events add up to: messages, streamed deltas, edits and
regenerations, partitioned by conversation and taken in order. The final messages are rendered
with a template that marks turns. Control strings inside texts are escaped, so that a rendered
conversation can be read back exactly and no text can open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The template: TURN role newline text END newline.
TURN, END = "<|turn|>", "<|end|>"
#: The role whose texts are learned from.
LEARNED = "assistant"
#: Kinds of events that replace a message's text so far; a delta adds to it.
REPLACING = ("message", "edit", "regenerate")

#: Where control strings of common chat templates begin inside a text.
_ANGLE = r"<(?=\||/?s>|</?SYS>)"
_BRACKET = r"\[(?=/?INST\])"


def escaped(text: Column) -> Column:
    """The text without any control string: backslashes doubled, openings written as a code."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    angled = F.regexp_replace(doubled, _ANGLE, r"\\l")
    return F.regexp_replace(angled, _BRACKET, r"\\b")


def unescaped(text: Column) -> Column:
    """What `escaped` was given."""
    coded = [(r"\l", "<"), (r"\b", "["), (r"\n", "\n")]

    def plain(part: Column) -> Column:
        for code, char in coded:
            part = F.replace(part, F.lit(code), F.lit(char))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def events_of(turns: DataFrame) -> DataFrame:
    """Events from a table with a row per turn (conv_id, turn, role, text).

    Every row is a message of its own, in the order of turn, role and text (nulls first), so
    that repeated rows and ties are kept. A learned role's texts come as a delta, as if streamed.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text"
    ).select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("seq"),
        F.row_number().over(order).cast("long").alias("message"),
        F.when(F.col("role") == LEARNED, "delta").otherwise("message").alias("kind"),
        "role",
        "text",
    )


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final messages of an event log.

    `events` has conv_id, seq, message (the place of a message in its conversation), kind, role
    and text. In the order of seq, a message, edit or regeneration replaces the text so far and
    a delta adds to it; a regeneration may be empty and be followed by deltas. Unknown kinds
    count as deltas. The role is the last one given, or empty. Null texts are empty. Events with
    the same seq are taken by kind, role and text; repeated events count as often as they occur.
    """
    log = events.select(
        "conv_id",
        "message",
        F.struct(
            "seq",
            F.col("kind").isin(*REPLACING).alias("replaces"),
            "role",
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("event"),
    )
    grouped = log.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list("event")).alias("log"))
    places = F.transform("log", lambda e, i: F.when(e["replaces"], i))
    grouped = grouped.withColumn("since", F.coalesce(F.array_max(places), F.lit(0)))
    valid = F.filter("log", lambda e, i: i >= F.col("since"))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return grouped.select(
        "conv_id",
        "message",
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform(valid, lambda e: e["text"]), "").alias("text"),
    )


def render(final: DataFrame) -> DataFrame:
    """(conv_id, formatted, segments): one row per conversation.

    `segments` are the pieces that make up `formatted`, each with whether it is learned from:
    the loss mask, which covers the texts of the learned role and nothing of the template.
    """
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(r"\n"))
    pieces = F.array(
        F.struct(F.concat(F.lit(TURN), role, F.lit("\n")).alias("text"), F.lit(False).alias("learned")),
        F.struct(escaped(F.col("text")).alias("text"), (F.col("role") == LEARNED).alias("learned")),
        F.struct(F.lit(f"{END}\n").alias("text"), F.lit(False).alias("learned")),
    )
    whole = final.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("message", pieces.alias("pieces")))).alias("turns")
    )
    whole = whole.select(
        "conv_id", F.flatten(F.transform("turns", lambda t: t["pieces"])).alias("segments")
    )
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return whole.select("conv_id", formatted.alias("formatted"), "segments")


def format_chats(events: DataFrame) -> DataFrame:
    """Rendered conversations of an event log, with their loss masks (see `messages`, `render`).

    Events are dealt out by conversation once; folding and rendering stay in that partitioning.
    A conversation is one row of the result, so it has to fit in a task, but nothing else of
    the log does. A null conv_id is a conversation of its own.
    """
    return render(messages(events.repartition("conv_id")))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    parts = F.slice(F.split(formatted, TURN.replace("|", r"\|")), 2, 1 << 30)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - len(END) - 2)
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of rendered conversations, all read from `formatted` and `segments`."""
    turns = formatted.select("conv_id", "formatted", "segments", read_turns(F.col("formatted")).alias("turns"))
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.transform(F.filter("segments", lambda s: s["learned"]), lambda s: unescaped(s["text"]))
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.array_join(learned, "").alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )

"""Chat formatting by event-sourced reconstruction, with DataFrame functions alone.

A log holds events of conversations: ``message`` opens a message with a role and text,
``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` takes back a message and
all that follow it.  Partitioned by conversation and sorted by sequence, the log folds into
final messages, which are rendered by a template:

    <|turn|>role NEWLINE text <|end|> NEWLINE

Control strings inside roles and texts, and line breaks inside roles, are broken by an escape
that reading undoes, so that no text can open or close a turn.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
ESCAPE = "\u241b"
#: Strings that this or another template gives a meaning (fixed values).
CONTROL = (
    "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<bos>", "<eos>", "<pad>", "<unk>",
    "<start_of_turn>", "<end_of_turn>"
)


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in "\\.[]{}()<>*+-=!?^$|/" else c for c in text)


_STARTS = "(" + "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in CONTROL) + ")"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e")), _STARTS, f"$1{ESCAPE}c")


def escaped_role(role: Column) -> Column:
    """As ``escaped``, and on one line: the template ends a role by a line break."""
    return F.replace(escaped(role), F.lit("\n"), F.lit(ESCAPE + "n"))


def unescaped(text: Column) -> Column:
    """The inverse of both: an escape of a text is always followed by the letter that says what it stands for."""
    for mark, meant in (("c", ""), ("n", "\n"), ("e", ESCAPE)):
        text = F.replace(text, F.lit(ESCAPE + mark), F.lit(meant))
    return text


def folded(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, message, role, text)`` of ``(conv_id, seq, kind, message, role, text)``.

    ``message`` is the number of the message that an event opens or concerns.  A regenerate
    event takes back the messages of its number and above that came before it.  Of what is
    left, a message has the text of its last message or edit event and the deltas after that.
    Events of equal seq come in the order message, edit, delta, regenerate, then by text;
    deltas and edits of a message that no message event opens have the role "".  Null texts
    and roles are empty, null conversations are one conversation, events of other kinds or
    with a null kind, seq or message have no effect.
    """
    known = events.select(
        "conv_id", "seq", "kind", "message", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")
    )
    known = known.where(
        F.col("kind").isin(
            "message", "edit", "delta", "regenerate"
        ) & F.col("seq").isNotNull() & F.col("message").isNotNull()
    )
    order = F.struct(
        "seq",
        F.array_position(F.array(*map(F.lit, ("message", "edit", "delta", "regenerate"))), F.col("kind")).alias("k"),
        "text", "role"
    )
    later = Window.partitionBy("conv_id").orderBy(F.col("at").desc()).rowsBetween(Window.unboundedPreceding, -1)
    taken_back = F.min(F.when(F.col("kind") == "regenerate", F.col("message"))).over(later)
    left = known.withColumn("at", order).withColumn("back", taken_back).where(
        "kind <> 'regenerate' and (back is null or message < back)"
    )
    own = Window.partitionBy("conv_id", "message")
    left = left.withColumn("base", F.max(F.when(F.col("kind") != "delta", F.col("at"))).over(own))
    last_role = F.max_by("role", F.when(F.col("kind") == "message", F.col("at")))
    pieces = F.array_sort(
        F.collect_list(F.when(F.col("base").isNull() | (F.col("at") >= F.col("base")), F.struct("at", "text")))
    )
    return left.groupBy("conv_id", "message").agg(
        F.coalesce(last_role, F.lit("")).alias("role"),
        F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text")
    )


def rendered(messages: DataFrame) -> DataFrame:
    """``(conv_id, formatted, mask)``: one row for each conversation.

    mask lists the spans of assistant texts in ``formatted``, as (start, length) in code
    points, start from 0: what training takes its loss from.  A conversation is one string,
    so it must fit a row.
    """
    head = F.concat(F.lit(TURN), escaped_role(F.col("role")), F.lit("\n"))
    turn = messages.select("conv_id", "message", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END) + 1
    placed = turn.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == "assistant", F.struct("start", F.length("body").cast("bigint").alias("length")))
    turns = F.array_sort(F.collect_list(F.struct("message", F.concat("head", "body", F.lit(END + "\n")).alias("text"))))
    return placed.groupBy("conv_id").agg(
        F.array_join(F.transform(turns, lambda t: t["text"]), "").alias("formatted"),
        F.array_sort(F.collect_list(span)).alias("mask")
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation, as array<struct<role, text>>."""
    pieces = F.slice(F.split(formatted, re.escape(TURN)), 2, 1 << 30)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substr(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 2 - len(END))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            mask, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
        ),
        ""
    )


def _numbered_turns(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv_id, message, role, text)``: by turn (nulls last), then role and text, so that tied rows stay rows; nulls are empty."""
    none = F.lit("")
    rows = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), none).alias("role"), F.coalesce(F.col(text), none).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).cast("bigint").alias("message"), "role", "text")


def turn_events(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A log of one message event for each row of a table of turns."""
    rows = _numbered_turns(rows, conv_id, turn, role, text)
    return rows.select(
        "conv_id", F.col("message").alias("seq"), F.lit("message").alias("kind"), "message", "role", "text"
    )


def streamed_events(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A log as a chat service writes it, which folds back to the table of turns.

    Every text arrives as a message event with its first third and two deltas.  Every third
    message first has other words that an edit replaces; every second answer is written
    twice, the first one taken back by a regeneration.
    """
    rows = _numbered_turns(rows, conv_id, turn, role, text)
    third = F.floor(F.length("text") / 3).cast("int")
    parts = [
        F.substr("text", F.lit(1), third), F.substr("text", third + 1, third),
        F.substr("text", 2 * third + 1, F.length("text"))
    ]
    edited = F.col("message") % 3 == 1
    again = (F.col("role") == "assistant") & (F.col("message") % 2 == 0)

    def event(seq: int, kind: str, text: Column, when: Column = F.lit(True)) -> Column:
        return F.when(when, F.struct(F.lit(seq).alias("step"), F.lit(kind).alias("kind"), text.alias("text")))

    events = F.array(
        event(0, "message", F.lit("An answer that is"), again),
        event(1, "delta", F.lit(" taken back <|end|>"), again),
        event(2, "regenerate", F.lit(""), again),
        event(3, "message", F.when(edited, "words that go").otherwise(parts[0])),
        event(4, "delta", F.lit(" with this"), edited),
        event(5, "edit", parts[0], edited),
        event(6, "delta", parts[1]),
        event(7, "delta", parts[2]),
    )
    steps = rows.select("conv_id", "message", "role", F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e"))
    seq = F.col("message") * 8 + F.col("e.step")
    return steps.select("conv_id", seq.alias("seq"), "e.kind", "message", "role", "e.text")


def format_log(events: DataFrame) -> DataFrame:
    """``(conv_id, formatted, mask)`` of a log of events (see ``folded``)."""
    return rendered(folded(events))


def format_conversations(rows: DataFrame, **columns: str) -> DataFrame:
    """``(conv_id, formatted, mask)`` of a table of turns.

    Repeated rows are turns of their own, null conversations are one conversation, null roles
    and texts are empty, an empty table gives an empty result.
    """
    return format_log(turn_events(rows, **columns))

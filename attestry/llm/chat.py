"""Chat formatting with a grammar round trip, in DataFrame functions only.

    conversation = turn*
    turn         = "[INST]" text "[/INST]"          user
                 | "<s>" text "</s>"                assistant
                 | "<<SYS>>" text "<</SYS>>"        system
                 | "<<ROLE " name ">>" text "<</ROLE>>"   any other role
    text, name   = characters without a control string, escapes read back

A conversation is rendered, read back by a deterministic parser of this grammar,
and compared with its source. Where they differ it is rendered again with the next
level of escapes: 0 none, 1 control strings and escapes lose their first character
to a code, 2 every bracket does. At level 2 no text can hold a control string, so
the trip ends there at the latest. A code is a backslash and a letter: ``\\l \\g \\o
\\c \\b`` for ``< > [ ] \\``.

The loss mask is a list of spans of the rendered text: what stands between the
marks of assistant turns.

Cases: null text and null roles count as empty; equal turn numbers are ordered by
role and text, repeated rows stay; rows of a null conversation are one conversation;
an empty table gives an empty one. A conversation and its rendered text are one row
each, so they must fit in one (2 GB), whatever the number of conversations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARKS = {
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
    "system": ("<<SYS>>", "<</SYS>>"),
}
OTHER = ("<<ROLE ", ">>", "<</ROLE>>")
CODES = {"<": "l", ">": "g", "[": "o", "]": "c"}
CONTROL = r"\[(?=/?INST\])|<(?=/?s>|</?SYS>>|<ROLE |</ROLE>>)|>(?=>)"
TURN = (
    r"(?s)\[INST\].*?\[/INST\]|<s>.*?</s>|<<SYS>>.*?<</SYS>>"
    r"|<<ROLE .*?>>.*?<</ROLE>>"
)
LEVELS = 3


def _swap(text: Column, found: str, character: str) -> Column:
    return F.regexp_replace(text, F.lit(found), F.lit("\\\\" + CODES[character]))


def escape(text: Column, level: int) -> Column:
    if level == 0:
        return text
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    if level == 1:
        text = _swap(text, r"\[(?=/?INST\])", "[")
        text = _swap(text, r"<(?=/?s>|</?SYS>>|<ROLE |</ROLE>>)", "<")
        return _swap(text, r">(?=>)", ">")
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("\\" + CODES[c])), CODES, text)


def unescape(text: Column) -> Column:
    text = reduce(lambda t, c: F.replace(t, F.lit("\\" + CODES[c]), F.lit(c)), CODES, text)
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def opening(role: Column, level: int) -> Column:
    named = F.concat(F.lit(OTHER[0]), escape(role, level), F.lit(OTHER[1]))
    return _by_role(role, 0, named)


def closing(role: Column) -> Column:
    return _by_role(role, 1, F.lit(OTHER[2]))


def _by_role(role: Column, side: int, other: Column) -> Column:
    cases = [F.when(role == F.lit(name), F.lit(marks[side])) for name, marks in MARKS.items()]
    return F.coalesce(*cases, other)


def parse(formatted: Column) -> Column:
    """Turns (role, text, clean) of a rendered text; null where it is not in the language.

    ``clean`` is false for a text or name that still holds a control string.
    """
    marked = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))

    def inner(turn, role):
        first, last = MARKS[role]
        return F.substring(turn, F.lit(len(first) + 1), F.length(turn) - (len(first) + len(last)))

    def read(turn):
        # The name of another role ends at the first mark after it.
        name = F.substring_index(F.substring(turn, F.lit(len(OTHER[0]) + 1), F.length(turn)), OTHER[1], 1)
        before = F.length(name) + (len(OTHER[0]) + len(OTHER[1]))
        rest = F.substring(turn, before + 1, F.length(turn) - before - len(OTHER[2]))
        known = [
            F.when(
                turn.startswith(MARKS[role][0]),
                F.struct(F.lit(role).alias("name"), inner(turn, role).alias("raw")),
            )
            for role in MARKS
        ]
        return F.coalesce(*known, F.struct(name.alias("name"), rest.alias("raw")))

    raw = F.transform(marked, read)
    turns = F.transform(
        raw,
        lambda t: F.struct(
            unescape(t["name"]).alias("role"),
            unescape(t["raw"]).alias("text"),
            (~t["raw"].rlike(CONTROL) & ~t["name"].rlike(CONTROL)).alias("clean"),
        ),
    )
    covered = F.aggregate(marked, F.lit(0), lambda n, m: n + F.length(m)) == F.length(formatted)
    return F.when(covered, turns)


def format_conversations(
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: ``key``, formatted, level, loss_spans.

    ``loss_spans`` are (start, chars) in code points of ``formatted``.
    """
    rows = conversations.select(
        F.col(key).alias("_key"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    before = (
        Window.partitionBy("_key")
        .orderBy("_turn", "_role", "_text")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    marked = {}
    for level in range(LEVELS):
        head, body = opening(F.col("_role"), level), escape(F.col("_text"), level)
        whole = F.length(head) + F.length(body) + F.length(closing(F.col("_role")))
        marked[f"_all{level}"] = whole.cast("bigint")
        marked[f"_head{level}"] = F.length(head)
        marked[f"_body{level}"] = F.length(body)
    measured = rows.withColumns(marked)
    # Where each text starts, at each level, while the turns still are rows.
    placed = measured.select(
        "_key",
        "_turn",
        "_role",
        "_text",
        *(
            F.struct(
                (F.coalesce(F.sum(f"_all{v}").over(before), F.lit(0)) + F.col(f"_head{v}")).alias("start"),
                F.col(f"_body{v}").cast("bigint").alias("chars"),
            ).alias(f"_span{v}")
            for v in range(LEVELS)
        ),
    )
    turns = placed.groupBy("_key").agg(
        F.sort_array(
            F.collect_list(
                F.struct("_turn", "_role", "_text", *(f"_span{v}" for v in range(LEVELS)))
            )
        ).alias("_turns")
    )

    def rendered(level):
        def render(t):
            return F.concat(
                opening(t["_role"], level), escape(t["_text"], level), closing(t["_role"])
            )

        return F.array_join(F.transform("_turns", render), "")

    def trip(level):
        """The text at this level if it reads back as its source, else null."""
        source = F.transform(
            "_turns",
            lambda t: F.struct(t["_role"].alias("role"), t["_text"].alias("text"), F.lit(True).alias("clean")),
        )
        made = rendered(level)
        return F.when(parse(made).eqNullSafe(source), F.struct(made.alias("formatted"), F.lit(level).alias("level")))

    last = F.struct(rendered(LEVELS - 1).alias("formatted"), F.lit(LEVELS - 1).alias("level"))
    trips = turns.withColumn("_trip", F.coalesce(*(trip(v) for v in range(LEVELS - 1)), last))
    answers = F.filter("_turns", lambda t: t["_role"] == "assistant")

    def spans_of(level):
        return F.transform(answers, lambda t: t[f"_span{level}"])

    spans = [F.when(F.col("_trip.level") == v, spans_of(v)) for v in range(LEVELS)]
    return trips.select(
        F.col("_key").alias(key),
        F.col("_trip.formatted").alias("formatted"),
        F.col("_trip.level").alias("level"),
        F.coalesce(*spans).alias("loss_spans"),
    )


def masked(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, escapes read back."""
    texts = F.transform(
        spans,
        lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["chars"].cast("int"))),
    )
    return F.array_join(texts, "")

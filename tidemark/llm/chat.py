"""Chat formatting with a grammar round trip.

A conversation becomes one string of turns ``<|im_start|>role\\ntext<|im_end|>\\n`` and a loss mask. Every turn is rendered
as it is, read back by a deterministic parser and compared with its source; what does not come back identical is rendered
with its control strings escaped. Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape_text(text: Column) -> Column:
    """Put one more backslash inside every ``<|``, ``<\\|``, ``<\\\\|`` ..., so that no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """As texts; a role also must not hold a line break."""
    return escape_text(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape_text(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted string, ``array<struct<role, text>>``; a piece that breaks the grammar gives a null."""
    pieces = F.split(formatted, r"\Q" + START + r"\E", -1)
    tail = END + "\n"

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(
            piece, F.char_length(role) + 2, F.char_length(piece) - F.char_length(role) - F.lit(1 + len(tail))
        )
        sound = (
            F.endswith(piece, F.lit(tail))
            & (F.char_length(piece) >= F.char_length(role) + F.lit(1 + len(tail)))
            & ~F.contains(role, F.lit("<|"))
            & ~F.contains(body, F.lit("<|"))
        )
        return F.when(sound, F.struct(unescape_role(role).alias("role"), unescape_text(body).alias("text")))

    first = F.when(F.element_at(pieces, 1) != "", F.array(F.lit(None).cast("struct<role:string,text:string>")))
    rest = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)
    return F.concat(F.coalesce(first, F.array().cast("array<struct<role:string,text:string>>")), rest)


def format_conversations(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, segments``.

    ``segments`` is the loss mask: the pieces of ``formatted`` in order, each with ``learn`` true for the texts of
    ``learn_roles`` and false for everything else; joined, they are ``formatted``.

    Null roles and texts count as empty. Rows with a null conversation id form one conversation, rows with a null turn
    come first, rows of the same turn follow by role and text, repeated rows stay. Other columns are left out. An empty
    table gives no rows. A conversation is one string by definition, so its rows meet in one task.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    # round trip of each turn: a turn that does not come back identical is escaped. Rendered turns begin and end with
    # their own markers, so what holds for each turn holds for their concatenation.
    source = F.array(F.struct("role", "text"))
    same = F.coalesce(parse_turns(_render(F.col("role"), F.col("text"))) == source, F.lit(False))
    rows = rows.withColumn("same", same).select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.when(F.col("same"), F.col("role")).otherwise(escape_role(F.col("role"))).alias("shown_role"),
        F.when(F.col("same"), F.col("text")).otherwise(escape_text(F.col("text"))).alias("shown_text"),
    )
    head = F.concat(F.lit(START), F.col("shown_role"), F.lit("\n"))
    pieces = F.array(
        F.struct(head.alias("text"), F.lit(False).alias("learn")),
        F.struct(F.col("shown_text").alias("text"), F.col("role").isin(*learn_roles).alias("learn")),
        F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("learn")),
    )
    grouped = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", pieces.alias("pieces")))).alias("all_turns")
    )
    segments = F.flatten(F.transform("all_turns", lambda t: t["pieces"]))
    return grouped.select(
        "conv_id",
        F.size("all_turns").cast("long").alias("n_turns"),
        segments.alias("segments"),
        F.array_join(F.transform(segments, lambda s: s["text"]), "").alias("formatted"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the output: turns by parsing the string, learned texts by the mask."""
    read = formatted.withColumn("read", parse_turns(F.col("formatted")))
    turns = F.array_join(
        F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learned = F.array_join(
        F.transform(F.filter("segments", lambda s: s["learn"]), lambda s: unescape_text(s["text"])), ""
    )
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )

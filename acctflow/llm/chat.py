r"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation's turns are put in order and written with a template: a start
mark, the role, a line end, the text, an end mark, a line end. Control strings
inside texts and roles are escaped reversibly, so no text can open or close a
turn: between ``<`` and ``|`` one backslash is added to those already there.
A line end inside a role becomes a control string of its own.

Every assistant turn becomes an example: the context is all that stands before
its text, and only its text is trainable. As each context is a prefix of the
same conversation, the conversation's text is kept once and an example holds
offsets into it; so the output stays in proportion to the input however long a
conversation is. ``expanded`` writes the contexts out where that is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The template: control strings of turns and of a line end inside a role.
START, END, ROLE_LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
END_LINE = "<\\|im_end\\|>\n"  # an end mark and its line end, as a pattern


def escaped(text: F.Column) -> F.Column:
    """Reversible; no ``<|`` is left in the result."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: F.Column) -> F.Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` (its whole text)
    and ``targets``, an array of one entry per turn: (start, end), its trainable
    span in code points from 0 of ``formatted``, or null if it has none.

    Turns are ordered by number, then role and text (nulls first), so ties and
    repeated rows have one order. Null texts and roles are empty; null
    conversation ids form one conversation. Other columns are not read. A
    conversation is one text, so it is gathered whole, after one shuffle.
    """
    role = F.regexp_replace(escaped(F.coalesce(F.col(role_col).cast("string"), F.lit(""))), "\n", ROLE_LINE)
    text = escaped(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text")
    ).withColumn("piece", F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n")))
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("until", F.sum(F.length("piece").cast("long")).over(so_far))
    end = F.col("until") - len(END) - 1
    target = F.when(F.col("role") == "assistant", F.struct((end - F.length("text")).alias("start"), end.alias("end")))
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("until", "piece", target.alias("target")))).alias("ts")
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("ts", lambda t: t["target"]).alias("targets"),
    )


def examples(conversations: DataFrame, *carry: str) -> DataFrame:
    """One row per assistant turn: ``conv_id``, ``example`` (from 0),
    ``context_chars`` (the prefix that is context), ``target_start``,
    ``target_end`` and ``target``, the trainable text as formatted; beside them
    the columns ``carry`` of ``conversations``. A conversation without an
    assistant turn keeps one row, its example fields null."""
    # A span ends where its turn's end mark begins, so it is taken from the end
    # of its turn; counting code points from the conversation's start for each
    # would grow with the square of its length.
    turns = F.slice(F.split("formatted", END_LINE, -1), 1, F.size("targets"))

    def example(turn: F.Column, t: F.Column) -> F.Column:
        n = (t["end"] - t["start"]).cast("int")
        target = F.substring(turn, F.length(turn) - n + 1, n)
        return F.when(t.isNotNull(), F.struct(t["start"].alias("start"), t["end"].alias("end"), target.alias("target")))

    cut = F.filter(F.zip_with(turns, "targets", example), lambda e: e.isNotNull())
    rows = conversations.select("conv_id", *carry, F.posexplode_outer(cut).alias("example", "e"))
    return rows.select(
        "conv_id", *carry, "example", F.col("e.start").alias("context_chars"), F.col("e.start").alias("target_start"),
        F.col("e.end").alias("target_end"), F.col("e.target").alias("target"),
    )


def expanded(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, context, target): each example with its context
    written out; its size grows with the square of a conversation's length."""
    rows = examples(conversations, "formatted").where(F.col("example").isNotNull())
    context = F.substring("formatted", F.lit(1), F.col("context_chars").cast("int"))
    return rows.select("conv_id", "example", context.alias("context"), "target")


def turns_of(formatted: F.Column) -> F.Column:
    """Read a formatted conversation back: array of (role, text), unescaped."""
    pieces = F.split(formatted, END_LINE, -1)
    bodies = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))

    def one(body: F.Column) -> F.Column:
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        plain = unescaped(F.regexp_replace(role, "<\\|nl\\|>", "\n"))
        return F.struct(plain.alias("role"), unescaped(text).alias("text"))

    return F.transform(bodies, one)


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and
    formatted_chars, all read back from the formatted text and its examples."""
    turns = F.col("turns")
    whole = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = conversations.withColumn("turns", turns_of(F.col("formatted"))).select(
        "conv_id", "formatted", "targets", F.size(turns).cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    held = ("n_turns", "turns_sha256", "formatted_chars")
    per_example = examples(read, *held).withColumn("target", unescaped(F.col("target")))
    grouped = per_example.groupBy("conv_id").agg(
        *[F.first(c).alias(c) for c in held],
        F.array_sort(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", "target")))).alias("es"),
    )
    loss = F.array_join(F.transform("es", lambda e: e["target"]), "")
    return grouped.select(
        "conv_id", "n_turns", "turns_sha256", F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )

"""Chat formatting by prefix-target expansion.

Every assistant turn is an example of its own: all turns before it are its context, and only its own text is trainable.
``format_turns`` formats each turn once and gives its place, and to a reply the span of its loss mask; ``rendered`` expands that to the
examples, each with its whole context, and ``read_examples`` reads them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A turn is MARK, the role, AFTER_ROLE, the text, END.
MARK, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
REPLY_ROLE = "assistant"
#: Turn numbers whose rows one task puts in order; the lengths of earlier ranges are added up beforehand.
RANGE = 1024

# A backslash goes before each first character of a mark, and before a backslash; a colon in a role becomes ``\.``.
_ESCAPED, _FOUND = r"([\\#<])", r"\\([\\#<])"


def escaped(text: Column) -> Column:
    """Text in which no mark of the template can be found."""
    return F.regexp_replace(text, _ESCAPED, r"\\$1")


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given."""
    return F.regexp_replace(text, _FOUND, "$1")


def _role_in(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(":"), F.lit(r"\."))


def _role_out(role: Column) -> Column:
    # Every backslash starts a pair, so the pairs are taken from left to right: first those of a backslash are set aside.
    parts = F.split(role, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: unescaped(F.replace(p, F.lit(r"\."), F.lit(":")))), "\\")


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted turns of ``turns`` (conv_id, turn, role, text): conv_id, place, start, chars, formatted, and the example of a reply.

    ``place`` counts the turns of a conversation from 0, ``start`` and all other lengths are code points of its formatted text.
    A reply's row is an example: ``context_turns`` and ``context_chars`` (the context and the reply's own heading, not trainable),
    ``loss_start`` and ``loss_end`` (its text, trainable) and ``example_chars``; they are null in other rows. Rows come by turn;
    equal turns by role and text, null first, and repeated rows are turns of their own. A null role or text counts as empty; rows
    without a conv_id are one conversation. Other columns are left out. Rows of one turn range of a conversation meet in one task, never all
    of a conversation, unless it has one turn number for all.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.select(
        "conv_id",
        # Joins and windows go by a key that is never null, so that they share one shuffle.
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.coalesce(F.floor(F.col("turn") / RANGE), F.lit(-(1 << 62))).alias("range"),
        "turn",
        "role",
        "text",
        F.concat(F.lit(MARK), _role_in(role), F.lit(AFTER_ROLE)).alias("heading"),
        escaped(text).alias("said"),
    )
    rows = rows.select("*", (F.length("heading") + F.length("said") + len(END)).cast("bigint").alias("chars"))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("conv", "range").agg(F.sum("chars").alias("sum"), F.count("*").alias("n"))
    before = ranges.select(
        "conv",
        "range",
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("turns_before"),
    )
    by_turn = Window.partitionBy("conv", "range").orderBy("turn", "role", "text")
    so_far = by_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns({"own_place": F.row_number().over(by_turn), "own_end": F.sum("chars").over(so_far)})
    start = F.col("chars_before") + F.col("own_end") - F.col("chars")
    placed = placed.join(before, ["conv", "range"]).withColumns({"place": F.col("turns_before") + F.col("own_place") - 1, "start": start})
    reply = F.col("role") == REPLY_ROLE
    loss_start = F.col("start") + F.length("heading")

    def of_reply(value: Column) -> Column:
        return F.when(reply, value)

    return placed.select(
        "conv_id",
        "place",
        "start",
        "chars",
        F.concat("heading", "said", F.lit(END)).alias("formatted"),
        of_reply(F.col("place")).alias("context_turns"),
        of_reply(loss_start).alias("context_chars"),
        of_reply(loss_start).alias("loss_start"),
        of_reply(loss_start + F.length("said")).alias("loss_end"),
        of_reply(F.col("start") + F.col("chars")).alias("example_chars"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """Role and text of formatted turns, taken from the formatted text alone, and the text under the loss mask (null without one)."""
    whole = F.col("formatted")
    heading_end = F.locate(AFTER_ROLE, whole, len(MARK) + 1)
    role = F.substring(whole, F.lit(len(MARK) + 1), heading_end - len(MARK) - 1)
    text_from = heading_end + len(AFTER_ROLE)
    said = F.substring(whole, text_from, F.length(whole) - len(END) - text_from + 1)
    masked = F.substring(whole, (F.col("loss_start") - F.col("start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    return formatted.withColumns({"role": _role_out(role), "text": unescaped(said), "loss_text": unescaped(masked)})


def rendered(formatted: DataFrame) -> DataFrame:
    """Examples with their whole text: conv_id, place, example, loss_start, loss_end, one row per reply.

    The text of the context is repeated in every example, so this grows with the square of a conversation. Its rows stand together by
    conversation, so that a compressed file holds a context about once.
    """
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = formatted.withColumn("example", F.array_join(F.collect_list("formatted").over(so_far), ""))
    return whole.filter("loss_start IS NOT NULL").select("conv_id", "place", "example", "loss_start", "loss_end")


def read_examples(examples: DataFrame) -> DataFrame:
    """What a trainer takes from ``rendered`` examples, read from their text alone: the context, and the text under the loss mask."""
    masked = F.substring(F.col("example"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    context = F.substring(F.col("example"), F.lit(1), F.col("loss_start").cast("int"))
    return examples.withColumns({"context": context, "loss_text": unescaped(masked)})

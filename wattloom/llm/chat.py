r"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of one
role form a block with one header.  The template of a block is

    ### role: text</turn>text</turn>\n

Inside texts and roles ``\`` becomes ``\\``, ``#`` becomes ``\#`` and ``</``
becomes ``<\/`` (in roles also ``:`` becomes ``\:``), so neither ``###`` nor
``</turn>`` occurs in them and every turn can be read back exactly.  The loss mask
lies on the texts of the trained role alone, not on headers or end marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import quoted

END = "</turn>"
_HEADER = r"(?s)^### ([^\\:]*+(?:\\.[^\\:]*+)*+): "


def escape(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("#", "\\#"), ("</", "<\\/")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted``.

    ``segments`` is an array of ``(text, loss)`` whose texts concatenate to
    ``formatted``; ``loss`` marks what is trained on.  Null texts and roles count
    as empty.  Turns are ordered by turn number (null first), then role, then
    text; repeated rows stay repeated.  Rows with a null conversation id form one
    conversation.  An empty table gives no row.  A conversation is one row, so
    it is bounded by the size of a Spark row.
    """
    rows = turns.select(
        quoted(conv_col).alias("conv_id"),
        F.struct(
            quoted(turn_col).alias("turn"),
            F.coalesce(quoted(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    # where a block begins: the first turn, and each whose role differs from the one before
    begins = F.filter(
        F.sequence(F.lit(1), F.size("t")),
        lambda i: (i == 1)
        | (F.element_at("t", i)["role"] != F.element_at("t", F.greatest(i - 1, F.lit(1)))["role"]),
    )
    located = sorted_turns.withColumn("b", begins)
    blocks = F.transform(
        "b",
        lambda i, k: F.slice(
            "t", i, F.coalesce(F.get("b", k + 1), F.size("t") + 1) - i
        ),
    )
    merged = located.select("conv_id", blocks.alias("blocks"))
    segments = F.flatten(F.transform("blocks", lambda block: _segments(block, trained_role)))
    out = merged.select("conv_id", segments.alias("segments"))
    return out.withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _segments(block: Column, trained_role: str) -> Column:
    role = block[0]["role"]
    no = F.lit(False)
    header = F.concat(F.lit("### "), F.replace(escape(role), F.lit(":"), F.lit("\\:")), F.lit(": "))
    bodies = F.flatten(
        F.transform(
            block,
            lambda t: F.array(
                _segment(escape(t["text"]), role == trained_role), _segment(F.lit(END), no)
            ),
        )
    )
    return F.concat(F.array(_segment(header, no)), bodies, F.array(_segment(F.lit("\n"), no)))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of ``(role, text)``."""
    blocks = F.filter(F.split(formatted, r"</turn>\n(?=###|\z)", -1), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.regexp_replace(b, _HEADER, ""), END, -1),
                lambda t: F.struct(
                    unescape(F.regexp_extract(b, _HEADER, 1)).alias("role"),
                    unescape(t).alias("text"),
                ),
            ),
        )
    )


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    marked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: unescape(s["text"])), "")

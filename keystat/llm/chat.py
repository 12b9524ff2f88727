"""Chat formatting: conversations as one marked-up text, native Spark SQL.

Turn rows become sorted arrays of turn structs, adjacent turns of one role form
one block, and the blocks are joined into the formatted text::

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n

Control strings inside roles and texts are escaped reversibly: ``\\`` becomes
``\\\\`` and ``<|`` becomes ``<\\|``, so no marker can come from a text (nor end
a role: a line feed there becomes ``<\\~``). A ``<`` before one single
backslash comes from an escape only, which is why two literal replacements undo
it. ``segments`` holds the same text cut where the loss mask changes.

Turns are sorted by (turn, role, text), nulls first, so ties and repeated rows
have one order; a null role or text counts as empty, rows without a conversation
id form one conversation, an empty table gives an empty result, and other
columns are ignored. Turns meet in two steps, first those of ``TURNS_A_PART``
consecutive turn numbers, so that a very long conversation is sorted in parts;
only its finished row is one task's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
TURNS_A_PART = 64


def _replace(x: Column, old: str, new: str) -> Column:
    return F.replace(x, F.lit(old), F.lit(new))


def escape(x: Column) -> Column:
    return _replace(_replace(x, "\\", "\\\\"), "<|", "<\\|")


def unescape(x: Column) -> Column:
    return _replace(_replace(x, "<\\|", "<|"), "\\\\", "\\")


def escape_role(x: Column) -> Column:
    return _replace(escape(x), "\n", "<\\~")


def unescape_role(x: Column) -> Column:
    return _replace(_replace(_replace(x, "<\\~", "\n"), "<\\|", "<|"), "\\\\", "\\")


def _pieces(turns: Column) -> Column:
    """The text of every turn with its block's marks: (text, loss) each."""
    def piece(x: Column, i: Column) -> Column:
        opens = (i == 0) | (F.get(turns, i - 1)["role"] != x["role"])
        closes = (i == F.size(turns) - 1) | (F.get(turns, i + 1)["role"] != x["role"])
        return F.array(
            F.struct(F.when(opens, F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n")))
                     .otherwise(F.lit(SEPARATOR)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(x["text"]).alias("text"), (x["role"] == LOSS_ROLE).alias("loss")),
            F.struct(F.when(closes, F.lit(END)).otherwise(F.lit("")).alias("text"), F.lit(False).alias("loss")))

    return F.flatten(F.transform(turns, piece))


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, segments, formatted) for every conversation of
    (conv_id, turn, role, text) rows; ``segments`` are (text, loss) structs."""
    turns = conversations.select(
        "conv_id", F.floor(F.col("turn") / TURNS_A_PART).alias("part"),
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    parts = turns.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "rows"))).alias("parts"))
    ordered = whole.select("conv_id", F.flatten(F.transform("parts", lambda p: p["rows"])).alias("turns"))
    marked = ordered.select("conv_id", _pieces(F.col("turns")).alias("segments"))
    return marked.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """The (role, texts) blocks of a formatted text, unescaped."""
    # the split leaves an empty text after the last end mark
    blocks = F.slice(F.split(formatted, r"<\|im_end\|>\n", -1), 1,
                     F.size(F.split(formatted, r"<\|im_end\|>\n", -1)) - 1)

    def block(b: Column) -> Column:
        role = F.substring(F.substring_index(b, "\n", 1), len(START) + 1, 1 << 30)
        body = F.substr(b, F.length(role) + F.lit(len(START) + 2))
        return F.struct(unescape_role(role).alias("role"),
                        F.transform(F.split(body, r"<\|im_sep\|>", -1), unescape).alias("texts"))

    return F.transform(blocks, block)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")

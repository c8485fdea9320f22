"""Chat conversations as training examples, one per assistant turn.

Every assistant turn becomes an example of its own: the text of all turns before it as
context, then its own turn, of which only the reply is trainable. The loss mask is a
span of code points in the example's text. Turns after the last reply, and
conversations without any, are kept in one more example without a trainable span, so
no turn is lost.

Template: a turn is ``[INST]role[/INST]text</s>``. A control string inside a role or a
text gets a backslash after its bracket, one that already has backslashes there gets one
more, so ``</s>`` is stored as ``<\\/s>`` and ``<\\/s>`` as ``<\\\\/s>``; taking one away
again gives the original. No other character changes.

Defined cases: null texts and roles are empty; rows of one conversation are ordered by
turn, then role, then text, and repeated rows stay repeated; a null turn comes first; each
row without a conversation id is a conversation of its own, since nothing says what belongs together, told
apart by ``row`` (null for all others). Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
_CONTROL = r"(/?INST\]|/?s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])\\(\\*)" + _CONTROL, r"$1$2$3")


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(CLOSE))


def format_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per example: conv_id, row, example, text, loss_start, loss_chars (code points; null without a target), last.

    ``last`` marks the example that holds all turns of its conversation.
    """
    empty = F.lit("")
    turns = rows.select(
        F.col(conv).alias("conv_id"),
        F.when(F.col(conv).isNull(), F.monotonically_increasing_id()).alias("row"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), empty).alias("role"),
            F.coalesce(F.col(text), empty).alias("text"),
        ).alias("t"),
    )
    # A conversation is one training text, so its turns meet in one row by definition.
    whole = turns.groupBy("conv_id", "row").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    marked = whole.withColumn(
        "parts",
        F.transform(
            "turns",
            lambda t: F.struct(
                _header(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("target")
            ),
        ),
    )
    is_end = lambda part, i: part["target"] | (i == F.size("parts") - 1)
    ends = F.filter(F.transform("parts", lambda p, i: F.when(is_end(p, i), i)), lambda i: i.isNotNull())
    examples = marked.select("conv_id", "row", "parts", F.posexplode(ends).alias("example", "upto"))
    piece = lambda p: F.concat(p["head"], p["body"], F.lit(END))
    target = F.element_at("parts", F.col("upto") + 1)
    formatted = F.array_join(F.transform(F.slice("parts", F.lit(1), F.col("upto") + 1), piece), "")
    return examples.select(
        "conv_id",
        "row",
        "example",
        formatted.alias("text"),
        target["target"].alias("has_target"),
        F.char_length(target["body"]).alias("body_chars"),
        (F.col("upto") == F.size("parts") - 1).alias("last"),
    ).select(
        "conv_id",
        "row",
        "example",
        "text",
        F.when(F.col("has_target"), F.char_length("text") - F.col("body_chars") - len(END)).alias("loss_start"),
        F.when(F.col("has_target"), F.col("body_chars")).alias("loss_chars"),
        "last",
    )


def read_turns(text: Column) -> Column:
    """The turns of an example, read back from its text as an array of (role, text)."""
    pieces = F.split(text, r"</s>", -1)
    inner = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(
        inner,
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), CLOSE, 1)).alias("role"),
            unescape(F.substr(p, F.locate(CLOSE, p) + len(CLOSE))).alias("text"),
        ),
    )


def trainable(text: Column, start: Column, chars: Column) -> Column:
    """What lies under the loss mask, unescaped."""
    return unescape(F.substr(text, start + 1, chars))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Counts and hashes of each conversation, read back from its examples."""
    turn_text = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    read = examples.select(
        "conv_id",
        "row",
        "example",
        F.char_length("text").cast("long").alias("chars"),
        F.when(F.col("loss_start").isNotNull(), trainable(F.col("text"), F.col("loss_start"), F.col("loss_chars"))).alias(
            "loss"
        ),
        F.when(F.col("last"), read_turns(F.col("text"))).alias("turns"),
    ).select(
        "conv_id",
        "row",
        "example",
        "chars",
        "loss",
        F.when(F.col("turns").isNotNull(), F.size("turns").cast("long")).alias("n_turns"),
        F.when(F.col("turns").isNotNull(), F.sha2(F.array_join(F.transform("turns", turn_text), ""), 256)).alias("hash"),
    )
    # One digest per conversation: the slim columns of its examples meet, not their texts.
    replies = F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss"))))
    return (
        read.groupBy("conv_id", "row")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("hash").alias("turns_sha256"),
            F.array_join(F.transform(replies, lambda r: r["loss"]), "").alias("loss"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )

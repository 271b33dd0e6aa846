"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Each turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Every assistant turn
is an example of its own: all turns before it are context, and only its text is
trainable. Turns after the last assistant turn end up in a closing example
without a target, so that no turn is lost.

Texts are escaped so that they never hold ``<|``: ``&`` becomes ``&amp;`` and
``<|`` becomes ``&lt;|``; in roles a line break becomes ``&#10;`` too.

Defined cases: a null role or text is empty; rows of a conversation are ordered
by turn (null first), then role and text, and repeated rows all stay; a null
conv_id is a conversation like any other; a conversation without assistant
turns has the closing example only; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&#10;"), F.lit("\n")), F.lit("&lt;"), F.lit("<")),
                     F.lit("&amp;"), F.lit("&"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, examples.

    ``examples`` holds, for each example in order, the turns it spans, the length
    of its text (a prefix of ``formatted``) and the place of its target in it.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"),
                                 escape(text).alias("body"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    piece = F.concat("head", "body", F.lit(END))
    placed = turns.select(
        "conv_id", "role", F.row_number().over(order).alias("no"), piece.alias("piece"),
        F.length("head").alias("head_chars"), F.length("body").alias("target_chars"),
        F.sum(F.length(piece)).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("chars"))
    target_start = F.col("chars") - F.length(F.lit(END)) - F.col("target_chars") + 1
    target = F.struct("no", "chars", target_start.alias("target_start"), F.col("target_chars").cast("long").alias("target_chars"))
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("no", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(F.when(F.col("role") == TARGET_ROLE, target))).alias("targets"),
        F.max(F.struct("no", "chars")).alias("last"))
    closing = F.struct(F.col("last.no").alias("no"), F.col("last.chars").alias("chars"),
                       F.lit(None).cast("long").alias("target_start"), F.lit(0).cast("long").alias("target_chars"))
    covered = F.coalesce(F.try_element_at("targets", F.lit(-1))["no"] == F.col("last.no"), F.lit(False))
    return whole.select(
        "conv_id", F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        F.when(covered, F.col("targets")).otherwise(F.concat("targets", F.array(closing))).alias("examples"))


def expand(formatted: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (from 0), closing (last of its conversation), n_turns, text, target_start (from 1), target_chars."""
    one = F.col("example")
    return (formatted.select("conv_id", "formatted", F.size("examples").alias("n"), F.posexplode("examples").alias("k", "example"))
            .select("conv_id", F.col("k").alias("example_no"), (F.col("k") == F.col("n") - 1).alias("closing"),
                    one["no"].alias("n_turns"), F.substring("formatted", F.lit(1), one["chars"].cast("int")).alias("text"),
                    one["target_start"].alias("target_start"), one["target_chars"].alias("target_chars"),
                    one["chars"].alias("chars"))
            .withColumnRenamed("example_no", "example"))


def target_of(text: Column, start: Column, chars: Column) -> Column:
    """The unescaped text under the loss mask; empty where there is no target."""
    return F.coalesce(unescape(F.substring(text, start.cast("int"), chars.cast("int"))), F.lit(""))


def turns_of(text: Column) -> Column:
    """The turns that a formatted text holds: an array of role and text."""
    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(F.split(text, r"<\|im_start\|>"), F.lit(2), F.greatest(F.size(F.split(text, r"<\|im_start\|>")) - 1, F.lit(0))), turn)


def digests(examples: DataFrame) -> DataFrame:
    """What the examples hold, read back from them, per conversation."""
    rows = examples.select(
        "conv_id", "example", "chars", target_of(F.col("text"), F.col("target_start"), F.col("target_chars")).alias("target"),
        F.when(F.col("closing"), F.col("text")).alias("all_text"))
    per = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("example", "target"))).alias("targets"),
        F.max("all_text").alias("all_text"), F.sum("chars").alias("formatted_chars"))
    per = per.select("conv_id", turns_of(F.col("all_text")).alias("turns"),
                     F.array_join(F.col("targets.target"), "").alias("target"), "formatted_chars")
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return per.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("target").cast("long").alias("loss_chars"), F.sha2(F.col("target").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))

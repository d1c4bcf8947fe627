"""Chat formatting by prefix-target expansion (built-in functions only).

Every assistant turn becomes an example of its own: all preceding turns are the context and only that
reply is trainable.  A conversation that does not end with an assistant turn gives one more example
without a target, so no turn is missing from the output.

Template: ``<|turn|>role<|text|>text<|end|>`` per turn.  Roles and texts are escaped reversibly:
backslash becomes ``\\b`` and ``<`` becomes ``\\l``, so no control string (all start with ``<``) can
stand inside a text, and undoing ``\\l`` before ``\\b`` gives the text back.

Edge cases: turns are ordered by (turn, role, text), which settles ties and repeated rows (each is a
turn); a null role or text is an empty one; rows with a null conv_id form one conversation; a null turn
number sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def examples(conversations: DataFrame, target_role: str = "assistant") -> DataFrame:
    """conv_id, example (0..), is_last, formatted, loss_start, loss_length (code points; 0 long without a target)."""
    empty = F.lit("")
    turns = conversations.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")))).alias("turns")
    )
    heads = F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)))
    bodies = F.transform("turns", lambda t: escape(t["text"]))
    pieces = turns.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == target_role).alias("is_target"),
        heads.alias("heads"),
        bodies.alias("bodies"),
    ).select("*", F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(END))).alias("formatted_turns"))
    # positions to expand: every target turn, and the last turn in any case
    positions = F.filter(F.sequence(F.lit(1), F.size("heads")), lambda i: F.element_at("is_target", i) | (i == F.size("heads")))
    one = pieces.withColumn("n", F.size("heads")).select("*", F.posexplode(positions).alias("example", "at"))
    context = F.array_join(F.slice("formatted_turns", F.lit(1), F.col("at") - 1), "")
    has_target = F.element_at("is_target", F.col("at"))
    lead = F.concat(context, F.element_at("heads", F.col("at")))
    return one.select(
        "conv_id", "example", (F.col("at") == F.col("n")).alias("is_last"), lead.alias("lead"), F.element_at("bodies", F.col("at")).alias("body"), has_target.alias("has_target")
    ).select(
        "conv_id",
        "example",
        "is_last",
        F.concat("lead", "body", F.lit(END)).alias("formatted"),
        F.length("lead").alias("loss_start"),
        F.when(F.col("has_target"), F.length("body")).otherwise(0).alias("loss_length"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted example as array<struct<role, text>>."""
    parts = F.split(formatted, r"<\|end\|>")
    full = F.slice(parts, F.lit(1), F.size(parts) - 1)  # after the last mark comes an empty rest
    return F.transform(
        full,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, len(TURN) + 1, 2147483647), TEXT, 1)).alias("role"),
            unescape(F.substring_index(p, TEXT, -1)).alias("text"),
        ),
    )


def digests(ex: DataFrame) -> DataFrame:
    """Per conversation, read from the examples: turn count and digest, loss text length and digest, formatted length."""
    trained = unescape(F.expr("substring(formatted, loss_start + 1, loss_length)"))
    rows = ex.select(
        "conv_id",
        F.struct("example", trained.alias("text")).alias("trained"),
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("is_last"), read_back(F.col("formatted"))).alias("turns"),
    )
    per = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("trained")).alias("trained"), F.sum("chars").alias("formatted_chars"), F.max("turns").alias("turns"))
    loss = F.array_join(F.transform("trained", lambda t: t["text"]), "")
    listing = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", F.size("turns").cast("long").alias("n_turns"), listing.alias("listing"), loss.alias("loss"), "formatted_chars").select(
        "conv_id",
        "n_turns",
        F.sha2("listing", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )

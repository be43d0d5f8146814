"""Chat formatting: one example per assistant turn, with all turns before it as context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template: a header with the role, the text, an end mark.
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    """No ``<|`` is left: every ``<``, backslashes, ``|`` gets one more backslash. See :func:`unescaped`."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role also loses line breaks, since one ends the header."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    plain = unescaped(role)
    # protect doubled backslashes, read line breaks, then restore
    halves = F.transform(F.split(plain, r"\\\\"), lambda part: F.replace(part, F.lit("\\n"), F.lit("\n")))
    return F.array_join(halves, "\\")


def header(role: Column) -> Column:
    return F.concat(F.lit(START), escaped_role(role), F.lit("\n"))


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, number, context, target, open_turns: every assistant turn with the turns before it.

    ``context`` is the formatted text up to and including the target's header, ``target`` the reply
    with its end mark; only ``target`` is trainable. Turns after the last reply (all of them, where
    no assistant speaks) make one more example without target, so that no turn is lost. Rows of a
    conversation are taken by turn (null last), then role, then text; a null text is empty, a null
    role has an empty name; a null conv_id is a conversation. A conversation is one row here, as the
    result's digests over all its turns ask for.
    """
    turn = F.struct(
        F.col("turn").isNull().alias("late"), F.col("turn").alias("at"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    piece = F.transform(
        "turns",
        lambda t: F.struct(
            header(t["role"]).alias("head"),
            F.concat(escaped(t["text"]), F.lit(END)).alias("body"),
            (t["role"] == ASSISTANT).alias("reply"),
        ),
    )
    formatted = turns.select("conv_id", piece.alias("p")).select("conv_id", "p", F.size("p").alias("n"))
    place = F.sequence(F.lit(1), F.col("n"))
    ends = F.filter(place, lambda i: F.get(F.col("p"), i - 1)["reply"] | (i == F.col("n")))
    each = formatted.select("conv_id", "p", F.posexplode(ends).alias("number", "end"))
    last = F.get(F.col("p"), F.col("end") - 1)
    before = F.transform(F.slice("p", F.lit(1), F.col("end") - 1), lambda t: F.concat(t["head"], t["body"], F.lit("\n")))
    context = F.concat(F.array_join(before, ""), last["head"])
    return each.select(
        "conv_id", "number",
        F.when(last["reply"], context).otherwise(F.concat(context, last["body"])).alias("context"),
        F.when(last["reply"], last["body"]).alias("target"),
    )


def turns_of(formatted: Column) -> Column:
    """Read a formatted text back: array of (role, text)."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda part, i: i > 0)
    return F.transform(
        parts,
        lambda part: F.struct(
            unescaped_role(F.substring_index(part, "\n", 1)).alias("role"),
            unescaped(
                F.substring_index(F.substr(part, F.length(F.substring_index(part, "\n", 1)) + 2), END, 1)
            ).alias("text"),
        ),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What :func:`examples` holds, read back per conversation.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (of all examples). The
    longest example of a conversation holds all its turns.
    """
    whole = F.concat("context", F.coalesce("target", F.lit("")))
    reply = unescaped(F.substring_index("target", END, 1))
    gathered = formatted.groupBy("conv_id").agg(
        F.max_by(whole, "number").alias("all"),
        F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("number", reply.alias("text"))))).alias("replies"),
        F.sum(F.length(whole)).alias("formatted_chars"),
    )
    turns = gathered.select("conv_id", turns_of(F.col("all")).alias("turns"), "replies", "formatted_chars")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("replies", lambda r: r["text"]), "")
    return turns.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )

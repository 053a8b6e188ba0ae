"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Template: every turn is ``<s>`` role newline text ``</s>``. Inside roles and texts a backslash becomes ``\\e``, and a
``\\-`` is put after the first character of every control string; in roles a newline becomes ``\\n``. As every backslash
of an escaped text opens an escape, replacing them back restores the text.

``expand`` makes one example of every assistant turn: the formatted turns up to it, of which only the reply's (escaped)
text is trainable, code points [loss_start, loss_end). Turns behind the last assistant turn, or a conversation without
one, are kept in an example without a trainable span, so that every turn stands in the output.

Turns are ordered by turn number, ties by role and text (nulls first). Null roles and texts are empty; null conversation
ids form one conversation; a role counts as assistant if it equals ``assistant``. A conversation is one text, so it has
to fit in a row; repeated rows are repeated turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Marks of this template and of common others, which no formatted text may contain by itself.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
OPEN, CLOSE, ASSISTANT = "<s>", "</s>", "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\e"))
    for mark in CONTROL:
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + "\\-" + mark[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\-"), F.lit("")), F.lit("\\e"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def expand(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per example: conv_id, example (from 0), last (whether it holds all turns), text, loss_start, loss_end."""
    empty = F.lit("")
    parts = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), empty).alias("role"),
        F.coalesce(F.col(text), empty).alias("body"),
    ).select(
        "conv_id", "turn", "role", "body", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("body")).alias("escaped")
    )
    order = ["turn", "role", "body"]
    size = F.length("head") + F.length("escaped") + F.lit(len(CLOSE))
    # the order by conversation is the groups' own below, so the rows are shuffled once
    end = F.sum(size.cast("long")).over(Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    spans = parts.withColumn("end", end)
    item = F.struct(
        F.col("end"),
        (F.col("end") - len(CLOSE) - F.length("escaped")).alias("from"),
        (F.col("role") == ASSISTANT).alias("reply"),
        F.concat("head", "escaped", F.lit(CLOSE)).alias("piece"),
    )
    whole = spans.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    whole = whole.select(
        "conv_id",
        F.array_join(F.transform("items", lambda x: x["piece"]), "").alias("all"),
        F.filter(F.transform("items", lambda x: F.struct(x["end"].alias("end"), x["from"].alias("from"), x["reply"].alias("reply"))), lambda x: x["reply"] | (x["end"] == F.get(F.col("items"), F.size("items") - 1)["end"])).alias("ends"),
    )
    each = whole.select("conv_id", "all", F.size("ends").alias("n"), F.posexplode("ends").alias("example", "at"))
    return each.select(
        "conv_id",
        "example",
        (F.col("example") == F.col("n") - 1).alias("last"),
        F.expr("substring(all, 1, cast(at.end as int))").alias("text"),
        F.when(F.col("at.reply"), F.col("at.from")).alias("loss_start"),
        F.when(F.col("at.reply"), F.col("at.end") - len(CLOSE)).alias("loss_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples: turns (role, text) of the whole conversation, replies in order, formatted length."""
    reply = F.expr("substring(text, cast(loss_start + 1 as int), cast(loss_end - loss_start as int))")
    parts = F.split(F.col("text"), CLOSE)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    cut = F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(F.substring(p, len(OPEN) + 1, 1 << 30), "\n", 1)).alias("role"),
            unescape(p.substr(F.locate("\n", p) + 1, F.length(p))).alias("text"),
        ),
    )
    rows = examples.select(
        "conv_id", F.when(F.col("loss_start").isNotNull(), F.struct("example", unescape(reply).alias("reply"))).alias("reply"), F.when(F.col("last"), cut).alias("turns"), F.when(F.col("last"), F.length("text").cast("long")).alias("formatted_chars")
    )
    found = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("reply")).alias("replies"), F.first("turns", ignorenulls=True).alias("turns"), F.max("formatted_chars").alias("formatted_chars"))
    return found.withColumn("replies", F.transform("replies", lambda x: x["reply"]))

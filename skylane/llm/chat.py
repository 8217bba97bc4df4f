"""Chat formatting: every assistant turn becomes an example of its own.

An example is the whole conversation before the turn as context, then the turn, and only
the reply's text is trainable. The template marks turns with control strings;
where a text holds something like them, one ``%`` is put inside, which reading takes out
again, so nothing in a text can end a turn or open another.

Rows of one conversation meet in one group, as an example holds them all; a
conversation is read into an array once, and examples are prefixes of it.

Defined results: null text and role count as empty; turns are ordered by turn,
then role, then text; repeated rows are turns of their own; a conversation that
does not end with an assistant turn gets one more row with all turns and
nothing trainable, so that every turn is in the output; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """``<|`` and any ``<%..%|`` get one more ``%``."""
    return F.regexp_replace(text, r"<(%*)\|", "<$1%|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(%*)%\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Also keeps the line end that closes the role: a line feed becomes ``<n>``, ``<%..n>`` gets one more ``%``."""
    return F.replace(F.regexp_replace(escape(role), "<(%*)n>", "<$1%n>"), F.lit("\n"), F.lit("<n>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(F.replace(role, F.lit("<n>"), F.lit("\n")), "<(%*)%n>", "<$1n>"))


def chat_examples(turns: DataFrame) -> DataFrame:
    """conv_id, example, context_turns, text, loss_start, loss_end (code points; equal when nothing is trainable)."""
    row = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    row = row.select("conv_id", F.struct("turn", "role", "text").alias("t"))
    talk = row.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    made = F.transform(
        "ts",
        lambda t: F.struct(
            (t["role"] == "assistant").alias("reply"),
            F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
        ),
    )
    talk = talk.select("conv_id", made.alias("ts"))
    last = F.size("ts") - 1
    wanted = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("ts", i)["reply"] | (i == last))
    one = talk.select("conv_id", "ts", F.posexplode(wanted).alias("example", "context_turns"))
    whole = lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))
    one = one.withColumns({"t": F.get("ts", F.col("context_turns")), "context": F.array_join(F.transform(F.slice("ts", F.lit(1), F.col("context_turns")), whole), "")})
    begin = F.length("context") + F.length("t.head")
    return one.select(
        "conv_id",
        "example",
        "context_turns",
        F.concat("context", whole(F.col("t"))).alias("text"),
        begin.cast("long").alias("loss_start"),
        F.when(F.col("t.reply"), begin + F.length("t.body")).otherwise(begin).cast("long").alias("loss_end"),
    )


def read_turns(text: Column) -> Column:
    """The (role, text) structs of a formatted text."""
    parts = F.split(text, r"<\|im_end\|>\n")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(F.substring(p, len(START) + 1, 1 << 30), "\n", 1)).alias("role"),
            unescape(F.substring(p, F.locate("\n", p) + 1, F.lit(1 << 30))).alias("text"),
        ),
    )


def trainable(text: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, as it was before escaping."""
    return unescape(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))

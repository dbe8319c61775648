"""Chat formatting by prefix-target expansion, DataFrame functions only.

A conversation is written once: turns between ``<|im_start|>role``, a line feed and ``<|im_end|>``, another line feed. Every
assistant turn is an example: its context is all that stands before the reply, and only the reply is trainable. Since each
context is a prefix of the same text, examples are kept as offsets; ``expand`` makes each one a row of its own.

Escaping: any ``<``, backslashes, ``|`` gets one more backslash before the bar, so no control string can stand inside a text, and
taking one backslash off restores it. In roles, backslashes are doubled and line feeds written as ``\\n`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, parts, running

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    lines = F.regexp_replace(unescape(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(lines, F.lit("\\\\"), F.lit("\\"))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target: str = "assistant") -> DataFrame:
    """One row per conversation: (conv, formatted, examples array<struct<turn_no, loss_start, loss_chars>>).

    Turns stand by ``turn`` (null first), then role and text, so ties and repeated rows have one order and all stay. Null role or text: empty.
    A null conversation id is a conversation of its own. loss_start is the code point (from 1) at which the reply starts: what stands
    before it is the example's context. A conversation without a ``target`` turn has no examples. An empty table gives an empty result.
    """
    rows = turns.select(F.col(conv).alias("conv"), F.struct(F.col(turn).alias("n"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("row"))
    # a conversation is one training text, so its turns meet in one row by nature; its turns are put in order after they meet
    whole = rows.groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    whole = whole.select("conv", F.transform("rows", lambda r: F.struct((r.role == target).alias("target"), F.concat(F.lit(START), escape_role(r.role), F.lit("\n")).alias("head"), escape(r.text).alias("body"))).alias("rows"))

    def examples(rows: Column) -> Column:
        ends = running(F.transform(rows, lambda r: F.length(r.head).cast("long") + F.length(r.body) + len(END)), lambda a, b: a + b)
        at = lambda r, e: e - len(END) - F.length(r.body) + 1
        numbered = let(ends, lambda e: F.transform(rows, lambda r, i: F.struct(i.alias("turn_no"), at(r, F.get(e, i)).alias("loss_start"), F.length(r.body).cast("long").alias("loss_chars"), r.target.alias("target"))))
        return F.transform(F.filter(numbered, lambda x: x.target), lambda x: F.struct(x.turn_no.alias("turn_no"), x.loss_start.alias("loss_start"), x.loss_chars.alias("loss_chars")))

    formatted = F.array_join(F.transform("rows", lambda r: F.concat(r.head, r.body, F.lit(END))), "")
    return whole.select(F.col("conv").alias(conv), formatted.alias("formatted"), let(F.col("rows"), examples).alias("examples"))


def expand(formatted: DataFrame, conv: str = "conv_id", outer: bool = False) -> DataFrame:
    """One row per example of ``format_conversations``: (conv, turn_no, context, reply, text, context_chars, and other columns of formatted); reply is the trainable part of text, still escaped.

    Contexts repeat what stands before a reply, so they take quadratic room in a conversation's turns; they are made only where a query uses them.
    outer: a conversation without examples has one row of nulls.
    """
    cuts = F.transform("examples", lambda e: F.struct((e.loss_start - 1).cast("int").alias("s"), (e.loss_start - 1 + e.loss_chars).cast("int").alias("e")))
    other = [c for c in formatted.columns if c not in (conv, "formatted", "examples")]
    held = formatted.select(F.col(conv).alias("conv"), "formatted", *other, F.arrays_zip("examples", parts(F.col("formatted"), cuts).alias("reply")).alias("examples"))
    e = F.col("e")
    rows = held.select("conv", "formatted", *other, (F.explode_outer if outer else F.explode)("examples").alias("e"))
    context = F.expr("substring(formatted, 1, cast(e.examples.loss_start - 1 as int))")
    return rows.select(F.col("conv").alias(conv), e.examples.turn_no.alias("turn_no"), context.alias("context"), e.reply.alias("reply"), F.concat(context, e.reply).alias("text"), (e.examples.loss_start - 1).alias("context_chars"), *other)


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Turns and losses parsed from the formatted text alone, with digests: the proof that formatting lost nothing. Losses come from the rows of ``expand``, in the order of turns."""

    def back(t: Column) -> Column:
        inner = F.substring(t, len(START) + 1, 2**31 - 1)
        role = F.substring_index(inner, "\n", 1)
        return F.concat(unescape_role(role), F.lit("\n"), unescape(F.substring(inner, F.length(role) + 2, F.lit(2**31 - 1))), F.lit("\n"))

    # what stands behind the last end of a turn is empty
    turns = F.split("formatted", r"<\|im_end\|>\n", -1)
    digest = let(turns, lambda t: F.struct((F.size(t) - 1).cast("long").alias("n"), F.sha2(F.array_join(F.transform(F.slice(t, F.lit(1), F.size(t) - 1), back), "").cast("binary"), 256).alias("sha")))
    whole = formatted.select(conv, "formatted", "examples", digest.alias("turns"), F.length("formatted").cast("long").alias("formatted_chars"))
    # the rows of a conversation are still together, so this moves nothing
    rows = expand(whole, conv, outer=True).groupBy(F.col(conv).alias("conv")).agg(
        F.any_value("turns").alias("turns"), F.any_value("formatted_chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct("turn_no", "reply"))).alias("replies"),
        F.count("turn_no").alias("n_examples"), F.coalesce(F.sum(F.col("context_chars") + F.length("reply")), F.lit(0)).alias("example_chars"),
    )
    rows = rows.withColumn("loss", F.array_join(F.transform("replies", lambda r: unescape(F.coalesce(r.reply, F.lit("")))), ""))
    return rows.select(
        F.col("conv").alias(conv),
        F.col("turns.n").alias("n_turns"),
        F.col("turns.sha").alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
        "example_chars",
    )

"""Chat formatting: one training example per assistant turn (DataFrame functions only).

Prefix-target expansion: a conversation's turns are put in order once, then every
assistant turn becomes its own example: all preceding turns as context, and only
that reply under the loss mask.  A conversation whose last turn is not the
assistant's (or that has no assistant turn) also gets one context-only example with an
empty mask, so that no turn is lost.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings inside
roles and texts are escaped reversibly (``&`` -> ``&amp;``, ``<|`` -> ``&lt;|``; in a role
also the line feed -> ``&nl;``), so a text can never open or close a turn.

Rows of one (conv_id, turn) are all kept, ordered by role then text; null texts and
roles are empty; a null turn number sorts first; a null conv_id is a conversation
of its own.  An example holds its conversation, so a conversation is the unit that
must fit a task; nothing else is gathered.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&nl;"), F.lit("\n")))


def format_examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (0..), formatted, loss_start, loss_length (code points; 0, 0: no target), last."""
    empty = F.lit("")
    head = F.concat(F.lit(START), _escape_role(F.coalesce("role", empty)), F.lit("\n"))
    body = escape(F.coalesce("text", empty))
    rows = conversations.select("conv_id", F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", empty).alias("role"), head.alias("head"), body.alias("body")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    n = F.size("turns")
    targets = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda x: x.isNotNull())
    # a context-only example for what follows the last reply
    upto = F.when(F.element_at("turns", -1)["role"] == "assistant", targets).otherwise(F.concat(targets, F.array(-n)))
    ex = convs.select("conv_id", "turns", F.posexplode(upto).alias("example", "upto"))
    used = F.slice("turns", 1, F.abs("upto"))
    ex = ex.select("conv_id", "example", "upto", F.size("turns").alias("n"),
                   F.element_at("turns", F.abs("upto")).alias("target"),
                   F.array_join(F.transform(used, lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "").alias("formatted"))
    has = F.col("upto") > 0
    tail = F.length(F.col("target.body")) + len(END) + 1
    return ex.select("conv_id", "example", "formatted",
                     F.when(has, F.length("formatted") - tail).otherwise(0).alias("loss_start"),
                     F.when(has, F.length(F.col("target.body"))).otherwise(0).alias("loss_length"),
                     (F.abs("upto") == F.col("n")).alias("last"))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted examples alone: turns and trained text."""
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 1 << 30)

    def turn(p: Column) -> Column:
        cut = F.instr(p, "\n")
        body = F.substring(p, cut + 1, F.length(p) - cut - (len(END) + 1))
        return F.concat(_unescape_role(F.substring(p, F.lit(1), cut - 1)), F.lit("\n"), unescape(body), F.lit("\n"))

    target = F.substring("formatted", F.col("loss_start") + 1, F.col("loss_length"))
    one = examples.select(
        "conv_id", "example", F.length("formatted").alias("chars"),
        F.when(F.col("loss_length") > 0, unescape(target)).otherwise("").alias("trained"),
        F.when(F.col("last"), F.struct(F.size(pieces).cast("long").alias("n"),
                                       F.sha2(F.array_join(F.transform(pieces, turn), ""), 256).alias("sha"))).alias("whole"))
    grouped = one.groupBy("conv_id").agg(
        F.max("whole").alias("whole"), F.sum(F.col("chars").cast("long")).alias("formatted_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "trained"))), lambda x: x["trained"]), "").alias("loss"))
    return grouped.select(
        "conv_id", F.col("whole.n").alias("n_turns"), F.col("whole.sha").alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")

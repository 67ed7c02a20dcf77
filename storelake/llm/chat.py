"""Chat formatting in budgeted windows (DataFrame functions only).

A conversation becomes windows of whole turns.  Prefix sums of turn tokens place every turn:
turns that start in the same stride form a span, a turn longer than a stride is a span alone.
With two strides and the history making up the budget, a window stays within it unless the
system turn or a single other turn is longer than that: turns are never torn.  Each window repeats the system turn and the last turns before
its span, up to ``history`` tokens; only assistant texts of the span itself are in its loss mask.

Template: ``<s>role\\ntext</s>`` per turn.  Inside roles and texts a backslash is doubled and
the control strings get one after their ``<``; ``unescaped`` takes one backslash off again.

Prefix sums are two-level (blocks of turn numbers, then inside a block), so a conversation with
very many turns is spread over tasks; a window is as large as its budget.

Defined results
    null text or role    the empty text
    null turn            before all others; equal turns are ordered by role, then text
    null conversation    a conversation of its own
    repeated rows        turns of their own
    system turn          the first turn of a conversation if its role is ``system``; others are plain turns
    empty table          no windows
    clashing columns     only conv_id, turn, role and text are read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelake.llm.common import WORD

BUDGET = 512
HISTORY = 96
TURN_OVERHEAD = 4
TURNS_TOGETHER = 512


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), r"<(/?s>)", r"<\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escaped_role(role: Column) -> Column:
    """As ``escaped``, and no plain line feed, which ends the role."""
    return F.regexp_replace(escaped(role), "\n", "\\\\\n")


def placed_turns(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Every turn with its place, token prefix sums, and the stride and history its conversation has room for."""
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.coalesce("turn", F.lit(-1)) / TURNS_TOGETHER).alias("block"),
    ).withColumn("tokens", F.regexp_count("text", F.lit(WORD)).cast("long") + TURN_OVERHEAD)
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    first = F.struct(F.coalesce(F.col("turn"), F.lit(-(1 << 63))).alias("t"), "role", "text", "tokens")
    blocks = rows.groupBy("conv_id", "block").agg(
        F.sum("tokens").alias("b_tokens"), F.count(F.lit(1)).alias("b_turns"), F.min(first).alias("b_first")
    )
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    blocks = blocks.select(
        F.col("conv_id").alias("b_conv"),
        F.col("block").alias("b_block"),
        F.coalesce(F.sum("b_tokens").over(ahead), F.lit(0)).alias("b_tokens"),
        F.coalesce(F.sum("b_turns").over(ahead), F.lit(0)).alias("b_turns"),
        F.min("b_first").over(whole).alias("opening"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    has_system = F.col("opening.role") == "system"
    system_tokens = F.when(has_system, F.col("opening.tokens")).otherwise(F.lit(0))
    room = F.greatest(F.lit(budget) - system_tokens, F.lit(4 * TURN_OVERHEAD))
    is_system = has_system & (F.col("place") == 0)
    return (
        rows.join(blocks, rows["conv_id"].eqNullSafe(F.col("b_conv")) & (rows["block"] == F.col("b_block")))
        .withColumn("place", F.col("b_turns") + F.row_number().over(inside) - 1)
        .withColumn("sum_before", F.col("b_tokens") + F.coalesce(F.sum("tokens").over(before), F.lit(0)))
        .withColumn("is_system", is_system)
        .withColumn("system_text", F.when(has_system, F.col("opening.text")))
        .withColumn("history", F.least(F.lit(history), F.floor(room / 4)).cast("long"))
        .withColumn("stride", F.floor((room - F.col("history")) / 2).cast("long"))
        # The system turn is repeated everywhere, so it takes no place on the token line.
        .withColumn("start", F.when(is_system, F.lit(0)).otherwise(F.col("sum_before") - system_tokens).cast("long"))
        .withColumn("end", F.when(is_system, F.lit(0)).otherwise(F.col("start") + F.col("tokens")).cast("long"))
        .withColumn("span", F.floor(F.col("start") / F.col("stride")))
        .withColumn("alone", (~F.col("is_system")) & (F.col("tokens") > F.col("stride")))
        .select("conv_id", "place", "role", "text", "tokens", "start", "end", "is_system", "system_text", "history", "stride", "span", "alone")
    )


def formatted(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, span and alone (their order), n_repeated turns at its head,
    n_turns of its own, n_tokens, the formatted text, and the loss mask as 0-based code point ranges."""
    placed = placed_turns(turns, budget, history)
    piece = lambda new: F.struct("place", F.lit(new).alias("new"), "role", "text", "tokens")
    own = placed.select("conv_id", "span", "alone", piece(True).alias("piece"))
    spans = placed.groupBy("conv_id", "span", "alone").agg(
        F.min("start").alias("span_start"),
        F.min("place").alias("span_place"),
        F.max(F.col("is_system").cast("int")).alias("with_system"),
        F.first("system_text").alias("system_text"),
    )
    # History: turns that end before a span and start at most ``history`` tokens before it.
    near = placed.where(~F.col("is_system") & (F.col("tokens") <= F.col("history"))).withColumn(
        "near_span",
        F.explode(F.sequence(F.floor(F.col("end") / F.col("stride")), F.floor((F.col("start") + F.col("history")) / F.col("stride")))),
    )
    n, s = near.alias("n"), spans.alias("s")
    repeated = n.join(
        s,
        F.col("n.conv_id").eqNullSafe(F.col("s.conv_id"))
        & (F.col("n.near_span") == F.col("s.span"))
        & (F.col("n.place") < F.col("s.span_place"))
        & (F.col("n.start") >= F.col("s.span_start") - F.col("n.history")),
    ).select(
        "s.conv_id",
        "s.span",
        "s.alone",
        F.struct("n.place", F.lit(False).alias("new"), "n.role", "n.text", "n.tokens").alias("piece"),
    )
    system = spans.where(F.col("system_text").isNotNull() & (F.col("with_system") == 0)).select(
        "conv_id",
        "span",
        "alone",
        F.struct(
            F.lit(-1).cast("long").alias("place"),
            F.lit(False).alias("new"),
            F.lit("system").alias("role"),
            F.col("system_text").alias("text"),
            (F.regexp_count("system_text", F.lit(WORD)).cast("long") + TURN_OVERHEAD).alias("tokens"),
        ).alias("piece"),
    )
    windows = (
        own.unionByName(repeated)
        .unionByName(system)
        .groupBy("conv_id", "span", "alone")
        .agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    )
    shown = F.transform(
        "pieces",
        lambda p: F.struct(
            p["new"].alias("new"),
            (p["new"] & (p["role"] == "assistant")).alias("learn"),
            F.concat(F.lit("<s>"), escaped_role(p["role"]), F.lit("\n")).alias("head"),
            escaped(p["text"]).alias("body"),
        ),
    )
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(seen, p):
        start = seen["at"] + F.length(p["head"])
        mask = F.array(F.struct(start.alias("start"), F.length(p["body"]).alias("length")))
        return F.struct(
            (start + F.length(p["body"]) + F.lit(len("</s>"))).alias("at"),
            F.when(p["learn"], F.concat(seen["spans"], mask)).otherwise(seen["spans"]).alias("spans"),
        )

    count = lambda test: F.size(F.filter("shown", test))
    return windows.withColumn("shown", shown).select(
        "conv_id",
        "span",
        "alone",
        count(lambda p: ~p["new"]).alias("n_repeated"),
        count(lambda p: p["new"]).alias("n_turns"),
        F.aggregate("pieces", F.lit(0).cast("long"), lambda t, p: t + p["tokens"]).alias("n_tokens"),
        F.array_join(F.transform("shown", lambda p: F.concat(p["head"], p["body"], F.lit("</s>"))), "").alias("formatted"),
        F.aggregate("shown", nothing, step, lambda seen: seen["spans"]).alias("loss_mask"),
    )


def own_turns(formatted_text: Column, n_repeated: Column) -> Column:
    """Read a window back: its own turns as an array of (role, text)."""
    marked = F.split(formatted_text, "</s>")
    turns = F.slice(marked, n_repeated + 1, F.size(marked) - 1 - n_repeated)
    head = r"(?s)^<s>((?:[^\\\n]++|\\.)*+)\n(.*)$"
    return F.transform(
        turns,
        lambda t: F.struct(
            unescaped(F.regexp_extract(t, head, 1)).alias("role"),
            unescaped(F.regexp_extract(t, head, 2)).alias("text"),
        ),
    )


def loss_texts(formatted_text: Column, loss_mask: Column) -> Column:
    """The unescaped texts below the mask, in order."""
    return F.transform(loss_mask, lambda m: unescaped(F.substring(formatted_text, m["start"] + 1, m["length"])))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: turns, loss text and formatted length."""
    read = windows.select(
        "conv_id",
        "span",
        "alone",
        F.transform(own_turns(F.col("formatted"), F.col("n_repeated")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))).alias("turns"),
        F.array_join(loss_texts(F.col("formatted"), F.col("loss_mask")), "").alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )
    window = F.struct("span", "alone", F.array_join("turns", "").alias("turns"), "loss")
    joined = lambda name: F.array_join(F.transform("windows", lambda w: w[name]), "")
    return (
        read.groupBy("conv_id")
        .agg(
            F.sum(F.size("turns")).cast("long").alias("n_turns"),
            F.sum(F.length("loss")).cast("long").alias("loss_chars"),
            F.sum("chars").alias("formatted_chars"),
            F.sort_array(F.collect_list(window)).alias("windows"),
        )
        .select(
            "conv_id",
            "n_turns",
            F.sha2(joined("turns").cast("binary"), 256).alias("turns_sha256"),
            "loss_chars",
            F.sha2(joined("loss").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )

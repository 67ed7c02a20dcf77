"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Every source becomes a stream of its documents in a seeded random order, cut into blocks of
equally many words.  Slot ``n`` of the mix draws the golden-ratio point ``n * phi mod 1`` and
belongs to the source whose share of the cumulative targets holds the point, so any stretch of
slots is close to the targets.  The k-th slot of a source takes block ``k`` of its stream, and
starts the stream again at its end.

Positions are two-level prefix sums (over hash ranges, then inside one), so a source with a
third of all rows is sorted by many tasks.

Defined results
    null text, empty text    size 0, nothing taken
    null source              a source of its own, after all others
    repeated rows            equal rows (id, source, text) share what they take equally, rounded down
    null id                  a key like any other
    empty table              no rows
    clashing columns         only doc_id, source and text are read; results replace columns of their names
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelake.llm.common import BLANKS, WORD
from storelake.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 64
SEED = 20_011
HASH_RANGE_BITS = 10
SLOTS_TOGETHER = 16_384
GRID = 4096

# Points are n * STEP mod POINTS in whole numbers: STEP / POINTS is the golden ratio's fraction,
# and the products stay below 2^62.  After POINTS slots the sequence repeats, evenly.
POINTS = 1 << 31
STEP = 1_327_217_885


@dataclass
class Mix:
    """``sized``: document keys with sizes; ``sources``: totals and targets; ``slots``: the
    schedule (slot, source_no, pass_no, block); ``taken``: words taken per document key."""

    sized: DataFrame
    sources: DataFrame
    slots: DataFrame
    taken: DataFrame


def sized_documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = MOST_PASSES) -> DataFrame:
    """Targets by weight, none above ``passes`` times its source, the excess going to the rest.

    Reshaping the excess until nothing is above ends in ``min(cap, weight * level)`` with one
    level for all; sorted by cap / weight, prefix sums give the level without a loop.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_ratio = everything.orderBy("_ratio", "source_no")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(passes)
    ranked = (
        totals.withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("_weight", weight)
        .withColumn("_ratio", cap / F.col("_weight"))
        .withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_caps", F.coalesce(F.sum(cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_open", F.sum("_weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", (F.col("_all") * share - F.col("_caps")) / F.col("_open"))
        .withColumn("_at", F.row_number().over(by_ratio))
    )
    fits = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_at", "_level"))
    level = F.coalesce(F.min(fits).over(everything)["_level"], F.max("_ratio").over(everything))
    return (
        ranked.withColumn("target", F.least(cap, F.col("_weight") * level))
        .withColumn("_end", F.sum("target").over(everything.orderBy("source_no")))
        .select("source", "source_no", "source_size", "target", (F.col("_end") - F.col("target")).alias("low"), F.col("_end").alias("high"))
    )


def _prefixed(rows: DataFrame, group: str, chunk: str, order: list, amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` over the rows before, per ``group`` in ``order``; ``chunk`` must rise with the order."""
    sums = rows.groupBy(group, chunk).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(group, chunk, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(offsets, [group, chunk])
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_offset")
    )


def mixed(docs: DataFrame, *, weights=WEIGHTS, share: float = SHARE, block_words: int = BLOCK_WORDS, seed: int = SEED) -> Mix:
    spark = docs.sparkSession
    sized = written(sized_documents(docs), "mix-sizes")
    sources = written(source_targets(sized, weights, share), "mix-sources")
    total = sources.agg(F.sum("target").alias("t")).first()["t"] or 0.0
    n_slots = int(-(-total // block_words))

    shape = sources.select("source", "source_no", F.ceil(F.col("source_size") / block_words).cast("long").alias("blocks"))
    # The grid turns "which interval holds the point" into an equi-join of bounded size.
    cell = float(POINTS // GRID)
    scaled = [(F.col(c) * (POINTS / total if total else 0.0)).alias(c) for c in ("low", "high")]
    cells = (
        sources.where("high > low")
        .select("source_no", *scaled)
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / cell), F.least(F.floor(F.col("high") / cell), F.lit(GRID - 1)))))
    )
    drawn = (
        spark.range(n_slots)
        .select(F.col("id").alias("slot"), ((F.col("id") % POINTS * STEP) % POINTS).alias("point"))
        .withColumn("cell", F.floor(F.col("point") / cell))
        .join(cells, "cell")
        .where("point >= low AND point < high")
        .select("slot", "source_no", F.floor(F.col("slot") / SLOTS_TOGETHER).alias("chunk"))
    )
    slots = (
        _prefixed(drawn, "source_no", "chunk", ["slot"], F.lit(1), "rank")
        .join(shape.select("source_no", "blocks"), "source_no")
        .where(F.col("rank") < F.col("blocks") * MOST_PASSES)
        .select(
            "slot",
            "source_no",
            F.floor(F.col("rank") / F.col("blocks")).alias("pass_no"),
            (F.col("rank") % F.col("blocks")).alias("block"),
        )
    )

    keys = sized.groupBy("source", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    keys = keys.where("size > 0").withColumn("words", F.col("rows") * F.col("size"))
    shuffled = (
        keys.join(shape.select("source", "source_no"), keys["source"].eqNullSafe(shape["source"]))
        .select("source_no", "doc_id", "text_hash", "rows", "words")
        .withColumn("order_hash", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
        .withColumn("chunk", F.shiftright("order_hash", 64 - HASH_RANGE_BITS))
    )
    placed = _prefixed(shuffled, "source_no", "chunk", ["order_hash", "doc_id", "text_hash"], F.col("words"), "start")
    spans = (
        placed.withColumn("stop", F.col("start") + F.col("words"))
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("stop") - 1) / block_words))))
        .withColumn("part", F.least("stop", (F.col("block") + 1) * block_words) - F.greatest("start", F.col("block") * block_words))
    )
    used = slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("uses"))
    taken = (
        spans.join(used, ["source_no", "block"])
        .groupBy("source_no", "doc_id", "text_hash")
        .agg(F.sum(F.col("part") * F.col("uses")).alias("_words"), F.max("rows").alias("_rows"))
        .join(shape.select("source", "source_no"), "source_no")
        .select("source", "doc_id", "text_hash", F.floor(F.col("_words") / F.col("_rows")).alias("taken"))
    )
    return Mix(sized, sources, slots, taken)


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes of it."""
    mix = mixed(docs, **options)
    sized, sources, taken = mix.sized.alias("d"), mix.sources.alias("s"), mix.taken.alias("t")
    same_row = F.lit(True)
    for key in ("source", "doc_id", "text_hash"):
        same_row = same_row & F.col(f"d.{key}").eqNullSafe(F.col(f"t.{key}"))
    return (
        sized.join(sources, F.col("d.source").eqNullSafe(F.col("s.source")), "left")
        .join(taken, same_row, "left")
        .select(
            "d.doc_id",
            "d.size",
            "s.source_size",
            "s.target",
            F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    A row per started pass over a document: whole where the pass takes all its words, cut to
    the first words taken (joined by one blank) where the schedule ends inside it.
    """
    mix = mixed(docs, **options)
    keyed = docs.withColumn("_mix_hash", F.xxhash64("text"))
    taken = mix.taken.select(
        F.col("source").alias("_mix_source"), F.col("doc_id").alias("_mix_id"), F.col("text_hash").alias("_mix_text"), F.col("taken").alias("_mix_taken")
    )
    joined = keyed.join(
        taken,
        keyed["source"].eqNullSafe(F.col("_mix_source")) & keyed["doc_id"].eqNullSafe(F.col("_mix_id")) & (F.col("_mix_hash") == F.col("_mix_text")),
    )
    size = F.regexp_count("text", F.lit(WORD)).cast("long")
    words = F.filter(F.split("text", BLANKS), lambda w: w != "")
    passes = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_mix_taken") - 1) / F.col("_mix_size")))
    cut = F.array_join(F.slice(words, 1, F.col("_mix_here").cast("int")), " ")
    rows = (
        joined.where("_mix_taken > 0")
        .withColumn("_mix_size", size)
        .withColumn("_mix_pass", F.explode(passes))
        .withColumn("_mix_here", F.least("_mix_size", F.col("_mix_taken") - F.col("_mix_pass") * F.col("_mix_size")))
        .withColumn("text", F.when(F.col("_mix_here") < F.col("_mix_size"), cut).otherwise(F.col("text")))
    )
    if "n_chars" in docs.columns:
        whole = F.col("_mix_here") == F.col("_mix_size")
        rows = rows.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])

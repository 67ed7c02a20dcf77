"""Which filter of a chain does the work: every order of five filters, from one count of the corpus.

A document fails a filter or passes it, so five filters split a part of the corpus into 32 cells.
One pass over the documents counts those cells per part (documents, good ones, toxic ones); a
part's counts are a 2x2x2x2x2 tensor.  What a step of an order keeps or removes is a contraction
of that tensor: along each axis pass, fail, or all is selected, and ``einsum`` does it for all
120 orders and 5 steps at once.

The duplicate filter needs no join of documents: an equal text fails the other text filters
alike, so per text it is enough to know the rows at its smallest id.  Rows are counted by text
digest before they meet, so a text that a third of all rows share costs one row per map task.

Defined results
    null or empty text   the empty text; it fails A (no words) and passes B, C and D
    null source          the part named by the empty string
    null id              neither fails E nor makes another row fail it; it has no label
    repeated rows        counted each; rows of one id are not smaller than each other, so none fails E for that
    repeated labels      a document is good (toxic) if any of its labels says so
    very long text       all of it counts
    ties                 equal texts: rows at the smallest id pass E
    empty table          no rows
    clashing columns     only doc_id, text and source of documents and doc_id, quality and toxic of labels are read
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.common import BLANKS, text_or_empty

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

# Fixed values of the filters.
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
SYMBOLS = r"[#$%&*|]"

PASS, FAIL, ALL = [1, 0], [0, 1], [1, 1]
LAYOUT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, bit i of ``mask`` for filter i."""
    text = text_or_empty()
    words = F.array_remove(F.split(text, BLANKS), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    failed = [
        n_words < LEAST_WORDS,
        n_distinct * 100 < n_words * LEAST_DISTINCT,
        F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text) * MOST_CAPITALS,
        text.rlike(SYMBOLS),
    ]
    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        sum(f.cast("int") * (1 << i) for i, f in enumerate(failed)).alias("mask"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    said = (
        labels.where((F.col("quality") == 1) | (F.col("toxic") == 1))
        .groupBy("doc_id")
        .agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    )
    kind = ["part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    per_id = rows.join(said, "doc_id", "left").groupBy("digest", "doc_id", *kind).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("doc_id").isNotNull()
    per_text = per_id.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("unnamed"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("least"),
    )
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    at_first = F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = per_text.withColumn("first", first).withColumn("copies", F.col("n") - F.col("unnamed") - F.coalesce(at_first, F.lit(0)))
    both = F.array(
        F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("mask") + (1 << 4)).alias("mask"), F.col("copies").alias("n")),
    )
    share = F.col("cell.n")
    return (
        split.select("part", "good", "toxic", F.explode(both).alias("cell"))
        .groupBy("part", F.col("cell.mask").alias("mask"))
        .agg(
            F.sum(share).alias("n"),
            F.sum(F.when(F.col("good"), share).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), share).otherwise(0)).alias("toxic"),
        )
    )


def tensors(mask: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts of one part as a 2x2x2x2x2 tensor per counted thing; axis i is filter i, 1 means it fails."""
    flat = np.zeros((counts.shape[1], 32), np.int64)
    np.add.at(flat.T, mask, counts)
    # Bit 0 of a mask is the fastest axis of the reshape, so the axes are turned round.
    return flat.reshape(-1, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1)


def selections(choose) -> np.ndarray:
    """A row per order and step, a pair (pass, fail) per filter axis, as ``choose(order, step, filter)`` says."""
    return np.array([[choose(o, s, f) for f in FILTERS] for o in ORDERS for s in range(len(FILTERS))], np.int64)


KEPT = selections(lambda order, step, f: PASS if order.index(f) <= step else ALL)
REMOVED = selections(lambda order, step, f: FAIL if f == order[step] else PASS if order.index(f) < step else ALL)
FAILING = selections(lambda order, step, f: FAIL if f == order[step] else ALL)
ONLY = selections(lambda order, step, f: FAIL if f == order[step] else PASS)


def contracted(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """(order and step, counted thing): the tensor summed over what is chosen along each axis."""
    return np.einsum("kabcde,sa,sb,sc,sd,se->sk", tensor, *(chosen[:, i] for i in range(len(FILTERS))))


def audited(part: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part, from its cells (32 rows at most)."""
    tensor = tensors(part["mask"].to_numpy(), part[["n", "good", "toxic"]].to_numpy(np.int64))
    removed = contracted(tensor, REMOVED)
    steps = pd.DataFrame([(o, s + 1) for o in ORDERS for s in range(len(FILTERS))], columns=["filter_order", "step"])
    steps.insert(0, "part", part["part"].iloc[0])
    steps["kept"] = contracted(tensor, KEPT)[:, 0]
    steps["removed"] = removed[:, 0]
    steps["redundant"] = contracted(tensor, FAILING)[:, 0] - removed[:, 0]
    steps["unique_fails"] = contracted(tensor, ONLY)[:, 0]
    steps["good_lost"], steps["toxic_lost"] = removed[:, 1], removed[:, 2]
    turn = [o[s] for o in ORDERS for s in range(len(FILTERS))]
    steps["shapley"] = steps["removed"].groupby(pd.Series(turn)).transform("sum")
    return steps


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step; 600 rows a part, made from 32 counts of it."""
    return cells(docs, labels).groupBy("part").applyInPandas(audited, LAYOUT)


# Fails as a bit mask per document, then the same sums per order and step by plain set logic.
SQL = r"""
WITH read AS (
    SELECT doc_id, ifnull(source, '') AS part, ifnull(text, '') AS t,
           regexp_extract_all(ifnull(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), failed AS (
    SELECT doc_id, part,
           (len(w) < 50)::INT AS a,
           (100 * len(list_distinct(w)) < 65 * len(w))::INT AS b,
           (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT AS c,
           regexp_matches(t, '[#$%&*|]')::INT AS d,
           ifnull(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS e
    FROM read
), said AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), cells AS (
    SELECT part, a, b, c, d, e, count(*) AS n, sum(ifnull(good, 0)) AS good, sum(ifnull(toxic, 0)) AS toxic
    FROM failed LEFT JOIN said USING (doc_id) GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
    SELECT concat(x1.l, x2.l, x3.l, x4.l, x5.l) AS filter_order
    FROM letters x1, letters x2, letters x3, letters x4, letters x5
    WHERE len(list_distinct([x1.l, x2.l, x3.l, x4.l, x5.l])) = 5
), met AS (
    SELECT filter_order, part, n, good, toxic, step, a + b + c + d + e AS failing,
           list_transform(string_split(filter_order, ''), lambda l: CASE l WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS f
    FROM cells, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), steps AS (
    SELECT part, filter_order, step::INT AS step,
           sum(CASE WHEN list_sum(f[:step]) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN f[step] = 1 AND list_sum(f[:step]) = 1 THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN f[step] = 1 AND list_sum(f[:step]) > 1 THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN f[step] = 1 AND failing = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN f[step] = 1 AND list_sum(f[:step]) = 1 THEN good ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN f[step] = 1 AND list_sum(f[:step]) = 1 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM met GROUP BY ALL
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM steps
"""

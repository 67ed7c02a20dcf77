"""Scoring with a gated recurrent language model.

Token counts are gathered from all training documents.  The model reads a frequent word as
itself and any other as the group its ending belongs to; a rare word's probability is its
group's, times its smoothed share of the group's tokens, ``(count + 1) / (tokens + words + 1)``.
So every text has a probability, and only the model's tables have a fixed size.

Training passes once over all training documents, in ``ROUNDS`` parts: every task trains a copy
of the model on its documents, and the copies are averaged by tokens after each part.

Every text is cut into tokens twice: for the counts, and to store its model numbers, which training and
scoring read.  Counts of the ``DICTIONARY`` most frequent words are part of the second task; those of
all other words are joined, so no task holds the vocabulary.

Defined results
    null or empty text   only the end token
    null id              hashed as the empty text
    no training rows     all counts are zero, every token has probability one in the base score,
                         and the model gives all groups of words the same probability
    very long text       read whole, in windows; the state goes on from one to the next
    repeated rows        rows of their own
    empty table          no rows
    clashing columns     only doc_id and text are read
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import id_bucket
from storelake.llm.gru import BLOCK, NAMES, Adam, Gru
from storelake.session import written

FOLDS, HELD_FOLD = 7, 2
WORDS = 2048
GROUPS = 32
DICTIONARY = 200_000
ROUNDS = 2
RATE = 0.03
SEED = 3
GROUP_TOKENS = 1 << 20
SCORE_TOKENS = 1 << 21
FLUSH_WORDS = 400_000
END = b""  # no word is empty, so the end token takes the empty text


def tokens(text: bytes | None) -> list[bytes]:
    words = (text or b"").lower().split()
    words.append(END)
    return words


def group(word: bytes) -> int:
    """The group of a rare word: its last two bytes, which tell languages and forms apart."""
    return zlib.crc32(word[-2:]) % GROUPS


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flushed():
        words = list(counts)
        columns = {"word": pa.array(words, pa.binary()), "c": pa.array(list(counts.values()), pa.int64())}
        counts.clear()
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        for text in batch["text"].cast(pa.binary()).to_pylist():
            counts.update(tokens(text))
        if len(counts) > FLUSH_WORDS:
            yield flushed()
    yield flushed()


def token_counts(training: DataFrame) -> DataFrame:
    """(word, c) over all tokens of the training texts."""
    return training.select("text").mapInArrow(_counted, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Dictionary words in order of count; the first ``n_words`` are the model's own words."""

    def __init__(self, frequent: list[tuple[bytes, int]], group_totals: list[tuple[int, int]], total: int, distinct: int):
        self.total, self.distinct = total, distinct
        self.n_words = len(frequent[:WORDS]) // BLOCK * BLOCK
        self.number = {w: i for i, (w, _) in enumerate(frequent)}
        self.counts = np.array([c for _, c in frequent], dtype=np.int64)
        rare = [(w, c) for w, c in frequent[: self.n_words]]
        self.group_tokens = np.array([n for n, _ in group_totals], dtype=np.int64)
        self.group_words = np.array([v for _, v in group_totals], dtype=np.int64)
        for w, c in rare:
            self.group_tokens[group(w)] -= c
            self.group_words[group(w)] -= 1
        ids = [i if i < self.n_words else self.n_words + group(w) for i, (w, _) in enumerate(frequent)]
        self.ids = np.array(ids, dtype=np.int32)
        self.log_count = np.log10(self.counts + 1.0)
        self.group_size = np.log10(self.group_tokens + self.group_words + 1.0)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int32, len(words))

    def model_ids(self, words: list[bytes], number: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return np.fromiter(map(group, words), np.int32, len(words))
        ids = self.ids[number]
        for i in np.flatnonzero(number < 0).tolist():
            ids[i] = self.n_words + group(words[i])
        return ids


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals of all counted words, and the dictionary: as many whole count levels as fit."""
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # Levels of a sixteenth of a doubling: a bounded table tells which count the dictionary reaches.
    level = F.floor(F.log2("c") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, held = math.inf, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        if held + r["n"] > DICTIONARY:
            break
        held, least = held + r["n"], r["level"]
    frequent = counts.where(level >= F.lit(int(least) if held else 1 << 30)).collect()
    frequent = sorted(((bytes(r["word"]), r["c"]) for r in frequent), key=lambda x: (-x[1], x[0]))

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(GROUPS, np.int64), np.zeros(GROUPS, np.int64)
        for batch in batches:
            at = np.fromiter(map(group, batch["word"].to_pylist()), np.int64, batch.num_rows)
            n += np.bincount(at, batch["c"].to_numpy(), GROUPS).astype(np.int64)
            v += np.bincount(at, minlength=GROUPS)
        yield pa.RecordBatch.from_pydict({"g": pa.array(np.arange(GROUPS)), "n": pa.array(n), "v": pa.array(v)})

    sums = counts.mapInArrow(grouped, "g long, n long, v long").groupBy("g").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    by_group = {r["g"]: (r["n"], r["v"]) for r in sums}
    return Vocabulary(frequent, [by_group.get(g, (0, 0)) for g in range(GROUPS)], total["n"] or 0, total["v"])


def _together(batches: Iterator[pa.RecordBatch], size: int = GROUP_TOKENS) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Batches with the model numbers of their texts, gathered to about ``size`` tokens."""
    held, texts, n = [], [], 0
    for batch in batches:
        ids = batch["ids"]
        ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        held.append(batch)
        texts += [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        n += int(ends[-1] - ends[0])
        if n >= size:
            yield held, texts
            held, texts, n = [], [], 0
    if held:
        yield held, texts


def trained(training: DataFrame, vocab: Vocabulary) -> Gru:
    """Model averaging: each part of the ``numbered`` documents trains copies of the present model."""
    model = Gru.start(vocab.counts[: vocab.n_words].astype(float), vocab.group_tokens.astype(float), SEED)
    shapes = {k: v.shape for k, v in model.p.items()}
    for part in range(ROUNDS):
        given = model

        def copies(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            own = Gru({k: v.copy() for k, v in given.p.items()}, given.n_words)
            adam, used = Adam(RATE), 0
            for _, texts in _together(batches):
                used += own.train(texts, adam)
            for name in NAMES if used else ():
                values = own.p[name].ravel().astype(float) * used
                yield pa.RecordBatch.from_pydict(
                    {"name": pa.array([name]), "tokens": pa.array([used], pa.int64()), "values": pa.array([values], pa.list_(pa.float64()))}
                )

        mine = training.where(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(ROUNDS)) == part).select("ids")
        sums = (
            mine.mapInArrow(copies, "name string, tokens long, values array<double>")
            .select("name", "tokens", F.posexplode("values").alias("at", "value"))
            .groupBy("name", "at")
            .agg((F.sum("value") / F.sum("tokens")).alias("value"))
            .toPandas()
        )
        if not len(sums):
            continue
        parts = {}
        for name, rows in sums.groupby("name"):
            flat = np.zeros(int(np.prod(shapes[name])), np.float32)
            flat[rows["at"].to_numpy()] = rows["value"].to_numpy()
            parts[name] = flat.reshape(shapes[name])
        model = Gru({k: parts.get(k, v) for k, v in model.p.items()}, model.n_words)
    return model


_NUMBERED = (
    "row long, doc_id {}, held_out boolean, n_tokens long, n_known long, base double, share double, "
    "ids array<int>, rare array<struct<word:binary,n:long>>"
)


def _numbers(vocab: Vocabulary):
    def lists(sizes: list[int], values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            n_tokens, n_known, base, shares, ids, rare = [], [], [], [], [], []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                words = tokens(text)
                number = vocab.numbers(words)
                own = vocab.model_ids(words, number)
                inside = number >= 0
                known = number[inside]
                groups = own[own >= vocab.n_words] - vocab.n_words
                # A rare word's share of its group: its count here, or joined later, over the group's size.
                shares.append(float(vocab.log_count[known[known >= vocab.n_words]].sum() - vocab.group_size[groups].sum()))
                n_tokens.append(len(words))
                n_known.append(len(known))
                base.append(float(vocab.log_count[known].sum()))
                ids.append(own)
                rare.append(Counter(map(words.__getitem__, np.flatnonzero(~inside).tolist())))
            others = [
                pa.array([*chain.from_iterable(rare)], pa.binary()),
                pa.array([*chain.from_iterable(x.values() for x in rare)], pa.int64()),
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(np.arange(row, row + batch.num_rows)),
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "n_tokens": pa.array(n_tokens, pa.int64()),
                    "n_known": pa.array(n_known, pa.int64()),
                    "base": pa.array(base, pa.float64()),
                    "share": pa.array(shares, pa.float64()),
                    "ids": lists(n_tokens, pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))),
                    "rare": lists([*map(len, rare)], pa.StructArray.from_arrays(others, ["word", "n"])),
                }
            )
            row += batch.num_rows

    return run


_PARTIAL = "row long, doc_id {}, held_out boolean, n_tokens long, n_known long, base double, score double"


def _scored(model: Gru):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, texts in _together(batches, SCORE_TOKENS):
            loglik = model.score(texts) / math.log(10)
            at = 0
            for batch in held:
                columns = {name: batch[name] for name in ("row", "doc_id", "held_out", "n_tokens", "n_known", "base")}
                score = loglik[at : at + batch.num_rows] + batch["share"].to_numpy()
                yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(score, pa.float64())})
                at += batch.num_rows

    return run


def scored(docs: DataFrame) -> DataFrame:
    """Every document with its token counts, the base score and the model's log10 probability."""
    rows = docs.select("doc_id", (id_bucket(FOLDS) == HELD_FOLD).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    training = rows.where(~F.col("held_out"))
    counts = written(token_counts(training), "token-counts")
    vocab = vocabulary(counts)
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = written(rows.mapInArrow(_numbers(vocab), _NUMBERED.format(kind)), "model-numbers")
    model = trained(numbered.where(~F.col("held_out")), vocab)
    partial = written(numbered.drop("rare").mapInArrow(_scored(model), _PARTIAL.format(kind)), "partial-scores")
    joined = (
        numbered.select("row", F.explode("rare").alias("r"))
        .select("row", "r.word", "r.n")
        .join(counts, "word")
        .groupBy("row")
        .agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (
        partial.join(joined, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + zero("more_known")).alias("n_known"),
            F.lit(vocab.total).cast("long").alias("train_tokens"),
            (F.col("base") + zero("more") - F.col("n_tokens") * math.log10(vocab.total + vocab.distinct + 1)).alias("base_score"),
            (F.col("score") + zero("more")).alias("score"),
        )
    )

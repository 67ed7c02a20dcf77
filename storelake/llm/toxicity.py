"""Toxicity by a linear-chain CRF over labelled tokens.

Training labels are per document, so tokens are labelled from them: a token of a toxic document
is toxic when its word, or the word's beginning or end (``AFFIX`` bytes of a longer word), is evidence
for toxicity.  Evidence is the lower bound of the log
odds, counted over all labelled training documents of different content (copies of the
same words share a signature and count once), in ``LEVELS`` steps.  The CRF learns from those token labels, with
every token of a clean document labelled clean; it weighs the three kinds of evidence and the neighbours'.  A document's score is a logistic function of
the forward-backward marginals: the expected number of toxic tokens and the largest marginal.

Word statistics cover all labelled training rows.  The CRF and the logistic function are fitted
on at most ``FIT_ROWS`` whole documents of either label (the smallest seeded hashes) of at most
``FIT_TOKENS`` tokens each, and the evidence keeps the ``MOST_WORDS`` strongest words and affixes.

Defined results
    null or empty text   no tokens; the score of a text without evidence
    no usable labels     score 0 for all
    conflicting labels   a document labelled twice counts under both
    very long text       scored whole; the cost follows its evidence.  Beyond FIT_TOKENS it counts as
                         evidence, but the tagger is not fitted on it
    repeated rows        rows of their own; they share one vote as evidence
    empty table          no rows
    clashing columns     only doc_id, text, labels.doc_id and labels.toxic are read
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import id_bucket
from storelake.llm.crf import LEVELS, Crf, code, highest, trained
from storelake.session import written

FOLDS, HELD_FOLD = 3, 1
CUT = 0.7
FIT_ROWS = 300
FIT_TOKENS = 20_000
MOST_WORDS = 20_000
LEAST_EVIDENCE, LEAST_AFFIX_EVIDENCE = 1.5, 2.25
AFFIX = 4
LEAST_MARK = 2
# Words whose observation is remembered at once by a task.
REMEMBERED = 200_000
SEED = 5
PLAIN = bytes(ord(chr(i).lower()) if i < 128 and chr(i).isalpha() else (32 if i < 128 else i) for i in range(256))


def tokens(text: bytes | None) -> list[bytes]:
    """Runs of letters, ASCII ones in lower case; bytes beyond ASCII are letters."""
    return (text or b"").translate(PLAIN).split()


def signature(words: list[bytes]) -> int:
    """A 64-bit hash of the whole token sequence: only true copies share it."""
    return xxhash.xxh64_intdigest(b" ".join(words), SEED) - (1 << 63)


def affixes(word: bytes) -> tuple[bytes, ...]:
    """Beginning and end of a word longer than ``AFFIX``; the marks ^ and $ occur in no token."""
    return (b"^" + word[:AFFIX], b"$" + word[-AFFIX:]) if len(word) > AFFIX else ()


class Observations(dict):
    """A word's observation (``crf.code``) from the evidence, remembered by word."""

    def __init__(self, evidence: dict[bytes, int]):
        self.evidence = evidence

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = code(*(self.evidence.get(k, 0) for k in (word, *affixes(word))))
        return found

    def __reduce__(self):
        return Observations, (self.evidence,)

    def placed(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Tokens with evidence: their places and observations."""
        seen = [self[w] for w in words]
        places = [i for i, x in enumerate(seen) if x]
        return places, [seen[i] for i in places]


@dataclass
class Model:
    observations: Observations
    crf: Crf
    weights: tuple[float, float, float]

    def features(self, places: list[int], levels: list[int], length: int) -> tuple[float, float]:
        if not places:
            return 0.0, 0.0
        _, p = self.crf.marginals(np.array(places), np.array(levels), length)
        return math.log1p(float(p.sum())), float(p.max())

    def score(self, x: tuple[float, float]) -> float:
        z = self.weights[0] + self.weights[1] * x[0] + self.weights[2] * x[1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def document(self, text: bytes | None) -> tuple[float, list[int], list[int], int]:
        words = tokens(text)
        places, levels = self.observations.placed(words)
        return self.score(self.features(places, levels, len(words))), places, levels, len(words)

    def spans(self, text: bytes, places, levels, length, cut: float = 0.5) -> list[dict]:
        """Code point ranges of tokens that are more likely toxic than not, with their marginals."""
        if not places:
            return []
        active, p = self.crf.marginals(np.array(places), np.array(levels), length)
        marked = {int(t): float(x) for t, x in zip(active, p) if x >= cut}
        if not marked:
            return []
        found = []
        for i, match in enumerate(re.finditer(rb"[^ ]+", text.translate(PLAIN))):
            if i in marked:
                start = len(text[: match.start()].decode())
                found.append({"start": start, "length": len(match.group().decode()), "marginal": marked[i]})
        return found


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float, float]:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    theta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (w * (y - p)) - 1e-2 * theta
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        theta = theta + np.linalg.solve(hessian, gradient)
    return tuple(theta)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [tokens(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
        found = {"signature": pa.array(map(signature, rows), pa.int64()), "n": pa.array(map(len, rows), pa.int64())}
        yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"]} | found)


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words and affixes of the rows whose text has the wanted signature."""
    for batch in batches:
        rows = [tokens(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
        distinct = [set(r) for r in rows]
        signs = [sorted(d.union(*map(affixes, d))) for d in distinct]
        batch = batch.append_column("words", pa.array(signs, pa.list_(pa.binary())))
        wanted = [signature(r) == s for r, s in zip(rows, batch["signature"].to_pylist())]
        yield batch.select(["toxic", "rows", "words"]).filter(pa.array(wanted, pa.bool_()))


def _evidence(train: DataFrame, labelled: DataFrame) -> dict[bytes, int]:
    """Words with their level of evidence; ``labelled``: (doc_id, signature, toxic) of training documents.

    Copies are found by signatures alone, so texts move once, to the one document of each
    signature and label that counts; its rows share that count if the document is repeated.
    """
    ids = labelled.groupBy("signature", "toxic", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    least = ids.groupBy("signature", "toxic").agg(F.min(F.struct("doc_id", "rows")).alias("w"))
    contents = written(least.select("signature", "toxic", "w.doc_id", "w.rows"), "contents")
    totals = {r["toxic"]: r["n"] for r in contents.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    t, c = totals.get(1, 0), totals.get(0, 0)
    if not t or not c:
        return {}
    words = train.join(contents.hint("merge"), "doc_id").select("toxic", "rows", "signature", "text")
    words = words.mapInArrow(_document_words, "toxic int, rows long, words array<binary>")
    counts = words.select("toxic", "rows", F.explode("words").alias("word")).groupBy("word").agg(
        F.round(F.sum(F.col("toxic") / F.col("rows")), 6).alias("t"), F.round(F.sum((1 - F.col("toxic")) / F.col("rows")), 6).alias("c")
    )
    odds = lambda n, of: F.log((F.col(n) + 0.5) / (F.lit(of + 0.5) - F.col(n)))
    is_affix = F.substring("word", 1, 1).isin(F.lit(b"^"), F.lit(b"$"))
    spread = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    strong = (
        counts.where("t >= 3")
        .withColumn("bound", odds("t", t) - odds("c", c) - 2 * spread)
        .where(F.col("bound") > F.when(is_affix, LEAST_AFFIX_EVIDENCE).otherwise(LEAST_EVIDENCE))
        .orderBy(F.desc("bound"), "word")
        .limit(MOST_WORDS)
        .collect()
    )
    return {bytes(r["word"]): min(LEVELS - 1, max(1, int(r["bound"] / 0.75))) for r in strong}


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled documents outside the held-out fold."""
    toxic = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")).distinct()
    train = docs.where(id_bucket(FOLDS) != HELD_FOLD).select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Labels grow with the documents: sorted and merged at every size, never broadcast.
    prints = train.mapInArrow(_signatures, f"doc_id {kind}, signature long, n long")
    labelled = written(prints.join(toxic.hint("merge"), "doc_id"), "labelled")
    evidence = _evidence(train, labelled)
    if not evidence:
        return Model(Observations({}), Crf.start(), (-30.0, 0.0, 0.0))
    observations = Observations(evidence)
    short = labelled.groupBy("toxic", "doc_id").agg(F.max("n").alias("n")).where(F.col("n") <= FIT_TOKENS)
    ids = short.select("toxic", "doc_id").withColumn("h", F.xxhash64(F.lit(SEED), "doc_id"))
    chosen = None
    for label in (0, 1):
        part = ids.where(F.col("toxic") == label).orderBy("h", "doc_id").limit(FIT_ROWS)
        chosen = part if chosen is None else chosen.unionByName(part)
    sample = train.join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [tokens(x) for x in batch["text"].cast(pa.binary()).to_pylist()]
            found = [observations.placed(r) for r in rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch["toxic"],
                    "n": pa.array([len(r) for r in rows], pa.int64()),
                    "places": pa.array([f[0] for f in found], pa.list_(pa.int64())),
                    "levels": pa.array([f[1] for f in found], pa.list_(pa.int64())),
                }
            )

    rows = sample.select("toxic", "text").mapInArrow(placed, "toxic int, n long, places array<long>, levels array<long>").collect()
    rows = sorted(rows, key=lambda r: (r["toxic"], r["n"], r["places"], r["levels"]))
    sequences = []
    for r in rows:
        levels, tags = np.zeros((2, r["n"]), dtype=np.int16)
        levels[r["places"]] = r["levels"]
        tags[[p for p, x in zip(r["places"], r["levels"]) if r["toxic"] and highest(x) >= LEAST_MARK]] = 1
        sequences.append((levels, tags))
    model = Model(observations, trained(sequences), (0.0, 0.0, 0.0))
    x = np.array([model.features(r["places"], r["levels"], r["n"]) for r in rows])
    y = np.array([float(r["toxic"]) for r in rows])
    # The sample holds both labels evenly; weights restore their true shares.
    true = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    share = {k: true.get(k, 0) / max(1, sum(true.values())) for k in (0, 1)}
    drawn = {k: max(1, int((y == k).sum())) / len(y) for k in (0, 1)}
    model.weights = _logistic(x, y, np.array([share[int(k)] / drawn[int(k)] for k in y]))
    return model


def _scored(model: Model, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("marginal", pa.float64())]))
        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            rows = [model.document(t) for t in texts]
            out = {c: batch[c] for c in ("doc_id", "held_out")} | {"score": pa.array([r[0] for r in rows], pa.float64())}
            if spans:
                out["spans"] = pa.array([model.spans(t or b"", *r[1:]) for t, r in zip(texts, rows)], kind)
            yield pa.RecordBatch.from_pydict(out)

    return run


def scored(docs: DataFrame, labels: DataFrame, spans: bool = True) -> DataFrame:
    """doc_id, held_out, score, predicted and the toxic spans of every document."""
    model = fitted(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, score double"
    schema += ", spans array<struct<start:int,length:int,marginal:double>>" if spans else ""
    rows = docs.select("doc_id", (id_bucket(FOLDS) == HELD_FOLD).alias("held_out"), "text").mapInArrow(_scored(model, spans), schema)
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below ``CUT``, with all their columns."""
    model = fitted(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.document(t)[0] for t in batch["text"].cast(pa.binary()).to_pylist()]
            yield batch.filter(pa.array([s < CUT for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

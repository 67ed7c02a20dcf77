"""Benchmark decontamination: a BM25 inverted index of test items, queried by block-max WAND.

Items are cut into segments of at most ``SEGMENT_WORDS`` words and indexed; weights are BM25
impacts over the segment's own total, so 1 is a passage that holds all of a segment.  Every
training passage (``PASSAGE_WORDS`` words, half overlapping) is a query, and all segments at or
above ``THRESHOLD`` are retrieved.  The pivot test of the short lists is done for all passages
of a batch at once: a segment can reach the threshold only if its short-list terms reach what
its other terms cannot give.  Passages for which some segment can are run through block-max
WAND.  A retrieved item counts as leaked when the document holds enough word n-grams of both
its question (all but the last sentence) and its answer (the last sentence).

The index is part of the task's code, in shards of at most ``SHARD_WORDS`` item words; a larger
benchmark is passed over shard by shard, so what a task holds is bounded.  Document frequencies, number
and mean length of segments are those of the whole benchmark, counted by Spark, so scores do not depend on
the shards.

Defined results
    null or empty text     no passages, never contaminated; an empty item matches nothing
    very long text         queried in slices, with passages across the seams
    equal items            each is retrieved on its own
    repeated rows          rows of their own
    empty table            no rows; without items nothing is contaminated
    clashing columns       only doc_id, text, item_id are read; ``decontaminated`` keeps all columns
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.session import written

PASSAGE_WORDS = 96
STRIDE = PASSAGE_WORDS // 2
SEGMENT_WORDS = STRIDE
THRESHOLD = 0.7
GRAM = 4
LEAST_OVERLAP = 0.6
SHORT_LIST = 12
BLOCK = 16
SHARD_WORDS = 1_000_000
SLICE_WORDS = STRIDE * 4096
K1, B = 1.2, 0.75

# ASCII letters to lower case, other ASCII but digits to blanks; further bytes are word bytes.
_PLAIN = bytes(ord(chr(i).lower()) if i < 128 and chr(i).isalnum() else (32 if i < 128 else i) for i in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_PLAIN).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence is the answer, what is before it the question; a single sentence is a question."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if terms(s.encode())]
    if len(sentences) < 2:
        return terms(text.encode()), []
    return terms(" ".join(sentences[:-1]).encode()), terms(sentences[-1].encode())


def grams(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[i:] for i in range(n))))


@dataclass
class Postings:
    segments: list[int]
    weights: list[float]
    most: float
    block_most: list[float]


@dataclass
class Index:
    items: list[tuple]
    owner: list[int] = field(default_factory=list)
    lists: dict[bytes, Postings] = field(default_factory=dict)
    rest: np.ndarray = None
    short: dict[bytes, int] = field(default_factory=dict)
    offsets: np.ndarray = None
    short_segments: np.ndarray = None
    short_weights: np.ndarray = None


@dataclass(frozen=True)
class Statistics:
    """Of all segments of a benchmark: their number, mean length, and in how many a term is."""

    n: int
    mean: float
    df: dict[bytes, int]


def segments_of(words: list[bytes]) -> list[list[bytes]]:
    """An item's words in pieces of equal length, ``SEGMENT_WORDS`` at most."""
    size = -(-len(words) // max(1, -(-len(words) // SEGMENT_WORDS)))
    return [words[at : at + size] for at in range(0, len(words), max(1, size))]


def build_index(items: list[tuple], whole: Statistics | None = None) -> Index:
    """``items``: (item_id, text); ``whole``: statistics of the benchmark they are part of, else their own."""
    index = Index([])
    segments: list[list[bytes]] = []
    for item_id, text in items:
        question, answer = question_and_answer(text or "")
        pieces = segments_of(question + answer)
        if pieces:
            segments += pieces
            index.owner += [len(index.items)] * len(pieces)
            index.items.append((item_id, question, answer))
    n = len(segments)
    if whole is None:
        whole = Statistics(n, sum(map(len, segments)) / max(1, n), Counter(t for s in segments for t in set(s)))
    df, mean = whole.df, whole.mean
    found: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
    index.rest = np.zeros(n)
    for number, words in enumerate(segments):
        impact = {
            t: math.log(1 + (whole.n - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(words) / mean))
            for t, c in Counter(words).items()
        }
        total = sum(impact.values())
        for t, w in impact.items():
            found[t].append((number, w / total))
            if df[t] > SHORT_LIST:
                index.rest[number] += w / total
    offsets, near, weight = [0], [], []
    for t, postings in found.items():
        numbers, weights = [p[0] for p in postings], [p[1] for p in postings]
        blocks = [max(weights[i : i + BLOCK]) for i in range(0, len(weights), BLOCK)]
        index.lists[t] = Postings(numbers, weights, max(weights), blocks)
        if df[t] <= SHORT_LIST:
            index.short[t] = len(offsets) - 1
            near += numbers
            weight += weights
            offsets.append(len(near))
    index.offsets, index.short_segments, index.short_weights = np.array(offsets), np.array(near, np.int64), np.array(weight)
    return index


def block_max_wand(index: Index, words: set[bytes], threshold: float) -> list[tuple[int, float]]:
    """All segments with a score of ``threshold`` or more for a query of distinct words."""
    end = len(index.owner)
    cursors = [[p.segments[0], 0, p] for p in (index.lists.get(w) for w in words) if p]
    found = []

    def forward(cursor, target):
        postings = cursor[2].segments
        cursor[1] = bisect_left(postings, target, cursor[1])
        cursor[0] = postings[cursor[1]] if cursor[1] < len(postings) else end

    while True:
        cursors = [c for c in cursors if c[0] < end]
        cursors.sort(key=lambda c: c[0])
        total, pivot = 0.0, -1
        for at, cursor in enumerate(cursors):
            total += cursor[2].most
            if total >= threshold - 1e-9:
                pivot = cursor[0]
                break
        if pivot < 0:
            return found
        last = at
        while last + 1 < len(cursors) and cursors[last + 1][0] == pivot:
            last += 1
        bound, until = 0.0, end
        for cursor in cursors[: last + 1]:
            postings = cursor[2]
            place = bisect_left(postings.segments, pivot, cursor[1])
            if place < len(postings.segments):
                block = place // BLOCK
                bound += postings.block_most[block]
                until = min(until, postings.segments[min(len(postings.segments), (block + 1) * BLOCK) - 1] + 1)
        if bound >= threshold - 1e-9:
            score = 0.0
            for cursor in cursors[: last + 1]:
                if cursor[0] < pivot:
                    forward(cursor, pivot)
                if cursor[0] == pivot:
                    score += cursor[2].weights[cursor[1]]
                    forward(cursor, pivot + 1)
            if score >= threshold:
                found.append((pivot, score))
        else:
            # No segment before the nearest block end, or the next cursor, can do better.
            following = cursors[last + 1][0] if last + 1 < len(cursors) else end
            target = max(pivot + 1, min(until, following))
            for cursor in cursors[: last + 1]:
                if cursor[0] < target:
                    forward(cursor, target)


def _slices(words: list[bytes]) -> Iterator[tuple[list[bytes], int]]:
    """(words, passages that start in them), with the overlap the last passages need."""
    for at in range(0, max(1, len(words)), SLICE_WORDS):
        part = words[at : at + SLICE_WORDS + STRIDE]
        yield part, min(SLICE_WORDS, len(part)) // STRIDE + 1


def _hopeful(index: Index, units: list[tuple[list[bytes], int]], threshold: float) -> list[tuple[int, int]]:
    """(unit, passage) pairs whose short lists leave some segment a chance."""
    flat = [w for words, _ in units for w in words]
    if not flat or not index.short:
        none_rest = bool(len(index.rest)) and float(index.rest.max()) >= threshold
        return [(u, p) for u, (_, n) in enumerate(units) for p in range(n)] if none_rest else []
    lengths = np.array([len(words) for words, _ in units])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    passages = np.concatenate([[0], np.cumsum([n + 1 for _, n in units])])
    get = index.short.get
    term = np.fromiter((get(w, -1) for w in flat), np.int64, len(flat))
    at = np.nonzero(term >= 0)[0]
    term = term[at]
    unit = np.searchsorted(starts, at, side="right") - 1
    stride = (at - starts[unit]) // STRIDE
    length = index.offsets[term + 1] - index.offsets[term]
    source = np.repeat(np.arange(len(term)), length)
    within = np.arange(len(source)) - np.repeat(np.cumsum(length) - length, length)
    posting = index.offsets[term[source]] + within
    segment, weight = index.short_segments[posting], index.short_weights[posting]
    slot = passages[unit[source]] + stride[source]
    early = stride[source] > 0
    n = len(index.owner)
    key = np.concatenate([slot * n + segment, (slot * n + segment)[early] - n])
    weight = np.concatenate([weight, weight[early]])
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else np.zeros(0, np.int64)
    sums = np.add.reduceat(weight, first) if len(key) else np.zeros(0)
    key = key[first]
    chosen = np.unique(key[sums >= threshold - index.rest[key % n] - 1e-9] // n)
    if float(index.rest.max()) >= threshold:
        chosen = np.arange(passages[-1])
    unit = np.searchsorted(passages, chosen, side="right") - 1
    return [(int(u), int(c - passages[u])) for u, c in zip(unit, chosen) if c - passages[u] < units[u][1]]


def leaks(index: Index, texts: list[bytes | None], threshold: float = THRESHOLD) -> Iterator[tuple[int, tuple, float, float, float]]:
    """(row, item_id, score, question overlap, answer overlap) of every leaked item."""
    done = 0
    while done < len(texts):
        units: list[tuple[list[bytes], int]] = []
        rows: list[int] = []
        size = 0
        while done < len(texts) and size < SLICE_WORDS:
            words = terms(texts[done])
            for unit in _slices(words):
                units.append(unit)
                rows.append(done)
            size += len(words)
            done += 1
        best: dict[tuple[int, int], float] = {}
        for u, p in _hopeful(index, units, threshold):
            query = set(units[u][0][p * STRIDE : p * STRIDE + PASSAGE_WORDS])
            for segment, score in block_max_wand(index, query, threshold):
                key = (rows[u], index.owner[segment])
                best[key] = max(score, best.get(key, 0.0))
        known: dict[tuple[int, int], set] = {}
        for (row, item), score in sorted(best.items()):
            overlaps = []
            item_id, question, answer = index.items[item]
            for part in (question, answer):
                n = max(1, min(GRAM, len(part)))
                if (row, n) not in known:
                    known = {k: v for k, v in known.items() if k[0] == row}
                    known[row, n] = grams(terms(texts[row]), n)
                wanted = grams(part, n)
                overlaps.append(len(wanted & known[row, n]) / len(wanted) if wanted else 1.0)
            if min(overlaps) >= LEAST_OVERLAP:
                yield row, item_id, score, overlaps[0], overlaps[1]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per segment and term, and per segment one without a term that has its words."""
    for batch in batches:
        found, sizes = [], []
        for text in batch["text"].to_pylist():
            question, answer = question_and_answer(text)
            for words in segments_of(question + answer):
                mine = [None, *set(words)]
                found += mine
                sizes += [len(words)] + [0] * (len(mine) - 1)
        yield pa.RecordBatch.from_pydict({"term": pa.array(found, pa.binary()), "words": pa.array(sizes, pa.int64())})


def indexes(benchmark: DataFrame, shard_words: int = SHARD_WORDS) -> Iterator[Index]:
    """The benchmark's index, one bounded shard at a time."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    counted = lambda part: part.select("text").mapInArrow(_counted, "term binary, words long")
    terms_in = written(counted(items).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("words").alias("words")), "terms")
    total = terms_in.where("term IS NULL").first()
    n, words = (total["df"], total["words"]) if total else (0, 0)
    shards = max(1, -(-2 * words // shard_words))
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        own = terms_in if shards == 1 else terms_in.join(counted(part).select("term").distinct(), "term")
        df = {bytes(r["term"]): r["df"] for r in own.where("term IS NOT NULL").select("term", "df").collect()}
        yield build_index([tuple(r) for r in part.orderBy("item_id", "text").collect()], Statistics(n, words / max(1, n), df))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, score and both overlaps."""
    kinds = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, score double, question_overlap double, answer_overlap double"

    def finder(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = list(leaks(index, batch["text"].cast(pa.binary()).to_pylist(), threshold))
                ids = batch["doc_id"].take(pa.array([h[0] for h in hits], pa.int64()))
                kind = pa.float64()
                found = {"doc_id": ids, "item_id": pa.array([h[1] for h in hits], _arrow(kinds[1]))}
                found |= {c: pa.array([h[i] for h in hits], kind) for i, c in enumerate(("score", "question_overlap", "answer_overlap"), 2)}
                yield pa.RecordBatch.from_pydict(found)

        return run

    out = None
    for index in indexes(benchmark, shard_words):
        part = docs.select("doc_id", "text").mapInArrow(finder(index), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents that leak no item, with all their columns."""

    def keeper(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for hit in leaks(index, batch["text"].cast(pa.binary()).to_pylist(), threshold):
                    keep[hit[0]] = False
                yield batch.filter(pa.array(keep))

        return run

    kept = docs
    for index in indexes(benchmark, shard_words):
        kept = kept.mapInArrow(keeper(index), docs.schema)
    return kept

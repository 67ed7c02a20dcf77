"""Near copies: five-word shingles with a Jaccard similarity of 0.8 or more.

A text's set of shingle hashes is sketched by ``BANDS`` bands of ``ROWS`` least hashes (MinHash);
texts that agree in a band meet in its bucket, and every text that goes has a verified near copy,
by the exact Jaccard similarity of the whole sets.  At a similarity of 0.8 two texts share a bucket
with probability 1 - (1 - 0.8^4)^32 > 0.9999999; the simhash digest of ``op4`` sees few of them.

Texts with equal sets are collapsed first.  In a bucket of few texts all are compared; in a larger one
only the smallest text, its lead, with all others: larger near copies of it go and the lead leaves the
bucket.  What stays there is no copy of that lead, so it is split by ``STEP`` further MinHash values
of the band, and the finer buckets are treated alike.  A level costs at most one pair a text and band
(``FEW`` in the last), and a bucket shrinks with every level, so a group of k texts that are alike but
not near costs k log k pairs, not k^2; a group of near copies costs k.  No pair is compared twice.

Two texts at 0.8 stay together in a level with probability 0.8^STEP per band, so recall falls with the depth at
which a crowd of similar texts around them ends (README has measured figures); texts outside such
crowds are compared at the first level.

Defined results
    null or empty text   no shingles; near copies of each other only
    under five words     one shingle, the whole text
    null id              after all others
    repeated rows        one of them stays
    very long text       all shingles count
    empty table          no rows
    clashing columns     only doc_id and text are read; all columns are kept as they are
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.session import written

SHINGLE_WORDS = 5
SIMILARITY = (4, 5)  # 0.8, as a fraction
BANDS, ROWS = 32, 4
SEED = 7
SLICE = 1 << 14
# Buckets of so many texts are compared as they are; larger ones are split by so many more values a level.
FEW = 8
STEP = 2

_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(SEED)
_TURNS = _rng.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64)
_FACTORS = _rng.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# The values that split a band further: those of all other bands, in an order of its own.
_FURTHER = np.array([_rng.permutation([i for i in range(BANDS * ROWS) if i // ROWS != band]) for band in range(BANDS)])
LEVELS = _FURTHER.shape[1] // STEP


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE_WORDS:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    parts = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS))))
    return np.unique(np.fromiter((digest(s, SEED) for s in parts), np.uint64, len(words) - SHINGLE_WORDS + 1))


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The MinHash values of a set, one per hash function."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), SLICE):
        turned = (hashes[None, start : start + SLICE] ^ _TURNS) * _FACTORS
        # A product alone keeps too much of the order of the hashes.
        turned ^= turned >> np.uint64(32)
        turned *= _MIX
        np.minimum(least, turned.min(axis=1), out=least)
    return least


def bands(hashes: np.ndarray) -> list[int]:
    """The bucket of a set in each band."""
    least = least_hashes(hashes)
    return [_signed(least[i * ROWS : (i + 1) * ROWS].tobytes()) for i in range(BANDS)]


def _signed(data: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(data, SEED)).astype(np.int64))


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``SIMILARITY``."""
    if not len(a) or not len(b):
        return len(a) == len(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    up, down = SIMILARITY
    return down * both >= up * (len(a) + len(b) - both)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, buckets = [], [], []
        for text in batch["text"].cast(pa.binary()).to_pylist():
            found = shingles(text)
            nodes.append(_signed(found.tobytes()))
            sizes.append(len(found))
            buckets.append(bands(found))
        columns = {name: batch[name] for name in batch.schema.names if name != "text"}
        columns |= {"node": pa.array(nodes, pa.int64()), "size": pa.array(sizes, pa.int64()), "bands": pa.array(buckets, pa.list_(pa.int64()))}
        yield pa.RecordBatch.from_pydict(columns)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t).view(np.int64) for t in batch["text"].cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_pydict({"node": batch["node"], "hashes": pa.array(found, pa.list_(pa.int64()))})


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per set and level, what splits each band further: a hash of the next values of the band."""
    for batch in batches:
        keys = []
        for found in batch["hashes"]:
            further = least_hashes(found.values.to_numpy().view(np.uint64))[_FURTHER[:, : LEVELS * STEP]]
            mixed = np.zeros((BANDS, LEVELS), np.uint64)
            for i in range(STEP):
                mixed = (mixed ^ further[:, i::STEP]) * _MIX
                mixed ^= mixed >> np.uint64(29)
            keys.append(mixed.astype(np.uint32).view(np.int32).ravel())
        yield pa.RecordBatch.from_pydict({"node": batch["node"], "keys": pa.array(keys, pa.list_(pa.int32()))})


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch["hashes_a"], batch["hashes_b"])
        close = [near(*(x.values.to_numpy().view(np.uint64) for x in p)) for p in pairs]
        yield batch.select(["b"]).filter(pa.array(close, pa.bool_()))


def _rank() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")


def _crowded(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one, with the number there and the bucket's lead."""
    buckets = members.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("held"), F.min(F.struct("rank", "node", "size")).alias("lead"))
    return members.join(buckets.where("held > 1"), ["band", "bucket"])


def _sized(a: str, b: str) -> Column:
    """Whether two set sizes allow the similarity."""
    up, down = SIMILARITY
    return F.least(a, b) * down >= F.greatest(a, b) * up


def pairs_of(crowded: DataFrame) -> DataFrame:
    """(a, b), the smaller first: all pairs of small buckets, the lead with each other text in larger ones."""
    led = crowded.where((F.col("held") > FEW) & (F.col("node") != F.col("lead.node")) & _sized("size", "lead.size"))
    few = crowded.where(F.col("held") <= FEW)
    other = few.select("band", "bucket", F.struct("rank", "node").alias("o"), F.col("size").alias("o_size"))
    every = few.join(other, ["band", "bucket"]).where((F.struct("rank", "node") < F.col("o")) & _sized("size", "o_size"))
    return (
        led.select(F.col("lead.node").alias("a"), F.col("node").alias("b"))
        .unionByName(every.select(F.col("node").alias("a"), F.col("o.node").alias("b")))
        .distinct()
    )


def _gone(crowded: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(node) of the texts that have a smaller near copy."""
    gone, compared, keys = None, None, None
    for level in range(LEVELS + 1):
        if crowded.isEmpty():
            break
        pairs = pairs_of(crowded)
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        compared = pairs if compared is None else compared.unionByName(pairs)
        placed = pairs.join(sets.toDF("b", "hashes_b"), "b").join(sets.toDF("a", "hashes_a"), "a")
        found = written(placed.select("b", "hashes_a", "hashes_b").mapInArrow(_verified, "b long").distinct().toDF("node"), "gone")
        gone = found if gone is None else gone.unionByName(found)
        left = crowded.where((F.col("held") > FEW) & (F.col("node") != F.col("lead.node"))).drop("held", "lead").join(gone, "node", "left_anti")
        if level == LEVELS or left.isEmpty():
            break
        if keys is None:
            wanted = sets.join(left.select("node").distinct(), "node", "left_semi")
            keys = written(wanted.mapInArrow(_finer, "node long, keys array<int>"), "finer")
        split = F.xxhash64("bucket", F.col("keys")[F.col("band") * LEVELS + level])
        members = left.join(keys, "node").select("node", "rank", "size", "band", split.alias("bucket"))
        crowded = written(_crowded(members), "members")
    return gone


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents without a smaller near copy, with all their columns; of equal texts the smallest id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.withColumn("_text_hash", F.xxhash64("text"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("_text_hash"), "text")
    sketches = written(
        texts.withColumnRenamed("_text_hash", "text_hash").mapInArrow(
            _sketches, f"doc_id {kind}, text_hash long, node long, size long, bands array<long>"
        ),
        "sketches",
    )
    nodes = written(
        sketches.groupBy("node").agg(F.min(_rank()).alias("rank"), F.max("size").alias("size"), F.max("bands").alias("bands")), "nodes"
    )
    members = nodes.select("node", "rank", "size", F.posexplode("bands").alias("band", "bucket"))
    crowded = written(_crowded(members), "members")
    wanted = crowded.select("node", F.col("rank.doc_id").alias("_keep_id"), F.col("rank.text_hash").alias("_keep_hash")).distinct()
    at = F.col("doc_id").eqNullSafe(F.col("_keep_id")) & (F.col("_text_hash") == F.col("_keep_hash"))
    sets = texts.join(wanted, at).select("node", "text").mapInArrow(_sets, "node long, hashes array<long>")
    gone = _gone(crowded, written(sets.dropDuplicates(["node"]), "shingle-sets"))
    staying = nodes if gone is None else nodes.join(gone, "node", "left_anti")
    winners = staying.select(F.col("rank.doc_id").alias("_keep_id"), F.col("rank.text_hash").alias("_keep_hash"))
    kept = keyed.join(winners, at)
    if not sketches.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["_keep_id", "_keep_hash"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

"""SimHash near duplicates by pigeonhole blocks.

A fingerprint has a bit set where more than half of the text's shingle hashes have it.  Its 64
bits are cut into four blocks; two fingerprints that differ in at most two bits agree in two of
the blocks at least, so they meet under one of six block pairs.  Fingerprints under one block
pair are compared by Hamming distance, and the verified links joined to components.

Equal fingerprints are collapsed first, so exact copies never meet.  A block pair that holds
more than ``BUCKET_LIMIT`` different fingerprints is not compared pair by pair: each of its
members is spread under its 496 keys with two of the other 32 bits cleared, and members under
one such key (four at most) are exactly those within the distance.  Nothing is dropped.

Defined results
    null or empty text   fingerprint zero, linked like any other
    null id              ignored by the smallest id; null if a component has no other
    repeated rows        rows of their own, in one component
    very long text       all shingles count, in slices of bounded memory
    empty table          no rows
    clashing columns     only doc_id and text are read; ``deduplicated`` keeps all columns as they are
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.components import components
from storelake.session import written

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 2
BLOCKS = 4
BLOCK_BITS = 16
BUCKET_LIMIT = 4096
SLICE = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """Signed 64-bit SimHash of a UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, SLICE):
        part = words[start : min(start + SLICE, n) + SHINGLE_WORDS - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(SHINGLE_WORDS)))) if len(words) >= SHINGLE_WORDS else [b" ".join(words)]
        hashes = np.array([digest(s, HASH_SEED) for s in shingles], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
        columns = {name: batch[name] for name in batch.schema.names if name != "text"}
        yield pa.RecordBatch.from_pydict(columns | {"fp": pa.array(prints, pa.int64())})


def fingerprinted(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _fingerprints, f"doc_id {kind}, text_hash long, fp long"
    )


def _block_keys() -> Column:
    """The six block pairs of a fingerprint: which pair, and its 32 bits."""
    block = lambda i: F.shiftrightunsigned("fp", BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    pairs = combinations(range(BLOCKS), BLOCKS - MAX_BITS)
    return F.array(
        *[F.struct(F.lit(n).alias("pair"), F.shiftleft(block(i), BLOCK_BITS).bitwiseOR(block(j)).alias("bits")) for n, (i, j) in enumerate(pairs)]
    )


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _close_pairs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within runs of equal ``key`` whose fingerprints are close."""
    a, b, lag, at = [], [], 1, np.arange(len(key))
    while len(at):
        at = at[at + lag < len(key)]
        at = at[key[at] == key[at + lag]]
        close = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= MAX_BITS]
        a.append(close)
        b.append(close + lag)
        lag += 1
    return (np.concatenate(a), np.concatenate(b)) if a else (at, at)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted buckets: each linked member to the first of its bucket that it reaches."""
    left_key, left_fp = np.empty(0, np.int64), np.empty(0, np.uint64)

    def links(key, fp):
        a, b = _close_pairs(key, fp)
        root = _roots(len(fp), a, b)
        moved = np.nonzero(root != np.arange(len(fp)))[0]
        return pa.RecordBatch.from_pydict({"a": pa.array(fp[moved].view(np.int64)), "b": pa.array(fp[root[moved]].view(np.int64))})

    for batch in batches:
        # Bits and pair together are below 2^35, so they make one number.
        key = batch["bits"].to_numpy() * 8 + batch["pair"].to_numpy()
        key = np.concatenate([left_key, key])
        fp = np.concatenate([left_fp, batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(key):
            continue
        if not len(key):
            continue
        # The last bucket may go on in the next batch.
        others = key[::-1] != key[-1]
        whole = len(key) - int(others.argmax()) if others.any() else 0
        left_key, left_fp = key[whole:], fp[whole:]
        if whole:
            yield links(key[:whole], fp[:whole])
    if len(left_key):
        yield links(left_key, left_fp)


def _masked_keys() -> Column:
    """Keys of a fingerprint in a crowded block pair: each clears two bits outside that pair."""
    outside = []
    for pair in combinations(range(BLOCKS), BLOCKS - MAX_BITS):
        bits = [i for i in range(64) if i // BLOCK_BITS not in pair]
        masks = [(1 << i) | (1 << j) for i, j in combinations(bits, MAX_BITS)]
        outside.append("array(" + ",".join(f"{m - (1 << 64) if m >> 63 else m}L" for m in masks) + ")")
    masks = F.element_at(F.expr(f"array({','.join(outside)})".replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")), F.col("pair") + 1)
    return F.transform(masks, lambda m: F.struct(m.alias("mask"), F.col("fp").bitwiseAND(F.bitwise_not(m)).alias("rest")))


def links(prints: DataFrame, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between different fingerprints ``fp`` that connect the same ones as all close pairs."""
    keyed = prints.select("fp", F.explode(_block_keys()).alias("k")).select("fp", "k.pair", "k.bits")
    sizes = keyed.groupBy("pair", "bits").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    crowded = written(keyed.join(sizes, ["pair", "bits"]), "blocks")
    small = crowded.where(F.col("members") <= limit).repartition("pair", "bits").sortWithinPartitions("pair", "bits", "fp")
    found = small.select("pair", "bits", "fp").mapInArrow(_verified, "a long, b long")
    spread = (
        crowded.where(F.col("members") > limit)
        .select("fp", F.explode(_masked_keys()).alias("m"))
        .groupBy("m")
        .agg(F.collect_set("fp").alias("close"))
        .where(F.size("close") > 1)
        .select(F.explode("close").alias("a"), F.array_min("close").alias("b"))
        .where("a != b")
    )
    return found.unionByName(spread)


def near_duplicates(docs: DataFrame, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, component_fp) per document.

    ``component_fp``, the smallest fingerprint of the component, also names one without any id.
    """
    table = written(fingerprinted(docs), "fingerprints")
    prints = written(table.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints")
    linked = components(links(prints, limit)).join(prints.withColumnRenamed("fp", "node"), "node")
    roots = linked.groupBy("root").agg(F.min("least_id").alias("root_id"))
    moved = linked.select("node", "root").join(roots, "root").select(F.col("node").alias("fp"), "root", "root_id")
    named = prints.join(moved, "fp", "left").select(
        "fp",
        F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("root_id")).alias("component_id"),
        F.coalesce("root", "fp").alias("component_fp"),
    )
    return table.join(written(named, "named"), "fp")


def deduplicated(docs: DataFrame, limit: int = BUCKET_LIMIT) -> DataFrame:
    """One document of each component, with all its columns: the smallest id, then text hash."""
    classes = written(near_duplicates(docs, limit), "classes")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    winners = (
        classes.groupBy("component_fp")
        .agg(F.min(first).alias("w"))
        .select(F.col("w.doc_id").alias("_keep_id"), F.col("w.text_hash").alias("_keep_hash"))
    )
    keyed = docs.withColumn("_text_hash", F.xxhash64("text"))
    kept = keyed.join(winners, keyed["doc_id"].eqNullSafe(F.col("_keep_id")) & (F.col("_text_hash") == F.col("_keep_hash")))
    if not classes.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["_keep_id", "_keep_hash"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

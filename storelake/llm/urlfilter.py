"""URL filters: listed rules, and a cascade of Bloom filters for listed hosts.

The cascade holds exact membership for the whole key universe of the corpus.  Its first level
encodes the listed keys; the second the unlisted keys that pass the first; the third the listed
keys that pass the second; until none passes wrongly.  A key is looked up level by level, and
the first level it fails decides, so pages need no join with the list.

Levels are built as grouped bit sums.  The cascade is broadcast; its size follows the number of
listed keys (about a byte each), and above ``SEGMENT_BYTES`` the key space is cut into segments
that are broadcast and applied one after the other.

Defined results
    null url, no ``://``   empty host and path, which no rule and no list holds
    repeated rows          rows of their own
    equally long rules     the first of the list
    empty table            no rows
    clashing columns       only page_id and url are read
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.session import written

FALSE_RATE = 1 / 16
SEGMENT_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules (host and path, verdict), and the labels that put a host on the list.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.coalesce(found, F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return found


def _hash(key: Column, salt: int, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), key), 64 - bits)


@dataclass
class Level:
    salt: int
    bits: int
    hashes: int
    words: np.ndarray

    def passes(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        inside = np.ones(len(first), dtype=bool)
        for i in range(self.hashes):
            at = (first + i * second) % self.bits
            inside &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return inside


def _level(keys: DataFrame, count: int, salt: int, rate: float) -> Level:
    """A Bloom filter of ``count`` keys: one row per 64 bits set in Spark, gathered as an array."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, math.ceil(count * hashes / math.log(2)))
    at = [(F.col("first") + i * F.col("second")) % bits for i in range(hashes)]
    set_words = (
        _hashed(keys, salt)
        .select(F.explode(F.array(*at)).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("set"))
        .toPandas()
    )
    words = np.zeros(bits // 64 + 1, dtype=np.uint64)
    words[set_words["word"].to_numpy(dtype=np.int64)] = set_words["set"].to_numpy(dtype=np.int64).view(np.uint64)
    return Level(salt, bits, hashes, words)


def _hashed(keys: DataFrame, salt: int) -> DataFrame:
    return keys.withColumn("first", _hash(F.col("key"), 2 * salt, 44)).withColumn("second", _hash(F.col("key"), 2 * salt + 1, 40))


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = level.passes(batch["first"].to_numpy(), batch["second"].to_numpy())
            yield pa.RecordBatch.from_pydict({"key": batch["key"].filter(pa.array(inside))})

    return _hashed(keys, level.salt).mapInArrow(run, "key string")


def cascade(keys: DataFrame, rate: float = FALSE_RATE) -> list[Level]:
    """Levels for ``keys`` (key, listed), distinct keys with no null."""
    encoded = keys.where("listed").select("key")
    tested = keys.where(~F.col("listed")).select("key")
    levels: list[Level] = []
    while count := encoded.count():
        level = _level(encoded, count, len(levels) + 1, rate)
        wrong = written(_passing(tested, level), "wrong-keys")
        levels.append(level)
        encoded, tested = wrong, encoded
    return levels


def _member(levels: list[Level]):
    """Listed or not, for rows with first_n and second_n per level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = np.full(batch.num_rows, len(levels) % 2 == 1)
            open_ = np.ones(batch.num_rows, dtype=bool)
            for n, level in enumerate(levels):
                inside = level.passes(batch[f"first_{n}"].to_numpy(), batch[f"second_{n}"].to_numpy())
                listed[open_ & ~inside] = n % 2 == 1
                open_ &= inside
            columns = {c: batch[c] for c in batch.schema.names if not c.startswith(("first_", "second_"))}
            yield pa.RecordBatch.from_pydict(columns | {"listed": pa.array(listed)})

    return run


def with_membership(rows: DataFrame, levels: list[Level], key: str) -> DataFrame:
    """``rows`` with the boolean ``listed``, by cascade lookups of column ``key``."""
    hashes = [_hash(F.col(key), 2 * level.salt + i, (44, 40)[i]).alias(f"{name}_{n}") for n, level in enumerate(levels) for i, name in enumerate(("first", "second"))]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.select("*", *hashes).mapInArrow(_member(levels), schema + ", listed boolean")


def listed_host(host: Column, labels=LISTED_LABELS) -> Column:
    return F.arrays_overlap(F.split(host, r"\."), F.array(*[F.lit(x) for x in labels]))


def judged(pages: DataFrame, rules=RULES, labels=LISTED_LABELS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """page_id, host, path, the rule that fits, and the verdict: the rule's, else block if the host is listed."""
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    universe = rows.groupBy(F.col("host").alias("key")).agg(F.count(F.lit(1)).alias("pages"))
    keys = written(universe.select("key", listed_host(F.col("key"), labels).alias("listed")), "url-keys")
    n_listed = keys.where("listed").count()
    segments = max(1, -(-n_listed * 2 // segment_bytes))
    in_segment = lambda c, s: F.pmod(F.xxhash64(F.lit(0), F.col(c)), F.lit(segments)) == s
    parts = [
        with_membership(rows.where(in_segment("host", s)), cascade(keys.where(in_segment("key", s))), "host")
        for s in range(segments)
    ]
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("fits", rule)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fits.rule").alias("rule"),
            F.coalesce("fits.verdict", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
            "listed",
        )
    )

"""Quality rules by robust multivariate outliers.

Every document becomes a vector of transformed statistics.  Per language and source, the
minimum covariance determinant estimate is found by concentration steps: keep the ``CORE`` share
of rows nearest to the present centre, take their mean and covariance, repeat.  The steps run from
each of ``STARTS`` deterministic starts side by side, and the result of least determinant is taken;
half the rows are the core, so up to nearly half of a group may be junk.  A document is rejected when its
Mahalanobis distance from its group's estimate is beyond the chi-square limit and one of the
coordinates that stand for junk is above the centre.

Groups below ``LEAST_ROWS`` rows use the estimate of their language, and that of the whole
table where the language is small as well.  Sums run inside map tasks first, so a group with a
third of all rows costs no more than others; only thresholds and sums per group travel.

Defined results
    null or empty text    no words; fails the base rule
    null lang or source   a group of its own
    repeated rows         rows of their own
    ties at a threshold   all belong to the core
    empty table           no rows
    clashing columns      only doc_id, text, lang and source are read
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.session import written

SYMBOLS = b"#*$%&|<>"
WINDOW_WORDS = 3
LEAST_WORDS = 50
CORE = 0.5
STEPS = 6
# Medians with quartile ranges, medians with the floors, lower quartiles with quartile ranges (junk
# lies above), mean and covariance of all rows.
STARTS = ("quartiles", "floors", "low", "all")
LEAST_ROWS = 100
# Smallest standard deviation taken for a coordinate: most are zero in most documents, and a line
# or a phrase said twice is no fault yet.
FLOOR = (0.05, 0.05, 0.1, 0.1)
# Beyond any chi-square quantile that chance reaches: 4 degrees of freedom, 1 in 10^9.
LIMIT = 47.6
COORDINATES = ("word_length", "symbols", "dup_lines", "repeats")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

_NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
_CONTINUED = bytes(range(0x80, 0xC0))


def _repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that occurs again in the text, the first one included."""
    n = len(words)
    if n < WINDOW_WORDS + 1:
        return 0
    ids: dict[bytes, int] = {}
    number = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    pair = number[:-1] * len(ids) + number[1:]
    if len(ids) >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(ids) + number[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    equal = ranked[1:] == ranked[:-1]
    again = np.zeros(len(window), dtype=bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    covered = np.zeros(n, dtype=bool)
    for i in range(WINDOW_WORDS):
        covered[i : i + len(window)] |= again
    return int(covered.sum())


def statistics(text: bytes | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS`` for a UTF-8 text."""
    text = text or b""
    words = text.split()
    seen: set[bytes] = set()
    lines = repeated = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            repeated += line in seen
            seen.add(line)
    joined = b"".join(words)
    chars = len(joined.translate(None, _CONTINUED))
    symbols = len(text.translate(None, _NOT_SYMBOLS))
    return len(words), chars, symbols, lines, repeated, _repeated_words(words)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
        columns = {c: batch[c] for c in ("doc_id", "lang", "source")}
        counts = {c: pa.array([r[i] for r in rows], pa.int64()) for i, c in enumerate(COUNTS)}
        yield pa.RecordBatch.from_pydict(columns | counts)


def measured(docs: DataFrame) -> DataFrame:
    """Counts, base rule and transformed vector of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = docs.select("doc_id", "lang", "source", "text").mapInArrow(
        _measured, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    )
    words = F.greatest(F.col("n_words"), F.lit(1))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    # Roots even out the spread of rates; the logarithm that of the mean word length.
    vector = [
        F.log1p(F.col("word_chars") / words),
        F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
    ]
    return counts.withColumn("base_failed", failed).withColumns(dict(zip(COORDINATES, vector)))


def _with_levels(rows: DataFrame) -> DataFrame:
    """Each row in its group, its language and the whole: (level, lang_, source_)."""
    text = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))  # noqa: E731  null differs from the empty text
    groups = F.array(
        F.struct(F.lit(0).alias("level"), text("lang").alias("lang_"), text("source").alias("source_")),
        F.struct(F.lit(1).alias("level"), text("lang").alias("lang_"), F.lit("*").alias("source_")),
        F.struct(F.lit(2).alias("level"), F.lit("*").alias("lang_"), F.lit("*").alias("source_")),
    )
    return rows.withColumn("g", F.explode(groups)).select("g.*", *COORDINATES)


GROUP = ["level", "lang_", "source_"]
STARTED = [*GROUP, "start"]
_STATE = (
    "level int, lang_ string, source_ string, start int, n long, centre array<double>, inverse array<double>, logdet double"
)


def _inverse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centre, inverse covariance and log-determinant of each group from its sums."""
    p = len(COORDINATES)
    floor = np.diag(np.square(FLOOR))
    for batch in rows:
        out = {c: batch[c] for c in (*STARTED, "n")}
        n = batch["n"].to_numpy(zero_copy_only=False).astype(float)
        sums = np.array(batch["sums"].to_pylist(), dtype=float).reshape(-1, p)
        products = np.array(batch["products"].to_pylist(), dtype=float).reshape(-1, p, p)
        mean = sums / n[:, None]
        cov = products / n[:, None, None] - mean[:, :, None] * mean[:, None, :] + floor
        out["centre"] = pa.array(mean.tolist(), pa.list_(pa.float64()))
        out["inverse"] = pa.array(np.linalg.inv(cov).reshape(-1, p * p).tolist(), pa.list_(pa.float64()))
        out["logdet"] = pa.array(np.linalg.slogdet(cov)[1])
        yield pa.RecordBatch.from_pydict(out)


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*STARTED).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(c) for c in COORDINATES]).alias("sums"),
        F.array(*[F.sum(F.col(a) * F.col(b)) for a in COORDINATES for b in COORDINATES]).alias("products"),
    ).mapInArrow(_inverse, _STATE)


def _distance(centre: str = "centre", inverse: str = "inverse"):
    p = len(COORDINATES)
    diff = [F.col(c) - F.col(centre)[i] for i, c in enumerate(COORDINATES)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(p):
            total = total + diff[i] * diff[j] * F.col(inverse)[i * p + j]
    return total


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Centre and inverse covariance of every group: of the starts' concentration steps, those of least determinant."""
    p = len(COORDINATES)
    leveled = written(_with_levels(rows), "mcd-rows")
    quartiles = leveled.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), *[F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(f"q_{c}") for c in COORDINATES]
    )
    spread = [F.greatest((F.col(f"q_{c}")[2] - F.col(f"q_{c}")[0]) / 1.349, F.lit(f)) for c, f in zip(COORDINATES, FLOOR)]
    zero = F.lit(0.0)

    def start(number: int, quartile: int, scale: list) -> Column:
        return F.struct(
            F.lit(number).alias("start"),
            F.array(*[F.col(f"q_{c}")[quartile] for c in COORDINATES]).alias("centre"),
            F.array(*[1 / (scale[i] * scale[i]) if i == j else zero for i in range(p) for j in range(p)]).alias("inverse"),
        )

    placed_starts = F.array(start(0, 1, spread), start(1, 1, [F.lit(f) for f in FLOOR]), start(2, 0, spread))
    state = quartiles.withColumn("s", F.explode(placed_starts)).select(*GROUP, "s.start", "n", "s.centre", "s.inverse", zero.alias("logdet"))
    state = state.unionByName(_sums(leveled.withColumn("start", F.lit(len(STARTS) - 1))))
    for _ in range(steps):
        state = written(state, "mcd-state")
        placed = leveled.join(state.select(*STARTED, "centre", "inverse"), GROUP).withColumn("d", _distance())
        # A written table of groups: its size is known, so rows do not move to it unless it is large.
        radius = written(placed.groupBy(*STARTED).agg(F.percentile_approx("d", CORE, 1000).alias("radius")), "mcd-radius")
        state = _sums(placed.join(radius, STARTED).where("d <= radius"))
    best = written(state, "mcd-state").groupBy(*GROUP).agg(F.min_by(F.struct("n", "centre", "inverse"), F.struct("logdet", "start")).alias("b"))
    return written(best.select(*GROUP, "b.*"), "mcd-best")


def consistency(p: int = len(COORDINATES), core: float = CORE) -> float:
    """Factor that makes the core's covariance that of all rows, for a normal distribution.

    core / F(q; p + 2), q the chi-square quantile of ``core`` with p degrees; both have closed
    forms for even p.
    """

    def chi2(x: float, k: int) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))

    low, high = 0.0, 100.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2(mid, p) < core else (low, mid)
    return core / chi2(low, p + 2)


def judged(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Every document with its counts, base verdict, squared robust distance and final verdict."""
    rows = written(measured(docs), "statistics")
    state = estimates(rows.where(~F.col("base_failed")))
    text = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    least = LEAST_ROWS * CORE
    fit = lambda level: state.where((F.col("level") == level) & ((F.col("n") >= least) | F.lit(level == 2)))
    est = lambda level: F.struct("centre", "inverse").alias(f"e{level}")
    everything = fit(2).select(F.first(F.struct("centre", "inverse")).alias("e2"))
    joined = (
        rows.withColumn("lang_", text("lang"))
        .withColumn("source_", text("source"))
        .join(fit(0).select("lang_", "source_", est(0)), ["lang_", "source_"], "left")
        .join(fit(1).select("lang_", est(1)), "lang_", "left")
        .withColumn("e", F.coalesce("e0", "e1", everything.scalar()))
        .withColumn("centre", F.col("e.centre"))
        .withColumn("inverse", F.col("e.inverse"))
        .withColumn("distance", _distance() / consistency())
    )
    # Only the junk side counts: more symbols, repeats, or odd word lengths, never fewer.
    junk = F.lit(False)
    for i, c in enumerate(COORDINATES[1:], start=1):
        junk = junk | (F.col(c) > F.col("centre")[i] + 2 * FLOOR[i])
    odd = F.abs(F.col(COORDINATES[0]) - F.col("centre")[0]) > 4 * FLOOR[0]
    rejected = F.coalesce((F.col("distance") > limit) & (junk | odd), F.lit(False))
    return joined.select(
        "doc_id",
        *COUNTS,
        "base_failed",
        F.col("distance").cast("double"),
        (~F.col("base_failed") & ~rejected).alias("kept"),
    )

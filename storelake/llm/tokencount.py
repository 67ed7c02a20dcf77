"""Token counts by prefix dynamic programming.

No piece of the vocabulary has a blank after another character, and a line feed is a piece of
its own; so a text cut before every run of blanks and around every line feed is tokenised part
by part.  The count at a prefix is the count at the last cut before it plus the count of the
rest of that part: ``count[i] = count[cut] + table[part][i - cut]``.  With ``stored`` the tables of
all parts are filled, and a document holds the step of the count at each of its code points (their
running sum is the count of every prefix) and sizes and counts of its parts (the counts at the
cuts), so budget questions read these alone.  Otherwise only the table a limit falls into is filled.

Inside a part a merge tokenizer gives a recurrence: if the last token of ``part[:i]`` is ``t``,
the tokens before it are those of ``part[:i - len(t)]``, and ``t`` is the last token exactly
when the last token there and ``t`` stay two tokens side by side.  So
``table[i] = table[i - len(t)] + tokens(t)`` looks back no further than the longest piece, and
pairs are looked up or asked of the library once.  Time and memory grow with the part.  New parts
are taken in order, so one goes on from the prefix it shares with the part before.

The cut rule is checked against the vocabulary when a model is loaded; a model that breaks it
has every text as one part, with the same counts.  A table whose last entry is not the library's
count of the part (another kind of model) is filled by encoding the prefixes.

Defined results
    null or empty text   no tokens, no cuts
    very long text       as any other; its parts are short
    very long part       encoded whole; its table is filled in time that grows with its length
    repeated rows        rows of their own
    empty table          no rows
    clashing columns     only doc_id and text are read
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
PARTS = ("part_chars", "part_tokens")
STEPS = "prefix_steps"
LIMIT = 4096
CACHED_PARTS = 400_000
CACHED_PAIRS = 1_000_000
CACHED_TABLE_CHARS = 4_000_000
GROUP_BYTES = 4 << 20
_PARTS = re.compile(f"[ {BLANK}]*[^ {BLANK}\n]+|[ {BLANK}]+|\n[^ {BLANK}\n]*")


class PrefixCounter:
    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = map(self.model.id_to_piece, range(self.model.vocab_size()))
        self.cuts = not any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces)
        self.counts: dict[str, int] = {BLANK: 1}
        self.tables: dict[str, np.ndarray] = {}
        self.table_chars = 0
        kinds = (self.model.is_byte, self.model.is_control, self.model.is_unknown, self.model.is_unused)
        plain = (i for i in range(self.model.vocab_size()) if not any(kind(i) for kind in kinds))
        self.pieces = {self.model.id_to_piece(i) for i in plain}
        # Lengths of the pieces that end in a character; the character alone is always tried.
        lengths: dict[str, set[int]] = {}
        for piece in self.pieces:
            lengths.setdefault(piece[-1:], {1}).add(len(piece))
        self.lengths = lengths
        self.orders: dict[tuple[str, int], tuple[int, ...]] = {}
        self.after: dict[str, dict[str, bool]] = {}
        self.own: dict[str, list[int]] = {}
        self.pairs = 0
        self.line_feed = len(self.model.encode("\n"))
        self._forget()

    def _forget(self) -> None:
        """No filled part: tables lie end to end, without the empty prefix."""
        self.rows: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.filled = np.zeros(0, np.int32)

    def parts(self, text: str) -> list[str]:
        """The text with the blank the library puts before it, cut up."""
        text = BLANK + text.replace(" ", BLANK)
        return _PARTS.findall(text) if self.cuts else [text]

    def _encoded(self, parts: list[str]) -> list[int]:
        # The library adds a blank: one is taken off, or, before a line feed, counted and taken back.
        given = [p[1:] if p[0] == BLANK else p for p in parts]
        found = self.model.encode(given, num_threads=1)
        return [len(ids) - (p[0] != BLANK) if g else 1 for ids, p, g in zip(found, parts, given)]

    def part_counts(self, parts: list[str]) -> np.ndarray:
        known = self.counts
        new = [p for p in dict.fromkeys(parts) if p not in known]
        if new:
            if len(known) + len(new) > CACHED_PARTS:
                known.clear()
                new = list(dict.fromkeys(parts))
            known.update(zip(new, self._encoded(new)))
        return np.fromiter(map(known.__getitem__, parts), dtype=np.int64, count=len(parts))

    def at_cuts(self, text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Parts, code points and tokens at each cut (the added blank is not a code point of the text)."""
        if not text:
            return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        parts = self.parts(text)
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))) - 1
        return parts, ends, np.cumsum(self.part_counts(parts))

    def _ids(self, text: str) -> list[int]:
        """Ids without the added blank: a line feed, which no longer piece holds, keeps it apart."""
        return self.model.encode("\n" + text)[self.line_feed :]

    def _token_ids(self, token: str) -> list[int]:
        if token not in self.own:
            self.own[token] = self._ids(token)
        return self.own[token]

    def _stay(self, left: str, right: str) -> bool:
        """Whether two tokens side by side stay as they are (one token by itself: at a part's start)."""
        known = self.after.get(left)
        if known is None:
            known = self.after[left] = {}
        if right not in known:
            if self.pairs >= CACHED_PAIRS:
                self.after.clear()
                self.own.clear()
                self.orders.clear()
                self.pairs = 0
                known = self.after[left] = {}
            self.pairs += 1
            if left:
                known[right] = self._ids(left + right) == self._token_ids(left) + self._token_ids(right)
            else:
                known[right] = right not in self.pieces or len(self._token_ids(right)) == 1
        return known[right]

    def _order(self, character: str, before: int) -> tuple[int, ...]:
        """Lengths the last token can have.  One of them holds; mostly the token before grows, or a new one begins."""
        known = sorted(self.lengths.get(character, {1}), key=lambda n: (n != before + 1, n != 1, -n))
        self.orders[character, before] = tuple(known)
        return self.orders[character, before]

    def _extended(self, part: str, counts: list[int], last: list[str]) -> bool:
        """Tokens and last token of every prefix, after those given; False where no token can be the last one."""
        pieces, orders, after = self.pieces, self.orders, self.after
        for end in range(len(counts), len(part) + 1):
            key = part[end - 1], len(last[-1])
            for length in orders.get(key) or self._order(*key):
                start = end - length
                if start < 0:
                    continue
                token = part[start:end]
                if token in pieces or length == 1:
                    left = last[start]
                    known = after.get(left)
                    stays = None if known is None else known.get(token)
                    if self._stay(left, token) if stays is None else stays:
                        # A character that is no piece becomes its bytes.
                        counts.append(counts[start] + (1 if token in pieces else len(self._token_ids(token))))
                        last.append(token)
                        break
            else:
                return False
        return True

    def _recurrence(self, part: str) -> list[int] | None:
        """Tokens of every prefix; None where no token can be the last one."""
        counts = [0]
        return counts if self._extended(part, counts, [""]) else None

    def fill(self, parts: Iterable[str]) -> None:
        """Have the tables of all these parts at hand."""
        new = [p for p in dict.fromkeys(parts) if p not in self.rows]
        if not new:
            return
        if len(self.rows) + len(new) > CACHED_PARTS or len(self.filled) > CACHED_TABLE_CHARS:
            self._forget()
            new = list(dict.fromkeys(parts))
        new.sort()
        tables: list[int] = []
        before, counts, last = "", [0], [""]
        for part, tokens in zip(new, self._encoded(new)):
            shared, most = 0, min(len(part), len(before))
            while shared < most and part[shared] == before[shared]:
                shared += 1
            del counts[shared + 1 :], last[shared + 1 :]
            if self.cuts and self._extended(part, counts, last) and counts[-1] == tokens:
                tables += counts[1:]
            else:
                tables += self._encoded([part[:i] for i in range(1, len(part) + 1)])
            before = part[: len(counts) - 1]
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        starts = len(self.filled) + np.cumsum(sizes) - sizes
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        self.filled = np.concatenate([self.filled, np.array(tables, np.int32)])

    def places(self, parts: list[str]) -> np.ndarray:
        """Where the tables of filled parts are."""
        return np.fromiter(map(self.rows.__getitem__, parts), np.int64, len(parts))

    def every_prefix(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes and tokens of a text's filled parts, and the tokens of every prefix of the text, the
        empty one first (in the place of the blank the library adds)."""
        return self.every_prefix_at(self.places(parts))

    def every_prefix_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``every_prefix``, by the places of the parts."""
        sizes, starts = self.sizes[at], self.starts[at]
        tokens = self.filled[starts + sizes - 1]
        inside = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        counts = self.filled[inside] + np.repeat(np.cumsum(tokens) - tokens, sizes)
        counts[:1] = 0
        return sizes, tokens, counts

    def table(self, part: str) -> np.ndarray:
        """Tokens of every prefix of a part, the empty one first."""
        if part not in self.tables:
            found = self._recurrence(part) if self.cuts else None
            if found is None or found[-1] != self.part_counts([part])[0]:
                found = [0] + self._encoded([part[:i] for i in range(1, len(part) + 1)])
            if self.table_chars + len(part) > CACHED_TABLE_CHARS:
                self.tables.clear()
                self.table_chars = 0
            self.table_chars += len(part)
            self.tables[part] = np.array(found)
        return self.tables[part]

    def prefix_tokens(self, text: str, chars: int) -> int:
        """Tokens of the first ``chars`` code points."""
        parts, ends, tokens = self.at_cuts(text)
        if chars <= 0 or not parts:
            return 0
        at = int(np.searchsorted(ends, min(chars, int(ends[-1]))))
        before = int(tokens[at - 1]) if at else 0
        inside = min(chars, int(ends[-1])) - (int(ends[at - 1]) if at else -1)
        return before + int(self.table(parts[at])[inside])

    def fitting_chars(self, parts: list[str], ends: np.ndarray, tokens: np.ndarray, limit: int) -> int:
        """Code points of the longest prefix with at most ``limit`` tokens."""
        if not parts or tokens[-1] <= limit:
            return int(ends[-1]) if parts else 0
        # Counts at cuts never fall, so the answer is the last cut that fits or lies in the next part.
        at = int(np.searchsorted(tokens, limit, side="right"))
        before, start = (int(tokens[at - 1]), int(ends[at - 1])) if at else (0, -1)
        fits = np.nonzero(self.table(parts[at]) <= limit - before)[0]
        return max(0, start + int(fits[-1]))


@lru_cache(maxsize=2)
def _counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


def _counted(model_file: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in batches:
            rows = []
            for text in batch["text"].to_pylist():
                parts, ends, tokens = counter.at_cuts(text or "")
                rows.append((int(tokens[-1]) if parts else 0, counter.fitting_chars(parts, ends, tokens, limit)))
            out = {name: batch[name] for name in batch.schema.names if name != "text"}
            out["n_tokens"] = pa.array([r[0] for r in rows], pa.int64())
            out["fitting_chars"] = pa.array([r[1] for r in rows], pa.int64())
            yield pa.RecordBatch.from_pydict(out)

    return run


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches, or slices of them, of about ``GROUP_BYTES`` of text together."""
    held, size = [], 0
    for batch in batches:
        mean = max(1, batch["text"].nbytes // max(1, batch.num_rows))
        step = max(1, GROUP_BYTES // mean)
        for at in range(0, batch.num_rows, step):
            held.append(batch.slice(at, step))
            size += mean * held[-1].num_rows
            if size >= GROUP_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _stored(model_file: str, limit: int):
    """As ``_counted``, with the count of every prefix of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for group in _grouped(batches):
            parts = [[counter.parts(t) if t else [] for t in batch["text"].to_pylist()] for batch in group]
            # A part is hashed once a group, in Arrow; its tables are looked up by number.
            flat = pa.array((p for texts in parts for own in texts for p in own), pa.large_string()).dictionary_encode()
            distinct = flat.dictionary.to_pylist()
            counter.fill(distinct)
            places, start = counter.places(distinct)[flat.indices.to_numpy()], 0
            for batch, texts in zip(group, parts):
                n_tokens, fitting, lists = [], [], {name: [] for name in (*PARTS, STEPS)}
                for own in texts:
                    sizes, tokens, counts = counter.every_prefix_at(places[start : start + len(own)])
                    start += len(own)
                    n_tokens.append(int(counts[-1]) if own else 0)
                    # Counts may fall, so the last prefix within the limit is looked for.
                    fits = not own or counts[-1] <= limit
                    fitting.append(max(0, len(counts) - 1) if fits else int(np.flatnonzero(counts <= limit)[-1]))
                    for name, values in zip(lists, (sizes, tokens, np.diff(counts))):
                        lists[name].append(values.astype(np.int32))
                out = {name: batch[name] for name in batch.schema.names if name != "text"}
                out |= {"n_tokens": pa.array(n_tokens, pa.int64()), "fitting_chars": pa.array(fitting, pa.int64())}
                yield pa.RecordBatch.from_pydict(out | {name: pa.array(v, pa.list_(pa.int32())) for name, v in lists.items()})

    return run


def token_counts(docs: DataFrame, model_file: str, limit: int = LIMIT, stored: bool = False) -> DataFrame:
    """Bytes, tokens and the longest prefix within ``limit`` tokens per document; with ``stored``
    also the step of the count at every code point, and the size and tokens of each part, for later
    questions (the first part starts with the blank the library adds)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, fitting_chars long"
    schema += "".join(f", {name} array<int>" for name in (*PARTS, STEPS)) if stored else ""
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow((_stored if stored else _counted)(model_file, limit), schema)


def fitting_prefixes(stored: DataFrame, limit: int) -> DataFrame:
    """Code points and tokens of the longest prefix within another ``limit``, from stored steps alone.

    Counts may fall from one prefix to the next, so the last one that fits counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for steps in batch[STEPS]:
                counts = np.cumsum(np.append(0, steps.values.to_numpy()))
                at = int(np.flatnonzero(counts <= limit)[-1]) if limit >= 0 else 0
                found.append((at, int(counts[at])))
            columns = {name: pa.array([f[i] for f in found], pa.int64()) for i, name in enumerate(("prefix_chars", "prefix_tokens"))}
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], **columns})

    kind = stored.schema["doc_id"].dataType.simpleString()
    return stored.select("doc_id", STEPS).mapInArrow(run, f"doc_id {kind}, prefix_chars long, prefix_tokens long")


def fitting_cuts(stored: DataFrame, limit: int) -> DataFrame:
    """Code points and tokens up to the last cut within another ``limit``, from stored counts alone.

    Counts at cuts never fall.  Returns ``doc_id, cut_chars, cut_tokens``; no cut fits: zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for chars, tokens in zip(batch[PARTS[0]], batch[PARTS[1]]):
                ends = np.cumsum(chars.values.to_numpy(), dtype=np.int64) - 1
                counts = np.cumsum(tokens.values.to_numpy(), dtype=np.int64)
                at = int(np.searchsorted(counts, limit, side="right"))
                found.append((int(ends[at - 1]), int(counts[at - 1])) if at and ends[at - 1] > 0 else (0, 0))
            columns = {name: pa.array([f[i] for f in found], pa.int64()) for i, name in enumerate(("cut_chars", "cut_tokens"))}
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], **columns})

    kind = stored.schema["doc_id"].dataType.simpleString()
    return stored.select("doc_id", *PARTS).mapInArrow(run, f"doc_id {kind}, cut_chars long, cut_tokens long")

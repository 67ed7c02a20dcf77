"""Mixing and chat formatting against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpus import documents, got, many, odd_rows
from storelake.llm import chat, mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(3, 1, 2)):
    """Share out, cap, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, capped = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_} if open_ else {}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return capped | share
        for s in over:
            capped[s] = 2 * sizes[s]
            left -= capped[s]


def mixed_rows(rng):
    rows = many(rng, 400, ("a", "b", "b", "b", "ü", "z", None))
    return rows + [(900 + i, "one word", "en", "tiny", 0) for i in range(2)] + odd_rows()


def test_targets_and_taken_words(llm):
    rows = mixed_rows(random.Random(1))
    docs = documents(llm, rows)
    found = mixing.taken_words(docs).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    want = targets(sizes)
    by_id = {r[0]: r for r in rows if r[0] is not None}
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        if r.doc_id is not None:
            source = by_id[r.doc_id][3]
            assert (r.size, r.source_size) == (size(by_id[r.doc_id][1]), sizes[source])
            assert r.target == pytest.approx(want[source])
            taken[source] += r.taken
    for source in ("b", "ü", "z"):
        assert abs(taken[source] - want[source]) <= 3 * mixing.BLOCK_WORDS
    assert got(mixing.taken_words(docs.repartition(7)).groupBy().agg(F.sum(F.hash("doc_id", "taken"))), "*") == got(
        mixing.taken_words(docs).groupBy().agg(F.sum(F.hash("doc_id", "taken"))), "*"
    )


def test_every_stretch_of_slots_is_close_to_the_targets(llm):
    docs = documents(llm, [(i, "w " * 200, "en", "abc"[i % 3], 0) for i in range(300)])
    mix = mixing.mixed(docs)
    shares = {r.source_no: r.target for r in mix.sources.collect()}
    total = sum(shares.values())
    slots = sorted((r.slot, r.source_no) for r in mix.slots.collect())
    for start in range(0, len(slots) - 200, 200):
        window = [s for _, s in slots[start : start + 200]]
        for source, target in shares.items():
            assert abs(window.count(source) - 200 * target / total) < 6


def test_mixed_documents_carry_the_taken_words(llm):
    docs = documents(llm, mixed_rows(random.Random(2))).withColumn("Block", F.lit("mine"))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    sizes = {k: v for k, v in got(out.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))), "*")}
    mix = mixing.mixed(docs)
    rows = mix.taken.join(mix.sized.groupBy("source", "doc_id", "text_hash").count(), ["doc_id", "text_hash"], "left")
    taken = {}
    for r in mix.taken.collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken * (2 if (r.doc_id, r.source) == (4, None) else 1)
    assert sizes == {k: v for k, v in taken.items() if v}
    assert rows is not None


def test_empty_table(llm):
    empty = documents(llm, [])
    assert mixing.taken_words(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


# -- chat ------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["", "<s>", "</s>", "\\", "\\<s>", "<\\s>", "<", "</s", "\\\\</s>\n", "a\nb", "</s>[INST] ok [/INST]", "É𝄞", None]


def conversations(rng, n):
    rows = []
    for c in range(n):
        turns = []
        if rng.random() < 0.5:
            turns.append("system")
        turns += [("user", "assistant", "tool\nx", None)[rng.choice((0, 1, 1, 2, 3))] for _ in range(rng.randint(1, 12))]
        for t, role in enumerate(turns):
            text = rng.choice(NASTY) if rng.random() < 0.3 else " ".join("w" * 3 for _ in range(rng.choice((1, 20, 200, 900))))
            rows.append((c, t, role, text))
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "a"), (77_000, None, "assistant", "x"), (77_000, None, "assistant", "x")]
    rows += [(88_000, 0, "system", "only")]
    return rows


def test_windows_read_back_exactly(llm):
    rows = conversations(random.Random(3), 60)
    turns = llm.createDataFrame(rows, TURNS).withColumn("span", F.lit("mine"))
    windows = chat.formatted(turns)
    found = {r.conv_id: r for r in chat.conversation_digests(windows).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append(((t is not None, t), role or "", text or ""))
    assert set(found) == set(want)
    for c, turns_of in want.items():
        turns_of.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns_of)
        loss = "".join(text for _, role, text in turns_of if role == "assistant")
        r = found[c]
        assert r.n_turns == len(turns_of)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for w in windows.collect():
        head = w.formatted.split("</s>")[0]
        if not (head.startswith("<s>system") and size(head) > 400):  # a system turn beyond the budget stays whole
            assert w.n_tokens <= chat.BUDGET or w.n_turns == 1
        assert sum(m.length for m in w.loss_mask) <= len(w.formatted)
    systems = {c for c, t, role, _ in rows if t == 0 and role == "system"}
    for w in windows.where(F.col("span") > 0).collect():
        assert w.formatted.startswith("<s>system\n") == (w.conv_id in systems)


def test_history_is_limited_and_masked(llm):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i} " + "w " * 29) for i in range(60)]
    windows = chat.formatted(llm.createDataFrame(rows, TURNS)).orderBy("span").collect()
    assert len(windows) > 3
    for w in windows[1:]:
        turns = w.formatted.split("</s>")
        assert 0 < w.n_repeated * 34 <= chat.HISTORY
        first = int(re.match(r"<s>\w+\nt(\d+)", turns[0]).group(1))
        mine = int(re.match(r"<s>\w+\nt(\d+)", turns[w.n_repeated]).group(1))
        assert mine == first + w.n_repeated
        start = w.formatted.index(turns[w.n_repeated])
        assert all(m.start >= start for m in w.loss_mask)


def test_no_conversations(llm):
    assert chat.conversation_digests(chat.formatted(llm.createDataFrame([], TURNS))).count() == 0

"""Language model, tagger, decontamination and the pipeline."""

import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus import documents, got, many, odd_rows, prose
from storelake.llm import crf, decontam, gru, lm, nearcopies, simhash, toxicity

# -- language model ------------------------------------------------------------------------


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = gru.Gru.start(np.full(64, 5.0), np.full(4, 9.0), 1, hidden=3)
    model.p = {k: (v + rng.normal(0, 0.2, v.shape)).astype(np.float64) for k, v in model.p.items()}
    texts = [rng.integers(0, 68, n) for n in (12, 7, 9)]
    targets, given, _ = next(gru._windows(texts, gru.WINDOW))

    def loss():
        h = np.zeros((3, targets.shape[1]))
        states, _ = model._states(given, h, None)
        real = targets >= 0
        return model._outputs(gru._picked(states, real), targets[real], None)[0].sum()

    seen = {}

    class Keep:
        def step(self, parts, grads, tokens):
            seen.update({k: v.copy() for k, v in grads.items()})

    model.train(texts, Keep())
    for name, value in model.p.items():
        for at in map(tuple, rng.integers(0, value.shape, (6, value.ndim))):
            was, eps = value[at], 1e-3
            value[at] = was + eps
            up = loss()
            value[at] = was - eps
            down = loss()
            value[at] = was
            assert seen[name][at] == pytest.approx((up - down) / (2 * eps), rel=0.05, abs=0.02)


def test_every_training_token_takes_a_step_and_gain_holds_on_new_texts():
    rng = np.random.default_rng(5)
    follow = rng.integers(0, 64, (64, 2))

    def text(n):
        out = [int(rng.integers(64))]
        while len(out) < n:
            out.append(int(follow[out[-1], rng.integers(2)]))
        return np.array(out)

    texts = [text(int(n)) for n in rng.integers(0, 200, 800)] + [np.zeros(0, np.int64), text(5000)]
    model = gru.Gru.start(np.bincount(np.concatenate(texts), minlength=64)[:64].astype(float), np.full(4, 1.0), 6)
    new = [text(300) for _ in range(20)]
    before = model.score(new).sum()
    assert model.train(texts, gru.Adam(lm.RATE)) == sum(map(len, texts))
    assert model.score(new).sum() > before + 0.3 * 20 * 300


def test_probabilities_sum_to_one_and_state_is_carried():
    model = gru.Gru.start(np.arange(1.0, 65), np.full(4, 9.0), 2, hidden=4)
    rng = np.random.default_rng(3)
    for k in ("classes", "words"):
        model.p[k] += rng.normal(0, 0.5, model.p[k].shape).astype(np.float32)
    start = rng.integers(0, 68, 300)
    ends = [np.append(start, i) for i in range(68)]
    without = model.score([start])[0]
    assert np.exp(model.score(ends) - without).sum() == pytest.approx(1, abs=1e-3)
    other = np.concatenate([start[::-1], start])
    assert abs(model.score([other])[0] - model.score([start[::-1]])[0] - without) > 1e-3
    many_texts = [rng.integers(0, 68, n) for n in (0, 1, 500, 40, 3)]
    assert np.allclose(model.score(many_texts), [model.score([t])[0] for t in many_texts], atol=1e-3)


def test_windows_fill_the_same_memory_and_leave_no_trace_in_it():
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 132, int(n)) for n in rng.integers(0, 300, 400)]
    fresh = lambda: gru.Gru.start(np.arange(128.0, 0, -1), np.full(4, 9.0), 4)
    used, new = fresh(), fresh()
    used.train(texts, gru.Adam(lm.RATE))
    held = {k: id(v) for k, v in used.room.held.items()}
    assert {"states", "gates", "through", "class logits", "word logits"} <= held.keys()
    used.p = {k: v.copy() for k, v in new.p.items()}
    assert used.train(texts, gru.Adam(lm.RATE)) == new.train(texts, gru.Adam(lm.RATE))
    assert {k: id(v) for k, v in used.room.held.items()} == held
    assert all((used.p[k] == new.p[k]).all() for k in gru.NAMES)
    few = texts[:3]
    assert (used.score(few) == new.score(few)).all()


@pytest.mark.parametrize("spread", [0.5, 60])  # with 60 logits pass the limit
def test_outputs_equal_plain_softmax(spread):
    rng = np.random.default_rng(9)
    model = gru.Gru.start(np.arange(256.0, 0, -1), np.full(4, 9.0), 4, hidden=3)
    model.p = {k: (v + rng.normal(0, spread, v.shape)).astype(np.float64) for k, v in model.p.items()}
    n = 2 * gru.SLICE + 77
    states, ids = rng.uniform(-1, 1, (1, 3, n)), np.where(rng.random(n) < 0.5, rng.integers(0, 3, n), rng.integers(0, 260, n))
    grads = {k: np.zeros_like(v) for k, v in model.p.items()}
    loglik, _ = model._outputs(gru._picked(states, np.ones((1, n), bool)), ids, grads)
    p, clip = model.p, np.clip
    plain, by_word = np.zeros(n), np.zeros_like(p["words"])
    for i, word in enumerate(ids):
        logits = clip(p["classes"].T @ states[0, :, i] + p["class_bias"], -gru.LIMIT, gru.LIMIT)
        at = model.class_of(np.array(word))
        plain[i] = logits[at] - np.log(np.exp(logits).sum())
        if word < 256:
            logits = clip(p["words"][at].T @ states[0, :, i] + p["word_bias"][at], -gru.LIMIT, gru.LIMIT)
            plain[i] += logits[word % 64] - np.log(np.exp(logits).sum())
            by_word[at] += np.outer(states[0, :, i], (np.arange(64) == word % 64) - np.exp(logits) / np.exp(logits).sum())
    assert np.allclose(loglik, plain, atol=1e-6)
    assert np.allclose(grads["words"], by_word, atol=1e-6)
    assert (loglik == model._outputs(gru._picked(states, np.ones((1, n), bool)), ids, None)[0]).all()


def test_model_numbers_are_read_where_they_lie():
    ids = pa.array([[1, 2, 3], [], [4], [5, 6]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_pydict({"ids": ids}).slice(1)
    [(held, texts)] = lm._together(iter([batch]))
    assert held == [batch] and [t.tolist() for t in texts] == [[], [4], [5, 6]]
    assert all(np.shares_memory(t, ids.values.to_numpy()) for t in texts if len(t))


def test_scores(llm, monkeypatch):
    monkeypatch.setattr(lm, "DICTIONARY", 300)
    rng = random.Random(4)
    rows = many(rng, 300, words=(5, 80)) + odd_rows()
    rows += [(1000 + i, "der die das " * 30, "de", "x", 0) for i in range(60)]
    out = lm.scored(documents(llm, rows).withColumn("score", F.lit("x"))).collect()
    assert len(out) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    counts = Counter(w for r in rows if not held(r[0]) for w in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = Counter(
        (
            repr(r[0]),
            held(r[0]),
            len(tokens(r[1])),
            sum(w in counts for w in tokens(r[1])),
            n,
            round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(r[1])), 4),
        )
        for r in rows
    )
    assert Counter((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == want
    new = [r for r in out if r.held_out]
    assert sum(r.score for r in new) > sum(r.base_score for r in new)
    assert all(r.score < 0 for r in out)


def test_no_texts_to_learn_from(llm):
    assert lm.scored(documents(llm, [])).count() == 0
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    out = lm.scored(documents(llm, [(ids[0], "a b", "en", "x", 3)])).first()
    assert (out.held_out, out.n_known, out.train_tokens, out.base_score) == (True, 0, 0, 0.0)
    assert out.score == pytest.approx(-3 * math.log10(lm.GROUPS), abs=1e-3)


# -- tagger ------------------------------------------------------------------------------------


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    weights = [np.concatenate([[0], rng.normal(0, 1, crf.LEVELS - 1)]) for _ in range(3)]
    model = crf.Crf(-0.7, *weights, rng.normal(0, 1, (2, 2)))
    for _ in range(20):
        n = int(rng.integers(1, 10))
        levels = rng.integers(0, crf.LEVELS, n) * (rng.random(n) < 0.3)
        u = model.potentials(levels)
        total, marked = 0.0, np.zeros(n)
        for tags in product((0, 1), repeat=n):
            weight = math.exp(sum(u[i] for i in range(n) if tags[i]) + sum(model.change[a, b] for a, b in zip(tags, tags[1:])))
            total += weight
            marked += weight * np.array(tags)
        places = np.nonzero(levels)[0]
        active, p = model.marginals(places, levels[places], n)
        assert np.allclose(p, (marked / total)[active.astype(int)] if len(active) else p, atol=1e-6)


def test_training_gradient_equals_differences():
    rng = np.random.default_rng(2)
    levels, tags = rng.integers(0, crf.LEVELS, (2, 6)), rng.integers(0, 2, (2, 6))
    lengths = np.array([6, 4])
    levels[1, 4:] = tags[1, 4:] = 0
    model = crf.Crf.start()

    def loglik(change):
        out = 0.0
        for i, n in enumerate(lengths):
            u = model.potentials(levels[i, :n])
            score = lambda t: sum(u[k] for k in range(n) if t[k]) + sum(change[a, b] for a, b in zip(t, t[1:]))
            out += score(tags[i, :n]) - math.log(sum(math.exp(score(t)) for t in product((0, 1), repeat=int(n))))
        return out

    pairs = crf._gradient(model, levels, tags, lengths)[4]
    for at in product((0, 1), repeat=2):
        up, down = model.change.copy(), model.change.copy()
        up[at] += 1e-4
        down[at] -= 1e-4
        assert pairs[at] == pytest.approx((loglik(up) - loglik(down)) / 2e-4, abs=1e-3)


def test_codes_weigh_word_beginning_and_end():
    rng = np.random.default_rng(4)
    weights = [np.concatenate([[0], rng.normal(0, 1, crf.LEVELS - 1)]) for _ in range(5)]
    model = crf.Crf(-0.7, *weights[:3], rng.normal(0, 1, (2, 2)), *weights[3:])
    parts = rng.integers(0, crf.LEVELS, (3, 5))
    levels = np.array([crf.code(*map(int, p)) for p in parts.T])
    u, top = model.potentials(levels), parts.max(axis=0)
    assert top.tolist() == [crf.highest(x) for x in levels]
    own, before, after, begin, end = weights
    for i in range(5):
        want = -0.7 + own[parts[0, i]] + begin[parts[1, i]] + end[parts[2, i]]
        want += (before[top[i - 1]] if i else 0) + (after[top[i + 1]] if i < 4 else 0)
        assert u[i] == pytest.approx(want)
    # Gradients of the affix weights against differences; all tags are 1.
    tags, lengths = np.ones((1, 5), dtype=int), np.array([5])
    grads = crf._gradient(model, levels[None], tags, lengths)

    def loglik():
        u = crf.Crf(-0.7, own, before, after, model.change, begin, end).potentials(levels)
        score = lambda t: sum(u[k] for k in range(5) if t[k]) + sum(model.change[a, b] for a, b in zip(t, t[1:]))
        return score((1,) * 5) - math.log(sum(math.exp(score(t)) for t in product((0, 1), repeat=5)))

    for at, weight in ((1, own), (5, begin), (6, end)):
        for level in set(parts[{1: 0, 5: 1, 6: 2}[at]]) - {0}:
            weight[level] += 1e-4
            up = loglik()
            weight[level] -= 2e-4
            down = loglik()
            weight[level] += 1e-4
            assert grads[at][level] == pytest.approx((up - down) / 2e-4, abs=1e-3)


def test_training_windows_hold_every_token_once():
    rng = np.random.default_rng(6)
    texts = [(rng.integers(0, 8, n), rng.integers(0, 2, n)) for n in (1, 5000, crf.WINDOW, 300, crf.WINDOW + 1)]
    seen = list(crf._windows(texts * 60))
    assert sum(int(n.sum()) for _, _, n in seen) == 60 * sum(len(x) for x, _ in texts)
    assert all(x.shape == y.shape and x.shape[0] <= crf.WINDOWS_AT_ONCE and x.shape[1] <= crf.WINDOW for x, y, _ in seen)
    assert sum(int(y.sum()) for _, y, _ in seen) == 60 * sum(int(y.sum()) for _, y in texts)


def toxic_corpus(n):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(20, 120)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(("Zgrrx", "zvexx,", "zmurk"))
        rows.append((100 + i, " ".join(words), "en", "s", 0))
        labels.append((100 + i, 1, int(toxic)))
    return rows, labels


def test_toxic_documents_and_spans(llm):
    rows, labels = toxic_corpus(500)
    marks = llm.createDataFrame(labels + [(None, 1, 1), (103, None, None)], "doc_id long, quality int, toxic int")
    out = toxicity.scored(documents(llm, rows + odd_rows()), marks).collect()
    assert len(out) == len(rows) + len(odd_rows())
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        if r.doc_id is not None and r.doc_id > 8:
            assert r.predicted == (r.doc_id % 5 == 0) and 0 <= r.score <= 1
            said = {texts[r.doc_id][s.start : s.start + s.length].lower() for s in r.spans}
            assert said <= {"zgrrx", "zvexx", "zmurk"} and bool(said) == (r.doc_id % 5 == 0)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    kept = toxicity.accepted(documents(llm, rows), marks)
    assert kept.count() == 400 and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_word_beginnings_and_a_million_words(llm):
    """Toxic words never come twice, only their beginnings do; one labelled text is very long."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        words = prose(rng, 60).split()
        if i % 4 == 0:
            for _ in range(3):
                words[rng.randrange(60)] = f"Xqzw{''.join(rng.choices('abcdefgh', k=8))}"
        rows.append((100 + i, " ".join(words), "en", "s", 0))
        labels.append((100 + i, 1, int(i % 4 == 0)))
    long_id = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 3 != 1)
    rows.append((long_id, "xqzwabab " + "plain words only " * 333_333, "en", "s", 0))
    out = toxicity.scored(documents(llm, rows), llm.createDataFrame([*labels, (long_id, 1, 1)], "doc_id long, quality int, toxic int"))
    found = {r.doc_id: (r.predicted, [(s.start, s.length) for s in r.spans]) for r in out.collect()}
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and all(found[i][0] == (i % 4 == 0) for i in held)
    assert (0, 8) in found[long_id][1] and len(found[long_id][1]) == 1


def test_only_true_copies_share_a_signature():
    rng = random.Random(15)
    shared = prose(rng, 400)
    texts = [f"{shared} {prose(rng, 4)} {i}x" + "yz"[i % 2] * (i + 1) for i in range(30)]
    sign = lambda t: toxicity.signature(toxicity.tokens(t.encode()))
    assert len({sign(t) for t in texts}) == 30
    assert sign(texts[0].upper().replace(" ", ", ")) == sign(texts[0])


def test_without_labels_nothing_is_toxic(llm):
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.scored(documents(llm, odd_rows()), none).collect()
    assert len(out) == len(odd_rows()) and not any(r.predicted for r in out)
    assert toxicity.scored(documents(llm, []), none).count() == 0


# -- decontamination ------------------------------------------------------------------------------


def items(rng, n):
    return [(i, f"{prose(rng, rng.randint(10, 40))}. {prose(rng, rng.randint(3, 70))}.") for i in range(n)]


def test_wand_finds_what_full_scoring_finds():
    rng = random.Random(6)
    index = decontam.build_index(items(rng, 120))
    for _ in range(60):
        own = [w for w in rng.choice(index.items)[1]]
        query = set(own[: rng.randint(1, len(own))] + prose(rng, 30).encode().split())
        scores = Counter()
        for w in query:
            p = index.lists.get(w)
            for s, x in zip(p.segments, p.weights) if p else ():
                scores[s] += x
        for threshold in (0.2, 0.5, 0.8):
            want = {s for s, x in scores.items() if x >= threshold}
            found = dict(decontam.block_max_wand(index, query, threshold))
            assert want == set(found) and all(found[s] == pytest.approx(scores[s]) for s in found)


def test_leaks_are_found_and_clean_documents_stay(llm, monkeypatch):
    rng = random.Random(7)
    bench = items(rng, 60)
    rows, want = [], set()
    for i in range(300):
        words = prose(rng, rng.randint(0, 400)).split()
        if i % 3 == 0:
            item = rng.choice(bench)
            at = rng.randint(0, len(words))
            words[at:at] = item[1].upper().replace(" ", "  ").split(" ")
            want.add((i, item[0]))
        rows.append((i, " ".join(words), "en", "s", 0))
    rows += [(400, prose(rng, 20_000) + " " + bench[5][1] + " " + prose(rng, 20_000), "en", "s", 0)]
    want.add((400, bench[5][0]))
    monkeypatch.setattr(decontam, "SLICE_WORDS", decontam.STRIDE * 8)
    found = set()
    for index in [decontam.build_index(bench)]:
        found |= {(rows[h[0]][0], h[1]) for h in decontam.leaks(index, [r[1].encode() for r in rows])}
    assert found == want
    benchmark = llm.createDataFrame([*bench, (900, None), (901, ""), (None, "...")], "item_id long, text string")
    docs = documents(llm, rows + odd_rows())
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, benchmark).collect()} == want
    kept = decontam.decontaminated(docs, benchmark)
    assert kept.count() == docs.count() - len({d for d, _ in want})
    assert decontam.contaminated(documents(llm, []), benchmark).count() == 0
    assert decontam.contaminated(docs, benchmark.limit(0)).count() == 0


def test_scores_do_not_depend_on_the_number_of_shards(llm):
    """Items with a part of their words gone score close to the threshold."""
    rng = random.Random(8)
    bench = items(rng, 80)
    rows = []
    for i in range(200):
        thinned = rng.choice(bench)[1].split()
        gap = int(len(thinned) * rng.uniform(0.15, 0.3))
        at = rng.randrange(len(thinned) - gap)
        del thinned[at : at + gap]
        rows.append((i, f"{prose(rng, 40)} {' '.join(thinned)} {prose(rng, 40)}", "en", "s", 0))
    docs, benchmark = documents(llm, rows), llm.createDataFrame(bench, "item_id long, text string")
    words = sum(len(decontam.terms(t.encode())) for _, t in bench)
    columns = "doc_id", "item_id", "score"
    want = sorted(got(decontam.contaminated(docs, benchmark), *columns))
    assert len(want) > 20 and min(s for _, _, s in want) < decontam.THRESHOLD + 0.05
    for shards in (2, 8):
        most = -(-2 * words // shards)
        assert len(list(decontam.indexes(benchmark, most))) == shards
        found = sorted(got(decontam.contaminated(docs, benchmark, shard_words=most), *columns))
        assert [f[:2] for f in found] == [w[:2] for w in want]
        assert [f[2] for f in found] == pytest.approx([w[2] for w in want])
    assert decontam.decontaminated(docs, benchmark, shard_words=-(-2 * words // 8)).count() == len(rows) - len({w[0] for w in want})


def test_some_thousand_words_are_modelled_as_themselves():
    words = [b"w%d" % i for i in range(3000)]
    vocab = lm.Vocabulary([(w, 5000 - i) for i, w in enumerate(words)], [(10**7, 3000)] * lm.GROUPS, 10**7, 3000)
    ids = vocab.model_ids(words, vocab.numbers(words))
    assert ids[:2048].tolist() == list(range(2048))
    assert set(ids[2048:].tolist()) <= set(range(2048, 2048 + lm.GROUPS))


# -- pipeline ------------------------------------------------------------------------------------


def test_pipeline(llm, tmp_path):
    rng = random.Random(8)
    rows, labels = toxic_corpus(400)
    bench = items(rng, 20)
    rows += [(1000 + i, rows[1][1], "en", "s", 0) for i in range(5)]
    rows += [(2000 + i, prose(rng, 60) + " " + bench[i][1] + " " + prose(rng, 50), "en", "t", 0) for i in range(10)]
    documents(llm, rows).write.parquet(str(tmp_path / "documents.parquet"))
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    llm.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = llm.read.parquet(str(tmp_path / "documents.parquet"))
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(llm, docs, str(tmp_path)).write.parquet(path)
        docs = llm.read.parquet(path)
        after[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "sharding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = {100 + i for i in range(400) if i % 5}
    assert after["toxicity"] == clean | set(range(1000, 1005)) | set(range(2000, 2010))
    assert after["near_duplicates"] == clean | set(range(2000, 2010))
    assert after["decontamination"] == clean
    assert after["mixing"] <= clean and len(after["mixing"]) > 0
    assert after["sharding"] == after["mixing"]
    rerun = corpus_pipeline.run(llm, str(tmp_path))
    assert sorted(map(repr, rerun.collect())) == sorted(map(repr, docs.collect()))


def test_pipeline_drops_what_the_simhash_operator_links(llm):
    rng = random.Random(21)
    chorus = " ".join([prose(rng, 5)] * 50)
    far = [f"{chorus} {prose(rng, 40)}" for _ in range(2)]
    base = prose(rng, 200).split()
    near = [" ".join(base), " ".join([*base[:195], *prose(rng, 5).split()])]
    docs = documents(llm, [(i, t, "en", "a", 0) for i, t in enumerate([*far, *near, prose(rng, 60)])])
    # The first two differ in most distinct shingles but not in two bits; the next two the other way round.
    linked = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert linked[1] == 0 and linked[3] == 3
    assert {r.doc_id for r in nearcopies.deduplicated(docs).collect()} == {0, 1, 2, 4}
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(llm, docs, "").collect()} == {0, 2, 4}

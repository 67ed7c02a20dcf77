"""Sharding, SimHash, quality rules, token counts, URL filters against brute force."""

import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from compare import difference
from corpus import documents, got, many, odd_rows, prose, word
from storelake.llm import nearcopies, queries, robust, sharding, simhash, tokencount, urlfilter
from storelake.llm.components import components


# -- sharding ------------------------------------------------------------------------------


def test_shards_hold_every_row_once_in_gapless_slots(llm):
    rows = many(random.Random(1), 500) + odd_rows()
    docs = documents(llm, rows).withColumn("SLOT", F.lit(-1))
    out = sharding.sharded(docs, bucket_bytes=4096)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    table = out.collect()
    assert sorted(map(repr, (tuple(r)[:5] for r in table))) == sorted(map(repr, rows))
    slots = {}
    for r in table:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24
    again = sharding.sharded(docs.repartition(9), bucket_bytes=4096)
    assert sorted(map(repr, map(tuple, again.collect()))) == sorted(map(repr, map(tuple, table)))


def test_one_more_shard_only_takes_rows(llm):
    docs = documents(llm, many(random.Random(2), 2000))
    moved = got(docs.select(sharding.shard_of(24).alias("a"), sharding.shard_of(25).alias("b")), "a", "b")
    assert all(a == b or b == 24 for a, b in moved)
    assert 30 < sum(b == 24 for _, b in moved) < 140


def test_order_inside_shards_is_random(llm):
    docs = documents(llm, many(random.Random(3), 3000))
    rows = sorted(got(sharding.sharded(docs, shards=2), "shard", "slot", "doc_id"))
    ids = np.array([r[2] for r in rows if r[0] == 0], float)
    assert abs(np.corrcoef(np.arange(len(ids)), ids)[0, 1]) < 0.1


def test_written_shards(llm, tmp_path):
    docs = documents(llm, many(random.Random(4), 50))
    sharding.written_shards(docs, str(tmp_path / "out"), shards=3)
    assert llm.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 3
    assert sharding.sharded(documents(llm, [])).count() == 0


# -- SimHash -------------------------------------------------------------------------------


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    listed = sorted(prints)
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in prints}


def test_components_equal_brute_force(llm):
    rng = random.Random(5)
    rows = many(rng, 60) + odd_rows()
    base = prose(rng, 2000).split()
    for i in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = word(rng)
        rows.append((5000 + i, " ".join(copy), "en", "c", 0))
    docs = documents(llm, rows).withColumn("fp", F.lit("mine"))
    found = simhash.near_duplicates(docs).collect()
    want_print = [slow_fingerprint(r[1]) for r in rows]
    roots = slow_components(set(want_print))
    least = {}
    for r, f in zip(rows, want_print):
        ids = least.setdefault(roots[f], [])
        if r[0] is not None:
            ids.append(r[0])
    want = sorted((repr(r[0]), f, min(least[roots[f]], default=None)) for r, f in zip(rows, want_print))
    assert sorted((repr(r.doc_id), r.fp & (2**64 - 1), r.component_id) for r in found) == want
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots.values()))


def test_crowded_blocks_link_like_small_ones(llm):
    rng = random.Random(6)
    prints = {0}
    while len(prints) < 300:  # a chain of close fingerprints in one half, some far ones
        f = rng.choice(sorted(prints)) ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(40))
        prints.add(f if rng.random() < 0.8 else rng.getrandbits(63))
    df = llm.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in prints], "fp long")
    want = slow_components(prints)
    groups = lambda pairs: {frozenset(x for x in pairs if pairs[x] == r) for r in set(pairs.values())}
    for limit in (4096, 3):
        found = {f: f for f in prints}
        found |= {n & (2**64 - 1): r & (2**64 - 1) for n, r in got(components(simhash.links(df, limit)), "node", "root")}
        assert groups(found) == groups(want)


def test_no_documents_to_compare(llm):
    assert simhash.near_duplicates(documents(llm, [])).count() == 0
    assert simhash.deduplicated(documents(llm, [])).count() == 0


# -- near copies ---------------------------------------------------------------------------


def slow_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_near(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b) > 0


def test_near_copies_go_and_all_others_stay(llm):
    rng = random.Random(14)
    rows = many(rng, 80, words=(1, 120)) + odd_rows()
    planted = []
    for i in range(150):
        base = prose(rng, rng.randint(60, 300)).split()
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.randint(1, max(1, len(copy) // 40))):
            copy[at] = word(rng) + "x"
        rows += [(5000 + 2 * i, " ".join(base), "en", "c", 0), (5001 + 2 * i, " ".join(copy), "en", "c", 0)]
        if slow_near(slow_shingles(" ".join(base)), slow_shingles(" ".join(copy))):
            planted.append(5001 + 2 * i)
    family = prose(rng, 400).split()
    for i in range(120):
        copy = list(family)
        for _ in range(rng.randint(0, 16)):
            copy[rng.randrange(len(copy))] = word(rng)
        rows.append((9000 + i, " ".join(copy), "en", "c", 0))
    docs = documents(llm, rows).withColumn("node", F.lit("mine"))
    out = nearcopies.deduplicated(docs)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert len(planted) > 80 and not {r[0] for r in kept} & set(planted)
    sets = [slow_shingles(t) for _, t in kept]
    assert not any(slow_near(a, b) for i, a in enumerate(sets) for b in sets[i + 1 :])
    stayed = Counter(map(repr, kept))
    for row in rows:
        if not stayed[repr(row[:2])]:
            own = slow_shingles(row[1])
            assert any(slow_near(own, slow_shingles(r[1])) for r in rows if r is not row and r[0] is not None and (row[0] is None or r[0] <= row[0]))
    assert nearcopies.deduplicated(documents(llm, [])).count() == 0


# -- quality rules ---------------------------------------------------------------------------


def slow_statistics(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(inside),
    )


@pytest.mark.parametrize("seed", range(4))
def test_statistics_equal_brute_force(seed):
    rng = random.Random(seed)
    parts = ["a", "b", "é𝄞", "#$", " ", "  ", "\n", "\n", "\t", "\u00a0", "\x85"]
    for n in (0, 1, 3, 4, 30, 200):
        text = " ".join(rng.choice(parts) for _ in range(n))
        assert robust.statistics(text.encode()) == slow_statistics(text)
    assert robust.statistics(None) == (0, 0, 0, 0, 0, 0)


def test_outliers_go_and_clean_documents_stay(llm):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        text = prose(rng, rng.randint(60, 400))
        junk = i % 10 == 0
        if junk:
            text = " ".join(w + "%%%" if k % 2 else w + "|" for k, w in enumerate(text.split()))
        rows.append((i + (10_000 if junk else 0), text, "en" if i % 3 else "fr", "s%d" % (i % 4), 0))
    out = robust.judged(documents(llm, rows + odd_rows()).withColumn("distance", F.lit("x"))).collect()
    assert len(out) == len(rows) + len(odd_rows())
    big = [r for r in out if r.doc_id is not None and r.n_words >= 50]
    assert not any(r.kept for r in big if 10_000 <= r.doc_id)
    assert all(r.kept for r in big if 8 < r.doc_id < 10_000)
    assert all(not r.kept for r in out if r.base_failed)
    assert robust.judged(documents(llm, [])).count() == 0


def test_minimum_covariance_resists_a_quarter_of_outliers(llm):
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (900, 4)), rng.normal(9, 1, (200, 4))
    values = [("en", "s", *map(float, x)) for x in np.vstack([good, bad])]
    df = llm.createDataFrame(values, "lang string, source string, " + ", ".join(f"{c} double" for c in robust.COORDINATES))
    state = robust.estimates(df).where("level = 0").first()
    assert np.abs(np.array(state.centre)).max() < 0.25
    cov = np.linalg.inv(np.array(state.inverse).reshape(4, 4)) * robust.consistency()
    assert np.abs(np.diag(cov) - 1).max() < 0.5


def test_copies_of_one_junk_document_do_not_become_the_core(llm):
    rng = random.Random(12)

    def junk(words, every):
        return " ".join(w + "%%%" if k % every == 0 else w for k, w in enumerate(words.split()))

    rows = [(i, prose(rng, rng.randint(60, 400)), "en", "s", 0) for i in range(270)]
    rows += [(1000 + i, junk(prose(rng, rng.randint(60, 400)), 1 + i % 3), "en", "s", 0) for i in range(20)]
    copy = junk(prose(rng, 200), 2)
    rows += [(2000 + i, copy, "en", "s", 0) for i in range(145)]
    out = robust.judged(documents(llm, rows)).collect()
    assert {r.doc_id for r in out if not r.kept} == {r[0] for r in rows if r[0] >= 1000}


def test_least_determinant_of_the_starts_is_taken(llm):
    rng = np.random.default_rng(1)
    # Both groups of rows hold about half; the tight one has the least determinant.
    tight, wide = rng.normal(0, 0.3, (520, 4)), rng.normal(6, 3, (480, 4))
    values = [("en", "s", *map(float, x)) for x in np.vstack([tight, wide])]
    df = llm.createDataFrame(values, "lang string, source string, " + ", ".join(f"{c} double" for c in robust.COORDINATES))
    state = robust.estimates(df).where("level = 0").first()
    assert np.abs(np.array(state.centre)).max() < 0.2


# -- token counts ------------------------------------------------------------------------------

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts(rng, n):
    parts = ["hello", " ", "  ", "▁", "\n", "\n\n", "\t", "\r", "é", "ﬁ", "𝄞", "<s>", "</s>", "<unk>", "The", "ing", "\x00", "日本", "a" * 40, "."]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_counts_equal_the_library_at_every_prefix():
    counter = tokencount.PrefixCounter(MODEL)
    assert counter.cuts
    for text in odd_texts(random.Random(9), 300):
        assert (counter.at_cuts(text)[2][-1] if text else 0) == len(counter.model.encode(text))
    for text in odd_texts(random.Random(10), 40):
        slow = [len(counter.model.encode(text[:i])) for i in range(len(text) + 1)]
        assert [counter.prefix_tokens(text, i) for i in range(len(text) + 1)] == slow
        for limit in (0, 1, 3, 8):
            fits = counter.fitting_chars(*counter.at_cuts(text), limit)
            assert slow[fits] <= limit and all(s > limit for s in slow[fits + 1 :])


def test_count_table(llm):
    rows = odd_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(odd_texts(random.Random(12), 50))]
    out = tokencount.token_counts(documents(llm, rows).withColumn("n_tokens", F.lit("x")), MODEL, stored=True).collect()
    counter = tokencount.PrefixCounter(MODEL)
    want = sorted((repr(r[0]), len((r[1] or "").encode()), len(counter.model.encode(r[1] or ""))) for r in rows)
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == want
    assert all(sum(r.part_tokens) == r.n_tokens for r in out)
    sizes = sorted((repr(r.doc_id), sum(r.part_chars) - bool(r.part_chars)) for r in out)
    assert sizes == sorted((repr(r[0]), len(r[1] or "")) for r in rows)
    assert tokencount.token_counts(documents(llm, []), MODEL).count() == 0


def test_the_count_of_every_prefix_is_stored(llm):
    texts = {i: t for i, t in enumerate([None, "", " ", "\n", *odd_texts(random.Random(17), 60), "the thin thing, " * 40 + "日本𝄞" * 20])}
    stored = tokencount.token_counts(documents(llm, [(i, t, None, None, None) for i, t in texts.items()]), MODEL, stored=True).persist()
    model = tokencount.PrefixCounter(MODEL).model
    slow = {i: [len(model.encode((t or "")[:n])) for n in range(len(t or "") + 1)] for i, t in texts.items()}
    for r in stored.collect():
        assert np.cumsum([0, *r.prefix_steps]).tolist() == slow[r.doc_id]
        assert r.n_tokens == slow[r.doc_id][-1]
    for limit in (0, 1, 7, 30):
        want = {i: max(n for n, c in enumerate(counts) if c <= limit) for i, counts in slow.items()}
        found = tokencount.fitting_prefixes(stored, limit).collect()
        assert {r.doc_id: (r.prefix_chars, r.prefix_tokens) for r in found} == {i: (n, slow[i][n]) for i, n in want.items()}
        capped = tokencount.token_counts(documents(llm, [(i, t, None, None, None) for i, t in texts.items()]), MODEL, limit, stored=True)
        assert {r.doc_id: r.fitting_chars for r in capped.collect()} == want
    stored.unpersist()


def test_full_caches_do_not_change_counts(monkeypatch):
    counter = tokencount.PrefixCounter(MODEL)
    monkeypatch.setattr(tokencount, "CACHED_PARTS", 20)
    monkeypatch.setattr(tokencount, "CACHED_PAIRS", 10)
    for text in filter(None, odd_texts(random.Random(18), 60)):
        parts = counter.parts(text)
        counter.fill(parts)
        counts = counter.every_prefix(parts)[2]
        assert counts.tolist() == [len(counter.model.encode(text[:i])) for i in range(len(text) + 1)]


def test_a_part_is_looked_up_once_a_group(monkeypatch):
    looked, places = [], tokencount.PrefixCounter.places
    monkeypatch.setattr(tokencount.PrefixCounter, "places", lambda self, parts: looked.append(parts) or places(self, parts))
    texts = [["one two two", None, ""], ["", "two one\ntwo one"], ["x"]]
    batches = [pa.RecordBatch.from_pydict({"doc_id": range(len(t)), "text": pa.array(t, pa.string())}) for t in texts]
    out = list(tokencount._stored(MODEL, 4)(iter(batches)))
    assert len(looked) == 1 and len(looked[0]) == len(set(looked[0]))
    model = tokencount.PrefixCounter(MODEL).model
    for batch, own in zip(out, texts, strict=True):
        assert batch["n_tokens"].to_pylist() == [len(model.encode(t or "")) for t in own]
        counts = [[len(model.encode((t or "")[:i])) for i in range(len(t or "") + 1)] for t in own]
        assert [np.cumsum([0, *steps]).tolist() for steps in batch["prefix_steps"].to_pylist()] == counts


def test_budgets_at_cuts_come_from_stored_counts(llm):
    rows = odd_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(odd_texts(random.Random(14), 60))]
    stored = tokencount.token_counts(documents(llm, rows), MODEL, stored=True)
    counter = tokencount.PrefixCounter(MODEL)
    cuts = {}
    for r in rows:
        _, ends, tokens = counter.at_cuts(r[1] or "")
        cuts.setdefault(repr(r[0]), []).append(list(zip(ends.tolist(), tokens.tolist())))
    for limit in (0, 1, 7, 30):
        for r in tokencount.fitting_cuts(stored, limit).collect():
            want = [max([c for c in mine if c[0] > 0 and c[1] <= limit], default=(0, 0)) for mine in cuts[repr(r.doc_id)]]
            assert (r.cut_chars, r.cut_tokens) in want
    assert tokencount.fitting_cuts(tokencount.token_counts(documents(llm, []), MODEL, stored=True), 5).count() == 0


def test_a_megabyte_without_blanks_in_seconds():
    rng = random.Random(15)
    counter = tokencount.PrefixCounter(MODEL)
    for text in (
        "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(340_000)),
        "".join(rng.choice("abcdeéfghiABC.,-日") for _ in range(400_000)),
        "a" * 400_000,
    ):
        begun = time.process_time()
        parts, ends, tokens = counter.at_cuts(text)
        fits = counter.fitting_chars(parts, ends, tokens, tokencount.LIMIT)
        table = counter.table(parts[0])
        assert time.process_time() - begun < 60 and len(parts) == 1
        assert fits == max(i for i in range(len(text) + 1) if table[i + 1] <= tokencount.LIMIT)
        for at in (1, 2, fits, fits + 1, *rng.sample(range(len(text)), 3), len(text)):
            assert counter.prefix_tokens(text, at) == len(counter.model.encode(text[:at]))


def test_recurrence_equals_encoded_prefixes():
    counter = tokencount.PrefixCounter(MODEL)
    rng = random.Random(16)
    for _ in range(300):
        part = "".join(rng.choice(["th", "e", "in", "g", "é", "日", "𝄞", "a", "aa", ".", "<s>", "Q"]) for _ in range(rng.randint(1, 14)))
        for given in (tokencount.BLANK * rng.randint(1, 3) + part, "\n" + part):
            found = counter._recurrence(given)
            assert found == [0] + counter._encoded([given[:i] for i in range(1, len(given) + 1)])


# -- URL filters ---------------------------------------------------------------------------------


def test_cascade_is_exact(llm):
    keys = [(f"host{i}.example.org", i % 7 == 0) for i in range(5000)]
    df = llm.createDataFrame(keys, "key string, listed boolean")
    levels = urlfilter.cascade(df, rate=0.25)
    assert len(levels) > 2
    found = dict(got(urlfilter.with_membership(df.select("key"), levels, "key"), "key", "listed"))
    assert found == dict(keys)


URLS = [
    None,
    "",
    "no scheme",
    "http://EXAMPLE.com/en/x?y#z",
    "http://www.example.com/en/",
    "http://www.example.com/EN/",
    "http://a.net/es/1",
    "http://net/fr/",
    "http://xnet/fr/",
    "http://x.com",
    "http://x.com?a=http://net/es/",
    "http://a.spam-farm.org/en/",
    "http://a.spam-farm.net/fr/\nx",
    "x://y://z/w",
]


def test_verdicts(llm):
    pages = llm.createDataFrame([(i, u, "") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string")
    for size in (1 << 20, 1):
        out = {r.page_id: r for r in urlfilter.judged(pages, segment_bytes=size).collect()}
        assert len(out) == 2 * len(URLS)
        told = [(out[i].host, out[i].path, out[i].rule, out[i].verdict) for i in range(len(URLS))]
        assert told[:3] == [("", "", None, "allow")] * 3
        assert told[3] == ("example.com", "/en/x", "example.com/en/", "block")
        assert told[4][2:] == ("www.example.com/en/", "allow") and told[5][2:] == ("com/", "allow")
        assert told[6][2:] == ("net/es/", "block") and told[7][2:] == ("net/fr/", "block") and told[8][2] is None
        assert told[9] == ("x.com", "", None, "allow") and told[10][:3] == ("x.com", "", None)
        assert told[11][2:] == (None, "block") and told[12][2:] == ("net/fr/", "block")
        assert told[13][:2] == ("y:", "//z/w")
    assert urlfilter.judged(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(llm, name):
    folder = "/root/testdata/sf0.001"
    sql = queries.oracle_sql()[name].replace("FROM pages", f"FROM '{folder}/pages.parquet'")
    assert difference(queries.queries()[name](llm, folder), folder, sql) == ""


def test_checksum_is_that_of_the_text(llm):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in llm.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op3_sharding(llm, folder).collect()
    assert len(rows) == len(texts)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r["size"] == len(texts[r.doc_id].encode()) + 8 for r in rows)

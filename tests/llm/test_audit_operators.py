"""Filter audit, personal data and conversation repair against plain Python."""

import hashlib
import random
import re
import zlib
from itertools import permutations, product

import pytest
from pyspark.sql import functions as F

from corpus import documents, got, odd_rows, prose
from storelake.llm import filteraudit, pii, repair

WORD = r"[^\x20\x09-\x0D]+"

# -- filter audit -------------------------------------------------------------------------

LABELS = "doc_id long, quality int, toxic int, source string"


def fails(rows):
    """The filters each row fails."""
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    found = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(WORD, text)
        mine = set()
        if len(words) < 50:
            mine.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            mine.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            mine.add("C")
        if re.search(r"[#$%&*|]", text):
            mine.add("D")
        if doc_id is not None and least[text] < doc_id:
            mine.add("E")
        found.append(mine)
    return found


def audited(rows, labels):
    """Every order applied document by document."""
    good = {i for i, quality, _, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, harm, _ in labels if harm == 1 and i is not None}
    failed = fails(rows)
    want = {}
    for part in {r[3] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failed) if (r[3] or "") == part]
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, letter in enumerate(order):
                out = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                want[part, "".join(order), step + 1] = [
                    len(left),
                    len(out),
                    sum(letter in f for _, f in mine) - len(out),
                    sum(f == {letter} for _, f in mine),
                    sum(i in good for i, _ in out),
                    sum(i in toxic for i, _ in out),
                ]
    shapley = {}
    for (part, order, step), row in want.items():
        key = part, order[step - 1]
        shapley[key] = shapley.get(key, 0) + row[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}


def audit_rows(rng):
    texts = [prose(rng, n) for n in (10, 49, 50, 90)]
    texts += [t.upper() for t in texts] + [t + " #1" for t in texts] + ["ba " * 60, "Ba ba ko " * 30, "É" * 40 + "A B C"]
    rows = [(i, rng.choice(texts), "en", rng.choice(["a", "b", "", None]), 0) for i in range(300)]
    return rows + [(i + 1000, "copied " * 3, "en", "hot", 0) for i in range(200)] + odd_rows()


def label_rows(rng):
    rows = [(rng.randrange(310), rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for _ in range(250)]
    return rows + [(None, 1, 1, "x"), (4, 1, 0, "x"), (4, 0, 1, "x"), (10**9, 1, 1, "x")]


def test_audit_equals_filtering_document_by_document(llm):
    rng = random.Random(5)
    rows, labels = audit_rows(rng), label_rows(rng)
    found = filteraudit.audit(documents(llm, rows), llm.createDataFrame(labels, LABELS)).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found} == audited(rows, labels)
    assert len(found) == 600 * len({r[3] or "" for r in rows})


def test_audit_of_an_empty_table(llm):
    assert filteraudit.audit(documents(llm, []), llm.createDataFrame([], LABELS)).collect() == []
    one = filteraudit.audit(documents(llm, [(1, "x", None, None, None)]), llm.createDataFrame([], LABELS)).collect()
    assert len(one) == 600 and {r.kept for r in one} == {0, 1}


def test_copies_are_counted_before_they_meet(llm):
    """A text that all rows share reaches the comparison of ids as one row per kind."""
    rows = [(i, "same", "en", "a", 0) for i in range(5000)]
    cells = filteraudit.cells(documents(llm, rows), llm.createDataFrame([], LABELS))
    assert sorted((r["mask"], r["n"]) for r in cells.collect()) == [(1, 1), (17, 4999)]


# -- personal data ------------------------------------------------------------------------


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base_spans(text):
    found = []
    for rank, (kind, (pattern, valid)) in enumerate(PLAIN.items()):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if valid(m.group())]
    return sorted(found)


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def personal(rng):
    card = "".join(rng.choice("0123456789") for _ in range(rng.randint(13, 18)))
    card += next(d for d in "0123456789" if luhn(card + d))
    return rng.choice([
        f"{prose(rng, 1)}.{rng.randrange(99)}@mail.example.com",
        ".".join(str(rng.randrange(300)) for _ in range(rng.randint(3, 6))),
        rng.choice(["", "-", " "]).join(re.findall("..?.?.?", card)),
        f"+{rng.randrange(99)} ({rng.randrange(999)}) {rng.randrange(9999)}-{rng.randrange(10**rng.randint(2, 6))}",
    ])


def test_base_spans_equal_plain_patterns(llm):
    rng = random.Random(3)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for alphabet in ("a1@.-_", "0123 -.", "+1(). -9", "é1.2@a") for _ in range(300)]
    texts += [" ".join(rng.choice([personal(rng), prose(rng, 3), "𝄞é"]) for _ in range(rng.randint(1, 12))) for _ in range(200)]
    texts += ["a@b.c_d@e.f+1@g.h", "0001.00255.0.256", "1.2.3.4.5.6.7.8", "a@b.c.@d.e"]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts, 100)] + odd_rows()
    found = pii.digests(pii.found_spans(documents(llm, rows))).collect()
    want = {r[0]: base_spans(r[1]) for r in rows if r[0] is not None}
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            continue
        spans = want[r.doc_id]
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in PLAIN] == [s for s in listed(spans).split(",") if s]
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[3] == k for s in spans) for k in PLAIN)


IBAN = "DE89 3704 0044 0532 0130 00"


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        (f"pay to {IBAN} today", ["iban"]),
        (f"pay to {IBAN.replace(' ', '')}.", ["iban"]),
        (f"É𝄞 GB82 WEST 1234 5698 7654 32 and {IBAN}", ["iban", "iban"]),
        ("pay to DE88 3704 0044 0532 0130 00 today", []),  # wrong check digits
        ("pay to DE89 3704 0044 0532 0130 today", []),  # too short
        (f"X{IBAN}", []),
        ("her social security number is 536-90-4399", ["ssn"]),
        ("order 536-90-4399 was sent", []),
        ("social security 666-90-4399", []),
        ("my card 4222222222222 expires", ["short_card"]),
        ("item 4222222222222 is sold out", []),
        ("my card 4222222222223 expires", []),
    ],
)
def test_added_spans_need_a_checksum_or_a_word_nearby(llm, text, kinds):
    found = pii.found_spans(documents(llm, [(1, text, "en", "a", 0)])).first().spans
    assert [s.kind for s in found] == kinds
    assert all(s.score >= pii.THRESHOLD for s in found)
    assert all(not text[s.start : s.end].startswith(" ") and text[s.start].isalnum() for s in found)


def test_words_nearby_raise_the_score(llm):
    texts = ["call +1 (337) 555-7349 now", "size +1 (337) 555-7349 now", "call " + "x" * 60 + " +1 (337) 555-7349"]
    found = pii.found_spans(documents(llm, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: r.spans[0].score for r in found} == {0: 0.8, 1: 0.6, 2: 0.6}


def test_long_texts_take_linear_time(llm):
    rng = random.Random(4)
    texts = ["a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "a@" * 500_000, "a@a." * 200_000, "+1 (" * 200_000, "A1" * 500_000]
    texts.append(" ".join(personal(rng) for _ in range(20_000)))
    found = pii.digests(pii.found_spans(documents(llm, [(i, t, "en", "a", 0) for i, t in enumerate(texts)]))).collect()
    last = max(found, key=lambda r: r.doc_id)
    assert last.base_sha256 == hashlib.sha256(listed(base_spans(texts[-1])).encode()).hexdigest()


def test_personal_data_query_stays_on_the_jvm_and_in_place(llm):
    found = pii.digests(pii.found_spans(documents(llm, odd_rows())))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert pii.digests(pii.found_spans(documents(llm, []))).collect() == []


# -- conversation repair ------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, copy string"


def damaged(rows):
    """(turn, role, text) of one conversation, damaged and in order."""
    found = []
    for conv_id, turn, role, text, *_ in rows:
        spaced = [" " if x is None else x for x in (conv_id, turn, role, text)]
        harm = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        role, text = spaced[2:]
        if harm == 0:
            continue
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub("[.!?]", "", text)
        if harm == 4:
            role = "user"
        found += [(turn, role, text)] * (2 if harm == 3 else 1)
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append(0 if not words else 1 if (role, text) in seen else 2 if words[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def edits(row, fault):
    """(letter, cost, repaired turn or None) of one row."""
    _, role, text = row
    extra = 1 if fault == 2 else 0
    if fault not in (0, 1):
        yield "K", extra, (role, text)
        yield from (("R", 2 + extra, (new, text)) for new in ("user", "assistant"))
    yield "D", 3, None


INSERTS = [p for n in range(3) for p in product(("user", "assistant"), repeat=n)]


def cheapest(rows):
    """All edit sequences of a short conversation: (cost, audit, repaired turns)."""
    ways = [(0, "", ())]
    for row, fault in zip(rows, faults(rows)):
        ways = [
            (cost + 2 * len(new) + price, audit + "I" * len(new) + letter, turns + tuple((r, "") for r in new) + ((turn,) if turn else ()))
            for cost, audit, turns in ways
            for new in INSERTS
            for letter, price, turn in edits(row, fault)
        ]
    ends = [(cost + 2 * len(new), audit + "I" * len(new), turns + tuple((r, "") for r in new)) for cost, audit, turns in ways for new in INSERTS]
    return min(w for w in ends if re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in w[2])))


def least_by_steps(rows):
    """The same for long conversations: best (cost, audit) per state after each row, audits as texts."""
    grow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}
    for row, fault in zip(rows, faults(rows)):
        after = {}
        for state, (cost, audit, turns) in best.items():
            for new in INSERTS:
                for letter, price, turn in edits(row, fault):
                    at, fits = state, True
                    for role in [*new, *([turn[0]] if turn else [])]:
                        fits = fits and role[:1] != "" and role[:1] in grow[at]
                        at = role[:1] if fits else at
                    if fits:
                        way = (cost + 2 * len(new) + price, audit + "I" * len(new) + letter, turns + tuple((r, "") for r in new) + ((turn,) if turn else ()))
                        after[at] = min(after.get(at, way), way, key=lambda w: w[:2])
        best = after
    ends = [best[s] for s in ("", "a") if s in best]
    for state, missing in (("u", ("assistant",)), ("s", ("user", "assistant"))):
        if state in best:
            cost, audit, turns = best[state]
            ends.append((cost + 2 * len(missing), audit + "I" * len(missing), turns + tuple((r, "") for r in missing)))
    return min(ends, key=lambda w: w[:2])


def expected(rows, solve):
    rows = damaged(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    found = faults(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, repaired = solve(rows)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
    return (gaps, found.count(0), found.count(1), found.count(2), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


def conversation(rng, conv_id, n, strict=False):
    rows = []
    for turn in range(n):
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "USER", "us"]) if not strict else "user"
        text = rng.choice(["hi.", "yes!", "who?", "cut off", " \t", "", None, "é.  ", "x.\n", "so. be it"])
        rows.append((conv_id, rng.choice([turn, turn, turn, turn // 2, None]), role, text, "extra"))
    return rows


def repairs(llm, rows):
    found = repair.repaired(repair.damaged(llm.createDataFrame(rows, TURNS))).collect()
    return {r.conv_id: tuple(r)[1:] for r in found}, len(found)


def test_repair_is_the_least_of_all_edit_sequences(llm):
    rng = random.Random(9)
    rows = {i: conversation(rng, i, 3 if i < 12 else rng.randint(1, 2)) for i in range(150)}
    rows |= {1000 + i: [(1000 + i, t, r, f"text {t}.", "") for t, r in enumerate(roles)] for i, roles in enumerate(product(("system", "user", "assistant", "tool"), repeat=2))}
    rows[None] = conversation(rng, None, 2)
    found, n = repairs(llm, [r for conv in rows.values() for r in conv])
    assert n == len(rows) == len(found)
    for conv_id, conv in rows.items():
        assert found[conv_id] == expected(conv, cheapest), conv


def test_long_conversations(llm):
    rng = random.Random(10)
    rows = {i: conversation(rng, i, n) for i, n in enumerate((60, 64, 65, 129, 700, 1500))}
    rows[90] = [(90, t, "user", f"same role {t}.", "") for t in range(400)]
    rows[91] = [(91, t, "assistant", "the same answer.", "") for t in range(300)]
    rows[92] = [(92, None, None, None, None)] * 5
    found, _ = repairs(llm, [r for conv in rows.values() for r in conv])
    for conv_id, conv in rows.items():
        assert found[conv_id] == expected(conv, least_by_steps), conv_id


def test_a_conversation_without_rows_after_the_damage(llm):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found, _ = repairs(llm, [(gone, 0, "user", "hi.", "")])
    assert found == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repairs(llm, []) == ({}, 0)


def test_integers_stay_short_in_long_conversations():
    work = repair.Repair()
    widest = 0
    for i in range(20_000):
        work.read("user" if i % 2 == 0 else "assistant", f"turn {i}.", None)
        widest = max(widest, max(p.weight.bit_length() for p in work.paths.values()))
    assert widest < 2_000
    cost, audit, _ = work.end()
    assert (cost, audit) == (0, "K" * 20_000)


def test_conversations_go_on_across_batches(llm):
    rows = [(i // 900, i % 900, ("user", "assistant")[i % 2], f"turn {i}.", "") for i in range(3600)]
    found, n = repairs(llm, rows)
    assert n == 4 and got(llm.createDataFrame(rows, TURNS).groupBy("conv_id").agg(F.count("*").alias("n")), "n") == [(900,)] * 4
    for i in range(4):
        assert found[i] == expected(rows[900 * i : 900 * i + 900], least_by_steps)

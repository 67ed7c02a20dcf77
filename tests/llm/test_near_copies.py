"""Near copies in crowds of texts that are alike but not near."""

import random

import pytest

from corpus import documents, prose
from storelake.llm import nearcopies

WORDS = 200


def variants(rng, k, share=0.1):
    """Texts with a part of one text replaced, each elsewhere: alike at about 0.63, hardly any pair at 0.8."""
    base, n = prose(rng, WORDS).split(), int(WORDS * share)
    texts = []
    for _ in range(k):
        words, at = list(base), rng.randrange(WORDS - n)
        words[at : at + n] = prose(rng, n).split()
        texts.append(" ".join(words))
    return texts


def smaller_near_copy(texts):
    """Indexes of texts with a near copy before them."""
    sets = [set(nearcopies.shingles(t.encode()).tolist()) for t in texts]
    near = lambda a, b: 5 * len(a & b) >= 4 * (len(a) + len(b) - len(a & b))
    return [i for i, s in enumerate(sets) if any(near(s, other) for other in sets[:i])]


@pytest.fixture
def compared(monkeypatch):
    """How many pairs each level compared."""
    made, plain = [], nearcopies.written

    def counted(df, purpose):
        out = plain(df, purpose)
        if purpose == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(nearcopies, "written", counted)
    return made


def staying(llm, texts):
    return {r.doc_id for r in nearcopies.deduplicated(documents(llm, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])).collect()}


def test_pairs_of_a_crowd_do_not_grow_with_its_square(llm, compared):
    made = []
    for k in (100, 400):
        texts = variants(random.Random(k), k)
        compared.clear()
        assert staying(llm, texts) == set(range(k)) - set(smaller_near_copy(texts))
        made.append(sum(compared))
    # All pairs would be 16 times as many; 4 times is in proportion.
    assert made[1] < 8 * made[0] and made[1] < 400 * 399 / 2 / 4


def test_near_copies_within_a_crowd_are_found(llm):
    rng, texts = random.Random(5), []
    for text in variants(random.Random(6), 200):
        words, n, at = text.split(), rng.choice([3, 5, 7, 8]), rng.randrange(WORDS - 10)
        words[at : at + n] = prose(rng, n).split()
        texts += [text, " ".join(words)]
    have = set(smaller_near_copy(texts))
    gone = set(range(len(texts))) - staying(llm, texts)
    assert len(have) >= 200 and gone <= have
    assert len(gone) >= 0.95 * len(have)


def test_a_group_of_near_copies_costs_a_few_pairs_each(llm, compared):
    texts = variants(random.Random(7), 300, share=0.015)
    assert staying(llm, texts) == {0}
    assert sum(compared) <= 10 * len(texts)

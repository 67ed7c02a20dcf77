"""Small document tables for the operator tests."""

import random

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["ba", "ko", "ti", "re", "mu", "sa", "lo", "ne", "fi", "du"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, odd characters, one long text."""
    rng = random.Random(11)
    same = prose(rng, 80)
    return [
        (None, same, "en", "a", 1),
        (1, None, "en", "a", None),
        (2, "", None, "a", 0),
        (3, " \t\n\x0b\x0c\r ", "en", None, 7),
        (4, same, None, None, None),
        (4, same, None, None, None),
        (5, same, "en", "b", 3),
        (6, "x", "en", "", 1),
        (7, "É\u00a0é <s> </s> \\ [INST] ▁ \u2028 𝄞 " + prose(rng, 30), "fr", "b", 5),
        (8, prose(rng, 30_000), "en", "a", 9),
        (None, None, None, None, None),
    ]


def documents(spark, rows):
    return spark.createDataFrame(rows, LAYOUT)


def many(rng, n, sources=("a", "b", "c"), words=(5, 60)):
    return [(100 + i, prose(rng, rng.randint(*words)), "en", rng.choice(sources), 0) for i in range(n)]


def got(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]

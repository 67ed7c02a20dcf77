"""Personal data in texts (DataFrame functions only).

Regular expressions propose spans, checksum validators confirm them, and words nearby adjust
their score.  E-mail addresses, IP addresses, cards (Luhn) and international phone numbers follow
fixed base rules and always stay.  Bank accounts (IBAN lengths, mod-97), shorter card numbers (Luhn)
and social security numbers are added where their score reaches ``THRESHOLD``: an IBAN's
checksum is enough for that, the others need a word nearby that says what they are.

Positions come from ``split`` and ``regexp_extract_all`` by one pattern: the pieces between matches
and the matches, whose lengths are summed up in blocks, so a text with very many matches costs
n * sqrt(n) at most.  The patterns start only where a run of their characters starts and never give
back what they took, so their time is linear in the text; they propose the same matches as the plain
forms beside them.  Texts stay where they are: nothing is shuffled.

Defined results
    null or empty text   no spans
    null id              kept as it is
    repeated rows        a row each
    ties                 spans of one start are ordered by kind
    very long text       all of it is searched; a row is as large as its text
    empty table          no rows
    clashing columns     only doc_id and text are read
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import text_or_empty

# Kinds in the order of equal starts; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban", "short_card", "ssn")
BASE = 4

# The plain forms are fixed values:
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+
#   phone  \+[0-9][\x20().0-9-]+[0-9]
# ``\G``: right after the last match a run may start in the middle.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
NUMBER = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$"

# Total length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU", 31: "MT SC", 32: "LC",
}
IBAN = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:"
    + "|".join(rf"(?:{'|'.join(names.split())})[0-9]{{2}}(?:[\x20-]?+[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items())
    + r")(?![A-Za-z0-9])"
)

# Words that say what a number is, in any case.
NEARBY = {
    "email": "contact e-mail email mail reach write",
    "ip": "address client host ip server",
    "card": "amex card credit debit mastercard payment visa",
    "phone": "call cell contact dial fax mobile phone tel telephone",
    "iban": "account bank bic iban payment swift transfer",
    "short_card": "amex card credit debit mastercard payment visa",
    "ssn": "security social ssn",
}
NEAR_CHARS = 40

# Scores: what a match of the pattern is worth, what its validator adds, what a word nearby adds.
PATTERN_SCORE = {"email": 0.7, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.3, "short_card": 0.2, "ssn": 0.3}
VALID_SCORE = {"email": 0.0, "ip": 0.2, "card": 0.3, "phone": 0.1, "iban": 0.5, "short_card": 0.3, "ssn": 0.2}
NEAR_SCORE = 0.2
THRESHOLD = 0.7

SUM_BLOCK = 512
PROPOSED = "array<struct<start:int,end:int,hit:string,near:string>>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def running_sums(steps: Column) -> Column:
    """Inclusive prefix sums of an array of ints, in two levels; the array is not empty."""

    def plain(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("sums"))
        add = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["sums"], F.array(a["at"] + x)).alias("sums"))
        return F.aggregate(values, start, add, lambda a: a["sums"])

    def blocks(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / SUM_BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: plain(F.slice(values, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))))

    def joined(inner: Column) -> Column:
        ahead = F.concat(F.array(F.lit(0)), plain(F.transform(inner, lambda sums: F.element_at(sums, -1))))
        return bound(ahead, lambda h: F.flatten(F.transform(inner, lambda sums, b: F.transform(sums, lambda x: x + h[b]))))

    return bound(bound(steps, blocks), joined)


def proposed(text: Column, pattern: str, worth: Column) -> Column:
    """All matches of ``pattern`` with their code point positions and the text around them.

    ``worth``: a cheaper test that all texts with a match pass."""

    def placed(cut: Column) -> Column:
        pieces = F.transform(
            cut["hits"],
            lambda hit, i: F.struct(
                hit.alias("hit"),
                F.length(hit).alias("len"),
                F.length(cut["gaps"][i]).alias("gap"),
                F.concat_ws(" ", F.right(cut["gaps"][i], F.lit(NEAR_CHARS)), F.left(cut["gaps"][i + 1], F.lit(NEAR_CHARS))).alias("near"),
            ),
        )
        return bound(pieces, ended)

    def ended(pieces: Column) -> Column:
        sums = running_sums(F.transform(pieces, lambda p: p["gap"] + p["len"]))
        return F.transform(
            F.arrays_zip(pieces.alias("p"), sums.alias("end")),
            lambda z: F.struct((z["end"] - z["p"]["len"]).alias("start"), z["end"].alias("end"), z["p"]["hit"].alias("hit"), z["p"]["near"].alias("near")),
        )

    cut = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    found = bound(cut, lambda c: F.when(F.size(c["hits"]) > 0, placed(c)))
    return F.coalesce(F.when(worth, found), F.array()).cast(PROPOSED)


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def passes_luhn(hit: Column, least: int, most: int) -> Column:
    """Whether a number has this many digits and their Luhn sum ends in zero."""
    return F.length(digits(hit)).between(least, most) & F.call_function("luhn_check", digits(hit))


def passes_mod97(hit: Column) -> Column:
    """Whether an IBAN's check digits are right: letters count from 10, the first four go last."""
    compact = F.regexp_replace(hit, r"[\x20-]", "")
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))

    def rest_of(value: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(value))
        number = lambda i: F.ascii(F.substr(value, i, F.lit(1)))
        return F.aggregate(
            places,
            F.lit(0),
            lambda a, i: F.when(number(i) < 58, a * 10 + number(i) - 48).otherwise(a * 100 + number(i) - 55) % 97,
        )

    return bound(turned, rest_of) == 1


def confirmed(proposals: Column, kind: str, valid: Callable[[Column], Column] | None = None) -> Column:
    """Proposals of a kind that its validator accepts, with their score."""
    kept = proposals if valid is None else F.filter(proposals, lambda p: valid(p["hit"]))
    words = rf"(?i)(?<![A-Za-z0-9])(?:{'|'.join(NEARBY[kind].split())})(?![A-Za-z0-9])"
    least = F.lit(PATTERN_SCORE[kind] + VALID_SCORE[kind])
    return F.transform(
        kept,
        lambda p: F.struct(
            p["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            p["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.round(F.when(p["near"].rlike(words), least + NEAR_SCORE).otherwise(least), 2).alias("score"),
        ),
    )


def found_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): every text's spans by start, then kind; a span has start, rank, end, kind and score.

    0-based code points, end exclusive."""
    text = F.col("text")
    read = docs.select("doc_id", text_or_empty().alias("text"))
    proposals = read.select(
        "doc_id",
        proposed(text, EMAIL, F.contains(text, F.lit("@"))).alias("email"),
        proposed(text, IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]")).alias("ip"),
        proposed(text, NUMBER, text.rlike(r"(?:[0-9][\x20-]?+){12}")).alias("number"),
        proposed(text, PHONE, F.contains(text, F.lit("+"))).alias("phone"),
        proposed(text, IBAN, text.rlike(r"[A-Z]{2}[0-9]{2}")).alias("iban"),
        proposed(text, SSN, text.rlike(r"[0-9]-[0-9]{2}-[0-9]")).alias("ssn"),
    )
    phone_digits = lambda hit: F.length(digits(hit)).between(10, 15)
    added = [
        confirmed(F.col("iban"), "iban", passes_mod97),
        confirmed(F.col("number"), "short_card", lambda hit: passes_luhn(hit, 12, 13)),
        confirmed(F.col("ssn"), "ssn"),
    ]
    every = F.concat(
        confirmed(F.col("email"), "email"),
        confirmed(F.col("ip"), "ip", lambda hit: hit.rlike(IP_PARTS)),
        confirmed(F.col("number"), "card", lambda hit: passes_luhn(hit, 14, 19)),
        confirmed(F.col("phone"), "phone", phone_digits),
        *[F.filter(spans, lambda s: s["score"] >= THRESHOLD) for spans in added],
    )
    return proposals.select("doc_id", F.sort_array(every).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, and all spans."""
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = listed(F.filter(spans, lambda s: s["rank"] < BASE))
    return found.select(
        "doc_id", *[count(kind) for kind in KINDS[:BASE]], F.sha2(base.cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans")
    )

"""Personal data: regular expressions propose spans, validators confirm them, words nearby adjust the score.

Kinds with a fixed definition, always reported when they meet it: email, ip (four numbers of at most 255), card (14 to
19 digits that pass the Luhn check), phone (10 to 15 digits after a plus). Kinds with a score: iban (mod-97 check),
ssn (groups of three, two and four digits in valid ranges), secret (a long token of letters and digits that follows a
word such as token or key). Their score starts from how much the form alone says and rises by each context word in the ``NEAR``
characters before the span; spans below ``THRESHOLD`` are dropped.

Matches are leftmost and do not overlap within a kind; one that fails its check is dropped and not tried again inside. Positions
are code points, the end exclusive. The expressions give the same matches as the plain ones in the comments but never try
a run of characters twice, and places and contexts are summed up along the text, so time is linear in texts of either kind.

DataFrame functions only. NULL texts are empty. Repeated rows are reported each. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineside.llm.common import let

# Kinds in the order that settles ties, and their patterns.
BASE_KINDS = ["email", "ip", "card", "phone"]
SCORED_KINDS = ["iban", "ssn", "secret"]
KINDS = BASE_KINDS + SCORED_KINDS
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{20,}+",
}
CONTEXT = {
    "iban": ["iban", "account", "bank", "konto", "compte", "cuenta"],
    "ssn": ["ssn", "social", "security"],
    "secret": ["token", "key", "secret", "password", "passwd", "api"],
}
PRIOR = {"iban": 0.6, "ssn": 0.4, "secret": 0.3}
BOOST = 0.3
THRESHOLD = 0.5
NEAR = 40
#: Matches whose places are summed up together.
BLOCK = 256
SPANS = "array<struct<start:int,end:int,match:string,before:string>>"


def proposals(text: Column, kind: str) -> Column:
    """Array of (start, end, match, before): what lies between matches gives their places, ``before`` is the ``NEAR`` characters.

    Lengths are summed up by blocks of matches first and within them then, so that no array grows over all matches of a text.
    """
    pattern = PATTERNS[kind]
    scored = kind in SCORED_KINDS

    def places(both: Column) -> Column:
        gaps, found = both["gaps"], both["found"]
        none = F.array().cast(SPANS)

        def inside(i: Column) -> Column:
            return F.sequence(i, F.least(i + BLOCK, F.size(found)) - 1)

        def length(acc: Column, i: Column) -> Column:
            return acc + F.length(F.get(gaps, i)) + F.length(F.get(found, i))

        def tail(acc: Column, i: Column) -> Column:
            return F.right(F.concat(acc, F.get(gaps, i), F.get(found, i)), F.lit(NEAR))

        def total(acc: Column, n: Column) -> Column:
            return F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

        def step(acc: Column, i: Column) -> Column:
            gap, m = F.get(gaps, i), F.get(found, i)
            start = acc["at"] + F.length(gap)
            end = start + F.length(m)
            before = F.right(F.concat(acc["last"], gap), F.lit(NEAR)) if scored else F.lit("")
            span = F.struct(start.alias("start"), end.alias("end"), m.alias("match"), before.alias("before"))
            return F.struct(
                end.alias("at"), (tail(acc["last"], i) if scored else F.lit("")).alias("last"),
                F.concat(acc["out"], F.array(span)).alias("out"))

        def block(i: Column, at: Column) -> Column:
            # A match has a character at least, so the NEAR matches before a block hold the characters before it.
            last = F.when(i > 0, F.aggregate(F.sequence(F.greatest(i - NEAR, F.lit(0)), i - 1), F.lit(""), tail)).otherwise("")
            begin = F.struct(at.alias("at"), (last if scored else F.lit("")).alias("last"), none.alias("out"))
            return F.aggregate(inside(i), begin, step, lambda acc: acc["out"])

        blocks = F.sequence(F.lit(0), F.size(found) - 1, F.lit(BLOCK))
        lengths = F.transform(blocks, lambda i: F.aggregate(inside(i), F.lit(0), length))
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        placed = let(F.aggregate(lengths, begin, total, lambda acc: acc["out"]), lambda starts: F.flatten(
            F.transform(blocks, lambda i, k: block(i, F.get(starts, k)))))
        return F.when(F.size(found) > 0, placed).otherwise(none)

    both = F.struct(F.split(text, pattern).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return let(both, places)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn's check on a string of digits."""
    def term(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    each = F.transform(F.split(F.reverse(number), ""), lambda c: F.try_to_number(c, F.lit("9")).cast("int"))
    return F.aggregate(F.transform(each, term), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(number: Column) -> Column:
    """The check of an account number: first four characters last, letters as 10 to 35, remainder 1."""
    turned = F.concat(F.substr(number, F.lit(5)), F.substr(number, F.lit(1), F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97).cast("int")

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    """What the kind's validator says of a match."""
    if kind == "ip":
        part = F.split(match, r"\.")
        return F.forall(part, lambda p: F.ltrim(p, F.lit("0")).rlike(r"^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return let(digits(match), lambda d: F.length(d).between(14, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    if kind == "iban":
        return mod97(F.replace(match, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)") & ~match.rlike("-00-|-0000$")
    return F.lit(True)


def spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans: array of (kind, start, end, score) by start, then kind as listed."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def scored(kind: str) -> Column:
        order = KINDS.index(kind)
        base = kind in BASE_KINDS

        def row(s: Column) -> Column:
            if base:
                score = F.lit(1.0)
            else:
                hits = sum((F.contains(F.lower(s["before"]), F.lit(w)).cast("int") for w in CONTEXT[kind]), F.lit(0))
                score = F.least(F.lit(1.0), F.lit(PRIOR[kind]) + BOOST * hits)
            return F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), score.alias("score"))

        good = F.filter(F.col(f"_{kind}"), lambda s: confirmed(kind, s["match"]))
        return F.filter(F.transform(good, row), lambda s: s["score"] >= THRESHOLD)

    names = F.array(*[F.lit(k) for k in KINDS])
    # A kind's first look is a cheap test of the whole text.
    first = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike("[0-9]"), "card": text.rlike("[0-9]"),
             "iban": text.rlike("[0-9]"), "ssn": text.rlike("[0-9]"), "secret": text.rlike("[0-9]")}
    none = F.array().cast(SPANS)
    found = docs.select("doc_id", "text", *[
        F.when(first[k], proposals(text, k)).otherwise(none).alias(f"_{k}") for k in KINDS])
    return found.select("doc_id", F.transform(
        F.sort_array(F.concat(*[scored(k) for k in KINDS])),
        lambda s: F.struct(F.get(names, s["order"]).alias("kind"), s["start"], s["end"], s["score"])).alias("spans"))


def joined(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of ``docs``."""
    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans(docs).select(
        "doc_id", *[number(k) for k in BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))

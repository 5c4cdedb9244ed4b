"""Secrets: patterns propose values, and how many owners and repositories hold a value tells examples from live ones.

Three kinds have a fixed definition and are always reported: assign (a name such as token, a sign and a value), access (a key
id with its prefix), hex (a long run of hexadecimal digits). Three more are only candidates: login (a password inside an
address), vendor (a value with an issuer's prefix), blob (a long run of letters in both cases and digits). A candidate that
overlaps a span of a kind listed before it is not one.

The value of each span, not its place, is hashed, and hashes are counted over the whole table: in how many distinct repositories,
and by how many distinct owners. A value of ``COPIED_OWNERS`` owners or more is ``copied``: documentation, fixtures,
mirrored code. One that a single owner holds and that looks random is ``live``. Everything else is ``unclear``. Candidates are
reported if they are live.

Matches are leftmost and do not overlap within a kind; one that fails its check is dropped and not tried again inside. Positions
are code points, the end exclusive. NULL texts are empty. A NULL owner or repository is one of its own. Repeated rows are
reported each, and count as one repository. An empty table gives an empty result. Other columns, whatever their names, are
not read. No pattern tries a run of characters again from each of its places, so very long texts take linear time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineside.llm.common import settle, slices

# Kinds in the order that settles ties, patterns, prefixes of issuers, words of made-up values.
BASE_KINDS = ["assign", "access", "hex"]
CANDIDATES = ["login", "vendor", "blob"]
KINDS = BASE_KINDS + CANDIDATES
NAMES = ["password", "passwd", "secret", "token", "api_?key"]
PREFIXES = ["ghp_", "gho_", "ghs_", "glpat-", "npm_", "xoxb-", "xoxp-", "sk_live_", "rk_live_", "AIza"]
MADE_UP = ["example", "sample", "dummy", "placeholder", "changeme", "your", "xxxx"]


def either_case(pattern: str) -> str:
    """ASCII letters of a pattern in both cases, and no other letters that fold to them."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


PATTERNS = {
    "assign": f"({either_case('|'.join(NAMES))})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{24,}",  # the runs [0-9a-f]+ of 24 characters and more
    "login": r"""://[^\x00-\x20/:@"'<>]+:([^\x00-\x20/:@"'<>]+)@""",
    "vendor": f"(?:{'|'.join(PREFIXES)})[A-Za-z0-9_-]{{16,}}",
    "blob": "[A-Za-z0-9_-]{24,}",
}
#: The group that holds the value.
VALUE = {"assign": 2, "login": 1}
COPIED_OWNERS = 3
#: A random-looking value has a digit, a letter, so many characters and so many different ones.
LEAST, DIFFERENT = 12, 8
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20

_search = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
_made_up = re.compile("|".join(MADE_UP))
_spans = pa.list_(pa.struct([("start", pa.int32()), ("order", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("random", pa.bool_())]))
FOUND = (
    "row long, doc_id long, owner string, repository string, "
    "found array<struct<start:int,order:int,end:int,value:string,random:boolean>>")


def looks_random(value: str) -> bool:
    return (
        len(value) >= LEAST and len(set(value)) >= DIFFERENT and re.search("[0-9]", value) is not None
        and re.search("[A-Za-z]", value) is not None and _made_up.search(value.lower()) is None)


def holds(kind: str, match: str, value: str) -> bool:
    """The check of a match after it was found."""
    if kind == "assign":
        return len(value) >= LEAST_ASSIGNED
    if kind == "access":
        return len(match) >= LEAST_ACCESS
    if kind == "blob":
        return all(re.search(c, value) for c in ("[0-9]", "[a-z]", "[A-Z]"))
    return True


def matches(text: str) -> list[tuple[int, int, int, str, bool]]:
    """(start, order of the kind, end, hash of the value, looks random) of every base span and candidate, by start."""
    kept: list[tuple[int, int, int, str, bool]] = []
    for order, kind in enumerate(KINDS):
        own = []
        for m in _search[kind].finditer(text):
            value = m[VALUE.get(kind, 0)]
            if holds(kind, m[0], value):
                own.append((m.start(), order, m.end(), value))
        if kind in CANDIDATES and kept:
            kept.sort()
            own = _apart(own, kept)
        kept += [(a, o, b, hashlib.sha256(v.encode()).hexdigest(), looks_random(v)) for a, o, b, v in own]
    return sorted(kept)


def _apart(own: list[tuple], others: list[tuple]) -> list[tuple]:
    """The spans of ``own`` that overlap none of ``others``; both by start, those of ``own`` disjoint."""
    out, i, reach = [], 0, -1
    for span in own:
        while i < len(others) and others[i][0] < span[2]:
            reach = max(reach, others[i][2])
            i += 1
        if reach <= span[0]:
            out.append(span)
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["start", "order", "end", "value", "random"]
    for part in slices(batches, "text"):
        each = [[dict(zip(names, m)) for m in matches(t)] if t else [] for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column(c) for c in ("row", "doc_id", "owner", "repository")] + [pa.array(each, _spans)],
            names=["row", "doc_id", "owner", "repository", "found"])


def found(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """Base spans and candidates of each row of ``docs``, settled; ``row`` tells repeated rows apart."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text",
        owner.cast("string").alias("owner"), repository.cast("string").alias("repository"))
    return settle(rows.mapInArrow(_scan, FOUND), "secrets")


def ownership(spans: DataFrame) -> DataFrame:
    """For each hashed value its distinct repositories and owners, and what they make of it.

    A repository belongs to one owner, so counts of the pairs add up; every step hands on partial counts, and a value that stands
    everywhere costs a task one row for each owner.
    """
    each = spans.select("owner", "repository", F.explode("found").alias("s")).select("owner", "repository", "s.value", "s.random")
    held = each.groupBy("value", "owner", "repository").agg(F.first("random").alias("random"))
    of = held.groupBy("value", "owner").agg(F.count("*").alias("n"), F.first("random").alias("random"))
    total = of.groupBy("value").agg(
        F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"), F.first("random").alias("random"))
    verdict = (
        F.when(F.col("n_owners") >= COPIED_OWNERS, "copied").when((F.col("n_owners") == 1) & F.col("random"), "live")
        .otherwise("unclear"))
    return total.select("value", "n_repositories", "n_owners", verdict.alias("verdict"))


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """doc_id and spans: array of (start, order, end, verdict, n_owners, n_repositories) of every row of ``docs``."""
    rows = found(docs, owner, repository)
    # Written, so that both sides of the join are shuffled and Spark can split a value that stands everywhere.
    known = settle(ownership(rows), "ownership")
    each = rows.select("row", "doc_id", F.explode("found").alias("s")).select("row", "doc_id", "s.*")
    judged = each.join(known, "value").where(F.col("order").isin(list(range(len(BASE_KINDS)))) | (F.col("verdict") == "live"))
    span = F.struct("start", "order", "end", "verdict", "n_owners", "n_repositories")
    with_spans = judged.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    # A row whose candidates all fell away has no span left: it comes from the other side.
    silent = rows.join(with_spans.select("row"), "row", "left_anti").select(
        "doc_id", F.array().cast(with_spans.schema["spans"].dataType).alias("spans"))
    return with_spans.select("doc_id", "spans").unionByName(silent)


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, live of every row of ``docs``."""
    def number(keep) -> Column:
        return F.size(F.filter("spans", keep)).cast("long")

    def of(verdict: str):
        return lambda s: s["verdict"] == verdict

    def kind_is(kind: str):
        return lambda s: s["order"] == KINDS.index(kind)

    counts = [number(kind_is(kind)).alias(f"n_{kind}") for kind in BASE_KINDS]
    base = F.filter("spans", lambda s: s["order"] < len(BASE_KINDS))
    return scan(docs, owner, repository).select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        number(of("live")).alias("n_live"), number(of("copied")).alias("n_copied"), joined(F.filter("spans", of("live"))).alias("live"))

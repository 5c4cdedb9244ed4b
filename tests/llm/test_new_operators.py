"""Secret scan, spelling variants and ranked search against plain Python on whole small tables, and at their edges."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from lineside.llm import catalog, ranked_search, secret_scan, spelling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
CLASHES = ["1 AS row", "2 AS owner", "3 AS repository", "4 AS found", "5 AS n", "6 AS word", "7 AS term", "8 AS item", "9 AS score",
           "10 AS value", "11 AS id", "'x' AS `a.b`"]


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def edges(spark):
    """NULL, empty, blank, repeated rows, a long text without blanks, no doc_id, and columns with clashing names."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "token: abcdef12 alpha"), (5, "token: abcdef12 alpha"),
            (6, "x" * 200_000), (None, "token: abcdef12 alpha")]
    catalog.ship(spark)
    return spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "'s' AS source", *CLASHES)


@pytest.fixture(scope="module")
def empty(spark):
    catalog.ship(spark)
    return spark.createDataFrame([], SCHEMA + ", source string")


def rows(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.mark.parametrize("name", ["op11_secret_scan", "op12_spelling_variants", "op13_ranked_search"])
def test_matches_sql(spark, name):
    assert differences(catalog.QUERIES[name](spark, SF), connect(SF), catalog.ORACLES[name]) is None


# ---- secrets ----

def brute_base(text):
    """The three fixed kinds as they are defined."""
    found = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    for k, pattern, least in ((1, r"AKIA[A-Z0-9]+", 20), (2, r"[0-9a-f]+", 24)):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def secrets(frame):
    return secret_scan.summary(frame, owner=F.col("source"), repository=F.col("doc_id"))


def fuzzed(n, seed):
    rng = random.Random(seed)
    parts = ["token", "TOKEN", "Secret", "api_key", "apikey", "passwd", "password", "ſecret", "toKen", ":", "=", " ", "  ", '"', "'", "AKIA",
             "AKIA" + "Z" * 16, "0123456789abcdef" * 2, "deadbeef", "abcdef", "é", "\n", "ABCDEFGH12", "://u:", "@h", "a1B2c3D4e5F6g7H8i9J0k1L2", "-", "_"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def test_base_secrets_match_brute_force(spark, texts):
    own = dict(enumerate([*texts.values(), *fuzzed(400, 3)]))
    frame = spark.createDataFrame([(d, t, f"o{d}") for d, t in own.items()], SCHEMA + ", source string")
    names = ["assign", "access", "hex"]
    for r in secrets(frame).collect():
        want = brute_base(own[r.doc_id] or "")
        text = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in want)
        kinds = Counter(k for _, k, _ in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds[k] for k in range(3))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        base = [s for s in r.spans.split(",") if s.split(":")[0] in names]
        assert ",".join(base) == text


def test_owners_tell_copied_values_from_live_ones(spark):
    blob, mine = "Zx9Kq2LmPv7Rt4Wn8Yb3Cd6F", "Qw8Er7Ty6Ui5Op4As3Df2Gh1"
    docs = [(1, f"a {blob}", "p"), (2, f"b {blob}", "q"), (3, f"c {blob}", "r"), (4, f"d {mine}", "p"), (5, f"e {mine} {mine}", "p"),
            (6, "token = a1b2c3d4e5f6g7h8", "p"), (7, "token = a1b2c3d4e5f6g7h8", "q"), (8, "token = your_example_key1", "s"),
            (9, f"token = {mine[:-1]}9", None)]
    out = {r.doc_id: r for r in secrets(spark.createDataFrame(docs, SCHEMA + ", source string")).collect()}
    assert [out[i].spans for i in (1, 2, 3)] == ["", "", ""]  # three owners: an example, and not of a fixed kind
    assert out[4].live == "blob:2:26" and out[5].live == "blob:2:26,blob:27:51" and out[5].n_live == 2
    assert (out[6].spans, out[6].n_live, out[6].n_copied) == ("assign:0:24", 0, 0)  # two owners: neither
    assert (out[8].n_assign, out[8].n_live) == (1, 0) and (out[9].n_assign, out[9].n_live) == (1, 1)
    spans = secret_scan.scan(spark.createDataFrame(docs, SCHEMA + ", source string"), F.col("source"), F.col("doc_id"))
    held = {r.doc_id: [(s.n_owners, s.n_repositories) for s in r.spans] for r in spans.collect()}
    assert held[4] == [(1, 2)] and held[6] == [(2, 2)]


def test_candidates_never_overlap_what_is_listed_before_them():
    for text in fuzzed(300, 9):
        spans = secret_scan.matches(text)
        for a, k, b, *_ in spans:
            assert k < 3 or not any(o < k and x < b and a < y for x, o, y, *_ in spans)


def test_secrets_at_the_edges(edges, empty):
    got = rows(secrets(edges).select("doc_id", "n_assign", "spans", "n_live"))
    assert sorted(got, key=repr) == sorted([
        (1, 0, "", 0), (2, 0, "", 0), (3, 0, "", 0), (4, 0, "", 0), (5, 1, "assign:0:15", 0), (5, 1, "assign:0:15", 0), (6, 0, "", 0),
        (None, 1, "assign:0:15", 0)], key=repr)
    assert rows(secrets(empty)) == []


@pytest.mark.parametrize("text", ["token" * 40_000, "token" + " " * 200_000, "://a" * 60_000, "a:b@" * 60_000, "AKIA" * 60_000, "f" * 300_000])
def test_secrets_take_linear_time(text):
    import time

    started = time.perf_counter()
    secret_scan.matches(text)
    assert time.perf_counter() - started < 5


# ---- spelling ----

def brute_words(docs, least_length, least_n, noise):
    counts = Counter()
    for d, t in docs:
        for m in re.finditer("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in m[0])
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % noise == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_n}


def one_edit(u, v):
    if len(u) < len(v):
        u, v = v, u
    if u == v or len(u) - len(v) > 1:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return any(u[:i] + u[i + 1:] == v for i in range(len(u)))


def brute_variants(words):
    near = defaultdict(list)
    keys = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            keys[w[:i] + w[i + 1:]].add(w)
        keys[w].add(w)
    for group in keys.values():
        for u in group:
            near[u] += [v for v in group if one_edit(u, v)]
    form = {}
    for w, n in words.items():
        best = min(((-words[v], v) for v in set(near[w])), default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(set(near[w])), words.get(form[w]))
    return out


def variants(frame, *args):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame, *args).collect()}


def test_variants_match_brute_force(spark, texts):
    docs = [*texts.items(), (None, "naïve naïve naïve naive naive naive Äpfel ÄPFEL äpfel"), (7, None), (8, "")]
    want = brute_variants(brute_words(docs, 3, 2, 11))
    assert len(want) > 1000 and any(v[0] for v in want.values())
    assert variants(spark.createDataFrame(docs, SCHEMA), 3, 2, 11) == want


@pytest.mark.parametrize("limit", [1, 2, 5, 4096])
def test_parts_cut_small_lose_and_double_nothing(spark, limit):
    rng = random.Random(limit)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(300)}
    words |= {"".join(rng.choice("äbc") for _ in range(3)) + "x" * rng.choice([70, 71, 72]) for _ in range(40)}
    words |= {"y" * n for n in (150, 151, 152)}
    frame = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    got = Counter(frozenset((r.u, r.v)) for r in spelling.near_pairs(frame, limit).collect())
    ordered = sorted(words)
    want = {frozenset((u, v)) for i, u in enumerate(ordered) for v in ordered[i + 1:] if one_edit(u, v)}
    assert set(got) == want and set(got.values()) == {1}


def test_acceptors_are_minimal():
    machine = spelling.Acceptor()
    root = machine.of(sorted(["tap", "taps", "top", "tops"]))
    assert sorted(machine.language(root)) == ["tap", "taps", "top", "tops"]
    assert len(machine.arcs) == 5  # t, a|o, p, s and the end: a and o lead to one state


def test_checksums_are_those_of_zlib():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 5000).astype(np.uint8)
    begin = rng.integers(0, 4000, 300)
    end = begin + rng.integers(0, 200, 300)
    start = rng.integers(0, 1 << 32, 300, dtype=np.uint64).astype(np.uint32)
    got = spelling.checksums(raw, begin, end, start)
    assert got.tolist() == [zlib.crc32(raw[a:b].tobytes(), int(s)) for a, b, s in zip(begin, end, start)]


def test_long_chains_of_forms_end_in_their_root(spark):
    chain = [("a" * 5 + "b" * i, 3 * 2 ** i) for i in range(20)]
    frame = spark.createDataFrame(chain, "word string, n long")
    out = {r.word: r.root for r in spelling.rooted(spelling.forms(frame)).collect()}
    assert set(out.values()) == {chain[-1][0]} and len(out) == 20


def test_spelling_at_the_edges(spark, edges, empty):
    assert variants(edges, 5, 1, 10 ** 9) == brute_variants(brute_words(rows(edges.select("doc_id", "text")), 5, 1, 10 ** 9))
    assert variants(empty) == {}
    long = spark.createDataFrame([(i, "z" * (100_000 + i % 2)) for i in range(6)], SCHEMA)
    got = variants(long, 5, 3, 10 ** 9)
    assert [v[3] for v in got.values()] == [1, 1]


# ---- search ----

def brute_search(docs, items, k=10):
    def terms(t):
        return ["".join(c.lower() if c < "\x80" else c for c in x) for x in re.findall("[0-9A-Za-z\x80-\U0010FFFF]+", t or "")]

    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scores = []
        for d, c, n in held:
            m = 25 + (75 * n * n_docs) // total
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, q in asked.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_search_matches_brute_force(spark, seed):
    """Words of very uneven frequency, ties, items of one to forty terms, and fewer documents than are asked for."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "ABC", "abc"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(rng.choice([5, 200]))]
    docs += [(1000 + i, docs[i % len(docs)][1]) for i in range(20)]
    items = [(i, " ".join(rng.choices(words + ["none"], k=rng.choice([1, 2, 3, 7, 40])))) for i in range(25)]
    got = rows(ranked_search.search(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), 7))
    assert sorted(got, key=repr) == brute_search(docs, items, 7)


def test_a_closed_item_makes_no_accumulators_of_its_common_terms(spark, tmp_path, monkeypatch):
    """Its rare terms decide: the documents that hold nothing but the common word never get a partial score."""
    rare = [(i, "the the the " + " ".join(f"r{j}" for j in range(6))) for i in range(12)]
    docs = rare + [(100 + i, "the " + f"z{i}") for i in range(3000)]
    items = [(1, "the " + " ".join(f"r{j}" for j in range(6)))]
    sizes = {}
    settle = ranked_search.settle

    def watched(frame, name):
        out = settle(frame, name)
        if name in ("partial", "alive"):
            sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(ranked_search, "settle", watched)
    got = rows(ranked_search.search(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")))
    assert sorted(got, key=repr) == brute_search(docs, items) and sizes["partial"] <= 12


def test_filter_lets_every_term_of_the_items_through(spark):
    items = spark.createDataFrame([(f"T{i} é{i}",) for i in range(500)], "text string")
    bits = np.frombuffer(ranked_search.term_filter(items), np.uint8)
    h = ranked_search.terms(pa.array([f"t{i} é{i}" for i in range(500)]))[3] % np.uint64(ranked_search.FILTER_BITS)
    assert all(bits[int(x) >> 3] >> (int(x) & 7) & 1 for x in h) and np.unpackbits(bits).sum() <= 1000


def test_search_at_the_edges(spark, edges, empty):
    items = spark.createDataFrame([(1, "alpha token"), (2, None), (3, ""), (None, "ONE"), (1, "alpha token")], "item_id long, text string")
    items = items.selectExpr("item_id", "text", "1 AS row", "2 AS id", "3 AS terms", "4 AS doc_id")
    want = brute_search(rows(edges.select("doc_id", "text")), rows(items.select("item_id", "text")))
    assert sorted(rows(ranked_search.search(edges, items)), key=repr) == want and len(want) == 7
    assert rows(ranked_search.search(empty, items)) == [] and rows(ranked_search.search(edges, items.limit(0))) == []
    assert rows(ranked_search.search(edges, items.where("item_id = 3"))) == []

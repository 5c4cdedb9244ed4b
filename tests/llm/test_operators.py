"""Each operator against brute force on whole small tables, and its defined results at the edges."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences

import corpus_pipeline
from lineside.llm import (
    catalog, decontamination, language_id, licenses, line_dedup, minhash, packing, pii, quality_classifier, quality_rules,
    token_files, tokens)
from lineside.llm.components import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def edges(spark):
    """NULL, empty, blank, one word, repeated rows, a long text without blanks, and columns with clashing names."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "a b c d e f g"), (5, "a b c d e f g"), (6, "x" * 200_000), (None, "a b c d e f g")]
    frame = spark.createDataFrame(rows, SCHEMA)
    catalog.ship(spark)
    return frame.selectExpr("doc_id", "text", "1 AS n_removed", "2 AS score", "3 AS band", "4 AS spans", "'en' AS lang")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_word_ids_are_those_of_the_library(texts):
    encoder = tokens.Encoder(catalog.tokenizer_path())
    odd = ["a<|endoftext|>b", "x's don't ½ ² a1b2 été", "İ ΣΣ", "á b", "", " ", "it's 'S l'été", "a\x85b", "a\x1cb", "__a_b", "ﬁ ß ſ"]
    whole = odd + list(texts.values())[:60]
    for text, ids in zip(whole, encoder.encode(whole)):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids
    assert encoder.encode([None]) == [b""]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    ids = np.random.default_rng(1).integers(0, 1 << 32, 1003, dtype=np.uint64).astype("<u4")
    assert (token_files.from_planes(token_files.to_planes(ids, kind), len(ids), kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_files_return_what_was_written(spark, texts, kind):
    docs = catalog.documents(spark, SF)
    got = token_files.round_trip(spark, docs, catalog.tokenizer_path(), 2, kind=kind, block=1000, file_ids=5000)
    encode, start, want = tokens.Encoder(catalog.tokenizer_path()).encode, 0, []
    for doc_id in sorted(texts):
        ids = encode([texts[doc_id]])[0] + np.array([2], "<u4").tobytes()
        want.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(rows(got)) == want


def test_token_files_at_the_edges(spark, edges, empty):
    got = sorted(rows(token_files.round_trip(spark, edges, catalog.tokenizer_path(), 2)), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 2, 3, 4, 5, 5, 6] and [r[2] for r in got][1:4] == [1, 1, 1]
    assert rows(token_files.round_trip(spark, empty, catalog.tokenizer_path(), 2)) == []


@pytest.mark.parametrize("capacity, lengths", [(10, [3, 3, 4, 7, 6, 5, 5]), (100, list(range(1, 100))), (7, [7] * 5 + [1] * 9), (6, [])])
def test_patterns_use_every_piece_once_within_capacity(capacity, lengths):
    counts = Counter(lengths)
    best, used = packing.patterns(dict(counts), capacity), Counter()
    for n, inside in best:
        assert sum(x * m for x, m in inside) <= capacity
        for x, m in inside:
            used[x] += n * m
    assert used == counts
    assert sum(n for n, _ in best) <= sum(n for n, _ in packing.best_fit(dict(counts), capacity))


def test_bin_completion_beats_best_fit():
    counts = {44: 1, 24: 2, 22: 1, 21: 1, 17: 2, 8: 2, 6: 2}  # best-fit decreasing needs three
    assert sum(n for n, _ in packing.patterns(counts, 100)) == 2


def test_packing_is_gapless(spark, edges, empty):
    for docs in (catalog.documents(spark, SF), edges):
        got = packing.pack(docs, catalog.tokenizer_path(), 1, 512).toPandas()
        assert len(got.dropna().drop_duplicates(["doc_id", "piece", "sequence_id", "offset"])) == len(got.dropna())
        for _, own in got.sort_values("offset").groupby("sequence_id"):
            assert own.length.sum() <= 512 and (own.offset == own.length.cumsum() - own.length).all()
    assert rows(packing.pack(empty, catalog.tokenizer_path())) == []


def test_near_duplicates_match_sql(spark):
    assert differences(catalog.QUERIES["op5_near_duplicates"](spark, SF), connect(SF), catalog.ORACLES["op5_near_duplicates"]) is None


def test_near_duplicates_at_the_edges(edges, empty):
    got = sorted(rows(minhash.near_duplicates(edges)), key=repr)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 3, 5, True), (5, 3, 5, True),
                          (6, 1, 6, True), (None, 3, None, True)], key=repr)
    assert rows(minhash.near_duplicates(empty)) == []


def test_links_that_the_bands_smallest_does_not_see(spark):
    """A chain: each text is near the next one only, so most of it hangs together without the smallest."""
    words = [f"w{i}" for i in range(400)]
    chain = [(100 + i, " ".join(words[8 * i:8 * i + 160])) for i in range(20)]
    got = rows(minhash.near_duplicates(spark.createDataFrame(chain, SCHEMA), k=1))
    assert {r[2] for r in got} == {100}


def test_possible_pairs_hold_every_similar_one(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(1 << 62), 1 << 62, 60)
    sets = {}
    for i in range(120):
        kept = base[rng.random(60) > rng.choice([0.02, 0.08, 0.2])]
        sets[i] = np.unique(np.r_[kept, rng.integers(-(1 << 62), 1 << 62, int(rng.integers(0, 12)))]).astype(np.int64)
    placed = spark.createDataFrame(
        [(i, len(s), i, [i % 2, 2 + i % 3]) for i, s in sets.items()], "doc_id long, n long, root long, bands array<long>")
    frame = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "doc_id long, s binary")
    got = {tuple(r) for r in minhash.possible(placed, frame, 80).collect()}
    want = set()
    for i in sets:
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common) and (i % 2 == j % 2 or i % 3 == j % 3):
                want.add((j, i))
    assert want and want <= got
    assert all(i % 2 == j % 2 or i % 3 == j % 3 for i, j in got)
    assert len(got) < 120 * 119 / 2


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(5)
    pairs = [tuple(map(int, rng.integers(0, 120, 2))) for _ in range(90)] + [(500, i) for i in range(501, 560)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in pairs:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    want = {(x, find(x)) for x in root if x != find(x)}
    assert set(rows(components(spark.createDataFrame(pairs, "u long, v long"), "u", "v"))) == want


def test_contaminated_matches_brute_force(spark, texts):
    fold = lambda t: [w.lower() for w in WORDS(t)]
    grams = lambda w: Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    items = {i: fold(t) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()}
    want = {}
    for doc_id, text in texts.items():
        w = fold(text)
        here = set(grams(w))
        for i, item in items.items():
            g = grams(item)
            if here & set(g):
                best = max(
                    sum((own & g).values()) / sum((own | g).values())
                    for s in range(max(1, len(w) - len(item) + 1)) for own in [grams(w[s:s + len(item)])])
                if best >= 0.8:
                    want[doc_id, i] = best
    got = {(r.doc_id, r.item_id): r.similarity for r in catalog.op2_decontamination(spark, SF).collect()}
    assert want and got == pytest.approx(want)


def test_contaminated_at_the_edges(spark, edges, empty):
    items = spark.createDataFrame([(1, "b c d e f g"), (2, "one"), (3, None), (4, ""), (5, "f g")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(edges, items).collect()}
    assert got == {(5, 1), (4, 2), (5, 5)}
    assert rows(decontamination.contaminated(empty, items)) == []
    assert rows(decontamination.contaminated(edges, items.limit(0))) == []


def test_rule_statistics_match_brute_force(spark, texts):
    def stats(text):
        w = WORDS(text or "")
        g = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        seen = Counter(g)
        covered = {j for i, x in enumerate(g) if seen[x] > 1 for j in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if WORDS(x)]
        return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)

    got = catalog.op3_quality_rules(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        want = stats(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and r.rule == 0)


def test_rules_are_learned_and_ordered(spark, edges, empty):
    good = [(i, "the quick brown fox jumps over the lazy dog near a quiet river bank " + f"w{i}") for i in range(60)]
    bad = [(100 + i, " ".join(f"w{i}x{j}***" for j in range(15))) for i in range(60)]
    docs = spark.createDataFrame(good + bad, SCHEMA)
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality_rules.judge(docs, labels).collect()}
    assert all(got[i] == (i < 100) for i, _ in good + bad)
    assert {r.kept for r in quality_rules.judge(edges, labels.limit(0)).collect()} == {False}
    assert rows(quality_rules.judge(empty, labels)) == []


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_personal_data_matches_brute_force(spark, texts):
    more = {-1: "a@b.c_d@e.f é😀 1.2.3.4.5.6.7.8 256.1.1.1 4111 1111 1111 1111 +1 (555) 123-4567--", -2: "9" * 20_000,
            -3: "a.b" * 20_000 + "@x", -4: "1.2." * 20_000, -5: "", -6: None, -7: "a-" * 20_000 + "a@b.c"}
    whole = {**texts, **more}
    got = pii.summary(spark.createDataFrame(list(whole.items()), SCHEMA)).collect()
    assert len(got) == len(whole)
    for r in got:
        want = base_spans(whole[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(want.count(f"{k}:") for k in pii.BASE_KINDS)


def test_scored_kinds_need_their_check_and_context(spark):
    got = rows(pii.summary(spark.createDataFrame([
        (1, "iban GB82WEST12345698765432"), (2, "iban GB83WEST12345698765432"), (3, "ssn 123-45-6789"), (4, "no 123-45-6789"),
        (5, "token = 186661156f3f9905942d70850a01cbf2"), (6, "see 186661156f3f9905942d70850a01cbf2")], SCHEMA)))
    assert {r[0]: r[-1] for r in got} == {
        1: "iban:5:27", 2: "", 3: "ssn:4:15", 4: "", 5: "secret:8:40", 6: ""}


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = catalog.op1_quality_classifier(spark, sf).join(catalog.table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_classifier_at_the_edges(spark, edges, empty):
    labels = spark.createDataFrame([(5, 1)], "doc_id long, label int")
    got = quality_classifier.scored(edges, quality_classifier.fit(edges, labels))
    assert got.columns[-1] == "score" and all(0 <= r.score <= 1 for r in got.collect()) and got.count() == 8
    assert rows(quality_classifier.scored(empty, quality_classifier.fit(empty, labels.limit(0)))) == []


def test_languages_by_all_evidence(spark, edges, empty):
    docs = spark.createDataFrame([(1, "the cat and the dog with a hat", "en"), (2, "der hund und die katze mit einem hut", "de")],
                                 "doc_id long, text string, lang string")
    pages = [(i, "http://a.example.de/x", "<html lang=de><p>der hund und die katze mit dem hut</p>") for i in range(5)]
    pages += [(i, "http://b.example.com/y", "<html lang='en'><p>the dog and the cat with the hat</p>") for i in range(5, 10)]
    pages += [(10, "http://a.example.de/z", None), (11, None, "<script>der hund</script>the cat and the dog"), (12, "odd", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in language_id.identify(frame, docs).collect()}
    assert [got[i].lang for i in range(12)] == ["de"] * 5 + ["en"] * 5 + ["de", "en"] and len(got) == 13
    assert all(0 < r.probability <= 1 for r in got.values())
    assert rows(language_id.identify(frame.limit(0), docs)) == []
    assert {r.lang for r in language_id.identify(frame, docs.limit(0)).collect()} == {None}


def test_licenses_are_found_with_their_spans(spark, edges, empty):
    line = licenses.TEMPLATES["gpl-3.0-line"]
    notice = licenses.TEMPLATES["mit-notice"]
    docs = spark.createDataFrame([
        (1, f"é {line} end"), (2, "intro " + notice.replace("charge", "cost").lower()), (3, "licensed under nothing"),
        (4, f"{line}\n{line}"), (5, None), (6, "")], SCHEMA)
    got = sorted(rows(licenses.scan(docs)))
    assert [(r[0], r[1]) for r in got] == [(1, "gpl-3.0-line"), (2, "mit-notice"), (4, "gpl-3.0-line"), (4, "gpl-3.0-line")]
    assert got[0][4:] == (2, 2 + len(line) - 1) and got[0][2] == 1.0 and 0.9 < got[1][2] < 1
    assert rows(licenses.scan(empty)) == [] and rows(licenses.scan(edges)) == []


def test_winnowing_keeps_its_guarantee():
    g = np.random.default_rng(2).integers(0, 1 << 60, 200, dtype=np.uint64)
    kept = set(licenses.winnow(g, 4).tolist())
    assert all(kept & set(range(i, i + 4)) for i in range(197))
    # Whatever words a match may lack, it has as many fingerprints as are asked for.
    rng = np.random.default_rng(5)
    index, keys, counts = licenses.template_index(licenses.TEMPLATES, licenses.COVERAGE)
    assert len(index) == len(licenses.TEMPLATES) and len(keys) < len({w for t in index for w in t.words.tolist()})
    for t in index:
        lost = len(t.words) - t.need
        for worst in (set(t.at[:lost].tolist()), *(set(rng.choice(len(t.words), lost, replace=False).tolist()) for _ in range(20))):
            assert len(set(t.at.tolist()) - worst) >= t.need_prints >= 1 or len(worst) > lost


def test_patience_aligns_in_order():
    a, b = [1, 2, 3, 4, 5, 9, 9], [7, 1, 2, 8, 4, 5, 9, 9]
    assert line_dedup.patience(a, b) == [(0, 1), (1, 2), (3, 4), (4, 5), (5, 6), (6, 7)]
    assert line_dedup.patience([1, 1], [1, 1, 1]) == [(0, 0), (1, 1)]
    assert line_dedup.patience([], [1]) == []


def test_common_blocks_leave_the_later_document(spark, edges, empty):
    passage = "\n".join(" ".join(f"p{i}w{j}" for j in range(20)) for i in range(3))
    docs = spark.createDataFrame([
        (1, f"own first line\n{passage}\nend"), (2, f"other\n\n{passage}\nlast"), (3, passage.replace("\n", "\n\n")), (4, "end\nother"),
        (5, None), (6, "")], SCHEMA)
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.remove_common(docs).collect()}
    assert got == {1: (f"own first line\n{passage}\nend", 0), 2: ("other\n\nlast", 3), 3: ("", 5), 4: ("end\nother", 0), 5: (None, 0), 6: ("", 0)}
    out = line_dedup.remove_common(edges)
    assert out.columns == ["doc_id", "text", "score", "band", "spans", "lang", "n_removed"] and out.count() == 8
    assert rows(line_dedup.remove_common(empty)) == []


def test_pipeline_stages_by_brute_force(spark):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.settle(stage(spark, docs, SF), "test-stage")
        if name != "best-fit packing":
            assert docs.columns == before.columns
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert all(b <= a for a, b in zip(seen, seen[1:])) and seen[3] == seen[4]
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == seen[4]


def test_pipeline_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, SF), "test-stage")
        assert docs.count() == 0


def test_hashes_of_batches_with_offsets():
    from lineside.llm.common import text_bytes, words

    column = pa.array(["skip", "a bc", None, "", "d"])[1:]
    raw, at = text_bytes(column)
    assert raw.tobytes() == b"a bcd" and at.tolist() == [0, 4, 4, 4, 5]
    begin, end, first = words(raw, at)
    assert [raw[x:y].tobytes() for x, y in zip(begin, end)] == [b"a", b"bc", b"d"] and first.tolist() == [0, 2, 2, 2, 3]


def passage_line(i, n=10):
    return " ".join(f"p{i}w{j}" for j in range(n))


def brute_lines(docs, min_words):
    """Each text without the lines of its blocks that an earlier document holds."""
    bodies = {d: [(i, x.split()) for i, x in enumerate(t.split("\n")) if x.split()] for d, t in docs}

    def blocks(d):
        own = bodies[d]
        for a in range(len(own)):
            for z in range(a + 1, len(own) + 1):
                if sum(len(x) for _, x in own[a:z]) >= min_words:
                    yield tuple(" ".join(x) for _, x in own[a:z]), own[a][0], own[z - 1][0]

    seen, out = set(), {}
    for d, t in sorted(docs):
        gone = {i for key, a, z in blocks(d) if key in seen for i in range(a, z + 1)}
        seen |= {key for key, _, _ in blocks(d)}
        out[d] = ("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone), len(gone))
    return out


def deduped(spark, docs, *args):
    frame = spark.createDataFrame(docs, SCHEMA)
    return {r.doc_id: (r.text, r.n_removed) for r in line_dedup.remove_common(frame, *args).collect()}


def test_a_passage_whose_lines_come_first_in_different_documents(spark):
    line = [passage_line(i) for i in range(6)]
    whole = "\n".join(line)
    docs = [(1 + k, "\n".join(line[2 * k:2 * k + 2])) for k in range(3)] + [(10, whole), (11, f"top\n{whole}\nend")]
    got = deduped(spark, docs)
    assert got[10] == (whole, 0) and got[11] == ("top\nend", 6)


def test_line_runs_match_brute_force(spark):
    rng = np.random.default_rng(11)
    line = ["", "", "a", *[" ".join(f"x{i}y{j}" for j in range(n)) for i, n in enumerate([1, 2, 2, 3, 5, 9])]]
    docs = [(d, "\n".join(line[i] for i in rng.integers(0, len(line), int(rng.integers(1, 25))))) for d in range(60)]
    assert deduped(spark, docs, 6) == brute_lines(docs, 6)


def test_passages_in_another_order_and_more_than_once(spark):
    p, q = ("\n".join(passage_line(i) for i in own) for own in (range(4), range(10, 15)))
    docs = [(1, f"{p}\nmid\n{q}"), (2, f"{q}\n\n{p}"), (3, f"{p}\nx\n{p}\ny\n{p}"), (4, f"z\n{q}\n{q}")]
    assert brute_lines(docs, 30) == {1: (docs[0][1], 0), 2: ("", 9), 3: ("x\ny", 12), 4: ("z", 10)}
    assert deduped(spark, docs) == brute_lines(docs, 30)


def test_license_lines_repeated_on_neighbouring_lines(spark):
    lines = [licenses.TEMPLATES[name] for name in ("mit-line", "cc-by-4.0-line", "apache-2.0-line")]
    texts = [sep.join([line] * n) for line in lines for n in range(1, 8) for sep in ("\n", " ")] + ["\n".join(lines * 3)]
    got = Counter(r[0] for r in rows(licenses.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA))))
    assert [got[i] for i in range(len(texts))] == [n for _ in lines for n in range(1, 8) for _ in range(2)] + [9]


def edited(words, rng, changed, added):
    """``words`` with some replaced or left out, and others put between."""
    out = list(words)
    for i in rng.choice(len(words), changed, replace=False):
        out[i] = "" if rng.random() < 0.3 else "zz"
    for i in rng.integers(0, len(words), added):
        out[i] += " yy"
    return "aa bb " + " ".join(x for x in out if x) + " cc dd"


def smith_waterman(a, b, need):
    """The best local alignment over the whole table: matched words, first and last (exclusive) of ``b``."""
    best, above = (0, 0, -1, -1), [(0, 0, -1, -1)] * (len(b) + 1)
    for x in a:
        row = [(0, 0, -1, -1)]
        for j, y in enumerate(b):
            s, m, first, last = above[j]
            cell = (s + 2, m + 1, j if first < 0 else first, j + 1) if x == y else (s - 1, m, first, last)
            for c in (above[j + 1], row[-1]):
                if c[0] - 1 > cell[0]:
                    cell = (c[0] - 1, *c[1:])
            row.append(cell if cell[0] > 0 else (0, 0, -1, -1))
            if row[-1][0] > best[0] and row[-1][1] >= need:
                best = row[-1]
        above = row
    return best[1:]


def test_licenses_edited_to_the_coverage_limit_match_brute_force(spark):
    rng = np.random.default_rng(4)
    line = licenses.TEMPLATES["mit-line"]
    got = rows(licenses.scan(spark.createDataFrame([(1, line.replace("the", "an")), (2, "released under my xx license")], SCHEMA)))
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(1, "mit-line", 0.8, 4)]
    for name, template in licenses.TEMPLATES.items():
        words = re.findall(r"[A-Za-z0-9]+", template)
        n = len(words)
        limit = n - int(np.ceil(licenses.COVERAGE * n))
        tries = 3 if n < 60 else 1
        texts = [edited(words, rng, min(n, max(0, limit + d)), added) for d in (-1, 0, 0, 1) for added in (0, 1, 3) for _ in range(tries)]
        want = {}
        for i, text in enumerate(texts):
            found = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9]+", text)]
            m, lo, hi = smith_waterman([w.lower() for w in words], [w for w, _, _ in found], n - limit)
            if m:
                want[i] = (m, found[lo][1], found[hi - 1][2])
        got = {r[0]: (r[3], r[4], r[5]) for r in rows(licenses.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA), {name: template}))}
        assert want and got == want


def test_helper_names_may_be_columns(spark):
    passage = "\n".join(passage_line(i) for i in range(4))
    docs = spark.createDataFrame([(1, passage), (2, f"x\n{passage}")], SCHEMA).selectExpr(
        "doc_id", "text", "7 AS _left", "8 AS _cuts", "9 AS _cut_doc", "10 AS cuts", "11 AS cut_doc", "12 AS left", "13 AS row",
        "14 AS gone", "15 AS _hit_doc", "16 AS _gone", "17 AS lines", "'en' AS `a.b`")
    out = {r.doc_id: r for r in line_dedup.remove_common(docs).collect()}
    assert out[2].text == "x" and tuple(out[2])[2:-1] == (7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, "en") and out[2].n_removed == 4
    hits = spark.createDataFrame([(2,)], "doc_id long")
    assert [tuple(r)[2:] for r in decontamination.without_contaminated(docs, hits).collect()] == [(7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, "en")]
    assert corpus_pipeline.near_duplicates(spark, docs, SF).columns == docs.columns


def test_short_texts_at_the_limit_of_similarity_are_all_contaminated(spark):
    """Few shingles, and repeated ones: most of the weight hangs together, so a sketch of the whole differs by more."""
    items = [(i, " ".join(f"i{i}w{j}" for j in range(9))) for i in range(400)]
    items += [(i, " ".join([f"i{i}a", f"i{i}b"] * 4 + [f"i{i}c"])) for i in range(400, 480)]
    docs = spark.createDataFrame([(i, " ".join(t.split()[:8])) for i, t in items], SCHEMA)
    got = rows(decontamination.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")))
    assert sorted(r[:3] for r in got) == [(i, i, 0.8) for i, _ in items]


def test_benchmark_items_without_an_id_are_compared(spark):
    items = spark.createDataFrame([(None, "a b c d e f"), (None, "p q r s t u v"), (7, "g h i j k l")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c d e f"), (2, "p q r s t u v"), (3, "g h i j k l"), (4, "no")], SCHEMA)
    assert sorted(rows(decontamination.contaminated(docs, items).select("doc_id", "item_id", "start"))) == [(1, None, 1), (2, None, 0), (3, 7, 0)]

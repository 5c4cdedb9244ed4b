"""Spelling variants: which words of a vocabulary are one edit apart, and which one each is a variant of.

A word is a maximal run of letters, A-Z folded to lower case. The vocabulary acceptor reads exactly the words that are long
and frequent enough. It is composed with a transducer of one inserted, deleted or replaced character and with itself;
the composition accepts the pairs of near words.

**Partitions.** The composition starts anew in many states. In the longer word of a pair the edit falls into one half of its
positions: what stands before that half, and after it, is the same in both words. The words that agree outside a half are the
part of the acceptor that is entered in one state and left in one, and its minimised form is composed on its own. Each word
enters four such parts: as the longer word with either half, as the one shorter by a character with either half. A part of more
than ``LIMIT`` words has its half cut in two again, down to single positions, where a part holds one word for each letter
of the alphabet; so no part is unbounded and none is left out.

A pair is accepted once: its edit is put at the end of the common beginning of the two words.

Empty and NULL texts have no words. A row without ``doc_id`` keys its noise by an empty id. Repeated rows count each. An
empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineside.llm.common import hashes, runs, settle, slices, text_bytes

LIMIT = 4096
#: Positions that one acceptor covers at most.
DEEP = 64
#: Different words a task holds before it hands on their counts.
HELD = 1 << 17
#: Pairs in a batch on their way out of Python.
PAIRS = 1 << 16

_letter = np.zeros(256, np.uint8)
_letter[[*range(65, 91), *range(97, 123)]] = 1
_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_crc = _crc_table()


# ---- words and their counts ----

def letter_runs(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of A-Z, a-z and U+00C0 to U+00FF, and for each text its first run."""
    kind = _letter[raw]
    lead = raw == 0xC3  # its second byte covers just that block
    kind[lead] = 1
    kind[1:][lead[:-1]] = 1
    return runs(kind, at)


def checksums(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, start: np.ndarray) -> np.ndarray:
    """crc32 of byte ranges, each going on from the crc32 in ``start``."""
    order = np.argsort(begin - end, kind="stable")  # longest first: those still running are a prefix
    long = int(np.count_nonzero(end - begin > DEEP))
    first, length, now = begin[order], (end - begin)[order], start[order] ^ np.uint32(0xFFFFFFFF)
    for i in range(long):
        now[i] = zlib.crc32(raw[first[i]:first[i] + length[i]], int(start[order[i]])) ^ 0xFFFFFFFF
    first, length, now, whole = first[long:], length[long:], now[long:], now
    for i in range(int(length[0]) if len(length) else 0):
        n = int(np.searchsorted(-length, -i, "left"))
        now[:n] = _crc[(now[:n] ^ raw[first[:n] + i]) & np.uint32(255)] ^ (now[:n] >> np.uint32(8))
    out = np.empty_like(whole)
    out[order] = whole
    return out ^ np.uint32(0xFFFFFFFF)


def _counts(batches: Iterator[pa.RecordBatch], least_length: int, noise: int) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for part in slices(batches, "text"):
        raw, at = text_bytes(part.column("text"))
        begin, end, first = letter_runs(raw, at)
        wide = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(raw == 0xC3, out=wide[1:])
        enough = end - begin - (wide[end] - wide[begin]) >= least_length  # no edit makes a word longer
        text = np.repeat(np.arange(part.num_rows), np.diff(first))[enough]
        begin, end = begin[enough], end[enough]
        if not len(begin):
            continue
        low = _fold[raw]
        ids = ["" if d is None else str(d) for d in part.column("doc_id").to_pylist()]
        start = np.array([zlib.crc32(f"{d}:".encode()) for d in ids], np.uint32)
        h = checksums(low, begin, end, start[text])
        bent = h % noise == 0
        _, where, n = np.unique(hashes(low, begin[~bent], end[~bent]), return_index=True, return_counts=True)
        for a, b, k in zip(begin[~bent][where].tolist(), end[~bent][where].tolist(), n.tolist()):
            word = low[a:b].tobytes()
            held[word] = held.get(word, 0) + k
        for a, b, x in zip(begin[bent].tolist(), end[bent].tolist(), h[bent].tolist()):
            word = low[a:b].tobytes().decode()
            i = x % len(word)
            if len(word) > least_length:
                word = (word[:i] + word[i + 1:]).encode()
                held[word] = held.get(word, 0) + 1
        if len(held) > HELD:
            yield batch()
    if held:
        yield batch()


def vocabulary(docs: DataFrame, least_length: int = 5, least_n: int = 3, noise: int = 97) -> DataFrame:
    """word and n for the words of at least ``least_length`` characters found at least ``least_n`` times.

    ``noise`` plants misspellings: where the crc32 of ``<doc_id>:<word>`` is a multiple of it, the word loses the character
    at that number modulo its length.
    """
    parts = docs.select("doc_id", "text").mapInArrow(
        lambda batches: _counts(batches, least_length, noise), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


# ---- acceptors and their composition with one edit ----

class Acceptor:
    """Minimised acyclic acceptors over one store of states: equal languages are the same state."""

    def __init__(self) -> None:
        self.final: list[bool] = []
        self.arcs: list[dict[str, int]] = []
        self._known: dict[tuple, int] = {}
        self._language: dict[int, list[str]] = {}
        self._common: dict[tuple[int, int], list[str]] = {}

    def state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.final.append(final)
            self.arcs.append(arcs)
        return self._known[key]

    def of(self, words: list[str], depth: int = 0) -> int:
        """The state that accepts ``words``, which are sorted and differ, each without its first ``depth`` characters."""
        final = bool(words) and len(words[0]) == depth
        arcs, i = {}, int(final)
        while i < len(words):
            j, c = i, words[i][depth]
            while j < len(words) and words[j][depth] == c:
                j += 1
            arcs[c] = self.of(words[i:j], depth + 1)
            i = j
        return self.state(final, arcs)

    def language(self, p: int) -> list[str]:
        if p not in self._language:
            own = [""] if self.final[p] else []
            self._language[p] = own + [c + x for c, r in self.arcs[p].items() for x in self.language(r)]
        return self._language[p]

    def common(self, p: int, q: int) -> list[str]:
        """What both states accept."""
        if p == q:
            return self.language(p)
        key = (p, q) if p < q else (q, p)
        if key not in self._common:
            a, b = self.arcs[p], self.arcs[q]
            own = [""] if self.final[p] and self.final[q] else []
            self._common[key] = own + [c + x for c, r in a.items() if c in b for x in self.common(r, b[c])]
        return self._common[key]

    def replaced(self, p: int, seen: dict[int, list]) -> list[tuple[str, str]]:
        """Pairs of accepted words that differ in one character, each once."""
        if p not in seen:
            arcs = list(self.arcs[p].items())
            out = [(c + x, c + y) for c, r in arcs for x, y in self.replaced(r, seen)]
            for i, (c, r) in enumerate(arcs):
                out += [(c + x, d + x) for d, s in arcs[i + 1:] for x in self.common(r, s)]
            seen[p] = out
        return seen[p]

    def shortened(self, p: int, q: int, seen: dict[tuple[int, int], list]) -> list[tuple[str, str]]:
        """Pairs of a word accepted from ``p`` and one from ``q`` that lacks one of its characters, each once."""
        if (p, q) not in seen:
            below = self.arcs[q]
            out = [(c + x, c + y) for c, r in self.arcs[p].items() if c in below for x, y in self.shortened(r, below[c], seen)]
            for c, r in self.arcs[p].items():
                out += [(c + x, x) for x in self.common(r, q) if x[:1] != c]  # else the words agree for one more character
            seen[p, q] = out
        return seen[p, q]


def near(long: list[str], short: list[str], lo: int, hi: int) -> Iterator[tuple[str, str]]:
    """Pairs whose edit stands at ``lo`` to ``hi`` of the longer word, each once.

    ``long`` words are of one length and ``short`` ones shorter by a character; all agree before ``lo`` and after ``hi``. Very long
    ranges are halved, so that no acceptor is deeper than ``DEEP``.
    """
    if hi - lo > DEEP:
        middle = (lo + hi) // 2
        for a, b in ((lo, middle), (middle, hi)):
            groups: dict[str, tuple[list[str], list[str]]] = {}
            for w in long:
                groups.setdefault(w[lo:a] + w[b:hi], ([], []))[0].append(w)
            for w in short:
                groups.setdefault(w[lo:a] + w[b - 1:hi - 1], ([], []))[1].append(w)
            for more, less in groups.values():
                if more and len(more) + len(less) > 1:
                    yield from near(more, less, a, b)
        return
    machine = Acceptor()
    p = machine.of(sorted(w[lo:hi] for w in long))
    q = machine.of(sorted(w[lo:hi - 1] for w in short))
    some = long[0]
    for x, y in machine.replaced(p, {}):
        yield some[:lo] + x + some[hi:], some[:lo] + y + some[hi:]
    for x, y in machine.shortened(p, q, {}):
        if x[-1] != some[hi:hi + 1] or not x.startswith(y):  # else the words agree beyond these positions, and are found there
            yield some[:lo] + x + some[hi:], some[:lo] + y + some[hi:]


# ---- partitions of the composition ----

def _outside(lo: str, hi: str) -> str:
    """What a word shows outside the positions ``lo`` to ``hi`` of the longer word; ``size`` is the longer one's length."""
    return f"concat(substring(word, 1, {lo}), substring(word, {hi} + 1 - (size - length(word)), size))"


def _cut(parts: DataFrame) -> DataFrame:
    """Each part's positions ``lo`` to ``hi`` cut in two."""
    halves = "explode(array(struct(lo AS lo, (lo + hi) div 2 AS hi), struct((lo + hi) div 2 AS lo, hi AS hi)))"
    cut = parts.selectExpr("word", "n", "size", f"{halves} AS half").selectExpr("word", "n", "size", "half.lo", "half.hi").where("lo < hi")
    return cut.selectExpr("word", "n", "size", "lo", "hi", f"{_outside('lo', 'hi')} AS outside")


KEY = ["size", "lo", "hi", "outside"]


def partitions(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Parts of the composition: size, lo, hi, outside and ``words``, an array of (word, n) of at most ``limit``.

    Only parts that can hold a pair are returned. The size of a part is counted before anything is gathered.
    """
    whole = words.selectExpr("word", "n", "explode(array(length(word), length(word) + 1)) AS size")
    left = settle(_cut(whole.selectExpr("word", "n", "size", "0 AS lo", "size AS hi")), "parts")
    done = []
    while True:
        counted = left.groupBy(*KEY).agg(
            F.count("*").alias("many"), F.count_if(F.expr("length(word) = size")).alias("longer")).where("longer > 0 AND many > 1")
        counted = settle(counted, "part-sizes")
        small = counted.where(f"many <= {limit} OR hi - lo = 1").select(*KEY)
        done.append(left.join(small, KEY, "left_semi"))
        large = counted.where(f"many > {limit} AND hi - lo > 1").select(*KEY)
        if large.isEmpty():
            break
        left = settle(_cut(left.join(large, KEY, "left_semi")), "parts")
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*KEY).agg(F.collect_list(F.struct("word", "n")).alias("words"))


PAIR = "u string, n_u long, v string, n_v long"


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[], [], [], []]

    def batch() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["u", "n_u", "v", "n_v"])
        for c in columns:
            c.clear()
        return out

    for part in batches:
        for size, lo, hi, held in zip(*(part.column(c).to_pylist() for c in ("size", "lo", "hi", "words"))):
            n = {w["word"]: w["n"] for w in held}
            for u, v in near([w for w in n if len(w) == size], [w for w in n if len(w) < size], lo, hi):
                for column, value in zip(columns, (u, n[u], v, n[v])):
                    column.append(value)
            if len(columns[0]) > PAIRS:
                yield batch()
    if columns[0]:
        yield batch()


def near_pairs(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """u, n_u, v, n_v: each pair of ``words`` (word, n) that are exactly one edit apart, once."""
    return partitions(words, limit).mapInArrow(_compose, PAIR)


def forms(words: DataFrame, times: int = 2, limit: int = LIMIT) -> DataFrame:
    """word, n, n_near, form, form_n: the near word of largest n if it has ``times`` the word's own."""
    pairs = settle(near_pairs(words, limit), "near")
    both = pairs.select(F.col("u").alias("word"), F.col("v").alias("other"), F.col("n_v").alias("m")).unionByName(
        pairs.select(F.col("v").alias("word"), F.col("u").alias("other"), F.col("n_u").alias("m")))
    near = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other"))).alias("best"))
    held = words.join(near, "word", "left")
    larger = -F.col("best.less") >= times * F.col("n")
    return held.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(larger, F.col("best.other")).alias("form"),
        F.when(larger, -F.col("best.less")).alias("form_n"))


def rooted(words: DataFrame) -> DataFrame:
    """``words`` (word, form and more) with ``root``, the end of each chain of forms.

    Chains end, as counts at least double along them. A round doubles the steps a word has gone, so there are as many rounds
    as the logarithm of the longest chain; each is settled in the shared folder.
    """
    step = settle(words.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settle(step.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                            F.col("next").isNotNull().alias("moved")), "roots")
        step = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return words.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, least_length: int = 5, least_n: int = 3, noise: int = 97) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary of ``docs``."""
    words = settle(vocabulary(docs, least_length, least_n, noise), "vocabulary")
    return rooted(settle(forms(words), "forms")).select("word", "form", "root", "n", "n_near", "form_n")

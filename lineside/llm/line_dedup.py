"""Line dedup by pairwise alignment: a block of lines that an earlier document has too goes from the later one.

A block is a run of neighbouring non-blank lines with ``min_words`` words and more.

1. **Pairs.** A line may be everywhere, a run of lines is rare: from each line the shortest block that begins there is hashed, and for each
   line the shortest block of two lines and more that ends there. One aggregate gives each hash the smallest ``doc_id`` that
   holds it and the place there, and every other document that has it is paired with that one. So the number of pairs follows
   the number of lines, however common a line or a passage is, and copies are never paired with each other.
2. **Alignment.** Of the earlier document only what the pair shares is needed, and equal hashes tell its lines from the later one's, so
   no text moves. Each pair is aligned by patience diff, and aligned blocks are deleted from the later document. Shared runs that
   the alignment left out, since passages stand in another order or more often, are aligned again on their own
   until none is left.

That is exact: every two neighbours, and every line, of a longer common block lie in one of the shortest blocks inside it, so a line
goes if and only if it lies in a block that a smaller ``doc_id`` holds. The smallest document that holds a line never loses
it, so one copy of each line stays.

Blank lines neither match nor end a block; those inside a deleted block go with it. NULL texts stay NULL. A text may become
empty. Rows with the same ``doc_id`` are one document and lose nothing to each other; a row without ``doc_id`` is left as
it is. An empty table gives an empty result. Other columns, whatever their names, are returned as they are, but ``n_removed`` is
replaced. A very long text is a row like any other, and so are its lines.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineside.llm.common import BLANK_CHARS, BLANKS, settle, spans

MIN_WORDS = 30


def _once(lines: list[int], start: int, stop: int) -> dict[int, int]:
    seen = Counter(lines[start:stop])
    return {x: i for i, x in enumerate(lines[start:stop], start) if seen[x] == 1}


def _numbered(lines: list[int], start: int, stop: int) -> dict[tuple[int, int], int]:
    seen: Counter[int] = Counter()
    out = {}
    for i in range(start, stop):
        out[lines[i], seen[lines[i]]] = i
        seen[lines[i]] += 1
    return out


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs that increases on both sides; the first side is in order already."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(j)
            at.append(n)
        else:
            tails[k], at[k] = j, n
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned lines of ``a`` and ``b`` as increasing pairs of positions."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b), False)]
    while todo:
        i, i_end, j, j_end, numbered = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        keys = _numbered if numbered else _once
        left, right = keys(a, i, i_end), keys(b, j, j_end)
        anchors = _increasing([(p, right[x]) for x, p in left.items() if x in right])
        if not anchors:
            if not numbered:
                todo.append((i, i_end, j, j_end, True))
            continue
        out.extend(anchors)
        ends = [(i - 1, j - 1), *anchors, (i_end, j_end)]
        # Between anchors by occurrence there is nothing left to find but what their order hides.
        todo.extend((p + 1, q, r + 1, s, numbered) for (p, r), (q, s) in zip(ends, ends[1:]))
    return sorted(out)


def shortest_runs(words: np.ndarray, at: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) line of the runs that are compared. ``words`` holds the words of each line of all texts end to
    end, one at least; ``at`` where the lines of each text begin (one more entry than texts)."""
    line = np.arange(len(words))
    before = np.concatenate([[0], np.cumsum(words)])
    owner = np.searchsorted(at, line, "right") - 1
    stop = np.maximum(np.searchsorted(before, before[:-1] + min_words), line + 1)
    start = np.minimum(np.searchsorted(before, before[1:] - min_words, "right") - 1, line - 1)
    from_here, to_here = stop <= at[owner + 1], start >= at[owner]
    first = np.concatenate([line[from_here], start[to_here]])
    last = np.concatenate([stop[from_here], line[to_here] + 1])
    return np.divmod(np.unique(first * (len(words) + 1) + last), len(words) + 1)


def aligned_blocks(pairs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Runs of aligned lines that are neighbours on both sides: first line on either side, number of lines."""
    out: list[list[int]] = []
    for i, j in pairs:
        if out and (i, j) == (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]):
            out[-1][2] += 1
        else:
            out.append([i, j, 1])
    return [tuple(block) for block in out]


def shared_lines(lines: list[int], words: list[int], runs: list[tuple[int, int, int]], min_words: int) -> list[tuple[int, int]]:
    """First and last (exclusive) line of the blocks of one document that it shares with one earlier document.

    ``runs`` are the blocks found equal: first line in the earlier document, first line here, number of lines. They tell what lines the
    earlier document has at these places.
    """
    known = {q + i: lines[p + i] for q, p, n in runs for i in range(n)}
    left = sorted({p + i for _, p, n in runs for i in range(n)})
    out: list[tuple[int, int]] = []

    def take(there: list[int], here: list[int]) -> None:
        pairs = patience([known[q] for q in there], [lines[p] for p in here])
        for _, p, n in aligned_blocks([(there[i], here[j]) for i, j in pairs]):
            if sum(words[p:p + n]) >= min_words:
                out.append((p, p + n))

    take(sorted(known), left)
    covered = merged(out)
    for q, p, n in runs:  # what another order or a repeat has hidden
        k = bisect_right(covered, (p, len(lines))) - 1
        if k < 0 or covered[k][1] < p + n:
            take(list(range(q, q + n)), list(range(p, p + n)))
    return merged(out)


def merged(cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same lines in as few cuts as there are without joining cuts that only touch."""
    out: list[tuple[int, int]] = []
    for first, stop in sorted(cuts):
        if out and first < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((first, stop))
    return out


def common_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id and cuts (array of first and last line to delete, counted from 0) of each document that loses some."""
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.split("text", "\n").alias("lines"))

    def line(x, i):
        body = F.trim(x, F.lit(BLANK_CHARS))
        return F.struct(
            i.cast("int").alias("i"), F.xxhash64(body).alias("h"), F.length(body).alias("chars"),
            F.size(F.split(body, BLANKS)).alias("words"))

    filled = F.filter(F.transform("lines", line), lambda x: x["chars"] > 0)
    hashed = settle(texts.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.transform(filled, lambda x: F.struct(x["i"], x["h"], x["words"])).alias("lines")), "lines")

    def cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("lines")
            at = column.offsets.to_numpy().astype(np.int64)
            lines = column.values.slice(at[0], at[-1] - at[0])
            at = at - at[0]
            h, words = (lines.field(c).to_numpy() for c in ("h", "words"))
            first, stop = shortest_runs(words.astype(np.int64), at, min_words)
            owner = np.searchsorted(at, first, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(spans(h.view(np.uint64), first, stop).view(np.int64)),
                 pa.array((first - at[owner]).astype(np.int32)), pa.array((stop - first).astype(np.int32))],
                names=["doc_id", "h", "first", "n"])

    held = settle(hashed.mapInArrow(cut_runs, "doc_id long, h long, first int, n int"), "line-runs")
    earliest = F.min(F.struct("doc_id", "first")).alias("earliest")
    repeated = (
        held.groupBy("h").agg(earliest, F.max("doc_id").alias("last_doc"))
        .where("earliest.doc_id < last_doc").select("h", "earliest.doc_id", "earliest.first").toDF("h", "other", "there"))
    # A document's shared runs are no more than twice its lines.
    paired = (
        held.join(repeated, "h").where("doc_id <> other")
        .groupBy("doc_id").agg(F.collect_list(F.struct("other", "there", "first", "n")).alias("runs")))
    # Repeated rows of one doc_id hold the same lines; any of them will do.
    found = hashed.join(paired, "doc_id").select("doc_id", "lines", "runs")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        for batch in batches:
            all_cuts = []
            for own, runs in zip(batch.column("lines"), batch.column("runs").to_pylist()):
                i, h, words = (own.values.field(c).to_pylist() for c in ("i", "h", "words"))
                by_other: dict[int, set[tuple[int, int, int]]] = {}
                for r in runs:
                    if r["first"] + r["n"] <= len(h):
                        by_other.setdefault(r["other"], set()).add((r["there"], r["first"], r["n"]))
                cuts = [cut for _, same in sorted(by_other.items()) for cut in shared_lines(h, words, sorted(same), min_words)]
                all_cuts.append([{"first": i[a], "last": i[b - 1]} for a, b in merged(cuts)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(all_cuts, kind)], names=["doc_id", "cuts"])

    return found.mapInArrow(align, "doc_id long, cuts array<struct<first: int, last: int>>").dropDuplicates(["doc_id"])


def remove_common(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the deleted lines gone from ``text``, and ``n_removed``, the number of these lines."""
    cuts = settle(common_lines(docs, min_words), "line-cuts").select(F.col("doc_id").alias("cut_doc"), "cuts")
    names = [c for c in docs.columns if c != "n_removed"]
    # All columns of a document are one, so that no name of theirs can meet one of those used here.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    lines = F.split("row.text", "\n")

    def stays(_, i):
        return ~F.exists("cuts", lambda c: (c["first"] <= i) & (i <= c["last"]))

    left = F.when(F.col("cuts").isNotNull(), F.filter(lines, stays))
    cut = F.col("left").isNotNull()
    text = F.when(cut, F.array_join("left", "\n")).otherwise(F.col("row.text"))
    removed = F.when(cut, F.size(lines) - F.size("left")).otherwise(F.lit(0)).cast("long")
    return (
        whole.join(cuts.hint("merge"), F.col("row.doc_id") == F.col("cut_doc"), "left").withColumn("left", left)
        .select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names], removed.alias("n_removed")))

"""Best-fit packing of tokenized documents into sequences of a fixed length.

Only lengths matter to a packing, and there are at most ``capacity`` of them, so the search runs on the histogram of
lengths, whatever the number of documents: at most 4,096 rows on the driver. It gives patterns, each a list of lengths
that share a sequence, with the number of sequences made that way. Pieces then take their places by rank
among the pieces of their length, which Spark counts in two steps so that no length gathers in one task.

The patterns come from bin completion. The incumbent is best-fit decreasing. Branch and bound then fills one sequence at
a time around the largest piece left: fillings of the rest of the space are enumerated, those that are dominated (a
piece could be swapped for a larger one left, or one more piece fits) are skipped, and a branch ends when its waste
so far exceeds what a packing with fewer sequences than the incumbent may waste. The search stops at the lower bound
``ceil(total / capacity)`` or after a fixed number of fillings, then the incumbent stands.

NULL and empty texts have the end id only. Repeated rows are packed as often as they occur. An empty table gives an
empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineside.llm.common import settle, slices
from lineside.llm.tokens import encoder

CAPACITY = 4096
FILLINGS = 400  # looked at around one largest piece
BRANCHES = 20_000  # sequences filled in the whole search
RANKED = 100_000  # pieces of one length that one task ranks

Pattern = tuple[int, list[tuple[int, int]]]  # sequences, then (length, pieces of it in each)


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram. Sequences with the same contents are kept as one group, and a length
    splits at most two groups, so there are at most three groups per length."""
    groups: dict[int, list[list]] = {}  # space left -> [sequences, contents]
    spaces: list[int] = []

    def put(space: int, n: int, inside: list[tuple[int, int]]) -> None:
        if space not in groups:
            groups[space] = []
            insort(spaces, space)
        groups[space].append([n, inside])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(spaces, length)
            if i == len(spaces):
                fit = capacity // length
                whole, rest = divmod(left, fit)
                if whole:
                    put(capacity - fit * length, whole, [(length, fit)])
                if rest:
                    put(capacity - rest * length, 1, [(length, rest)])
                break
            space = spaces[i]
            group = groups[space][-1]
            fit = space // length
            n, extra = min(group[0], left // fit), 0
            if not n:  # fewer pieces than one sequence could take
                n, extra = 1, left
            group[0] -= n
            put(space - (extra or fit) * length, n, [*group[1], (length, extra or fit)])
            left -= n * (extra or fit)
            if not group[0]:
                groups[space].remove(group)
                if not groups[space]:
                    del groups[space]
                    spaces.remove(space)
    return [(n, inside) for rows in groups.values() for n, inside in rows]


def fillings(lengths: list[int], left: dict[int, int], space: int) -> list[tuple[int, list[int]]]:
    """Undominated fillings of ``space`` as (waste, pieces), least waste first; ``lengths`` ascend."""
    found: list[tuple[int, list[int]]] = []
    used: dict[int, int] = {}
    budget = FILLINGS

    def dominated(waste: int, pieces: list[int]) -> bool:
        for x in set(pieces):
            for y in lengths[bisect_right(lengths, x):bisect_right(lengths, x + waste)]:
                if left[y] > used.get(y, 0):
                    return True
        return False

    def fill(space: int, top: int, pieces: list[int]) -> bool:
        """True once nothing better can come."""
        nonlocal budget
        maximal = True
        i = min(top, bisect_right(lengths, space)) - 1
        while i >= 0 and budget:
            x = lengths[i]
            if left[x] > used.get(x, 0):
                maximal = False
                budget -= 1
                used[x] = used.get(x, 0) + 1
                done = fill(space - x, i + 1, [*pieces, x])
                used[x] -= 1
                if done:
                    return True
            i -= 1
        if maximal and not any(left[y] > used.get(y, 0) for y in lengths[:bisect_right(lengths, space)]):
            if not space:
                found.append((0, pieces))
                return True
            if not dominated(space, pieces):
                found.append((space, pieces))
        return False

    fill(space, len(lengths), [])
    found.sort(key=lambda f: (f[0], len(f[1])))
    return found[:4]


def complete(counts: dict[int, int], capacity: int, allowed: int) -> list[Pattern] | None:
    """Bin completion with at most ``allowed`` waste, or None if there is no such packing or the search gave up."""
    left = {x: n for x, n in counts.items() if n}
    lengths = sorted(left)
    made: list[Pattern] = []
    choices: list[list[tuple[int, list[int]]]] = []
    waste, steps = 0, 0

    def take(pattern: Pattern, sign: int) -> None:
        n, inside = pattern
        for x, m in inside:
            before = left.get(x, 0)
            left[x] = before - sign * n * m
            if not left[x]:
                lengths.remove(x)
            elif not before:
                insort(lengths, x)

    while lengths:
        steps += 1
        if steps > BRANCHES:
            return None
        top = lengths[-1]
        left[top] -= 1
        options = fillings(lengths, left, capacity - top)
        left[top] += 1
        choices.append(options or [(capacity - top, [])])
        while True:
            if choices[-1]:
                lost, pieces = choices[-1].pop(0)
                run: dict[int, int] = {lengths[-1]: 1}
                for x in pieces:
                    run[x] = run.get(x, 0) + 1
                n = min(left[x] // m for x, m in run.items())
                if lost:
                    n = min(n, (allowed - waste) // lost)
                if n > 0:
                    pattern = (n, sorted(run.items(), reverse=True))
                    take(pattern, 1)
                    made.append(pattern)
                    waste += n * lost
                    break
                choices[-1].clear()
            choices.pop()
            if not made:
                return None
            undone = made.pop()
            take(undone, -1)
            waste -= undone[0] * (capacity - sum(x * m for x, m in undone[1]))
    return made


def patterns(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use every piece once, with as few sequences as the search finds."""
    best = best_fit(counts, capacity)
    total = sum(x * n for x, n in counts.items())
    sequences = sum(n for n, _ in best)
    if sequences > -(-total // capacity):
        better = complete(counts, capacity, (sequences - 1) * capacity - total)
        if better is not None:
            best = better
    return best


def slots(best: list[Pattern]) -> dict[str, np.ndarray]:
    """Runs of places: pieces of ``length`` ranked from ``rank`` on, ``each`` of them per sequence, the first at
    ``offset`` of sequence ``base``. Sorted by length and rank."""
    rows, rank, base = [], {}, 0
    for n, inside in best:
        offset = 0
        for length, each in inside:
            first = rank.get(length, 0)
            rows.append((length, first, each, base, offset))
            rank[length] = first + n * each
            offset += length * each
        base += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "each", "base", "offset"), table.T))


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Ids of every text and the end id, cut at ``capacity``: doc_id, piece, start, length, ids_crc32."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        for part in slices(batches, "text"):
            rows = []
            for doc_id, raw in zip(part.column("doc_id").to_pylist(), encode(part.column("text").to_pylist())):
                raw += end
                for i in range(0, len(raw), 4 * capacity):
                    own = raw[i:i + 4 * capacity]
                    rows.append((doc_id, i // (4 * capacity), i // 4, len(own) // 4, zlib.crc32(own)))
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = settle(pieces(docs, tokenizer, end_id, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = slots(patterns(histogram, capacity))
    salts = 1 + max(histogram.values(), default=0) // RANKED
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")).select(
        "length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("_own", F.row_number().over(own) - 1)
        .join(bases, ["length", "_salt"])
        .select(*cut.columns, (F.col("_base") + F.col("_own")).alias("_rank"))
    )
    shared = spark.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        shift = 1 << 44
        key = p["length"] * shift + p["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            at = np.searchsorted(key, length * shift + rank, "right") - 1
            k = rank - p["rank"][at]
            sequence, offset = p["base"][at] + k // p["each"][at], p["offset"][at] + k % p["each"][at] * length
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

"""Near-duplicate documents: MinHash signatures, banding, verification on full sets, connected components.

A document's set holds its distinct runs of ``k`` words (A-Z folded to lower case); with fewer words, the whole sequence
is its one shingle. Texts that are NULL or have no word have an empty set and are linked with nothing. Two documents are
linked if ``100 * |intersection| >= percent * |union|``.

Documents with the same set are one class, found by grouping on the size and a 128-bit digest of the set; the class is
its smallest ``doc_id`` from there on, so copies are never paired. Classes that share a band are candidates:

1. In each shared band every class is checked against the smallest one. Verified links give first components.
2. In bands whose classes are not all in the component of the smallest, classes of different components are checked
   against each other if they share a shingle so early in their sets, rarest shingles first, that the similarity is
   possible: what two sets share lies at or after their first common shingle in both. The ``AHEAD`` shingles that follow it
   in both must agree on enough, too, as the rest of a set can't make up for more than its own number. Members of one
   component need no check against each other, their link changes nothing.

The filter in 2 is exact, so no link between different components of a band is lost. It is a join on the shingle and on steps of
the set's size. Classes of one size that each have over a ninth of their shingles to themselves never meet, however many they are;
those of a template that differ in what ``AHEAD`` covers meet in the join but don't leave it.
A pair at the limit of 0.8 shares none of the 40 bands of 6 with a chance of 5 in a million.

Rows with the same ``doc_id`` are one document. A row without ``doc_id`` is linked with nothing: its component is NULL and it is
kept. An empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineside.llm.common import grams, hashes, mix, settle, slices, text_bytes, words
from lineside.llm.components import components

BANDS, ROWS = 40, 6
SIGNATURE = 512
#: Verified on full sets only if so much of the signatures agrees; at 0.8 similarity that is 11 deviations off.
LIKELY = 0.6
#: Set sizes are compared in steps of a fiftieth of their logarithm, two hundredths of the size.
STEPS = 50
#: Shingles after a common one that two sets compare before they become a pair.
AHEAD = 32
#: Shingles in a batch on their way out of Python.
UNFOLDED = 1 << 18
_rng = np.random.default_rng(7)
_factor = (_rng.integers(0, 1 << 31, SIGNATURE, dtype=np.uint64) * 2 + 1).astype(np.uint32)[:, None]
_shift = _rng.integers(0, 1 << 32, SIGNATURE, dtype=np.uint64).astype(np.uint32)[:, None]


def shingle_sets(batch: pa.RecordBatch, k: int) -> list[np.ndarray]:
    """The sorted set of each text of ``batch`` as 64-bit hashes."""
    raw, at = text_bytes(batch.column("text"))
    begin, end, first = words(raw, at)
    h = hashes(raw, begin, end, lower=True)
    bounds = first.tolist()
    return [np.unique(grams(h[a:b], min(k, b - a))) if b > a else h[:0] for a, b in zip(bounds, bounds[1:])]


def signature(s: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """Minimum of each of the first ``size`` universal hashes over a set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(size, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(best, (_factor[:size] * x[None, i:i + 2048] + _shift[:size]).min(axis=1), out=best)
    return best


def described(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, a and b (digest of the set), bands (one key for each)."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part, k)
            minima = np.stack([signature(s, BANDS * ROWS) for s in sets])
            sigs = minima.astype(np.uint64).reshape(len(sets), BANDS, ROWS)
            keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), BANDS))
            for j in range(ROWS):
                keys = mix(keys + sigs[:, :, j])
            mixed = [mix(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(np.array([m.sum(dtype=np.uint64) for m in mixed], np.uint64).view(np.int64)),
                 pa.array(np.array([mix(m + np.uint64(1)).sum(dtype=np.uint64) for m in mixed], np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(
                     np.arange(0, BANDS * len(sets) + 1, BANDS, dtype=np.int32), keys.ravel().view(np.int64))],
                names=["doc_id", "n_shingles", "a", "b", "bands"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        describe, "doc_id long, n_shingles long, a long, b long, bands array<long>")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, s (the sorted set), sig (a byte of each minimum)."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part, k)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary()),
                 pa.array([signature(s).astype(np.uint8).tobytes() for s in sets], pa.binary())],
                names=["doc_id", "s", "sig"])

    return docs.mapInArrow(collect, "doc_id long, s binary, sig binary")


def unfolded(sets: DataFrame) -> DataFrame:
    """doc_id, shingle: a row for each member of each set."""
    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, s in zip(batch.column("doc_id").to_pylist(), batch.column("s")):
                members = np.frombuffer(s.as_buffer(), np.int64)
                for i in range(0, len(members), UNFOLDED):
                    part = members[i:i + UNFOLDED]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), doc_id, np.int64)), pa.array(part)], names=["doc_id", "shingle"])

    return sets.select("doc_id", "s").mapInArrow(unfold, "doc_id long, shingle long")


def possible(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of ``placed`` (doc_id, n, root, bands) with a common band, different roots and an early common shingle.

    ``left`` counts a set's shingles from one on, rarest first, that at least two of the sets have. The sets share ``left`` shingles
    at most if this one is the first they share; ``(100 + percent) * shared >= percent * (n + m)`` is the similarity asked for.
    ``after`` holds the next ``AHEAD`` of them. A similar pair passes at its first common shingle, if at no other.
    """
    rows = settle(unfolded(sets.join(placed.select("doc_id"), "doc_id", "left_semi")), "unfolded")
    often = settle(rows.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1"), "often")
    last_first = Window.partitionBy("doc_id").orderBy(F.desc("often"), F.desc("shingle"))
    after = F.collect_list("shingle").over(last_first.rowsBetween(-AHEAD, -1))
    ranked = rows.join(often, "shingle").withColumn("left", F.row_number().over(last_first).cast("long")).withColumn("after", after)
    carried = ["doc_id", "n", "root", "bands", "left", "after"]
    early = settle(
        ranked.join(placed.select("doc_id", "n", "root", "bands"), "doc_id")
        .where(F.col("left") * (100 + percent) >= F.ceil(F.col("n") * percent / 100) * percent + F.col("n") * percent)
        .select("shingle", *carried), "early")

    def step(size: Column) -> Column:
        return F.floor(F.log(size) * STEPS)

    # The smaller set of a pair, or one of two equal ones, has this size; the larger one reaches down to it.
    small = early.where(F.col("left") * (100 + percent) >= F.col("n") * 2 * percent).select(
        "shingle", step(F.col("n")).alias("step"), *carried)
    least = F.ceil(F.col("n") * percent / 100)
    most = F.least("n", F.floor((F.col("left") * (100 + percent) - F.col("n") * percent) / percent))
    large = early.withColumn("step", F.explode(F.sequence(step(least), step(most)))).select(
        "shingle", "step", *[F.col(c).alias(f"x_{c}") for c in carried])
    shared = (F.col("n") + F.col("x_n")) * percent
    # Both sets are in one order, so a common shingle that is not in both stretches lies beyond the one that ends earlier.
    beyond = F.greatest(F.col("left") - F.size("after"), F.col("x_left") - F.size("x_after"))
    reach = F.size(F.array_intersect("after", "x_after")) + beyond
    return small.join(large, ["shingle", "step"]).where(
        (F.col("root") != F.col("x_root")) & (F.col("n") <= F.col("x_n"))
        & (F.col("left") * (100 + percent) >= shared) & (F.col("x_left") * (100 + percent) >= shared)
        & (reach * (100 + percent) >= shared) & F.arrays_overlap("bands", "x_bands")
    ).select(F.least("doc_id", "x_doc_id").alias("u"), F.greatest("doc_id", "x_doc_id").alias("v")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for su, sv, gu, gv in zip(*(batch.column(c).to_pylist() for c in ("su", "sv", "gu", "gv"))):
                near = np.count_nonzero(np.frombuffer(gu, np.uint8) == np.frombuffer(gv, np.uint8))
                if near < LIKELY * SIGNATURE:
                    good.append(False)
                    continue
                x, y = np.frombuffer(su, np.uint64), np.frombuffer(sv, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(good, pa.bool_())) for c in (batch.column("u"), batch.column("v"))], names=["u", "v"])

    left = sets.select(F.col("doc_id").alias("u"), F.col("s").alias("su"), F.col("sig").alias("gu"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("s").alias("sv"), F.col("sig").alias("gv"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "su", "sv", "gu", "gv").mapInArrow(
        check, "u long, v long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    known = settle(described(docs, k), "described")
    classes = settle(
        known.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "a", "b")
        .agg(F.min("doc_id").alias("rep")), "classes")
    reps = known.join(
        classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "n_shingles", "a", "b"], "left_semi")
    rows = reps.select(F.explode("bands").alias("band"), "doc_id", F.col("n_shingles").alias("n"))
    shared = (
        rows.groupBy("band").agg(F.min("doc_id").alias("center"), F.max("doc_id").alias("last"))
        .where("center < last").select("band", "center"))
    members = settle(rows.join(shared, "band").select("band", "center", "doc_id", "n"), "members")
    wanted = members.select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sets = settle(full_sets(texts.join(wanted, "doc_id", "left_semi"), k).dropDuplicates(["doc_id"]), "sets")
    stars = members.where("doc_id <> center").select(F.col("center").alias("u"), F.col("doc_id").alias("v")).distinct()
    links = settle(verified(stars, sets, percent), "links")
    found = components(links, "u", "v")
    # What a band's smallest class does not reach.
    placed = members.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "root", F.coalesce("root", "doc_id"))
    at_center = placed.where("doc_id = center").select("band", F.col("root").alias("center_root")).distinct()
    placed = settle(placed.join(at_center, "band").select("band", "center", "doc_id", "n", "root", "center_root"), "placed")
    mixed = placed.where("root <> center_root").select("band").distinct()
    mixed = settle(
        placed.join(mixed, "band").where("doc_id <> center").groupBy("doc_id", "n", "root")
        .agg(F.collect_set("band").alias("bands")), "mixed")
    rest = possible(mixed, sets, percent)
    more = settle(verified(rest, sets, percent), "links")
    if not more.isEmpty():
        found = components(links.union(more), "u", "v")
    roots = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n_shingles", "a", "b", F.coalesce("root", "rep").alias("_root"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id"))
    return known.drop("bands").join(roots, ["n_shingles", "a", "b"], "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))

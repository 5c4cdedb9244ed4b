"""Benchmark decontamination: documents with a window that nearly equals a benchmark item.

A window has as many words as the item (the whole text, if that is shorter). Its shingles are runs of five words (all words of an
item with fewer), A-Z folded, weighted by how often they occur in the window. Similarity is the weighted Jaccard
index: the sum of the smaller weights over the sum of the larger ones.

1. Windows that can reach the similarity hold shingles of items, and there are enough positions in the text with such shingles.
   One scan of the text finds these positions, and every shared shingle puts a window where an item would lie. Places are put by the
   shingle, its position and the size of its item, not by item: a head that all items share gives no more rows than one.
2. Each window and each item has a 64-bit SimHash of its weighted shingles. Fingerprints are cut into ``RADIUS + 1`` blocks; two that
   differ in at most ``RADIUS`` bits agree in a block, so a join on (size, block, bits) finds all of them.
3. Windows and items of fewer than ``SKETCHED`` different shingles, for which a sketch says little, meet on shared shingles instead.
4. Weighted shingles of what is left are compared in full.

At similarity 0.8 about 9 of 64 bits differ, with a deviation of 3; the radius is four deviations off. Without a sketch nothing is lost.

A benchmark item of one word makes a hit of each document that has the word, as a window of one word equals it; give ``least_words``
to leave such items out. Very long texts are read like others, but a window is never longer than its item.

DataFrame functions only. Items or texts that are NULL or have no word match nothing, nor do rows without ``doc_id``. Items
without ``item_id`` are compared as well, and reported as one item with a NULL ``item_id``. Repeated rows count once. Empty tables
give an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineside.llm.common import BLANKS, let, settle, without

SHINGLE = 5
SIMILARITY = 0.8
BITS, RADIUS = 64, 20
#: Different shingles that a window or an item has at least to be sketched.
SKETCHED = 20
#: Shingles of the benchmark that are broadcast (24 bytes each); above that the join shuffles.
BROADCAST_SHINGLES = 1_000_000


def word_array(text: Column) -> Column:
    """The words of a text, A-Z folded."""
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(folded, BLANKS), lambda w: w != "")


def shingle_array(words: Column, k: int) -> Column:
    """Hash of each run of ``k`` words; none if there are fewer."""
    def runs(w: Column) -> Column:
        return F.when(F.size(w) >= k, F.transform(
            F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(*[F.get(w, i + (j - 1)) for j in range(k)]))
        ).otherwise(F.array().cast("array<bigint>"))

    return let(words, runs)


def simhash(shingles: str) -> Column:
    """Bit j is set if it is set in more than half of the weight of the shingles."""
    return F.expr(
        f"aggregate(sequence(0, {BITS - 1}), 0L, (f, j) -> f | IF(2 * aggregate({shingles}, 0, (n, h) -> "
        f"n + CAST(shiftright(h, j) & 1L AS INT)) > size({shingles}), shiftleft(1L, j), 0L))")


def blocks(fingerprint: str, radius: int) -> Column:
    """(block, bits) for ``radius + 1`` blocks that cover the fingerprint."""
    cuts = [BITS * b // (radius + 1) for b in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(b).alias("block"), F.shiftright(fingerprint, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits"))
        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])


def met(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """Windows (doc_id, start, m, n_words, g) and items (item_id, m, g) of one size that may be similar."""
    small = F.size(F.array_distinct("g")) < SKETCHED
    w, i = (frame.withColumn("small", small) for frame in (windows, items))
    i = i.withColumnRenamed("g", "item_g")

    def sketched(frame: DataFrame, g: str, f: str) -> DataFrame:
        marked = settle(frame.where("NOT small").withColumn(f, simhash(g)), "sketches")
        return marked.select("*", F.inline(blocks(f, radius)))

    near = sketched(w, "g", "f").join(sketched(i, "item_g", "item_f").drop("small"), ["m", "block", "bits"]).where(
        F.bit_count(F.col("f").bitwiseXOR(F.col("item_f"))) <= radius)
    # If one of the two has few shingles and the other has not, they are compared in full as well.
    shared = w.select("*", F.explode(F.array_distinct("g")).alias("h")).join(
        i.select("item_id", "m", "item_g", F.col("small").alias("item_small"), F.explode(F.array_distinct("item_g")).alias("h")),
        ["m", "h"]).where("small OR item_small")
    columns = ["doc_id", "start", "n_words", "item_id", "g", "item_g"]
    return near.select(*columns).unionByName(shared.select(*columns)).distinct()


def weighted(shingles: Column) -> Column:
    """A set that stands for the weighted shingles: the n-th occurrence of a shingle is an element of its own."""
    def numbered(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), g).otherwise(F.transform(
            g, lambda x, i: F.xxhash64(x, F.size(F.filter(F.slice(g, F.lit(1), i), lambda y: y == x)))))

    return let(shingles, numbered)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS,
    least_words: int = 1,
) -> DataFrame:
    """One row per document (doc_id, text) and item (item_id, text) that meet: doc_id, item_id, similarity of the best
    window, start (its first word, from 0) and n_words."""
    items = benchmark.select("item_id", word_array(F.col("text")).alias("w")).where(
        F.size("w") >= max(1, least_words))
    items = items.select("item_id", "w", F.size("w").alias("m"), F.least(F.size("w"), F.lit(k)).alias("k"))
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # k values at most
    shingles = F.array().cast("array<bigint>")
    for n in sizes:
        shingles = F.when(F.col("k") == n, shingle_array(F.col("w"), n)).otherwise(shingles)
    items = settle(items.select("item_id", "m", "k", shingles.alias("g")), "items")

    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    texts = known.select("doc_id", word_array(F.col("text")).alias("w"))

    def grams(n: int) -> DataFrame:
        return texts.select("doc_id", F.lit(n).alias("k"), F.posexplode(shingle_array(F.col("w"), n)).alias("pos", "h"))

    held = reduce(DataFrame.unionAll, [grams(n) for n in sizes or [k]])
    index = settle(items.select("m", "k", F.posexplode("g").alias("at", "h")).distinct(), "index")
    if index.count() <= BROADCAST_SHINGLES:
        index = F.broadcast(index)
    seeds = settle(held.join(index, ["k", "h"]).select(
        "doc_id", "m", "k", "pos", (F.col("pos") - F.col("at")).alias("start")).distinct(), "seeds")
    # As many positions as the similarity asks for, in the whole text.
    enough = seeds.groupBy("doc_id", "m", "k").agg(F.countDistinct("pos").alias("n")).where(
        F.col("n") >= similarity * (F.col("m") - F.col("k") + 1)).select("doc_id", "m", "k")
    spots = seeds.join(enough, ["doc_id", "m", "k"], "left_semi").select("doc_id", "start", "m", "k").distinct()
    spots = spots.groupBy("doc_id").agg(F.collect_list(F.struct("start", "m", "k")).alias("spots"))  # of one text
    # The spots grow with the corpus, so they are not broadcast; texts are shuffled as they are, word arrays take twice that.
    wanted = known.join(spots.hint("merge"), "doc_id").select("doc_id", word_array(F.col("text")).alias("w"), "spots")
    per_size = F.array(*[shingle_array(F.col("w"), n) for n in range(1, k + 1)])
    first = F.greatest(F.lit(0), F.least(F.col("s.start"), F.col("n") - F.col("s.m")))
    windows = (
        wanted.select("doc_id", F.size("w").alias("n"), per_size.alias("by_k"), "spots")
        .select("doc_id", "n", "by_k", F.explode("spots").alias("s"))
        .select("doc_id", first.alias("start"), F.col("s.m").alias("m"), F.least("n", "s.m").alias("n_words"),
                F.slice(F.get("by_k", F.col("s.k") - 1), first + 1,
                        F.greatest(F.lit(0), F.least("n", "s.m") - F.col("s.k") + 1)).alias("g"))
        .where("size(g) > 0"))
    windows = settle(windows.distinct(), "windows")
    near = met(windows, items.select("item_id", "m", "g").distinct(), radius)
    common = F.size(F.array_intersect("x", "y"))
    scored = near.select(
        "doc_id", "item_id", "start", "n_words", weighted(F.col("g")).alias("x"), weighted(F.col("item_g")).alias("y")
    ).select("doc_id", "item_id", "start", "n_words", common.alias("c"), (F.size("x") + F.size("y")).alias("both"))
    scored = scored.withColumn("similarity", F.col("c") / (F.col("both") - F.col("c"))).where(
        F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words")).alias("best")
    return scored.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.before")).cast("long").alias("start"),
        F.col("best.n_words").cast("long").alias("n_words"))


def without_contaminated(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """``docs`` but for documents with a hit."""
    return without(docs, hits)

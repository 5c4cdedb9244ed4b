"""Ranked lexical search, a term at a time with limited accumulators.

A term is a maximal run of ASCII letters, digits and characters outside ASCII, A-Z folded to lower case. A document's score for an
item is the sum, over the item's terms with repeats, of ``w * ((10^9 * tf) div (1000 * tf + 8 * m))``: w weighs a term by how few
documents hold it, m is 100 for a document of mean length and moves by three quarters with the length. Sums are whole numbers, so
results do not hang on their order.

**Terms rarest first.** The terms of each item are ordered by the documents that hold them. A round takes the next few terms of every item
that is still open and adds what they give to the item's accumulators, one for each document met so far. The most that the terms not
yet taken can add is known from the largest value each of them reaches in any document. Once that falls below the kth best
partial score, no document without an accumulator can come among the k best: the item is closed and makes no new ones.

**Survivors.** Accumulators of a closed item that cannot reach the kth partial score any more go. For the others the remaining terms
are looked up by document and term, so their scores are exact. The common terms, which stand in nearly all documents, are hardly ever
turned into accumulators.

Rounds take 2, 4, 8 ... terms, so an item has as many rounds as the logarithm of its terms. All accumulators stay in tables; each
round is settled in the shared folder.

A NULL or empty text has no terms: it is not counted among the documents and is never found. Each row is a document, also where
``doc_id`` repeats or is NULL (NULLs rank last among equal scores), and each row of items is an item of its own. Empty
tables give an empty result. Other columns, whatever their names, are not read. Very long texts are documents like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineside.llm.common import hashes, runs, settle, slices, text_bytes

FIRST = 2
#: Bits of the filter that tells which terms no item has; it has this size whatever the items.
FILTER_BITS = 1 << 23

_term = np.zeros(256, np.uint8)
_term[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts, begin, end and folded hash of each term, and for each text its first term."""
    raw, at = text_bytes(column)
    begin, end, first = runs(_term[raw], at)
    return raw, begin, end, hashes(raw, begin, end, lower=True), first


def _counted(part: pa.RecordBatch, bits: np.ndarray | None) -> pa.RecordBatch:
    """row, n, terms: how many terms each text has, and its distinct terms (those in ``bits``) with their counts."""
    raw, begin, end, h, first = terms(part.column("text"))
    n = np.diff(first)
    text = np.repeat(np.arange(part.num_rows), n)
    if bits is not None:
        spot = h % np.uint64(FILTER_BITS)
        kept = (bits[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
        begin, end, h, text = begin[kept], end[kept], h[kept], text[kept]
    _, where, term = np.unique(h, return_index=True, return_inverse=True)
    spelled = pa.array([raw[a:b].tobytes().lower() for a, b in zip(begin[where].tolist(), end[where].tolist())], pa.binary())
    held, tf = np.unique(text * max(1, len(where)) + term, return_counts=True)
    owner, which = np.divmod(held, max(1, len(where)))
    starts = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays(
        [spelled.cast(pa.string()).take(pa.array(which)), pa.array(tf, pa.int64())], names=["term", "tf"])
    return pa.RecordBatch.from_arrays(
        [part.column("row"), part.column("id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(starts, pairs)],
        names=["row", "id", "n", "terms"])


COUNTED = "row long, id long, n long, terms array<struct<term:string,tf:long>>"


def counted(rows: DataFrame, bits: bytes | None = None) -> DataFrame:
    """Distinct terms of each of ``rows`` (row, id, text), settled; with ``bits`` only those that the filter lets through."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if shared.value is None else np.frombuffer(shared.value, np.uint8)
        for part in slices(batches, "text"):
            yield _counted(part, known)

    return settle(rows.mapInArrow(count, COUNTED), "terms")


def term_filter(items: DataFrame) -> bytes:
    """A filter of ``FILTER_BITS`` bits with those of all terms of ``items`` set, or-ed together where they lie."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            spot = np.unique(terms(part.column("text"))[3] % np.uint64(FILTER_BITS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(spot >> np.uint64(6), pa.int64()), pa.array((np.uint64(1) << (spot & np.uint64(63))).view(np.int64))],
                names=["place", "bits"])

    found = items.mapInArrow(words, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[found["place"].to_numpy()] = found["bits"].to_numpy()
    return out.tobytes()


def weight(n_docs: int, df: Column) -> Column:
    return F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * df + 1).cast("double"))).cast("long")


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), "text")


def _best(partial: DataFrame, k: int) -> DataFrame:
    """item and least: the kth best score of each item that has k."""
    first = Window.partitionBy("item").orderBy(F.desc("score"), "row")
    top = partial.select("item", "row", "score", F.row_number().over(first).alias("rank")).where(F.col("rank") <= k)
    return top.groupBy("item").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k).select("item", "least")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0, exactly.

    Only documents of ``docs`` (doc_id, text) that hold a term of an item get postings. ``items`` has item_id and text.
    """
    wanted = counted(_numbered(items.select("item_id", "text"), "item_id"))
    held = counted(_numbered(docs.select("doc_id", "text"), "doc_id"), term_filter(items.select("text")))
    size = held.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    if not size["terms"]:
        return _ranked(wanted.limit(0).selectExpr("row AS item", "id AS item_id", "row", "id AS doc_id", "0L AS score"), k)
    m = F.expr(f"25 + (75 * n * {size['docs']}L) div {size['terms']}L")
    postings = settle(held.select("row", "id", m.alias("m"), F.explode("terms").alias("t")).select(
        "row", F.col("id").alias("doc_id"), "t.term", F.expr("(1000000000 * t.tf) div (1000 * t.tf + 8 * m)").alias("part")), "postings")

    # A term's documents and its largest part; terms that only the filter let through meet no item.
    known = postings.groupBy("term").agg(F.count("*").alias("df"), F.max("part").alias("most"))
    asked = wanted.select(F.col("row").alias("item"), F.col("id").alias("item_id"), F.explode("terms").alias("t")).select(
        "item", "item_id", "t.term", "t.tf").join(known, "term")
    asked = asked.withColumn("times", F.col("tf") * weight(size["docs"], F.col("df")))
    order = Window.partitionBy("item").orderBy("df", "term")
    asked = settle(asked.select(
        "item", "item_id", "term", "times", F.row_number().over(order).alias("place"),
        F.coalesce(F.sum(F.col("times") * F.col("most")).over(order.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)).alias("after")), "asked")

    last = asked.agg(F.max("place")).first()[0] or 0
    partial, open_terms, closed, place, step = None, asked, None, 0, FIRST
    finished: list[DataFrame] = []
    while place < last:
        place, step = place + step, step * 2
        now = open_terms.where((F.col("place") > place - step // 2) & (F.col("place") <= place))
        gained = postings.join(now, "term").select("item", "row", "doc_id", (F.col("times") * F.col("part")).alias("score"))
        both = gained if partial is None else partial.unionByName(gained)
        partial = settle(both.groupBy("item", "row").agg(F.first("doc_id").alias("doc_id"), F.sum("score").alias("score")), "partial")
        # What comes after this round's last term, for the items that have one.
        bound = open_terms.groupBy("item").agg(
            F.coalesce(F.min(F.when(F.col("place") <= place, F.col("after"))), F.lit(0)).alias("after"))
        state = settle(bound.join(_best(partial, k), "item", "left").select(
            "item", "after", F.coalesce("least", F.lit(0)).alias("least"), F.expr("after < coalesce(least, 0) OR after = 0").alias("closed")), "state")
        ended = state.where("closed")
        # A document can still come among the best only if it reaches the kth partial score.
        alive = partial.join(ended, "item").where(F.col("score") + F.col("after") >= F.col("least")).select("item", "row", "doc_id", "score")
        rest = open_terms.where(F.col("place") > place).join(ended.select("item"), "item", "left_semi")
        finished.append(_completed(alive, rest, postings))
        partial = partial.join(ended.select("item"), "item", "left_anti")
        open_terms = settle(open_terms.join(ended.select("item"), "item", "left_anti"), "open")
    scores = finished[0] if finished else asked.limit(0).selectExpr("item", "item AS row", "item AS doc_id", "times AS score")
    for more in finished[1:]:
        scores = scores.unionByName(more)
    ids = wanted.select(F.col("row").alias("item"), F.col("id").alias("item_id"))
    return _ranked(scores.join(ids, "item"), k)


def _completed(alive: DataFrame, rest: DataFrame, postings: DataFrame) -> DataFrame:
    """``alive`` (item, row, doc_id, score) with what the terms of ``rest`` add, looked up by document and term."""
    alive = settle(alive, "alive")
    asked = alive.select("item", "row").join(rest.select("item", "term", "times"), "item")
    more = asked.join(postings.select("row", "term", "part"), ["row", "term"]).select(
        "item", "row", F.lit(None).cast("long").alias("doc_id"), (F.col("times") * F.col("part")).alias("score"))
    return settle(alive.unionByName(more).groupBy("item", "row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("score").alias("score")), "scores")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return scores.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


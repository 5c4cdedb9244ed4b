"""Language of web pages by Bayesian evidence fusion.

Text: likelihood of the visible text's byte trigrams under a model per language, fitted on at most ``SAMPLE`` documents of each
language and tempered, as neighbouring trigrams are not independent. It gives each page a first distribution over
languages. Grouped sums of these say how often a language comes with a declared ``lang`` attribute or with an address suffix, and what
hosts hold: a host's prior is smoothed by its domain's, that by the whole table's, and a page doesn't count
in its own host's. The product of prior and likelihoods, scaled to 1, is the result.

A NULL or empty page has its language from the other evidence. A NULL or odd address has an empty host; pages without
a declared language have '' there. Repeated rows count as often as they occur. An empty table gives an empty result; without
documents of known language the language is NULL. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineside.llm.common import settle, slices, text_bytes

SAMPLE = 300
BUCKETS = 1 << 15
TEMPER = 60.0  # trigrams of a page count as so many at most
SMOOTH = 2.0  # pages that the level above adds to a group
_fold = np.arange(256, dtype=np.uint32)
_fold[65:91] += 32
_fold[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every byte trigram; A-Z folded, other ASCII than letters as a blank."""
    raw, at = text_bytes(column)
    if len(raw) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    b = _fold[raw]
    g = (b[:-2] * np.uint32(65536) + b[1:-1] * np.uint32(256) + b[2:]) * np.uint32(0x9E3779B1) >> np.uint32(17)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    own = (text[:-2] == text[2:]) & ~((b[:-2] == 32) & (b[1:-1] == 32))
    return text[:-2][own], g[own].astype(np.int64)


def text_model(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages of ``docs`` (doc_id, text, lang) in order, and log-probabilities of the buckets for each."""
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = settle(known.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= sample).drop("nth"), "chosen")
    languages = sorted(r["lang"] for r in chosen.select("lang").distinct().collect())  # few
    if not languages:
        return [], np.empty((0, BUCKETS), np.float32)
    texts = docs.select("doc_id", "text", F.col("lang").alias("_l")).join(F.broadcast(chosen), "doc_id").where(
        "_l = lang").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            text, bucket = trigrams(part.column("text"))
            lang = np.searchsorted(languages, part.column("lang").to_pylist())
            both, n = np.unique(lang[text] * BUCKETS + bucket, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both, pa.int64()), pa.array(n, pa.int64())], names=["k", "n"])

    rows = texts.mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets
    counts = np.full(len(languages) * BUCKETS, 0.2)
    counts[rows["k"].to_numpy(np.int64)] += rows["n"].to_numpy(float)
    counts = counts.reshape(len(languages), BUCKETS)
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def visible(html: Column) -> Column:
    """What is left of a page without scripts, styles, comments, tags and entities.

    What is never closed reaches to the end of the page, as in a browser, so no part of a page is looked through twice.
    """
    cut = F.regexp_replace(
        html, r"(?is)<(script|style)\b.*?(?:</\1\s*+>|\z)|<!--.*?(?:-->|\z)|<[a-z/!?][^>]*+(?:>|\z)", " ")
    return F.regexp_replace(cut, r"&[A-Za-z0-9#]{1,10};", " ")


def evidence(pages: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """page_id, declared, host, domain, suffix and p, the distribution by text alone."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    path = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:]+://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)", 1))
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b[^<>]*?\slang\s*+=\s*+[\"']?([A-Za-z]+)", 1))
    parts = pages.select(
        "page_id", declared.alias("declared"), host.alias("host"),
        F.substring_index(host, ".", -2).alias("domain"),
        F.concat_ws("/", F.substring_index(host, ".", -1), F.nullif(path, F.lit(""))).alias("suffix"),
        visible(F.coalesce("html", F.lit(""))).alias("text"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in slices(batches, "text"):
            text, bucket = trigrams(part.column("text"))
            n = np.maximum(np.bincount(text, minlength=part.num_rows), 1)
            ll = np.stack([np.bincount(text, row[bucket], part.num_rows) for row in m], axis=1)
            ll *= np.minimum(1.0, TEMPER / n)[:, None]
            p = np.exp(ll - ll.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            size = len(m)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("page_id", "declared", "host", "domain", "suffix")),
                 pa.ListArray.from_arrays(np.arange(0, size * part.num_rows + 1, size, dtype=np.int32), p.ravel())],
                names=["page_id", "declared", "host", "domain", "suffix", "p"])

    return parts.mapInArrow(
        read, "page_id long, declared string, host string, domain string, suffix string, p array<double>")


def identify(pages: DataFrame, docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per page (page_id, url, html): page_id, lang, probability, text_lang, declared, host."""
    languages, model = text_model(docs, sample)
    if not languages:
        return pages.select(
            F.col("page_id").cast("long").alias("page_id"), *[F.lit(None).cast(t).alias(c) for c, t in (
                ("lang", "string"), ("probability", "double"), ("text_lang", "string"), ("declared", "string"), ("host", "string"))])
    size = len(languages)
    page = settle(evidence(pages.withColumn("page_id", F.col("page_id").cast("long")), languages, model), "page-evidence")
    sums = [F.sum(F.get("p", F.lit(i))) for i in range(size)]

    def group(key: str) -> DataFrame:
        return page.groupBy(key).agg(F.array(*sums).alias(f"{key}_n"))

    every = page.agg(F.array(*sums).alias("all_n")).first()["all_n"]
    whole = [x or 0.0 for x in every]
    total = sum(whole)
    overall = F.array(*[F.lit((x + 1.0) / (total + size)) for x in whole])
    out = page
    for key in ("declared", "suffix", "host", "domain"):
        out = out.join(group(key), key, "left")

    def share(counts: Column, above: Column, own: Column) -> Column:
        """Counts without the page's own, smoothed by the level above."""
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.transform(counts, lambda x, i: (x - F.get(own, i) + SMOOTH * F.get(above, i)) / (n - 1.0 + SMOOTH))

    def likelihood(counts: Column) -> Column:
        """How often each language comes with this value: counts over the language's total."""
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        share_all = n / total if total else F.lit(1.0)
        return F.transform(counts, lambda x, i: (x + SMOOTH * share_all) / (F.get(F.array(*map(F.lit, whole)), i) + SMOOTH))

    out = out.withColumn("domain_p", share(F.col("domain_n"), overall, F.col("p")))
    out = out.withColumn("host_p", share(F.col("host_n"), F.col("domain_p"), F.col("p")))
    out = out.withColumn("declared_l", likelihood(F.col("declared_n"))).withColumn("suffix_l", likelihood(F.col("suffix_n")))
    product = F.transform("p", lambda x, i: (
        F.greatest(x, F.lit(1e-12)) * F.greatest(F.get("host_p", i), F.lit(1e-9)) * F.get("declared_l", i) * F.get("suffix_l", i)))
    out = out.withColumn("w", product).withColumn("best", F.array_max("w"))
    names = F.array(*[F.lit(x) for x in languages])

    def at_max(values: Column) -> Column:
        return F.get(names, (F.array_position(values, F.array_max(values)) - 1).cast("int"))

    return out.select(
        "page_id", at_max(F.col("w")).alias("lang"),
        (F.col("best") / F.aggregate("w", F.lit(0.0), lambda a, x: a + x)).alias("probability"),
        at_max(F.col("p")).alias("text_lang"), "declared", "host")

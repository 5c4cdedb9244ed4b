"""Quality rules as a learned decision list over statistics of the text.

Base statistics come first, and texts that fail the base rule go. What is left meets an ordered list of rules, each a
conjunction of thresholds on ratios of the statistics; the first rule that holds rejects the document, no rule keeps it.

The list is learned from labelled documents by sequential covering. A rule grows on two thirds of the rows that are not
covered yet, by the condition with the best information gain (FOIL), until it covers no good document or nothing helps;
it is pruned on the other third, by dropping last conditions while precision there does not fall; it enters the list only if it is
precise and covers enough there. Each step is one aggregate over all labelled rows: counts by feature and bin. The driver sees
these counts only (features x bins), never rows.

DataFrame functions only. A NULL text has no words and fails the base rule. Without labels, or with one class only, the list is empty.
Repeated rows count as often as they occur. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineside.llm.common import BLANK_CHARS, BLANKS, let, settle

# What counts as a symbol, and the base rule.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20

BINS = 24
MAX_RULES = 8
MAX_CONDITIONS = 3
PRECISION = 0.9
COVERED = 5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines"]
FEATURES = {
    "words": "double(n_words)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _covered_words(words: Column) -> Column:
    """Words inside windows that occur twice or more. Most texts have none, which a set of the windows' hashes shows."""
    def count(g: Column) -> Column:
        by_hash = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def total(s: Column) -> Column:
            def twice(x: Column, n: Column) -> Column:
                return (F.get(s, n - 1)["h"] == x["h"]) | (F.get(s, n + 1)["h"] == x["h"])

            at = F.sort_array(F.transform(F.filter(s, lambda x, n: F.coalesce(twice(x, n), F.lit(False))), lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
            step = lambda acc, i: F.struct(
                (i + WINDOW).alias("end"), (acc["n"] + F.least(F.lit(WINDOW), i + WINDOW - acc["end"])).alias("n"))
            return F.aggregate(at, start, step, lambda acc: acc["n"])

        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(by_hash, total))

    def windows(w: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(*[F.get(w, i + (j - 1)) for j in range(WINDOW)]))
        return F.when(F.size(w) > WINDOW, let(grams, count)).otherwise(F.lit(0))

    return let(words, windows)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics ``BASE`` of every text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANK_CHARS)) != "")
    packed = F.translate(text, BLANK_CHARS, "")
    upper = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")
    counts = let(words, lambda w: F.struct(F.size(w).alias("n_words"), _covered_words(w).alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return docs.select("doc_id", counts.alias("c"), by_line.alias("l"), *[
        c.cast("long").alias(n) for n, c in {
            "word_chars": F.length(packed),
            "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
            "n_upper": F.length(text) - F.length(upper),
        }.items()]).select("doc_id", *[
            (F.col(f"c.{n}") if n in ("n_words", "n_repeat_words") else F.col(f"l.{n}") if n in ("n_lines", "n_dup_lines")
             else F.col(n)).cast("long").alias(n) for n in BASE])


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule], F.lit(True))


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def _counts(rows: DataFrame, edges: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """Bad and good rows by feature and bin."""
    def bin_of(f: str, cuts: list[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(float(e)) for e in cuts]), lambda e: e < F.col(f)))

    bins = F.array(*[F.struct(F.lit(f).alias("f"), bin_of(f, cuts).alias("b")) for f, cuts in edges.items()])
    out = {f: [[0, 0] for _ in range(len(cuts) + 1)] for f, cuts in edges.items()}
    counted = rows.select("bad", F.inline(bins)).groupBy("f", "b").agg(
        F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    for r in counted.collect():
        out[r["f"]][r["b"]] = [r["bad"], r["good"]]
    return out


def _grow(rows: DataFrame, edges: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        counts = _counts(rows.where(_holds(rule)), edges)
        all_bad, all_good = (sum(b[i] for b in next(iter(counts.values()))) for i in (0, 1))
        if not all_bad or rule and not all_good:
            break
        best, found = 0.0, None
        for f, bins in counts.items():
            for n, cut in enumerate(edges[f]):
                for above in (True, False):
                    side = bins[n + 1:] if above else bins[:n + 1]
                    gain = _gain(sum(b for b, _ in side), sum(g for _, g in side), all_bad, all_good)
                    # Of cuts that do equally well the one that covers least.
                    if gain > best + 1e-9 or above and found and found.feature == f and found.above and gain > best - 1e-9:
                        best, found = gain, Condition(f, above, cut)
        if found is None or found in rule:
            break
        rule += (found,)
    return rule


def learn(labelled: DataFrame) -> list[Rule]:
    """Ordered rules that reject, from rows of statistics with a boolean ``bad``."""
    rows = settle(labelled.select(
        "bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grows"), *BASE,
        *[F.expr(e).alias(f) for f, e in FEATURES.items()]), "labelled-statistics")
    share = [i / BINS for i in range(1, BINS)]
    # Quantiles of each class: the few bad rows must have thresholds of their own.
    quantiles = rows.groupBy("bad").agg(*[F.percentile_approx(f, share, 10_000).alias(f) for f in FEATURES]).collect()
    if len(quantiles) < 2:
        return []
    edges = {f: sorted({x for r in quantiles for x in r[f]}) for f in FEATURES}
    rules: list[Rule] = []
    grow, prune = rows.where("grows"), rows.where("NOT grows")
    while len(rules) < MAX_RULES:
        rule = _grow(grow, edges)
        if not rule:
            break
        tests = [F.count_if(_holds(rule[:n]) & (F.col("bad") == bad)) for n in range(1, len(rule) + 1) for bad in (True, False)]
        seen = list(prune.agg(*tests).first())
        scores = [(bad / max(1, bad + good), bad) for bad, good in zip(seen[::2], seen[1::2])]
        n = max(range(len(rule)), key=lambda i: (scores[i][0], -i))
        if scores[n][0] < PRECISION or scores[n][1] < COVERED:
            break
        rules.append(rule[:n + 1])
        grow, prune = (x.where(~_holds(rule[:n + 1])) for x in (grow, prune))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, counted from 1, or 0."""
    out = None
    for n, rule in enumerate(rules, 1):
        out = F.when(_holds(rule), F.lit(n)) if out is None else out.when(_holds(rule), F.lit(n))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, ``BASE``, base_failed, rule (first that rejects, 0 for none) and kept for every row of ``docs``.

    ``labels`` has doc_id and quality (0 or 1, other values are not used); several labels of a document count each.
    """
    stats = settle(statistics(docs), "statistics")
    marked = labels.where("quality IN (0, 1)").select("doc_id", (F.col("quality") == 0).alias("bad"))
    rules = learn(stats.where(~base_failed()).join(marked, "doc_id"))
    out = stats.withColumn("base_failed", base_failed()).withColumn(
        "rule", F.when(F.col("base_failed"), F.lit(0)).otherwise(verdict(rules)).cast("int"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))

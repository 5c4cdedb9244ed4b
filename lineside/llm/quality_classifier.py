"""Quality classifier: Naive Bayes support vectors.

Features are indicators of n-grams, hashed into ``BUCKETS``: tokens, pairs of tokens, and triples of token shapes (letters
in lower, title or upper case, digits, symbols; whether the token repeats the one before). Tokens are runs of letters, digits or
other characters. An indicator is scaled by its class log-count ratio, a text's features to unit length, and a linear
hinge-loss model is fitted to them by dual coordinate descent with classes weighed alike. A logistic curve fitted
to the margins of the quarter of the sample that the model hasn't seen turns margins into probabilities.

The model is fitted in one task on at most ``SAMPLE`` labelled documents, those with the least hash of ``doc_id``, and has a fixed
size (a weight per bucket). Scoring reads every text in full. Only the text enters a score.

NULL and empty texts have no features and score as the curve has it at margin 0 plus bias. Without labels of both classes
the score is the share of label 1 (0.5 without labels). Repeated rows score alike. An empty table gives an empty
result. Other columns are returned as they are; one named ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineside.llm.common import MULTIPLIER, grams, hashes, mix, runs, slices, text_bytes

BUCKETS = 1 << 18
SAMPLE = 6_000
EPOCHS = 12
COST = 1.0
SMOOTH = 1.0
SCORE_TYPE = pa.float64()
_kind = np.full(256, 3, np.uint8)
_kind[[32, *range(9, 14)]] = 0
_kind[48:58] = 2
_kind[65:91] = 1
_kind[97:123] = 1
_kind[128:] = 1
_upper = np.zeros(256, np.int64)
_upper[65:91] = 1


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # one per bucket
    bias: float
    slope: float
    offset: float

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margins + self.bias) + self.offset, -40, 40)))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every feature, each once per text, in order."""
    raw, at = text_bytes(column)
    begin, end, first = runs(_kind[raw], at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    if not len(begin):
        return text, text
    word = hashes(raw, begin, end)
    ups = np.concatenate([[0], np.cumsum(_upper[raw])])
    n_up, kind = ups[end] - ups[begin], _kind[raw[begin]]
    shape = (kind.astype(np.int64) * 8 + np.minimum(n_up, 1) * 4 + ((n_up > 1) & (n_up * 2 >= end - begin)) * 2).astype(np.uint64)
    shape[1:] += ((word[1:] == word[:-1]) & (text[1:] == text[:-1])).astype(np.uint64)
    found = [(text, word)]
    for values, n, salt in ((word, 2, 1), (shape, 3, 2)):
        g = grams(values, n)
        own = text[:len(g)] == text[n - 1:]
        found.append((text[:len(g)][own], mix(g[own] * MULTIPLIER + np.uint64(salt))))
    texts = np.concatenate([t for t, _ in found])
    buckets = np.concatenate([h for _, h in found]) >> np.uint64(64 - 18)
    both = np.unique(texts.astype(np.int64) * BUCKETS + buckets.astype(np.int64))
    return both // BUCKETS, both % BUCKETS


def descend(rows: list[np.ndarray], x: list[np.ndarray], y: np.ndarray, cost: np.ndarray, seed: int = 1) -> np.ndarray:
    """Dual coordinate descent for the hinge loss; the last weight is the bias."""
    w = np.zeros(BUCKETS + 1)
    alpha = np.zeros(len(y))
    square = np.array([float(v @ v) + 1 for v in x])
    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in order.permutation(len(y)):
            g = y[i] * (w[rows[i]] @ x[i] + w[-1]) - 1
            new = min(max(alpha[i] - g / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * x[i]
                w[-1] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps on smoothed targets."""
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        s = p * (1 - p) + 1e-9
        ga, gb = ((p - target) * margins).sum() + 1e-3 * (a - 1), (p - target).sum()
        haa, hab, hbb = (s * margins * margins).sum() + 1e-3, (s * margins).sum(), s.sum() + 1e-9
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def fit_rows(rows: list[np.ndarray], good: np.ndarray) -> Model:
    share = (good.sum() + 1) / (len(good) + 2)
    if good.all() or not good.any():
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    seen = np.arange(len(good)) % 4 > 0
    if not (good[seen].any() and good[~seen].any() and not good[seen].all() and not good[~seen].all()):
        seen[:] = True
    counts = [np.full(BUCKETS, SMOOTH), np.full(BUCKETS, SMOOTH)]
    for i in np.flatnonzero(seen):
        counts[int(good[i])][rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    x = [ratio[r] / np.sqrt(max(1, len(r))) for r in rows]
    train = np.flatnonzero(seen)
    y = np.where(good, 1.0, -1.0)
    n_good = good[train].sum()
    weigh = COST * len(train) / 2 / np.where(good[train], n_good, len(train) - n_good)
    w = descend([rows[i] for i in train], [x[i] for i in train], y[train], weigh)
    held = np.flatnonzero(~seen) if not seen.all() else train
    slope, offset = curve(np.array([w[rows[i]] @ x[i] + w[-1] for i in held]), good[held])
    return Model((w[:-1] * ratio).astype(np.float32), float(w[-1]), slope, offset)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``labels`` (doc_id, label 0 or 1) on ``docs`` (doc_id, text)."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND label IN (0, 1)").select("doc_id", "label")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample))  # so it may be broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            text, bucket = features(part.column("text"))
            starts = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("label").cast(pa.int32()),
                 pa.ListArray.from_arrays(starts, bucket.astype(np.int32))], names=["doc_id", "label", "buckets"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(d, y, np.array(b, np.int64)) for batch in batches for d, y, b in zip(
            *(batch.column(c) if c == "buckets" else batch.column(c).to_pylist() for c in ("doc_id", "label", "buckets")))
            for b in [b.values.to_numpy(zero_copy_only=False) if b.values is not None else []]]
        seen.sort(key=lambda r: (r[0], r[1], len(r[2])))
        # Documents in the order of their ids need not be well mixed.
        mixed = np.random.default_rng(3).permutation(len(seen))
        model = fit_rows([seen[i][2] for i in mixed], np.array([seen[i][1] == 1 for i in mixed], bool))
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()], pa.binary()), *(pa.array([v]) for v in (model.bias, model.slope, model.offset))],
            names=["weights", "bias", "slope", "offset"])

    row = (
        texts.mapInArrow(extract, "doc_id long, label int, buckets array<int>").repartition(1)
        .mapInArrow(train, "weights binary, bias double, slope double, offset double").first())
    if row is None:
        return fit_rows([], np.empty(0, bool))
    return Model(np.frombuffer(bytes(row["weights"]), np.float32), row["bias"], row["slope"], row["offset"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` and ``score``, the probability of label 1."""
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in slices(batches, "text"):
            text, bucket = features(part.column("text"))
            total = np.bincount(text, m.weights[bucket], part.num_rows)
            n = np.bincount(text, minlength=part.num_rows)
            p = m.probability(total / np.sqrt(np.maximum(n, 1)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, SCORE_TYPE)], names=[*part.schema.names, "score"])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))

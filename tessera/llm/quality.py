"""Quality classifier: naive Bayes support vectors (Wang and Manning 2012).

Features are indicators of word n-grams (A-Z as a-z), n from 1 to 2, and of n-grams of token shapes (letter case, last
character, length, whether the token repeats the one before), n from 1 to 3, one indicator for each share of
the text that the n-gram reaches. Each is scaled by the log-count ratio of the classes; a
linear hinge-loss model is fitted on them by dual coordinate descent (Hsieh et al. 2008), and its
margins become probabilities by a logistic fit on out-of-fold margins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import shared, table
from tessera.llm.labelled import folds_of, scored, training_rows
from tessera.llm.lookup import word_hashes

BITS = 20
#: An n-gram's indicators: it makes up at least this share of the text's n-grams.
SHARES = np.array([0.0, 0.02, 0.1, 0.3])
#: Most labelled documents that the model is fitted on.
SAMPLE = 8000
THRESHOLD = 0.3

_CLASS = np.zeros(256, np.uint8)
_CLASS[33:128] = 4
_CLASS[48:58] = 3
_CLASS[65:91] = 2
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[[0, 127]] = 4
_CLASS[1:9] = _CLASS[14:32] = 4


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_POWERS: list = []
_BYTE_HASH = _mix(np.arange(256, 512, dtype=np.uint64))


def shapes(data: bytes) -> np.ndarray:
    """A number for each token's shape."""
    b = np.frombuffer(data, np.uint8)
    kind = _CLASS[b]
    ink = np.concatenate(([0], (kind > 0).astype(np.int8), [0]))
    step = np.diff(ink)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(start):
        return np.empty(0, np.uint64)
    length = end - start
    upper, lower, digit, mark = ((c := np.concatenate(([0], np.cumsum(kind == k))))[end] - c[start] for k in (2, 1, 3, 4))
    case = np.where(upper == 0, np.where(lower > 0, 1, 0), np.where(lower == 0, 2, np.where((upper == 1) & (kind[start] == 2), 3, 4)))
    last = np.where(kind[end - 1] == 4, b[end - 1], 0)
    run = np.minimum(mark, 3) * 2 + (digit > 0)
    # A sum over a token's bytes tells, with its length, whether it repeats the one before.
    sums_to = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE_HASH[b], dtype=np.uint64)))
    sums = sums_to[end] - sums_to[start]
    same = np.concatenate(([False], (sums[1:] == sums[:-1]) & (length[1:] == length[:-1])))
    size = np.searchsorted([3, 6, 10, 16], length)
    return ((((case * 256 + last) * 8 + run) * 5 + size) * 2 + same).astype(np.uint64)


def features(text: str | None) -> np.ndarray:
    """The indicators that are on, as distinct feature numbers."""
    s = shapes(text.encode("utf-8", "surrogatepass")) if text else np.empty(0, np.uint64)
    if not len(s):
        return np.zeros(1, np.int64)  # a feature of its own: no words
    words = word_hashes(pa.array([text]), _POWERS)[0].view(np.uint64)
    pairs = _mix(words[:-1]) + words[1:]
    found = [_mix(np.unique(w) + np.uint64(level)) >> np.uint64(64 - BITS) for level, w in ((101, words), (102, pairs))]
    for n in (1, 2, 3):
        if len(s) < n:
            break
        h = s[: len(s) - n + 1] + np.uint64(n << 32)
        for k in range(1, n):
            h = _mix(h) + s[k : len(s) - n + 1 + k]
        grams, counts = np.unique(h, return_counts=True)
        for level, share in enumerate(SHARES):
            on = grams[counts >= share * len(h)] if level else grams
            found.append(_mix(_mix(on) + np.uint64(level)) >> np.uint64(64 - BITS))
    return np.unique(np.concatenate(found)).astype(np.int64)


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    logs = []
    for label in (1, 0):
        counts = np.full(1 << BITS, alpha)
        for r, t in zip(rows, y, strict=True):
            if t == label:
                counts[r] += 1  # a row's features are distinct
        logs.append(np.log(counts / counts.sum()))
    return logs[0] - logs[1]


def hinge_fit(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, c: float = 0.05, epochs: int = 12) -> tuple[np.ndarray, float]:
    """Weights on the indicators, and a bias: L1-loss support vectors by dual coordinate descent.

    Solves min |w|^2/2 + c * sum max(0, 1 - y w.x) over the ratio-scaled indicators.
    """
    sign = np.where(y > 0, 1.0, -1.0)
    square = np.array([(v := ratio.take(r)) @ v + 1.0 for r in rows])
    w, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at = rows[i].astype(np.int64)
            # Looked up each time, as the values of all rows are twice the rows' size.
            value, own = ratio.take(at), w.take(at)
            slope = sign[i] * (own @ value + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), c)
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[at] = own + step * value
                bias += step
                alpha[i] = new
    return w * ratio, bias


def logistic_fit(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the probability, by Newton steps with Platt's smoothed targets."""
    up, down = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, v = p - target, p * (1 - p) + 1e-9
        ga, gb = g @ margin + 1e-6 * a, g.sum()
        haa, hab, hbb = v @ (margin * margin) + 1e-6, v @ margin, v.sum()
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-9:
            break
    return float(max(a, 1e-3)), float(b)


class Model:
    """Weights, bias and the logistic fit. Without both classes every score is the share of label 1, or 0.5."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray):
        self.constant = None
        if len(y) < 10 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        out, part = np.zeros(len(y)), folds_of(len(y), 3)
        for k in range(3):
            train = np.flatnonzero(part != k)
            if y[train].min() == y[train].max():
                continue
            mine = [rows[i] for i in train]
            w, bias = hinge_fit(mine, y[train], log_count_ratios(mine, y[train]))
            for i in np.flatnonzero(part == k):
                out[i] = w[rows[i]].sum() + bias
        self.slope, self.offset = logistic_fit(out, y)
        w, self.bias = hinge_fit(rows, y, log_count_ratios(rows, y))
        self.w = w.astype(np.float32)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        margin = np.array([self.w[features(t)].sum() for t in texts]) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> Model:
    """Fit in one task of the cluster, on at most `most` labelled documents: neither texts nor features reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).astype(np.int32) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["f", "y"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import cloudpickle

        rows, y = [], []
        for batch in batches:
            lists = batch.column(0)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            rows += [flat[ends[i] : ends[i + 1]] for i in range(len(lists))]
            y += (batch.column(1).to_numpy() > 0).astype(float).tolist()
        order = sorted(range(len(rows)), key=lambda i: (len(rows[i]), rows[i].tobytes(), y[i]))  # whatever order they came in
        model = Model([rows[i] for i in order], np.array([y[i] for i in order]))
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(model)], pa.binary())], names=["model"])

    from pyspark import cloudpickle

    known = training_rows(docs, labels, label, most).mapInArrow(run, "f array<int>, y double")
    models = known.repartition(1).mapInArrow(fit, "model binary").collect()
    return cloudpickle.loads(bytes(models[0][0])) if models else Model([], np.empty(0))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD, most: int = SAMPLE) -> DataFrame:
    """docs(doc_id, text, ...) with held_out, score and predicted.

    The score reads the whole text and nothing else. Null and empty texts, and texts of white space,
    share one feature and so one score. Equal texts score equally; repeated rows stay. An empty table
    gives an empty result; without labels of both classes the score is constant.
    """
    model = shared(docs.sparkSession, train(docs, labels, label, most))  # 4 MB, whatever the input
    return scored(docs, lambda texts: model()(texts), threshold)


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")

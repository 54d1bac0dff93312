"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words, and stems of 4 letters, that toxic training documents hold far more
often than others. Features are densities of lexicon hits, hits near second-person words,
capitals, punctuation and obfuscation rates (letters mixed with digits or marks inside a
word, stretched letters, hits that appear only after undoing such spelling).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import shared, table
from tessera.llm.labelled import folds_of, scored, training_rows

#: Most labelled documents that lexicon and trees are fitted on.
SAMPLE = 8000
THRESHOLD = 0.5
#: Words of direct address in the languages served.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros os".split()
)
#: How many words from a second-person word still count as near.
NEAR = 4
STEM = 4
#: Marks and digits that stand for letters.
UNDO = str.maketrans("013457@$!*", "oieastasi_")
_word = re.compile(r"[^\W\d_]+").findall
_odd = re.compile(r"(?<![^\W_])[^\W\d_]++[\d@$!*]++[^\W\d_]++").findall
_stretched = re.compile(r"([^\W\d_])\1{2,}").findall

NAMES = (
    "word_density", "stem_density", "severe_density", "mean_weight", "top_weight", "hits_log", "kinds_log", "near_you",
    "you_density", "capitals", "shouted", "exclaimed", "questioned", "marks", "obfuscated", "undone_hits", "stretched", "tokens_log",
)


class Lexicon:
    """Weights (log odds) of words and of 4-letter stems; at most `most` of each."""

    def __init__(self, toxic: Counter, clean: Counter, n_toxic: int, n_clean: int, most: int = 1000):
        weigh = {}
        for entry, up in toxic.items():
            down = clean.get(entry, 0)
            odds = np.log((up + 0.5) / (n_toxic + 1)) - np.log((down + 0.5) / (n_clean + 1))
            if up >= 4 and odds >= 2.0:
                weigh[entry] = (up * odds, float(odds))
        best = sorted(weigh, key=lambda e: (-weigh[e][0], e))
        self.words = {e[1]: weigh[e][1] for e in [e for e in best if e[0] == "w"][:most]}
        self.stems = {e[1]: weigh[e][1] for e in [e for e in best if e[0] == "s"][:most]}


def _entries(words: set[str]) -> set[tuple[str, str]]:
    return {("w", w) for w in words if len(w) > 2} | {("s", w[:STEM]) for w in words if len(w) > STEM}


def learn_lexicon(texts: list[str], y: np.ndarray) -> Lexicon:
    counts, n = (Counter(), Counter()), [0, 0]
    for text, label in zip(texts, y, strict=True):
        counts[int(label)].update(_entries(set(_word(text.lower()))))
        n[int(label)] += 1
    return Lexicon(counts[1], counts[0], n[1], n[0])


def features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    out = np.zeros(len(NAMES))
    if not text:
        return out
    low = text.lower()
    words = _word(low)
    n, chars = len(words), len(text)
    if n:
        whole, stems = lexicon.words, lexicon.stems
        at = [i for i, w in enumerate(words) if w in whole or w[:STEM] in stems]
        hit = [max(whole.get(words[i], 0.0), stems.get(words[i][:STEM], 0.0)) for i in at]
        you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        out[0] = sum(words[i] in whole for i in at) / n
        out[1] = len(at) / n
        if at:
            out[2] = sum(h >= 4 for h in hit) / n
            out[3], out[4] = sum(hit) / len(hit), max(hit)
            out[5], out[6] = np.log1p(len(at)), np.log1p(len({words[i] for i in at}))
            if you:
                gap = np.searchsorted(you, at)
                left, right = np.asarray([-(10**9), *you])[gap], np.asarray([*you, 10**9])[gap]
                out[7] = float(np.mean(np.minimum(np.subtract(at, left), np.subtract(right, at)) <= NEAR))
        out[8] = len(you) / n
        odd = _odd(low)
        if odd:
            out[14] = len(odd) / n
            plain = [o.translate(UNDO) for o in odd]
            out[15] = sum(p in whole or p[:STEM] in stems for p in plain) / n
    letters = sum(map(len, words))
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    capitals = int(np.count_nonzero((data >= 65) & (data <= 90)))
    out[9] = capitals / max(letters, 1)
    out[10] = sum(map(str.isupper, text.split())) / max(n, 1) if capitals else 0.0
    out[11], out[12] = text.count("!") / chars, text.count("?") / chars
    out[13] = (chars - letters - text.count(" ") - text.count("\n")) / chars
    out[16] = len(_stretched(low)) / max(n, 1)
    out[17] = np.log1p(n)
    return out


class Trees:
    """Boosted trees of depth 3 on binned features, logistic loss, Newton leaves."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.15, depth: int = 3, least: int = 5):
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 33)[1:-1])) for c in x.T]
        cuts = [np.unique(np.concatenate((c, [0.0]))) if (col == 0).any() else c for c, col in zip(cuts, x.T, strict=True)]
        bins = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T, strict=True)], 1)
        width, margin = max(map(len, cuts)) + 1, np.full(len(y), self.base)
        features_n = x.shape[1]
        self.trees = []
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            node, splits = np.zeros(len(y), np.int64), []
            for level in range(depth):
                nodes = 1 << level
                flat = (node[:, None] * features_n + np.arange(features_n)) * width + bins
                shape = (nodes, features_n, width)
                size = nodes * features_n * width
                sums = [np.bincount(flat.ravel(), np.repeat(v, features_n), size).reshape(shape).cumsum(2) for v in (g, h, np.ones(len(y)))]
                gl, hl, nl = sums
                gt, ht, nt = (s[:, :, -1:] for s in sums)
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(nl < least) | (nt - nl < least)] = 0
                best = gain.reshape(nodes, -1).argmax(1)
                f, b = best // width, best % width
                none = gain.reshape(nodes, -1).max(1) <= 1e-9
                cut = np.array([np.inf if none[k] or b[k] >= len(cuts[f[k]]) else cuts[f[k]][b[k]] for k in range(nodes)])
                splits.append((f, cut))
                node = 2 * node + (x[np.arange(len(y)), f[node]] > cut[node])
            leaf = -np.bincount(node, g, 1 << depth) / (np.bincount(node, h, 1 << depth) + 1) * rate
            margin = margin + leaf[node]
            self.trees.append((splits, leaf))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        margin, rows = np.full(len(x), self.base), np.arange(len(x))
        for splits, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for f, cut in splits:
                node = 2 * node + (x[rows, f[node]] > cut[node])
            margin += leaf[node]
        return margin


class Isotonic:
    """Pool adjacent violators; between the pools' means the probability is linear."""

    def __init__(self, margin: np.ndarray, y: np.ndarray):
        order = np.argsort(margin, kind="stable")
        pools: list[list[float]] = []  # mean of y, weight, mean margin
        for m, t in zip(margin[order], y[order], strict=True):
            pools.append([float(t), 1.0, float(m)])
            while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
                v, w, c = pools.pop()
                u = pools[-1]
                total = u[1] + w
                pools[-1] = [(u[0] * u[1] + v * w) / total, total, (u[2] * u[1] + c * w) / total]
        self.at = np.array([p[2] for p in pools])
        self.to = np.clip([p[0] for p in pools], 0.5 / len(y), 1 - 0.5 / len(y))

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.at, self.to)


class Model:
    """Lexicon, trees and calibration; without both classes every score is the share of label 1, or 0."""

    def __init__(self, texts: list[str], y: np.ndarray):
        self.constant = None
        if len(y) < 10 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.0
            return
        out, part = np.zeros(len(y)), folds_of(len(y), 3)
        for k in range(3):
            # The lexicon too is learned without the fold that it is tried on.
            train, test = np.flatnonzero(part != k), np.flatnonzero(part == k)
            if y[train].min() == y[train].max():
                continue
            mine = learn_lexicon([texts[i] for i in train], y[train])
            x = np.stack([features(t, mine) for t in texts])
            out[test] = Trees(x[train], y[train])(x[test])
        self.isotonic = Isotonic(out, y)
        self.lexicon = learn_lexicon(texts, y)
        self.trees = Trees(np.stack([features(t, self.lexicon) for t in texts]), y)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return self.isotonic(self.trees(np.stack([features(t, self.lexicon) for t in texts])))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = SAMPLE) -> Model:
    """Fit in one task of the cluster, on at most `most` labelled documents: their texts never reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import cloudpickle

        rows = sorted((t or "", float(v > 0)) for b in batches for t, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        model = Model([t for t, _ in rows], np.array([v for _, v in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(model)], pa.binary())], names=["model"])

    from pyspark import cloudpickle

    rows = training_rows(docs, labels, label, most).coalesce(1).mapInArrow(run, "model binary").collect()
    return cloudpickle.loads(bytes(rows[0][0])) if rows else Model([], np.empty(0))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, most: int = SAMPLE) -> DataFrame:
    """docs(doc_id, text, ...) with held_out, score and predicted.

    The score reads the whole text and nothing else. Null and empty texts have features of zero and
    so one score. Equal texts score equally; repeated rows stay. An empty table gives an empty result;
    without labels of both classes the score is constant.
    """
    model = shared(docs.sparkSession, train(docs, labels, label, most))  # under 1 MB, whatever the input
    return scored(docs, lambda texts: model()(texts), threshold)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")

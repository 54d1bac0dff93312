"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

For an item of n words every run of n words of a document is a window, and its fingerprint the 128-bit SimHash of its 5-word
shingles. The index files each item under the 8 blocks of 16 bits of its fingerprint, with all values within 1 bit; a window looks up
each of its blocks with all values within 2 bits. So it meets every item that agrees with it to 3 bits in some
block, and no fingerprint within 31 bits is missed (8 x 4 = 32). Pairs in the radius are compared exactly: weighted Jaccard
similarity, a shingle's weight its number of occurrences.

Only windows that can reach the similarity are fingerprinted: at similarity s two bags of x and y shingles share at least
s / (1 + s) (x + y), so as many of the window's shingles must occur in items of that length at all. That bound loses nothing.
At similarity 0.8 about a ninth of the bits differ; 31 of 128 is over four deviations off (measured recall: tests).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import shared, table, words
from tessera.llm.lookup import Map, mix, slices, word_hashes
from tessera.llm.simhash import shingle_hashes

WIDTH = 5
SIMILARITY = 0.8
#: Bits of a fingerprint that may differ; blocks of 16 bits, and within how many bits items and windows are filed and looked up.
RADIUS, BLOCKS, FILED, ASKED = 31, 8, 1, 2
#: Most bytes of item text that one broadcast index holds; more items are searched block by block.
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 1 << 20


def _near(bits: int) -> np.ndarray:
    """All 16-bit numbers with at most so many bits."""
    return np.array([sum(1 << b for b in c) for k in range(bits + 1) for c in combinations(range(16), k)], np.int64)


_FILE, _ASK = _near(FILED), _near(ASKED)


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """A number >= 0 for each run of width word hashes."""
    n = len(hashes) - width + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n].view(np.uint64)
    return (mix(total) >> np.uint64(1)).view(np.int64)


def _fingerprints(shingles: np.ndarray) -> np.ndarray:
    """(k, n) hashes of the shingles of k windows -> (k, BLOCKS) blocks: bits set in over half of the hashes."""
    both = np.stack((shingles, mix(shingles)), axis=-1).astype(">u8").view(np.uint8)
    bits = np.unpackbits(both.reshape(*shingles.shape, 2 * BLOCKS), axis=-1)
    return np.packbits(2 * bits.sum(1, dtype=np.int64) > shingles.shape[1], axis=1).view(">u2").astype(np.int64)


def _shingles(tokens: list[bytes], width: int) -> np.ndarray:
    return shingle_hashes(tokens, width).view(">u8").ravel().astype(np.uint64)


def _by_id(row: tuple) -> tuple:
    return (row[0] is not None, *row)


class Items:
    """An index of benchmark items."""

    def __init__(self, rows: list[tuple[int, str]], similarity: float = SIMILARITY):
        self.similarity, self.items, self.kinds, self.totals, self.powers = similarity, [], [], [], []
        groups: dict[tuple[int, int], int] = {}
        anchors: dict[int, list[np.ndarray]] = {}
        prints, group_of = [], []
        for item, text in rows:
            tokens = words(text)
            if not tokens:
                continue
            width = min(WIDTH, len(tokens))
            group = groups.setdefault((len(tokens), width), len(groups))
            runs = _runs(word_hashes(pa.array([text]), self.powers)[0], width)
            anchors.setdefault(width, []).append(np.stack((runs, np.full(len(runs), group)), axis=1))
            shingles = _shingles(tokens, width)
            self.items.append(item)
            self.kinds.append(np.unique(shingles, return_counts=True))
            self.totals.append(len(shingles))
            prints.append(_fingerprints(shingles[None])[0])
            group_of.append(group)
        self.groups = list(groups)
        #: For each shingle width the runs of items' words, and the groups of items that hold each.
        self.anchors = {}
        for width, pairs in anchors.items():
            pairs = np.unique(np.concatenate(pairs), axis=0)
            runs, first = np.unique(pairs[:, 0], return_index=True)
            self.anchors[width] = (Map(runs, np.arange(len(runs))), np.concatenate((first, [len(pairs)])), pairs[:, 1])
        self.prints = np.array(prints, np.int64).reshape(-1, BLOCKS)
        filed = self._keys(np.array(group_of, np.int64), self.prints)[:, :, None] ^ _FILE
        owner = np.repeat(np.arange(len(prints)), BLOCKS * len(_FILE))
        order = np.argsort(filed.ravel(), kind="stable")
        self.owner = owner[order]
        self.keys, first = np.unique(filed.ravel()[order], return_index=True)
        self.first = np.concatenate((first, [len(order)]))

    @staticmethod
    def _keys(group: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return ((group[:, None] * BLOCKS + np.arange(BLOCKS)) << 16) | prints

    def near(self, group: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item): the pairs within the radius, by the index."""
        asked = self._keys(np.full(len(prints), group), prints)[:, :, None] ^ _ASK
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        window, block, mask = np.nonzero(self.keys[at] == asked)
        at = at[window, block, mask]
        many = self.first[at + 1] - self.first[at]
        item = self.owner[np.repeat(self.first[at] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        pairs = np.unique(np.repeat(window, many) * len(self.items) + item)
        window, item = pairs // len(self.items), pairs % len(self.items)
        close = np.bitwise_count(prints[window] ^ self.prints[item]).sum(1) <= RADIUS
        return window[close], item[close]

    def scan(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, int, float]]]]:
        """(place, matches) of the texts that match; a match is (item, first word, words, similarity) of an item's best window."""
        hashes, sizes = word_hashes(texts, self.powers)
        ends = np.cumsum(sizes)
        found: dict[int, list] = {}
        for width, (known, first, groups) in self.anchors.items():
            run = known(_runs(hashes, width))
            at = np.flatnonzero(run >= 0)
            doc = np.searchsorted(ends, at, "right")
            whole = at + width <= ends[doc]
            at, doc = at[whole], doc[whole]
            for own in np.split(np.arange(len(at)), np.flatnonzero(np.diff(doc)) + 1) if len(at) else ():
                i = int(doc[own[0]])
                places, runs = at[own] - (ends[i] - sizes[i]), run[at[own]]
                many = first[runs + 1] - first[runs]
                of = groups[np.repeat(first[runs] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
                places = np.repeat(places, many)
                found.setdefault(i, []).extend(self._document(words(texts[i].as_py()), width, places, of))
        for i in sorted(found):
            best = {}
            for item, start, n, score in found[i]:
                if item not in best or (-score, start) < (-best[item][2], best[item][0]):
                    best[item] = (start, n, score)
            if best:
                yield i, sorted(((self.items[item], *rest) for item, rest in best.items()), key=_by_id)

    def matches(self, text: str | None) -> list[tuple[int, int, int, float]]:
        return next((m for _, m in self.scan(pa.array([text], pa.string()))), [])

    def _document(self, tokens: list[bytes], width: int, places: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """Matches among the windows with enough shingles (at places) that items of a group (of) hold."""
        count = max(len(tokens) - width + 1, 1)
        order = np.lexsort((places, of))
        places, of = places[order], of[order]
        for own in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1):
            group, p = int(of[own[0]]), places[own]
            total = self.groups[group][0] - width + 1
            size = min(total, count)
            need = max(1, int(np.ceil(self.similarity / (1 + self.similarity) * (total + size) - 1e-9)))
            if len(p) < need:
                continue
            low, high = np.maximum(p[need - 1 :] - size + 1, 0), np.minimum(p[: len(p) - need + 1], count - size)
            low, high = low[low <= high], high[low <= high]
            if not len(low):
                continue
            many = high - low + 1
            starts = np.unique(np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum()))
            for k in range(0, len(starts), 256):
                yield from self._windows(tokens, width, group, size, starts[k : k + 256])

    def _windows(self, tokens: list[bytes], width: int, group: int, size: int, starts: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        at = starts[:, None] + np.arange(size)
        used, place = np.unique(at, return_inverse=True)
        hashes = np.concatenate([_shingles(tokens[p : p + width], width) for p in used.tolist()])
        shingles = hashes[place].reshape(at.shape)
        window, item = self.near(group, _fingerprints(shingles))
        for i, j in zip(window.tolist(), item.tolist(), strict=True):
            kinds, weights = self.kinds[j]
            place = np.minimum(np.searchsorted(kinds, shingles[i]), len(kinds) - 1)
            place = place[kinds[place] == shingles[i]]
            both = int(np.minimum(np.bincount(place, minlength=len(kinds)), weights).sum())
            score = both / (self.totals[j] + size - both)
            if score >= self.similarity:
                yield j, int(starts[i]), size + width - 1, score


def indexes(benchmark: DataFrame, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES) -> Iterator[Callable[[], Items]]:
    """Broadcast indexes of at most about block_bytes of item text each, together of all items."""
    rows = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    for k in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        yield shared(benchmark.sparkSession, Items(sorted((tuple(r) for r in part.collect()), key=_by_id), similarity))


def contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): a row for each document and item with a
    window at the similarity or above, its best window, the first of equals.

    Texts are words between [\\x20\\x09-\\x0D]+, A-Z lower-cased; an item of fewer than 5 words is one shingle.
    A document shorter than an item is one window. Null and empty texts and items match nothing.
    Repeated rows are judged each on its own; extra columns are not read; empty tables give no rows.
    """
    schema = T.StructType(
        [docs.schema["doc_id"], benchmark.schema["item_id"]]
        + [T.StructField("start_word", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("similarity", T.DoubleType())]
    )
    out = None
    for index in indexes(benchmark, similarity):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(a, n) for b in batches for a, n in slices(b.column(1), SLICE_BYTES)):
                rows = [(i, m) for i, own in index().scan(batch.column(1)) for m in own]
                ids = batch.column(0).take(pa.array([i for i, _ in rows], pa.int64()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
                rest = [pa.array([m[k] for _, m in rows], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([ids, *rest], names=["doc_id", "item_id", "start_word", "n_words", "similarity"])

        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs without the documents that hold a passage of the benchmark, in the same scan; all columns pass."""
    at = docs.columns.index("text")
    for index in indexes(benchmark, similarity):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(a, n) for b in batches for a, n in slices(b.column(at), SLICE_BYTES)):
                clean = np.ones(batch.num_rows, bool)
                clean[[i for i, _ in index().scan(batch.column(at))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Groups of documents of similar word shingles: candidates, then the exact similarity.

Two texts are near copies if their sets of five-word shingles have a Jaccard similarity of at
least 0.8. At that similarity 64-bit fingerprints differ in up to 17 bits and more, where no
key of equal bits is selective. So to the links of fingerprints come bands of eight minima: a
pair of similarity s meets in one of 48 bands with probability 1 - (1 - s^8)^48, 0.9998 at
0.8. Both only propose. Documents that proposals connect form a candidate group; within each,
an inverted index of the shingles gives every pair's exact similarity, and a spanning forest of
the links leaves the task. A large candidate group is dealt into blocks of bounded weight, and
every two blocks meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, words
from tessera.llm.components import components
from tessera.llm.simhash import links, majority, shingle_hashes

WIDTH = 5
LEAST = 0.8
ROWS, BANDS = 8, 48
#: Characters of text that a block of a candidate group holds, about.
BLOCK = 8_000_000
#: Salts of a band key in the join, so that a key of many texts is split.
SALTS = 8


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The set of big-endian hashes, as sorted numbers."""
    return np.unique(hashes.reshape(-1).view(">u8").astype(np.uint64))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingle hashes of a text; a text of fewer words is one shingle, one of none has none."""
    return distinct(shingle_hashes(words(text), width))


@cache
def _mixes(how_many: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    turn = draw.integers(0, 2**32, how_many, np.uint32)
    return turn, draw.integers(0, 2**31, how_many, np.uint32) * np.uint32(2) + np.uint32(1)


def minima(hashes: np.ndarray, how_many: int = ROWS * BANDS, seed: int = 11) -> np.ndarray:
    """The least value of each of how_many mixes of the hashes."""
    turn, scale = _mixes(how_many, seed)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(how_many, 2**32 - 1, np.uint32)
    for at in range(0, len(short), 256):
        np.minimum(least, ((short[at : at + 256, None] ^ turn) * scale).min(axis=0), out=least)
    return least


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, a, b, fp, bands): 128 bits of the shingle set, the fingerprint, the band keys."""
    import xxhash

    for batch in batches:
        a, b, fps, bands = [], [], [], []
        for text in batch.column(1):
            hashes = shingle_hashes(words(text.as_py()), WIDTH)
            fps.append(majority(hashes))
            own = distinct(hashes)
            digest = np.frombuffer(xxhash.xxh128_digest(own.tobytes()), ">i8")
            a.append(int(digest[0]))
            b.append(int(digest[1]))
            raw = minima(own).tobytes()
            width = 4 * ROWS
            keys = b"".join(xxhash.xxh64_digest(raw[k * width : (k + 1) * width], k) for k in range(BANDS))
            bands.append(np.frombuffer(keys, ">i8").astype(np.int64))
        ends = pa.array(np.arange(0, BANDS * (len(a) + 1), BANDS, dtype=np.int32))
        lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (a, b, fps)), lists], names=["id", "a", "b", "fp", "bands"])


def forest(sets: list[np.ndarray], least: float = LEAST) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets with a similarity of at least least, as positions. Empty sets are alike."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    part = Fraction(str(least))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    vocabulary, code = np.unique(np.concatenate(sets) if n else np.empty(0, np.uint64), return_inverse=True)
    order = np.argsort(code, kind="stable")
    posted = np.repeat(np.arange(n), sizes)[order]
    of, alive, links = code[order], np.ones(n, bool), []

    def index():
        counts = np.bincount(of, minlength=len(vocabulary))
        return counts, np.cumsum(counts) - counts, int(alive.sum())

    counts, starts, indexed = index()
    for first in range(n):
        if not alive[first]:
            continue
        alive[first] = False
        front = [first]
        while front and alive.any():
            at = front.pop()
            if 2 * alive.sum() < indexed:  # only sets without a link yet are looked for
                still = alive[posted]
                posted, of = posted[still], of[still]
                counts, starts, indexed = index()
            mine = code[ends[at] : ends[at + 1]]
            many = counts[mine]
            here = np.repeat(starts[mine] - np.cumsum(many) + many, many) + np.arange(many.sum())
            common = np.bincount(posted[here], minlength=n)
            union = sizes + sizes[at] - common
            found = np.flatnonzero(alive & (common * part.denominator >= union * part.numerator))
            alive[found] = False
            links += [(at, int(f)) for f in found]
            front += found.tolist()
    return links


def _links(group: pa.Table) -> pa.Table:
    ids = group.column("id").to_pylist()
    found = forest([shingle_set(t.as_py()) for t in group.column("text")])
    return pa.table({"u": pa.array([ids[x] for x, _ in found], pa.int64()), "v": pa.array([ids[y] for _, y in found], pa.int64())})


def proposals(nodes: DataFrame, sketches: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) nodes that fingerprints within the radius, or bands, bring together; each chain or band is a star."""
    firsts = scratch.keep(nodes.groupBy("fp").agg(F.min("node").alias("first")), "firsts")
    alike = nodes.join(firsts, "fp").select(F.col("node").alias("u"), F.col("first").alias("v"))
    close = scratch.keep(links(firsts.select("fp")), "links")
    close = (
        close.join(firsts.select(F.col("fp").alias("u"), F.col("first").alias("x")), "u")
        .join(firsts.select(F.col("fp").alias("v"), F.col("first").alias("y")), "v")
        .select(F.col("x").alias("u"), F.col("y").alias("v"))
    )
    probes = sketches.join(nodes, F.col("id") == F.col("node"), "left_semi").select("id", F.explode("bands").alias("key"))
    shared = probes.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).filter("n > 1")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    met = (
        probes.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        .join(shared.select("key", "first", salts.alias("salt")), ["key", "salt"])
        .select(F.col("id").alias("u"), F.col("first").alias("v"))
    )
    return met.unionByName(alike).unionByName(close)


def copies(docs: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """docs(id long, text) -> (id): the ids that are not the smallest of their group of near copies.

    Groups are the components of all links of a similarity of 0.8 or more. Null ids take no part. An id that
    repeats stands for all its texts. Texts without words are copies of each other.
    """
    docs = docs.filter("id is not null")
    sketches = scratch.keep(docs.mapInArrow(_sketches, "id long, a long, b long, fp long, bands array<long>"), "sketches")
    # Equal sets are one node, the smallest id's.
    nodes = scratch.keep(sketches.groupBy("a", "b").agg(F.min(F.struct("id", "fp")).alias("s")).select("a", "b", "s.fp", F.col("s.id").alias("node")), "nodes")
    rooted = scratch.keep(components(proposals(nodes, sketches, scratch), scratch), "candidates")
    texts = docs.join(rooted, F.col("id") == F.col("node")).select("id", "root", "text")
    weights = texts.groupBy("root").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.char_length("text")) / block)).alias("spread"))
    # Weights of one block are the rule, so only the few other groups are looked up.
    dealt = (
        texts.join(scratch.keep(weights.filter("spread > 1"), "large"), "root", "left")
        .withColumn("spread", F.coalesce("spread", F.lit(1).cast("long")))
        .withColumn("mine", F.pmod(F.xxhash64("id", F.lit(7)), F.col("spread")))
        .select("id", "text", "root", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("spread") - 1)).alias("other"))
        .select("id", "text", "root", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
    )
    linked = scratch.keep(dealt.groupBy("root", "p", "q").applyInArrow(lambda g: _links(g), "u long, v long"), "similar")
    far = components(linked, scratch).filter("node <> root").select(F.col("node").alias("id"))
    equal = sketches.drop("bands").join(nodes.select("a", "b", "node"), ["a", "b"]).filter("id <> node").select("id")
    return scratch.keep(far.unionByName(equal).distinct(), "copies")


def one_of_each(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """docs(doc_id, text, ...) with one row of each group of near copies: the smallest id's.

    Near copies have sets of five-word shingles with a Jaccard similarity of 0.8 or more. Of rows that repeat
    id and text one stays. Rows with a null id cannot be named as a group's smallest: they stay, once for each
    text. Texts without words, null or empty, are copies of each other. An empty table gives an empty result.
    """
    gone = copies(docs.select(F.col("doc_id").alias("id"), "text"), scratch or Scratch(docs.sparkSession))
    return docs.join(gone, docs["doc_id"] == gone["id"], "left_anti").dropDuplicates(["doc_id", "text"])

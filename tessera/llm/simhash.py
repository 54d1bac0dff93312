"""SimHash near-duplicates: fingerprints, pigeonring candidates, exact Hamming links, components.

Pigeonring. Cut 64 bits into 8 bytes around a ring. If two fingerprints differ in at most
3 bits, some byte starts a chain whose first k bytes differ in at most floor(3k/8) bits, for
every k from 1 to 8: none in 2 bytes, at most 1 in 5, 2 in 7 and 3 in 8. So for each start
the first two bytes are equal, and of the next three at most one differs: 8 starts times 3
choices of the byte left out give 24 join keys of 32 equal bits, and every link meets in one
of them. The rest of the chain is tested next, the full Hamming distance last.

Groups. Equal fingerprints are one row from the start. A key that many different
fingerprints share is dealt into blocks of bounded size, and every two blocks meet in one
task, which returns a spanning forest of its links (fewer rows than fingerprints), never
all pairs. Components of the forests are the components of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Scratch, table, words
from tessera.llm.components import components

RADIUS = 3
#: Most fingerprints of one key that a block holds, about.
BLOCK = 2048
#: (k bytes, most differing bits) at the end of each stretch of one budget.
CHAIN = ((2, 0), (5, 1), (7, 2), (8, 3))


def shingle_hashes(tokens: list[bytes], width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of width words, space-joined; of the whole when there are fewer. Big-endian bytes."""
    import xxhash

    if not tokens:
        return np.empty((0, 8), np.uint8)
    joined, n = b" ".join(tokens), len(tokens)
    if n <= width:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, n) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: n - width + 1].tolist()
        shingles = [joined[a:b] for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed))), np.uint8).reshape(-1, 8)


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of a text, as a signed long."""
    return majority(shingle_hashes(words(text), width, seed))


def majority(hashes: np.ndarray) -> int:
    """64 bits, as a signed long: a bit is 1 if it is set in over half of the hashes; 0 of none."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[at : at + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp): null and empty texts have fingerprint 0."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), width, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _keys(fp: str) -> F.Column:
    """The 24 keys: the ring turned to each start, two bytes and two of the next three, and which."""
    keys = []
    for start in range(8):
        turned = (
            F.col(fp)
            if not start
            else F.shiftleft(fp, 8 * start).bitwiseOR(F.shiftrightunsigned(fp, 64 - 8 * start))
        )
        for out in range(3):
            mask = sum(0xFF << (56 - 8 * k) for k in (0, 1, 2, 3, 4) if k != 2 + out)
            mask -= (mask >> 63) << 64
            keys.append(turned.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(3 * start + out)))
    return F.explode(F.array(*keys))


def chained(x: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Which differences x hold the chain's budgets from byte start on."""
    s = np.asarray(start, np.uint64) * np.uint64(8)
    turned = np.where(s == 0, x, (x << s) | (x >> ((np.uint64(64) - s) & np.uint64(63))))
    good = np.ones(np.shape(x), bool)
    for k, most in CHAIN:
        good &= np.bitwise_count(turned >> np.uint64(64 - 8 * k)) <= most
    return good


def forest(members: np.ndarray, start: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among members (uint64, distinct) whose chain begins at start."""
    left, ends = members, ([], [])
    while len(left) > 1:
        front, left = [left[-1]], left[:-1]
        while front and len(left):
            at = front.pop()
            x = left ^ at
            near = chained(x, start)
            near &= np.bitwise_count(x) <= radius
            if near.any():
                found = left[near]
                ends[0].append(np.full(len(found), at, np.uint64))
                ends[1].append(found)
                front += list(found)
                left = left[~near]
    return tuple(np.concatenate(e) if e else np.empty(0, np.uint64) for e in ends)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, members) -> (u, v)."""
    for batch in batches:
        us, vs = [], []
        start = (batch.column(0).to_numpy(zero_copy_only=False) & 0xFF) // 3
        lists = batch.column(1)
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        sizes = np.diff(ends)
        two = np.flatnonzero(sizes == 2)
        a, b = flat[ends[two]], flat[ends[two] + 1]
        near = chained(a ^ b, start[two])
        near &= np.bitwise_count(a ^ b) <= RADIUS
        us.append(a[near])
        vs.append(b[near])
        for i in np.flatnonzero(sizes > 2):
            u, v = forest(np.unique(flat[ends[i] : ends[i + 1]]), int(start[i]))
            us.append(u)
            vs.append(v)
        u, v = (np.concatenate(e).view(np.int64) for e in (us, vs))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """distinct(fp) -> (u, v): links that connect what all links within the radius connect."""
    probes = distinct.select("fp", _keys("fp").alias("key"))
    shared = probes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    spread = F.ceil(F.col("n") / block)
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("spread"))
    pairs = (
        probes.join(shared, "key")
        .withColumn("spread", spread)
        .withColumn("mine", mine)
        .select("key", "fp", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("spread") - 1)).alias("other"))
        .select("key", "fp", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
    )
    groups = pairs.groupBy("key", "p", "q").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1)
    return groups.select("key", "members").mapInArrow(_forests, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """(id, fingerprint, component_id): fingerprints link at 3 or fewer differing bits.

    component_id is the smallest id reachable over links, itself included. Empty and null
    texts have fingerprint zero and link like any other. Repeated rows stay, each with its
    component; a null id stays too, and never is the smallest unless alone. Extra columns
    are not read. An empty table gives an empty result.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    prints = scratch.keep(fingerprints(docs, id_col, text_col, width), "prints")
    firsts = scratch.keep(prints.groupBy("fp").agg(F.min("id").alias("first")), "firsts")
    edges = scratch.keep(links(firsts.select("fp")), "links")
    rooted = scratch.keep(components(edges, scratch), "rooted")
    small = rooted.join(firsts, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("first").alias("least"))
    # One row per fingerprint that has links; the others' component is their first id.
    of = rooted.join(small, "root").select(F.col("node").alias("fp"), "least")
    of = firsts.join(of, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return prints.join(of, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op2_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    return near_duplicates(table(spark, sf_dir, "documents"))

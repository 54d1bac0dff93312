"""Language-model scoring: corpus counts in Spark, a sharded n-gram trie in the shared folder, whole texts scored.

Pairs and triples seen at least LEAST times in the training texts, and all words, make the model, whatever the corpus;
words and n-grams are known by 63-bit hashes. Absolute discounting, interpolated: with a(y|x) = (n(xy) - D) / n(x) of a kept pair, 0 of
another, and l(x) = 1 - sum of a(y|x), p(y|x) = a(y|x) + l(x) p(y); a triple's a(z|xy) and l(xy) likewise over p(z|y). So
log10 p of a text is its unigram score and a sum of values: log l(x) for each word x that something follows,
log p(y|x) - log p(y) - log l(x) for a kept pair and log l(xy) for it as a context, log p(z|xy) - log l(xy) - log p(z|y) for a kept
triple.

The trie is dealt into shards by context, a context with the share RARE of all tokens or more by its successors too, so
none is hot. Words, pairs and triples with that share, at most 3 / RARE of them, are broadcast and
answered where the text is read, which changes no result and leaves no key heavy; for the rest each shard answers the
queries that are sent to it. Counts and queries are shuffled as packed sorted arrays, one for each shard and
task. Bitmaps of BITS bits pass every n-gram that is kept, and few others while these are fewer than its bits.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, fold, joined_by_share, shared, shuffle_partitions, small_batches, table
from tessera.llm.lookup import Map, mix, slices, word_hashes
from tessera.llm.triefile import Trie, short_key

#: An n-gram seen so often in the training texts is kept, at any corpus size.
LEAST = 2
DISCOUNT = 0.5
#: The share of all tokens from which an n-gram is broadcast.
RARE = 1e-6
BITS, SLOTS = 1 << 27, 64
#: About how many tokens' n-grams one shard holds, and how many n-grams a task gathers before it sends them.
SHARD, GATHERED = 1 << 20, 1 << 20
SLICE_BYTES = 1 << 19
#: The end of a text, and what stands before its first word, as a hash.
END = 0x2545F4914F6CDD1D
FOLDS, HELD_OUT = 7, 2


def _slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, n in slices(batch.column(at), SLICE_BYTES):
            yield batch.slice(a, n)


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A key >= 0 of each ordered pair of word hashes."""
    u = np.uint64
    return (mix(a.view(u) * u(0x9E3779B97F4A7C15) + b.view(u)) >> u(1)).view(np.int64)


def _triple_key(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """A key >= 0 of two pairs that share a word."""
    return k1 ^ ((k2 << 1 | k2 >> 62) & 0x7FFFFFFFFFFFFFFF)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """A key's shard, by its high bits."""
    return ((keys >> 31) * parts) >> 32


def _hashed(texts: pa.Array, powers: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of texts, END before and after each; where each pair that lies in one text begins; words of each text."""
    hashes, sizes = word_hashes(texts, powers)
    starts = np.concatenate(([0], np.cumsum(sizes + 2)))[:-1]
    seq = np.full(len(hashes) + 2 * len(sizes), END, np.int64)
    inner = np.ones(len(seq), bool)
    inner[starts] = inner[starts + sizes + 1] = False
    seq[inner] = hashes
    pair = np.ones(max(len(seq) - 1, 0), bool)
    pair[starts[1:] - 1] = False
    return seq, pair, sizes


def _pack(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpack(data, kinds: tuple) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(data, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _dealt(part: np.ndarray, keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, its rows with equal keys together) of each shard."""
    bits = (parts - 1).bit_length()
    order = np.argsort((part << (63 - bits)) | (keys >> bits))
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for own in np.split(order, cuts) if len(order) else ():
        yield int(part[own[0]]), own


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys without those that repeat the one before, and how often each stands there."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.concatenate((first, [len(keys)]))).astype(np.int32)


def _packed(rows: DataFrame, parts: int) -> DataFrame:
    """(shard, data): the rows of a table as packed arrays, dealt by their key, the first column."""
    kinds = {"bigint": np.int64, "float": np.float32, "int": np.int32}
    columns = [(c, kinds[t]) for c, t in rows.dtypes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held)
            own = [whole.column(c).to_numpy().astype(k, copy=False) for c, k in columns]
            for at, at_rows in _dealt(_part(own[0], parts), own[0], parts):
                data = _pack(*(c[at_rows] for c in own))
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([data], pa.binary())], names=["shard", "data"])

        for b in batches:
            held.append(b)
            size += b.num_rows
            if size > GATHERED:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    return rows.mapInArrow(run, "shard int, data binary")


def _unpacked(packed: DataFrame, kinds: tuple, of: Callable, schema: str) -> DataFrame:
    """A row for each element of of(columns), a dict of arrays, of each packed row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d in b.column(0):
                yield pa.RecordBatch.from_pydict(of(_unpack(d.as_buffer(), kinds)))

    return packed.select("data").mapInArrow(run, schema)


def _rows(column: pa.ChunkedArray, kinds: tuple) -> list[np.ndarray]:
    """The columns that _packed packed."""
    got = [_unpack(b.as_buffer(), kinds) for b in column]
    return [np.concatenate(c) for c in zip(*got, strict=True)] if got else [np.empty(0, k) for k in kinds]


_COUNTED = (np.int64, np.int32, np.int64, np.int32)


def _summed(x: np.ndarray, y: np.ndarray, n: np.ndarray, key: Callable) -> list[np.ndarray]:
    """Rows (x, y, n) with equal key(x, y) as one, sorted by key: x, y, n, key."""
    k = key(x, y)
    order = np.argsort(k)
    x, y, n, k = x[order], y[order], n[order], k[order]
    if not len(k):
        return [x, y, n, k]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return [x[first], y[first], np.add.reduceat(n, first), k[first]]


def _counted(texts: DataFrame, grams: Callable, keys: list[Callable], route: Callable, parts: int) -> DataFrame:
    """(kind, part, data): packed counts of each kind of grams(texts, powers) -> [(x, y), ...], summed per task, dealt by route(x, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, powers = [], 0, []

        def out() -> Iterator[pa.RecordBatch]:
            for kind, key in enumerate(keys):
                x, y = (np.concatenate(c) for c in zip(*(h[kind] for h in held), strict=True))
                x, y, n, k = _summed(x, y, np.ones(len(x), np.int32), key)
                for shard, own in _dealt(_part(route(x, k), parts), x, parts):
                    distinct, many = _runs(x[own])
                    data = _pack(distinct, many, y[own], n[own].astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([shard], pa.int32()), pa.array([data], pa.binary())], names=["kind", "part", "data"])

        for batch in _slices(batches, 0):
            held.append(grams(batch.column(0), powers))
            size += len(held[-1][0][0])
            if size > GATHERED:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    return texts.mapInArrow(run, "kind int, part int, data binary")


def _whole(column: pa.ChunkedArray, key: Callable, least: int) -> list[np.ndarray]:
    """The counts of one shard, those seen so often: x, y, n, key."""
    rows = [_unpack(b.as_buffer(), _COUNTED) for b in column]
    if not rows:
        return [np.empty(0, np.int64)] * 4
    x = np.concatenate([np.repeat(r[0], r[1]) for r in rows])
    y, n = (np.concatenate([r[k] for r in rows]) for k in (2, 3))
    got = _summed(x, y, n.astype(np.int64), key)
    kept = got[2] >= least
    return [c[kept] for c in got]


def _bitmap(packed: DataFrame, kinds: tuple, key: Callable) -> np.ndarray:
    """Bit key mod BITS is set for each of key(columns); joined in SLOTS pieces on executors, so that BITS bits come to the driver."""
    wide = BITS // SLOTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            at = np.unique(np.concatenate([key(_unpack(d.as_buffer(), kinds)) for d in b.column(0)]) & (BITS - 1))
            for own in np.split(at, np.searchsorted(at, np.arange(1, SLOTS) * wide)):
                if len(own):
                    data = (own % wide).astype(np.uint32).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([own[0] // wide], pa.int32()), pa.array([data], pa.binary())], names=["slot", "data"])

    def join(rows: pa.Table) -> pa.Table:
        flags = np.zeros(wide, np.uint8)
        for d in rows.column("data"):
            flags[np.frombuffer(d.as_buffer(), np.uint32)] = 1
        return pa.table([rows.column("slot")[:1].combine_chunks(), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())], names=["slot", "bits"])

    out = np.zeros(BITS // 64, np.int64)
    for slot, bits in packed.select("data").mapInArrow(run, "slot int, data binary").groupBy("slot").applyInArrow(join, "slot int, bits binary").collect():
        out[slot * wide // 64 : (slot + 1) * wide // 64] = np.frombuffer(bits, np.int64)
    return out


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return (bits[(keys & (BITS - 1)) >> 6] >> (keys & 63)) & 1 == 1


def _place(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys stand, or might; and which do."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    got = df.select(*names).toArrow()
    cols = [got.column(n).to_numpy() for n in names]
    order = np.argsort(cols[0])
    return [c[order] for c in cols]


def _free(spark) -> None:
    """Shuffles of written tables go from the disks once nothing refers to them; the scheduler lets go of a job at the next one."""
    gc.collect()
    spark.range(1).count()
    spark._jvm.System.gc()


class Model:
    """What scoring needs: the shards as a written table, and the broadcast share.

    frequent: words, pairs and triples with their values, bounded by RARE; bits: the bitmaps of kept pairs and triples.
    """

    def __init__(self, shards: DataFrame, parts: int, tokens: int, norm: int, frequent: tuple, bits: tuple):
        self.shards, self.parts, self.tokens, self.norm, self.frequent, self.bits = shards, parts, tokens, norm, frequent, bits


def shard_count(texts: DataFrame) -> int:
    """Shards as the texts' bytes have it; a token takes about six."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(shuffle_partitions(texts.sparkSession), -(-size // (6 * SHARD)))


def train(texts: DataFrame, scratch: Scratch, parts: int, rare: float = RARE) -> Model:
    """The model of texts(text), in so many shards."""
    spark = texts.sparkSession
    log = F.log10
    first_key, own_key = (lambda x, y: x), (lambda x, k: k)

    def pairs_of(texts, powers):
        seq, pair, _ = _hashed(texts, powers)
        # Each word that ends a pair, and so each text's last END, is one token.
        return (seq[1:][pair], np.zeros(int(pair.sum()), np.int64)), (seq[:-1][pair], seq[1:][pair])

    def pairs_kept(rows: pa.Table) -> pa.Table:
        kind = rows.column("kind")[0].as_py()
        x, y, n, key = _whole(rows.column("data"), _pair_key if kind else first_key, LEAST if kind else 1)
        return pa.table({"kind": np.full(len(x), kind, np.int32), "x": x, "y": y, "n": n, "key": key})

    dealt = _counted(texts, pairs_of, [first_key, _pair_key], own_key, parts)
    counts = scratch.keep(dealt.groupBy("kind", "part").applyInArrow(pairs_kept, "kind int, x long, y long, n long, key long"), "counts")
    _free(spark)
    words, pairs = counts.filter("kind = 0").select("x", "n"), counts.filter("kind = 1").drop("kind")
    tokens, kinds = (x or 0 for x in words.agg(F.sum("n"), F.count(F.lit(1))).first())
    norm, least = tokens + kinds + 1, max(LEAST, int(np.ceil(rare * tokens)))
    often = F.col("n") >= least
    # Every word of a text is followed by one, and END stands before each text, so n(x) is x's count.
    mass = pairs.groupBy("x").agg(F.sum(F.col("n") - DISCOUNT).alias("mass"))
    w = F.coalesce(log(1 - F.col("mass") / F.col("n")), F.lit(0.0))
    lexicon = scratch.keep(words.join(mass, "x", "left").select("x", "n", w.alias("w")), "lexicon")
    heads = lexicon.filter(F.col("n") >= LEAST).select("x", F.col("n").alias("nx"), "w")
    tails = lexicon.filter(F.col("n") >= LEAST).select(F.col("x").alias("y"), F.col("n").alias("ny"))
    both = joined_by_share(pairs, "x", heads.filter(F.col("nx") >= least), heads.filter(F.col("nx") < least))
    both = joined_by_share(both, "y", tails.filter(F.col("ny") >= least), tails.filter(F.col("ny") < least))
    p1 = (F.col("ny") + 1) / F.lit(float(norm))
    p2 = (F.col("n") - DISCOUNT) / F.col("nx") + F.pow(F.lit(10.0), "w") * p1
    value = log(p2) - log(p1) - F.col("w")
    both = _packed(both.select("key", "n", p2.cast("float").alias("p2"), value.cast("float").alias("v")), parts)
    both, of_pair = scratch.keep(both, "pairs"), (np.int64, np.int64, np.float32, np.float32)
    scratch.drop(counts)
    _free(spark)

    def hot_pairs(columns):
        return {c: v[columns[1] >= least] for c, v in zip(("key", "n", "p2", "v"), columns, strict=True)}

    hot = _columns(_unpacked(both, of_pair, hot_pairs, "key long, n long, p2 float, v float"), "key", "n", "p2", "v")  # at most 1 / rare rows
    bits2 = _bitmap(both, of_pair, lambda columns: columns[0])
    get = shared(spark, (hot[0], hot[2], bits2))

    def triples_of(texts, powers):
        seq, pair, _ = _hashed(texts, powers)
        keys = _pair_key(seq[:-1], seq[1:])
        good = pair & _passes(get()[2], keys)
        both = good[:-1] & good[1:]
        return ((keys[1:][both], keys[:-1][both]),)

    def key_of(y, x):
        return _triple_key(x, y)

    def to_second(y, k):
        return np.where(_place(get()[0], y)[1], k, y)

    def triples_kept(own: pa.Table, rows: pa.Table) -> pa.Table:
        y, x, n, k = _whole(rows.column("data"), key_of, LEAST)
        held, _, p, _ = _rows(own.column("data"), of_pair)
        order = np.argsort(held)
        at, here = _place(held[order], y)
        near, often_ = _place(get()[0], y)
        p2 = np.where(here, p[order][at] if len(p) else 0.0, np.where(often_, get()[1][near] if len(get()[1]) else 0.0, 0.0))
        kept = p2 > 0  # a bitmap passes some pairs that are not kept
        x, y, n, k, p2 = x[kept], y[kept], n[kept], k[kept], p2[kept].astype(np.float32)
        dealt = list(_dealt(_part(np.where(_place(get()[0], x)[1], k, x), parts), x, parts))
        data = [_pack(x[at], y[at], n[at], p2[at]) for _, at in dealt]
        return pa.table([pa.array([shard for shard, _ in dealt], pa.int32()), pa.array(data, pa.binary())], names=["shard", "data"])

    dealt = _counted(texts, triples_of, [key_of], to_second, parts).groupBy("part")
    triples = both.groupBy("shard").cogroup(dealt).applyInArrow(triples_kept, "shard int, data binary")
    triples, of_triple = scratch.keep(triples, "triples"), (np.int64, np.int64, np.int64, np.float32)
    _free(spark)

    # Contexts that are broadcast lie in many shards, so the mass of their triples is summed here: at most 1 / rare rows.
    def spent_by(columns):
        own = _place(get()[0], columns[0])[1]
        key, at = np.unique(columns[0][own], return_inverse=True)
        return {"x": key, "mass": np.bincount(at, columns[2][own] - DISCOUNT, len(key)).astype(np.float64)}  # of nothing it counts whole numbers

    spent = _unpacked(triples, of_triple, spent_by, "x long, mass double")
    spent = _columns(spent.groupBy("x").agg(F.sum("mass").alias("mass")), "x", "mass")
    at, here = _place(spent[0], hot[0])
    back = np.log10(1 - np.where(here, spent[1][at] if len(spent[1]) else 0.0, 0.0) / np.maximum(hot[1], 1))
    contexts = shared(spark, (hot[0], hot[1], back))

    def shard_of(rows: pa.Table) -> pa.Table:
        own_hot, many, rest = contexts()
        word, pair, triple = (rows.filter(pc.equal(rows.column("kind"), k)).column("data") for k in range(3))
        x, n, w = _rows(word, of_word)
        order = np.argsort(x)
        vocabulary = _pack(x[order], n[order], w[order])
        key, total, _, value = _rows(pair, of_pair)
        order = np.argsort(key)
        order = order[total[order] < least]
        key, total, value = key[order], total[order], value[order].astype(np.float64)
        x, y, n, p = _rows(triple, of_triple)
        p = p.astype(np.float64)
        near, wide = _place(own_hot, x)
        strange = ~wide & ~_place(key, x)[1]  # a bitmap passes some contexts that are not kept
        x, y, n, p, near, wide = (c[~strange] for c in (x, y, n, p, near, wide))
        keys = np.unique(np.concatenate((key, x[wide])))
        first, totals, owner = np.zeros(len(keys)), np.ones(len(keys)), np.searchsorted(keys, x)
        totals[np.searchsorted(keys, key)] = total
        a = (n - DISCOUNT) / np.where(wide, many[near] if len(many) else 1, totals[owner])
        left = np.log10(1 - np.bincount(owner[~wide], a[~wide], len(keys)))
        first[np.searchsorted(keys, key)] = value
        first += left  # a broadcast context has its value there, and 0 here
        own = np.where(wide, rest[near] if len(rest) else 0.0, left[owner])
        second = np.log10(a + 10**own * p) - own - np.log10(p)
        trie = Trie.build(keys, first, owner, short_key(y), second)
        heavy = n >= least
        found = _pack(_triple_key(x, y)[heavy], second[heavy])
        columns = [pa.array([d], pa.binary()) for d in (vocabulary, trie.dump(), found)]
        return pa.table([pa.array([rows.column("shard")[0].as_py()], pa.int32()), *columns], names=["shard", "words", "levels", "heavy"])

    lexicon_rows = lexicon.filter(~often).select("x", "n", F.col("w").cast("float").alias("w"))
    of_word = (np.int64, np.int64, np.float32)
    built = [df.withColumn("kind", F.lit(k)) for k, df in enumerate((_packed(lexicon_rows, parts), both, triples))]
    built = built[0].unionByName(built[1]).unionByName(built[2])
    built = built.groupBy("shard").applyInArrow(shard_of, "shard int, words binary, levels binary, heavy binary")
    shards = scratch.keep(built, "shards")
    bits3 = _bitmap(triples, of_triple, lambda columns: _triple_key(columns[0], columns[1]))
    often_words = _columns(lexicon.filter(often), "x", "n", "w")  # at most 1 / rare rows
    scratch.drop(both, triples, lexicon)
    _free(spark)
    got = [_unpack(r[0], (np.int64, np.float64)) for r in shards.select("heavy").collect()]  # at most 1 / rare triples
    heavy = [np.concatenate([g[k] for g in got]) if got else np.empty(0, k and float or np.int64) for k in (0, 1)]
    frequent = (*often_words, hot[0], hot[3].astype(np.float64) + back, *heavy)
    return Model(shards, parts, tokens, norm, frequent, (bits2, bits3))


class _Frequent:
    """The broadcast share, ready for look-ups."""

    def __init__(self, given: tuple):
        (words, n, w, pairs, self.pair_values, triples, self.triple_values), (self.bits2, self.bits3), norm = given
        self.words, self.pairs, self.triples = (Map(k, np.arange(len(k))) for k in (words, pairs, triples))
        self.log = np.log10((n + 1) / norm)
        self.full = self.log + w  # with the word's weight as a context; END stands once on either side of a text


#: The first document of the task in a blob; pairs asked, by which document after it; pairs asked with a successor, likewise;
#: words, likewise; documents' marks and what is known of them.
_ASKED = (np.int64, np.int64, np.uint16, np.int64, np.uint16, np.uint32, np.int64, np.uint16, np.int32, np.int64, np.int64, np.int64, np.int64, np.float64, np.float64)
#: What a shard answers to one task: documents and their sums of n-gram values; documents and their words known, unigram and context values.
_ANSWERED = (np.int32, np.float32, np.int32, np.int32, np.float64, np.float64)
_SCORES = (("hi", np.int64), ("lo", np.int64), ("n", np.int64), ("known", np.int64), ("base", np.float64), ("score", np.float64))


def text_scores(marked: DataFrame, model: Model) -> DataFrame:
    """marked(text, hi, lo) -> (hi, lo, n, known, base, score) for each distinct mark."""
    parts, norm = model.parts, model.norm
    get = shared(marked.sparkSession, (model.frequent, model.bits, norm), _Frequent)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, powers = get(), []
        origin, seen = TaskContext.get().partitionId(), set()
        held, docs_done, size = [], 0, 0

        def row(shard: int, arrays: tuple) -> pa.RecordBatch:
            data = _pack(*(np.asarray(a, k) for a, k in zip(arrays, _ASKED, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([origin], pa.int32()), pa.array([data], pa.binary())], names=["shard", "origin", "data"])

        def out() -> Iterator[pa.RecordBatch]:
            x, kid, route, who, word, whose, *known = (np.concatenate(c) for c in zip(*held, strict=True))
            none, low = (), int(known[0][0])
            yield row(origin % parts, (*[none] * 8, *known))
            plain, kin = np.flatnonzero(kid == 0), np.flatnonzero(kid)
            asked = [dict(_dealt(_part(r, parts), k, parts)) for r, k in ((route[plain], x[plain]), (route[kin], x[kin]), (word, word))]
            for shard in sorted(asked[0].keys() | asked[1].keys() | asked[2].keys()):
                p, q, t = (own.get(shard, np.empty(0, np.int64)) for own in asked)
                p, q = plain[p], kin[q]
                yield row(shard, ([low], x[p], who[p] - low, x[q], who[q] - low, kid[q], word[t], whose[t] - low, *[none] * 7))

        for batch in (b.slice(k, 256) for b in _slices(batches, 0) for k in range(0, b.num_rows, 256)):
            hi, lo = (batch.column(k).to_numpy() for k in (1, 2))
            fresh = []
            for i, mark in enumerate(zip(hi.tolist(), lo.tolist(), strict=True)):
                if mark not in seen:
                    seen.add(mark)
                    fresh.append(i)
            if not fresh:
                continue
            seq, pair, sizes = _hashed(batch.column(0).take(pa.array(fresh)), powers)
            docs_ = len(fresh)
            owner = np.repeat(np.arange(docs_), sizes + 2)
            last = np.ones(len(seq), bool)  # all but each text's first END are tokens
            last[np.concatenate(([0], np.cumsum(sizes + 2)))[:-1]] = False
            token, whose = seq[last], owner[last]
            at = own.words(token)
            here = at >= 0
            log, full = (np.bincount(whose[here], v[at[here]], docs_) for v in (own.log, own.full))
            keys, owner = _pair_key(seq[:-1], seq[1:]), owner[:-1]
            good = np.flatnonzero(pair & _passes(own.bits2, keys))
            at2 = own.pairs(keys[good])
            often = np.zeros(len(keys), bool)
            often[good] = at2 >= 0
            rest = np.zeros(len(keys), bool)  # pairs that a shard may know
            rest[good] = at2 < 0
            at2, good = at2[at2 >= 0], good[at2 >= 0]
            score = full + np.bincount(owner[good], own.pair_values[at2], docs_)
            both = np.flatnonzero((often | rest)[:-1] & (often | rest)[1:])  # triples, by the place of their first pair
            third = _triple_key(keys[both], keys[both + 1])
            maybe = _passes(own.bits3, third)
            both, third = both[maybe], third[maybe]
            at3 = own.triples(third)
            score += np.bincount(owner[both[at3 >= 0]], own.triple_values[at3[at3 >= 0]], docs_)
            both, third = both[at3 < 0], third[at3 < 0]
            kid, route = np.zeros(len(keys), np.int64), keys.copy()
            kid[both] = short_key(keys[both + 1])
            route[both] = np.where(often[both], third, keys[both])
            asks = np.flatnonzero(rest | (kid > 0))
            held.append((keys[asks], kid[asks], route[asks], owner[asks] + docs_done, token[~here], whose[~here] + docs_done,
                         np.arange(docs_) + docs_done, hi[fresh], lo[fresh], sizes + 1, np.bincount(whose[here], minlength=docs_), log, score))
            docs_done += docs_
            size += len(asks) + int((~here).sum()) + 8 * docs_
            if size > GATHERED // 4 or len(held) >= 128:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    def answer(shards: pa.Table, rows: pa.Table) -> pa.Table:
        if shards.num_rows:
            trie = Trie.load(shards.column("levels")[0].as_buffer())
            words, n, w = _unpack(shards.column("words")[0].as_buffer(), (np.int64, np.int64, np.float32))
        else:
            trie, words, n, w = None, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
        asked, out = {}, []
        for origin, data in zip(rows.column("origin").to_pylist(), rows.column("data"), strict=True):
            first, x, who, y, whom, kids, word, whose, *known = _unpack(data.as_buffer(), _ASKED)
            if len(known[0]):
                out.append((origin, True, _pack(*known)))
            else:
                low = np.int64(first[0])
                asked.setdefault(origin, []).append((x, who + low, y, whom + low, kids, word, whose + low))
        own = {origin: [np.concatenate(c) for c in zip(*parts_, strict=True)] for origin, parts_ in asked.items()}
        if trie is not None and own:  # all tasks' questions at once
            every = [np.concatenate((x, y)) for x, _, y, _, _, _, _ in own.values()]
            kin = [np.concatenate((np.zeros(len(x), np.int64), kids.astype(np.int64))) for x, _, _, _, kids, _, _ in own.values()]
            answers = np.split(trie.values(np.concatenate(every), np.concatenate(kin)), np.cumsum([len(e) for e in every])[:-1])
        for i, (origin, (x, who, y, whom, _, word, whose)) in enumerate(own.items()):
            asks = np.concatenate((who, whom))
            values = answers[i] if trie is not None else np.zeros(len(asks))
            asks, at = np.unique(asks, return_inverse=True)
            holders, of = np.unique(whose, return_inverse=True)
            place, here = _place(words, word)
            base = np.log10((np.where(here, n[place] if len(n) else 0, 0) + 1) / norm)
            back = np.where(here, w[place] if len(w) else 0.0, 0.0)
            sums = (np.bincount(at, values, len(asks)), np.bincount(of[here], minlength=len(holders)), np.bincount(of, base, len(holders)), np.bincount(of, back, len(holders)))
            out.append((origin, False, _pack(*(np.asarray(c, k) for c, k in zip((asks, sums[0], holders, *sums[1:]), _ANSWERED, strict=True)))))
        kinds = (pa.int32(), pa.bool_(), pa.binary())
        return pa.table([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names=["origin", "own", "data"])

    def join(rows: pa.Table) -> pa.Table:
        """The sums of one task's documents: what it knew itself and what the shards answered."""
        own = [_unpack(d.as_buffer(), _ASKED[8:]) for d, mine in zip(rows.column("data"), rows.column("own").to_pylist(), strict=True) if mine]
        doc, hi, lo, size, known, base, score = (np.concatenate(c) for c in zip(*own, strict=True))
        top = int(doc.max()) + 1
        place = np.empty(top, np.int64)
        place[doc] = np.arange(len(doc))
        known, base, score = known.copy(), base.copy(), score.copy()
        for d, mine in zip(rows.column("data"), rows.column("own").to_pylist(), strict=True):
            if not mine:
                asks, values, holders, found, plain, back = _unpack(d.as_buffer(), _ANSWERED)
                score[place[asks]] += values
                known[place[holders]] += found
                base[place[holders]] += plain
                score[place[holders]] += plain + back
        return pa.table({name: np.asarray(c, kind) for (name, kind), c in zip(_SCORES, (hi, lo, size, known, base, score), strict=True)})

    asked = marked.select("text", "hi", "lo").mapInArrow(ask, "shard int, origin int, data binary")
    found = model.shards.drop("heavy").groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(answer, "origin int, own boolean, data binary")
    found = found.groupBy("origin").applyInArrow(join, "hi long, lo long, n long, known long, base double, score double")
    # Equal rows in several tasks have asked each for themselves.
    return found.groupBy("hi", "lo").agg(*[F.max(c).alias(c) for c in ("n", "known", "base", "score")])


def lm_scores(docs: DataFrame, scratch: Scratch | None = None, rare: float = RARE) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row; rare changes the cost only.

    Learns from documents whose crc32(doc_id) mod 7 is not 2 and scores all. A null or empty text is its end
    alone. Equal texts score equally; repeated rows are texts of their own; a null doc_id counts as the empty
    string. Extra columns are not read; an empty table gives an empty result. A row is known by 128 bits of its id and text.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    held = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    marked = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("hi"), F.xxhash64(F.lit(1), "text", "doc_id").alias("lo"))
    parts = shard_count(docs)
    with small_batches(docs.sparkSession, parts):
        model = train(docs.filter(~held).select("text"), scratch, parts, rare)
        scores = scratch.keep(text_scores(marked, model), "scores")
        scratch.drop(model.shards)
    out = marked.drop("text").join(scores, ["hi", "lo"], "left")
    return out.select(
        "doc_id", held.alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))

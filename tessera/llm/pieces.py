"""SentencePiece encoding and decoding as a streaming Viterbi search.

The lattice's nodes are character boundaries, its edges pieces. For a byte-pair model a path is
good if merging the joined text of every two neighbouring pieces gives just these two; each boundary then has exactly
one good last piece, so one backpointer survives there. Only boundaries within the longest piece of the head can still
be continued: the search keeps that window, and commits ids whenever the backpointers of all boundaries in it lead
through one boundary. If they do not meet, the window grows until they do, so the ids are exact whatever the text.

Pieces are numbers. A piece that ends at a boundary is found by walking back through a trie of reversed pieces; whether two
pieces fit is decided by merge ranks along their common boundary. No piece crosses the end of a run (a word with the
spaces before it, or a line's end), so all paths meet there. The distinct runs of a slice of texts are
searched together, one character of each at a time; a run longer than LANE is streamed alone.

For unigram models the search keeps, at each boundary, the piece of the highest sum of scores.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import shared, table
from tessera.llm.lookup import Map, slices

#: The model's file; it is read, never copied.
MODEL = os.environ.get("TESSERA_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
SPACE_MARK = "▁"
#: Runs of at most so many characters are searched side by side, so many at once.
LANE, LANES = 64, 8192
#: About how many bytes of text are encoded at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """A model's pieces, with encode() and decode()."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        if spec.model_type not in (1, 2) or norm.precompiled_charsmap or norm.remove_extra_whitespaces or spec.treat_whitespace_as_suffix:
            raise ValueError("unigram and byte-pair models without normalisation only")
        self.merging, self.prefix = spec.model_type == 2, norm.add_dummy_prefix
        normal = [(p.piece, i, p.score) for i, p in enumerate(proto.pieces) if p.type == 1]
        self.score = {p: s for p, _, s in normal}
        self.ids = {p: i for p, i, _ in normal}
        self.unk = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.longest = max(map(len, self.ids))
        self.low = min(self.score.values()) - 10
        self.endings = {p[k:] for p in self.ids for k in range(len(p))}
        spaced = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids) and not any("\n" in p for p in self.ids)
        #: Whether runs can be searched side by side: then text falls apart at spaces and line ends.
        self.sided = self.merging and spaced and len(self.bytes) == 256
        self.runs = re.compile(f"\n|{SPACE_MARK}*[^{SPACE_MARK}\n]+|{SPACE_MARK}+" if spaced else "(?s).+")
        self.surface = [b""] * len(proto.pieces)
        for p, i in self.ids.items():
            self.surface[i] = p.replace(SPACE_MARK, " ").encode()
        for b, i in self.bytes.items():
            self.surface[i] = bytes([b])
        self.surface[self.unk] = " ⁇ ".encode()
        self.surfaces = pa.array(self.surface, pa.large_binary())
        self.known: dict[tuple[int, int], bool] = {}
        if self.merging:
            self._number(len(proto.pieces))

    # -- byte-pair models: pieces as numbers

    def merge(self, text: str) -> list[str]:
        """What byte-pair merging makes of a short text: the best-scored neighbours first, leftmost of equals."""
        return self._merges(text)[0]

    def _merges(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The parts, and the last two that were merged."""
        parts, score, last = list(text), self.score, None
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def _number(self, size: int) -> None:
        """Numbers for pieces and for characters that only occur inside them, merge ranks and halves, the trie, the pairs."""
        inner = sorted({c for p in self.ids for c in p} - self.ids.keys())
        self.number = self.ids | {c: size + k for k, c in enumerate(inner)}
        self.unknown = size + len(inner)  # a character of no piece
        self.text = [""] * (self.unknown + 1)
        for p, i in self.number.items():
            self.text[i] = p
        steps = {s: k for k, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank = np.full(self.unknown + 1, -1, np.int64)  # single characters come before all merges
        self.left, self.right = np.zeros((2, self.unknown + 1), np.int64)
        self.odd = np.zeros(self.unknown + 1, bool)
        self.chars = np.ones(self.unknown + 1, np.int64)
        reached = self.reached = {}
        for p, i in self.number.items():
            parts, last = self._merges(p)
            if len(parts) > 1:
                continue  # merging never gives it
            reached[p] = i
            if last:
                self.rank[i], self.left[i], self.right[i] = steps[self.score[p]], self.number[last[0]], self.number[last[1]]
                self.chars[i] = len(p)
        for p, i in sorted(reached.items(), key=lambda r: len(r[0])):
            # Ranks tell the order of merges only where every half is merged before its whole.
            self.odd[i] = len(p) > 1 and any(self.odd[h] or self.rank[h] >= self.rank[i] for h in (self.left[i], self.right[i]))
        letters = sorted({c for p in self.ids for c in p})
        self.letters, self.width = np.array([ord(c) for c in letters], np.int64), len(letters) + 1
        self.base = np.array([self.unknown] + [self.number[c] for c in letters], np.int32)
        place, nodes, ends = {c: k + 1 for k, c in enumerate(letters)}, {}, [-1]
        for p, i in reached.items():
            at = 0
            for c in reversed(p):
                key = at * self.width + place[c]
                at = nodes.setdefault(key, len(ends))
                if at == len(ends):
                    ends.append(-1)
            ends[at] = i
        self.child = Map(np.fromiter(nodes, np.int64, len(nodes)), np.fromiter(nodes.values(), np.int64, len(nodes)))
        self.ends = np.array(ends, np.int32)
        stride = self.stride = self.unknown + 1
        pairs = {}
        for p, s in self.score.items():
            for k in range(1, len(p)):
                a, b = self.number.get(p[:k]), self.number.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * stride + b] = steps[s]
        self.joined = Map(np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs)))
        #: The last answers of fits(), by a slot for each pair.
        self.asked, self.answers = np.full(1 << 19, -1, np.int64), np.zeros(1 << 19, bool)

    def _ranked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pairs of pieces fit, by ranks: undo their merges, last first; at no time may the two that meet at the boundary be merged first."""
        good = np.ones(len(a), bool)
        limit = np.full(len(a), 1 << 40)
        at = np.arange(len(a))
        while len(at):
            c = self.joined(a * self.stride + b)
            crossed = (c >= 0) & (c < limit)
            good[at[crossed]] = False
            x, y = self.rank[a], self.rank[b]
            go = ~crossed & ((x >= 0) | (y >= 0))
            at, a, b, x, y = at[go], a[go], b[go], x[go], y[go]
            # Of equal ranks the left one was merged first, before the boundary's pair, and that before the right one.
            first = x > y
            limit = np.where(first, x, y + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return good

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the joined text of two pieces gives just the two; anything fits after the start (-1) or an unknown character."""
        free = (a < 0) | (a >= self.unknown)
        key = a.astype(np.int64) * self.stride + b
        slot = ((key.view(np.uint64) * _MULTIPLY) >> np.uint64(45)).astype(np.int64)
        out = self.answers[slot] | free
        new = np.flatnonzero((self.asked[slot] != key) & ~free)
        if len(new):
            x, y = a[new].astype(np.int64), b[new].astype(np.int64)
            good = self._ranked(x, y)
            for i in np.flatnonzero(self.odd[x] | self.odd[y]):
                l, r = self.text[x[i]], self.text[y[i]]
                good[i] = self.merge(l + r) == [l, r]
            out[new] = good
            self.asked[slot[new]] = key[new]
            self.answers[slot[new]] = good
            # Two pairs of one slot: what stands there must be the answer of the key that stands there.
            clash = self.asked[slot[new]] != key[new]
            if clash.any():
                self.asked[slot[new[clash]]] = -1
        return out

    def fit(self, a: str, b: str) -> bool:
        x, y = self.number.get(a, -1), self.number[b]
        if len(self.known) >= 500_000:
            self.known.clear()
        if (x, y) not in self.known:
            self.known[x, y] = bool(self.fits(np.array([x]), np.array([y]))[0])
        return self.known[x, y]

    def side_by_side(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The search for many short runs of characters: (run, boundary, piece) of every piece found, run by run in order."""
        order = np.argsort(-sizes, kind="stable")
        found = ([], [], [])
        for k in range(0, len(order), LANES):
            own = order[k : k + LANES]
            lane, end, piece = self._block(codes, starts[own], sizes[own])
            for kept, new in zip(found, (own[lane], end, piece), strict=True):
                kept.append(new)
        run, end, piece = (np.concatenate(x) if x else np.empty(0, np.int64) for x in found)
        order = np.argsort(run * (LANE + 1) + end, kind="stable")
        return run[order], end[order], piece[order]

    def _block(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs from long to short. back[j, i]: the piece that ends at boundary j of run i, its one surviving path's last."""
        top, n = int(sizes[0]), len(sizes)
        live = np.searchsorted(-sizes, -np.arange(top), "left")  # runs longer than each length
        letters = np.zeros((top, n), np.int64)
        back = np.full((top + 1, n), -1, np.int64)
        for t in range(top):
            m = int(live[t])
            letters[t, :m] = codes[starts[:m] + t]
            own = np.zeros(m, np.int64)
            at, cands = np.arange(m), []
            for length in range(1, min(t + 1, self.longest) + 1):
                node = self.child(own * self.width + letters[t + 1 - length, at])
                more = node >= 0
                if not more.all():
                    at, node = at[more], node[more]
                if not len(at):
                    break
                own = node.astype(np.int64)
                piece = self.ends[own]
                whole = piece >= 0
                cands.append((length, at[whole], piece[whole]))
            best, open_ = self.base[letters[t, :m]].astype(np.int64), np.ones(m, bool)
            # Longest first; exactly one fits, a lone character that no piece holds apart.
            for length, at, piece in reversed(cands[1:]):
                still = open_[at]
                at, piece = at[still], piece[still]
                if len(at):
                    good = self.fits(back[t + 1 - length, at], piece)
                    at = at[good]
                    best[at] = piece[good]
                    open_[at] = False
            back[t + 1, :m] = best
        out = ([], [], [])
        at, end = np.arange(n), sizes.astype(np.int64)
        while len(at):
            piece = back[end, at]
            for kept, new in zip(out, (at, end, piece), strict=True):
                kept.append(new)
            end = end - self.chars[piece]
            more = end > 0
            at, end = at[more], end[more]
        return tuple(np.concatenate(x) for x in out)

    # -- one run at a time: any length, and unigram models

    def search(self, text: Iterable[str]) -> Iterator[str]:
        """The pieces of a stream of characters, each yielded as soon as all surviving paths hold it.

        window: the last characters. back[j], total[j]: the piece that ends at boundary j of it,
        and its path's score.
        """
        window, back, total = "", [""], [0.0]
        fit, longest, endings = self.fit, self.longest, self.endings
        due = 2 * longest
        for c in text:
            window += c
            end, best, top = len(window), None, 0.0
            if self.merging:
                # The longest that fits is the one.
                best, start = c, end
                while start > 0 and window[start - 1 :] in endings:
                    start -= 1
                for at in range(start, end - 1):
                    piece, before = window[at:], back[at]
                    if piece in self.reached and (before not in self.number or fit(before, piece)):
                        best = piece
                        break
            else:
                top = -np.inf
                for start in range(max(0, end - longest), end):
                    piece = window[start:]
                    s = self.score.get(piece, self.low if start == end - 1 else None)
                    if s is not None and total[start] + s > top:
                        best, top = piece, total[start] + s
            back.append(best)
            total.append(top)
            if end >= due:
                # Where do the paths of all boundaries that can still be continued meet?
                ends = set(range(end - longest + 1, end + 1))
                while len(ends) > 1:
                    last = max(ends)
                    ends.discard(last)
                    ends.add(last - len(back[last]))
                meet = ends.pop()
                yield from self._path(back, meet)
                window, back, total = window[meet:], back[meet:], [t - total[meet] for t in total[meet:]]
                due = max(2 * longest, 2 * len(window))  # paths that have not met are looked at again at twice the length
        yield from self._path(back, len(window))

    @staticmethod
    def _path(back: list[str], end: int) -> Iterator[str]:
        out = []
        while end > 0:
            out.append(back[end])
            end -= len(back[end])
        return reversed(out)

    def run_ids(self, run: str) -> list[int]:
        out = []
        unknown = False
        for piece in self.search(run):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
            elif not unknown:
                out.append(self.unk)
            unknown = i is None
        return out

    # -- whole texts

    def _runs_ids(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all, how many of each) for distinct runs, as UTF-8 with spaces for their marks."""
        text = b"".join(runs.to_pylist()).decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        plain = points.copy()
        points[points == 32] = ord(SPACE_MARK)
        raw = np.frombuffer(b"".join(runs.to_pylist()), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, runs.to_pylist()), np.int64, len(runs)))
        ends = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[ends]
        starts = np.concatenate(([0], ends[:-1]))
        sizes = ends - starts
        place = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        codes = np.where(self.letters[place] == points, place + 1, 0)
        short = np.flatnonzero(sizes <= LANE)
        run, end, piece = self.side_by_side(codes, starts[short], sizes[short])
        run = short[run]
        # A character of no piece becomes its bytes.
        odd = piece >= len(self.surface)
        point = np.where(odd, plain[np.minimum(starts[run] + end - 1, len(plain) - 1)] if len(plain) else 0, 0)
        width = np.where(odd, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000), 1)
        at = np.repeat(np.arange(len(piece)), width)
        k = np.arange(len(at)) - np.repeat(np.cumsum(width) - width, width)
        point, many = point[at], width[at]
        lead = np.where(many == 1, 0, (0xF00 >> many) & 0xFF)
        byte = np.where(k == 0, lead | (point >> (6 * (many - 1))), 0x80 | ((point >> np.maximum(6 * (many - 1 - k), 0)) & 0x3F))
        names = np.array([self.bytes[b] for b in range(256)])
        flat = np.where(odd[at], names[byte & 0xFF], piece[at])
        owner = run[at]
        for i in np.flatnonzero(sizes > LANE):
            own = self.run_ids(text[starts[i] : ends[i]].replace(" ", SPACE_MARK))
            flat, owner = np.concatenate((flat, own)), np.concatenate((owner, np.full(len(own), i)))
        order = np.argsort(owner, kind="stable")
        return flat[order].astype(np.int32), np.bincount(owner, minlength=len(runs))

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each one's begin and end). A null text counts as empty."""
        plain = pc.fill_null(texts, "")
        if not self.sided or not self.prefix:
            own = [self._plain(t) for t in plain.to_pylist()]
            return np.concatenate([np.array(o, np.int32) for o in own] or [np.empty(0, np.int32)]), np.concatenate(([0], np.cumsum([len(o) for o in own]))).astype(np.int64)
        plain = pc.replace_substring(plain, SPACE_MARK, " ")
        full = np.asarray(pc.not_equal(plain, "").to_numpy(zero_copy_only=False))
        filled = pc.binary_join_element_wise("", plain.filter(pa.array(full)), " ").cast(pa.large_string())
        if not len(filled):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        where = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
        data = np.frombuffer(filled.buffers()[2], np.uint8)[where[0] : where[-1]]
        where = where - where[0]
        space, line = data == 32, data == 10
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins |= line
        begins[1:] |= line[:-1]
        begins[where[:-1]] = True
        starts = np.concatenate((np.flatnonzero(begins), [len(data)])).astype(np.int64)
        cut = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data))])
        coded = cut.dictionary_encode()
        flat, many = self._runs_ids(coded.dictionary)
        first = np.cumsum(many) - many
        use = coded.indices.to_numpy()
        sizes = many[use]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = flat[np.repeat(first[use] - ends[:-1], sizes) + np.arange(ends[-1])]
        own = np.zeros(len(texts), np.int64)
        own[full] = np.diff(ends[np.searchsorted(starts, where)])
        return ids, np.concatenate(([0], np.cumsum(own)))

    def _plain(self, text: str) -> list[int]:
        whole = (SPACE_MARK if self.prefix else "") + text.replace(" ", SPACE_MARK)
        return [i for run in (self.runs.findall(whole) if text else ()) for i in self.run_ids(run)]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_many(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        data = b"".join(map(self.surface.__getitem__, ids))
        if self.prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")

    def returns(self, ids: np.ndarray, ends: np.ndarray, texts: pa.Array) -> list[bool]:
        """Whether decoding each text's ids gives its bytes back."""
        out = self.surfaces.take(pa.array(ids))
        where = np.frombuffer(out.buffers()[1], np.int64)[out.offset : out.offset + len(out) + 1] if len(out) else np.zeros(1, np.int64)
        data = memoryview(out.buffers()[2]) if len(out) else memoryview(b"")
        same = []
        for text, a, b in zip(texts, where[ends[:-1]].tolist(), where[ends[1:]].tolist(), strict=True):
            got, want = bytes(data[a:b]), text.as_buffer()
            got = got[1:] if self.prefix and got[:1] == b" " else got
            same.append(got == (want.to_pybytes() if want is not None else b""))
        return same


def encode_texts(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """docs(text, ...) with ids (array of int), n_ids and round_trip: whether decoding gives the text back.

    Ids are those of the SentencePiece library. A null text counts as empty and has no ids. Texts
    that hold U+2581 come back with spaces for it, as the library has it, and then round_trip is
    false. Other columns and repeated rows pass; an empty table gives an empty result.
    """
    with open(model_path, "rb") as f:  # the driver reads it; executors get it by broadcast, half a MB
        model = shared(docs.sparkSession, f.read(), Pieces)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model()
        for batch in batches:
            for a, n in slices(batch.column(at), SLICE_BYTES):
                part = batch.slice(a, n)
                texts = part.column(at)
                ids, ends = pieces.encode_many(texts)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                more = [lists, pa.array(np.diff(ends)), pa.array(pieces.returns(ids, ends, texts), pa.bool_())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, "ids", "n_ids", "round_trip"])

    more = [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_ids", T.LongType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every document's ids, by the method above, decoded again to see that nothing is lost."""
    return encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

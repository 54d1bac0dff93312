"""A compact n-gram trie over hashed keys: Elias-Fano levels, 16-bit values, queried in batches where it lies.

The first level holds contexts (pairs of words, as sorted keys), the second each context's successors: a context's
number and its successor's short key make one number, so the whole level is monotone. Monotone pointers tell
where a context's successors begin. All sequences are Elias-Fano: low bits packed, high bits in unary; a search selects its
bucket of high bits by counted words and compares low bits there, so nothing is unpacked. A dumped trie is
read as it is, from bytes or a memory map.
"""

from __future__ import annotations

import json

import numpy as np

_U = np.uint64
#: Bits of a successor's short key.
SHORT = 32


def short_key(keys: np.ndarray) -> np.ndarray:
    """A successor's short key, never 0."""
    return (keys & ((1 << SHORT) - 1)) | 1


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Values of so many bits, side by side in 64-bit words (and one word more)."""
    words = np.zeros(len(values) * bits // 64 + 2, _U)
    if bits and len(values):
        at = np.arange(len(values), dtype=np.int64) * bits
        values = values.astype(_U)
        np.bitwise_or.at(words, at >> 6, values << (at & 63).astype(_U))
        over = (at & 63) + bits > 64
        np.bitwise_or.at(words, (at[over] >> 6) + 1, values[over] >> (64 - (at[over] & 63)).astype(_U))
    return words


class EliasFano:
    """A monotone sequence of n numbers >= 0."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.bits, self.low, self.high = n, bits, low, high
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)))
        #: Ones and zeros before each word of the high bits.
        self.ones, self.zeros = ones, np.arange(len(high) + 1) * 64 - ones
        self.mask = _U((1 << bits) - 1)

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        bits = max(0, (max(top // max(n, 1), 1)).bit_length() - 1)
        ones = (values >> bits) + np.arange(n)
        flags = np.zeros(((int(ones[-1]) if n else 0) // 64 + 2) * 64, np.uint8)
        flags[ones] = 1
        return cls(n, bits, _pack(values & ((1 << bits) - 1), bits), np.packbits(flags, bitorder="little").view(_U))

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """The place of the k-th one (or zero) of the high bits."""
        word = np.searchsorted(before, k, "right") - 1
        held = self.high[word]
        held = ~held if flip else held
        rest, at = k - before[word], np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            many = np.bitwise_count((held >> at.astype(_U)) & _U((1 << width) - 1)).astype(np.int64)
            go = rest >= many
            rest = np.where(go, rest - many, rest)
            at += np.where(go, width, 0)
        return word * 64 + at

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), _U)
        at = i * self.bits
        word, off = at >> 6, (at & 63).astype(_U)
        return ((self.low[word] >> off) | np.where(off > 0, self.low[word + 1] << ((_U(64) - off) & _U(63)), _U(0))) & self.mask

    def __getitem__(self, i) -> np.ndarray:
        i = np.atleast_1d(np.asarray(i, np.int64))
        return ((self._select(i, self.ones, False) - i) << self.bits) | self._low(i).astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Where each value stands, -1 where it does not: the successor search within its bucket of high bits."""
        values = np.asarray(values, np.int64)
        high = values >> self.bits
        inside = (values >= 0) & (high < self.zeros[-1])
        high = np.where(inside, high, 0)
        end = np.where(inside, np.minimum(self._select(high, self.zeros, True) - high, self.n), 0)
        place = np.where(inside & (high > 0), self._select(np.maximum(high - 1, 0), self.zeros, True) - high + 1, 0)
        want = values.astype(_U) & self.mask
        out = np.full(len(values), -1, np.int64)
        live = np.flatnonzero(place < end)
        while len(live):
            low = self._low(place[live])
            hit = low == want[live]
            out[live[hit]] = place[live[hit]]
            live = live[low < want[live]]
            place[live] += 1
            live = live[place[live] < end[live]]
        return out


class Quantised:
    """Numbers from low to high in 16 bits."""

    def __init__(self, codes: np.ndarray, low: float, step: float):
        self.codes, self.low, self.step = codes, low, step

    @classmethod
    def build(cls, values: np.ndarray) -> "Quantised":
        low, high = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
        step = (high - low) / 65535 or 1.0
        return cls(np.round((values - low) / step).astype(np.uint16), low, step)

    def __getitem__(self, i) -> np.ndarray:
        return self.low + self.codes[i] * self.step


class Trie:
    """Contexts with a value each, and their successors with a value each."""

    SEQUENCES, VALUES = ("keys", "pointers", "kids"), ("first", "second")

    def __init__(self, base: int, **parts):
        self.base = base
        self.__dict__.update(parts)

    @classmethod
    def build(cls, keys: np.ndarray, first: np.ndarray, owner: np.ndarray, kids: np.ndarray, second: np.ndarray) -> "Trie":
        """keys: sorted, distinct, >= 0, with values first; successors of the key numbered owner, by their short keys, with values second."""
        base = int(keys[0]) if len(keys) else 0
        order = np.argsort((owner.astype(np.int64) << SHORT) | kids, kind="stable")
        owner, kids, second = owner[order], kids[order], second[order]
        pointers = np.searchsorted(owner, np.arange(len(keys) + 1))
        seqs = (keys - base, pointers, (owner.astype(np.int64) << SHORT) | kids)
        return cls(base, **dict(zip(cls.SEQUENCES, map(EliasFano.build, seqs), strict=True)), **dict(zip(cls.VALUES, map(Quantised.build, (first, second)), strict=True)))

    def values(self, keys: np.ndarray, kids: np.ndarray) -> np.ndarray:
        """Each context's value and that of its successor kids (0: none asked); what is not here counts 0."""
        # Each context and successor is searched once, however often it is asked.
        distinct, where = np.unique(keys, return_inverse=True)
        at = self.keys.find(distinct - self.base)
        own = np.where(at >= 0, self.first[np.maximum(at, 0)] if self.keys.n else 0.0, 0.0)
        out, at = own[where], at[where]
        ask = np.flatnonzero((at >= 0) & (kids > 0))
        if len(ask) and self.kids.n:
            distinct, where = np.unique((at[ask] << SHORT) | kids[ask], return_inverse=True)
            own, found = distinct >> SHORT, self.kids.find(distinct)
            inside = (found >= self.pointers[own]) & (found < self.pointers[own + 1])
            out[ask] += np.where(inside, self.second[np.maximum(found, 0)], 0.0)[where]
        return out

    def dump(self) -> bytes:
        head, body, at = {"base": self.base}, [], 0

        def put(data: np.ndarray) -> list[int]:
            nonlocal at
            raw = data.tobytes()
            raw += b"\0" * (-len(raw) % 8)
            body.append(raw)
            at += len(raw)
            return [at - len(raw), len(data)]

        for name in self.SEQUENCES:
            seq = getattr(self, name)
            head[name] = [seq.n, seq.bits, *put(seq.low), *put(seq.high)]
        for name in self.VALUES:
            q = getattr(self, name)
            head[name] = [q.low, q.step, *put(q.codes)]
        raw = json.dumps(head).encode()
        raw += b" " * (-len(raw) % 8)
        return len(raw).to_bytes(8, "little") + raw + b"".join(body)

    @classmethod
    def load(cls, data) -> "Trie":
        """From bytes or a memory map (see open), which is read in place."""
        view = memoryview(data)
        size = int.from_bytes(view[:8], "little")
        head, body = json.loads(bytes(view[8 : 8 + size])), 8 + size
        got = lambda at, n, kind: np.frombuffer(view, kind, n, body + at)
        seqs = {n: EliasFano(head[n][0], head[n][1], got(*head[n][2:4], _U), got(*head[n][4:6], _U)) for n in cls.SEQUENCES}
        return cls(head["base"], **seqs, **{n: Quantised(got(*head[n][2:4], np.uint16), *head[n][:2]) for n in cls.VALUES})

    @classmethod
    def open(cls, path: str) -> "Trie":
        """A file of dump(), mapped into memory."""
        return cls.load(np.memmap(path, np.uint8, "r"))

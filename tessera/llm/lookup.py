"""Numbers looked up and words hashed for whole arrays at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_MULTIPLY = _U(0x9E3779B97F4A7C15)


class Map:
    """A fixed map from distinct numbers >= 0 to numbers >= 0, looked up for many at once; -1 where there is none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[left[free]]  # of several for one slot the last stays
            own = self.keys[slot] == keys[left]
            self.values[slot[own]] = values[left[own]]
            left, slot = left[~own], (slot[~own] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(_U) * _MULTIPLY) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], -1)
        at = np.flatnonzero((held != keys) & (held >= 0))
        slot = slot[at]
        while len(at):
            slot = (slot + 1) & self.mask
            held = self.keys[slot]
            hit = held == keys[at]
            out[at[hit]] = self.values[slot[hit]]
            more = ~hit & (held >= 0)
            at, slot = at[more], slot[more]
        return out


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Bytes between words: [\x20\x09-\x0D]; and a number for each other byte, A-Z as a-z.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mix(np.arange(1, 257, dtype=_U) * _MULTIPLY)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0xD1342543DE82EF95
#: Bytes hashed at once; a longer word is hashed alone.
_SPAN = 1 << 19


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(_BASE, -1, 1 << 64)
            self.up, self.down = (np.cumprod(np.concatenate((np.ones(1, _U), np.full(n, b, _U)))) for b in (_BASE, inverse))
        return self.up[:n], self.down[:n]


def word_hashes(texts: pa.Array, powers: list) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, how many of each text): the words between [\\x20\\x09-\\x0D]+, A-Z as a-z, as 63-bit hashes; a null text has none.

    powers: an empty list, kept from call to call. A word's hash is a polynomial of its bytes, from running sums, mixed.
    """
    if not powers:
        powers.append(_Powers())
    raw = b"\n".join(b if (b := t.as_buffer()) is not None else b"" for t in texts)
    data = np.frombuffer(raw, np.uint8)
    ink = ~_SPACE[data]
    step = np.diff(np.concatenate(([0], ink.view(np.int8), [0])))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    out = np.empty(len(starts), _U)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + _SPAN, "right")))
        low, n = int(starts[a]), int(ends[b - 1] - starts[a])
        up, down = powers[0].upto(n)
        sums = np.zeros(n + 1, _U)
        np.cumsum(_BYTE[data[low : low + n]] * up, out=sums[1:])
        s, e = starts[a:b] - low, ends[a:b] - low
        out[a:b] = (sums[e] - sums[s]) * down[s] + (e - s).astype(_U)
        a = b
    sizes = np.fromiter((len(b) if (b := t.as_buffer()) is not None else 0 for t in texts), np.int64, len(texts))
    edges = np.concatenate(([0], np.cumsum(sizes + 1)))
    return (mix(out) >> _U(1)).view(np.int64), np.diff(np.searchsorted(starts, edges))


def slices(texts: pa.Array, most: int):
    """(start, count) of neighbouring texts, together of about so many bytes; a longer text stands alone."""
    sizes = np.cumsum([len(b) if (b := t.as_buffer()) is not None else 0 for t in texts], dtype=np.int64)
    at = 0
    while at < len(texts):
        done = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield at, end - at
        at = end

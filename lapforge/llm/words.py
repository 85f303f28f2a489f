"""Words of many texts at once, as 64-bit numbers.

Python's ``split`` makes an object per word; here a whole Arrow column of texts
is cut and hashed with array operations on its bytes, which costs a few
nanoseconds per byte.  A word is a run of bytes other than space, tab, LF, VT,
FF and CR, with A-Z lowered; its number is a polynomial over its bytes modulo
2**64 with an odd base, mixed.  Texts are worked off in pieces of about
``PIECE`` bytes (whole texts, so one longer text is a piece of its own), which
bounds the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] += np.uint64(32)

_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 2 * PIECE)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            _POWERS[name] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base))])
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of ``n`` texts: ``code[bounds[i]:bounds[i + 1]]`` belong to text i of the piece that starts at row ``first``."""

    first: int
    n: int
    code: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    sums: np.ndarray

    def prefix(self, k: int) -> np.ndarray:
        """Numbers of the first k bytes of each word (of the whole word if it is shorter)."""
        stop = np.minimum(self.end, self.start + k)
        return mix((self.sums[stop] - self.sums[self.start]) * _powers(len(self.data))[1][self.start])

    def text(self, i: int) -> str:
        """The word at position i, lowered."""
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace").translate(_LOWER)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.bounds))


_LOWER = {i: i + 32 for i in range(65, 91)}


def pieces(column: pa.Array | pa.ChunkedArray) -> Iterator[Words]:
    """The words of every text of the column, piece by piece; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    everything = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + PIECE, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield _cut(everything[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first)
        first = last


def _cut(data: np.ndarray, offsets: np.ndarray, first: int) -> Words:
    n = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(first, n, np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), none, none, data, np.zeros(1, np.uint64))
    inside = _IS_WORD[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False  # a text's first byte continues nothing
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    after[ends] = False
    end = np.flatnonzero(inside & ~after) + 1
    up, down = _powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUE[data] * up[: len(data)], out=sums[1:])
    code = mix((sums[end] - sums[start]) * down[start])
    return Words(first, n, code, np.searchsorted(start, offsets), start, end, data, sums)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of k words, ascending, text by text: their numbers and the bounds of each text.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    sizes = np.diff(words.bounds)
    code = words.code
    rolled = np.zeros(max(0, len(code) - k + 1), np.uint64)
    for j in range(k):
        rolled = rolled * _STEP + code[j : j + len(rolled)]
    rolled = mix(rolled)
    parts, bounds = [], np.zeros(words.n + 1, np.int64)
    for i in range(words.n):
        at, size = words.bounds[i], sizes[i]
        if size >= k:
            own = np.sort(rolled[at : at + size - k + 1])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif size:
            value = np.uint64(size)
            with np.errstate(over="ignore"):
                for word in code[at : at + size]:
                    value = value * _STEP + word
            own = mix(np.array([value], np.uint64))
        else:
            own = code[:0]
        parts.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return (np.concatenate(parts) if parts else code[:0]), bounds


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

"""Terms of whole texts as 64-bit hashes, found by numpy in the texts' bytes.

By default a term is a maximal run of ASCII letters and digits and of any characters beyond
ASCII; only A-Z is lower-cased. That is `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, and in UTF-8 every byte of
a character beyond ASCII is at least 0x80, so bytes alone decide. Equal terms have equal hashes.
With NOT_SPACE, a term is what stands between spaces, tabs and line breaks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
# Bytes of text handled at a time; longer texts go alone, their hashes in pieces of this size.
CHUNK = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Which bytes, lower-cased, are part of a term.
LETTERS = np.zeros(256, bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[128:] = True
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[9:14] = NOT_SPACE[32] = False


def _powers(base: int) -> np.ndarray:
    out = np.full(CHUNK + 1, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, made once per worker."""
    if not _POWERS:
        _POWERS.extend((_powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))))
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


@dataclass
class Terms:
    """The terms of consecutive texts: `first[i]:first[i + 1]` are those of text `row + i`."""

    row: int
    first: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    lowered: np.ndarray

    def text(self, begin: int, end: int) -> str:
        """Terms `begin:end`, joined by spaces."""
        data = self.lowered
        return b" ".join(
            data[s:e].tobytes() for s, e in zip(self.start[begin:end], self.end[begin:end])
        ).decode("utf-8")


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Per term the sum of byte * base^place, with its length, mixed."""
    power, inverse = _tables()
    sums = np.zeros(len(start), _U)
    first = 0
    while first < len(start):
        last = int(np.searchsorted(end, start[first] + CHUNK, side="right"))
        if last <= first:  # one term longer than a piece
            total, at = 0, int(start[first])
            for low in range(at, int(end[first]), CHUNK):
                part = data[low : min(low + CHUNK, int(end[first]))].astype(_U)
                total += int((part * power[: len(part)]).sum(dtype=_U)) * pow(_BASE, low - at, 1 << 64)
            sums[first] = total & ((1 << 64) - 1)
            first += 1
            continue
        at = int(start[first])
        part = data[at : int(end[last - 1])].astype(_U)
        part *= power[: len(part)]
        running = np.zeros(len(part) + 1, _U)
        np.cumsum(part, out=running[1:])
        s, e = start[first:last] - at, end[first:last] - at
        sums[first:last] = (running[e] - running[s]) * inverse[s]
        first = last
    return mix(sums + (end - start).astype(_U))


def terms_of(texts: pa.Array, kind: np.ndarray = LETTERS) -> Iterator[Terms]:
    """The terms of all texts, in pieces of whole texts. Null has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        upto = int(np.searchsorted(ends, ends[row] + CHUNK, side="right")) - 1
        upto = min(max(upto, row + 1), len(texts))
        low, high = int(ends[row]), int(ends[upto])
        lowered = _LOWER[data[low:high]]
        inside = np.zeros(high - low + 2, np.int8)
        inside[1:-1] = kind[lowered]
        edge = np.diff(inside)
        # A term also ends where its text ends.
        cuts = ends[row + 1 : upto] - low
        cuts = cuts[(cuts > 0) & (cuts < high - low)]
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
        start = np.flatnonzero(edge == 1)
        end = np.flatnonzero(edge == -1)
        if len(cuts):
            cuts = np.unique(cuts)
            start, end = np.sort(np.concatenate((start, cuts))), np.sort(np.concatenate((end, cuts)))
        first = np.searchsorted(start, ends[row : upto + 1] - low)
        yield Terms(row, first, _hashes(lowered, start, end), start, end, lowered)
        row = upto


class Known:
    """A fixed set of hashes, sorted; finds their places in arrays of any size."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(np.asarray(hashes, _U))
        bits = min(26, max(10, int(len(self.hashes) * 16).bit_length()))
        self.mask = _U((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self.hashes & self.mask] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `values` that hold a known hash, and the places of these hashes."""
        at = np.flatnonzero(self.maybe[values & self.mask])
        if not len(self.hashes) or not len(at):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.hashes, values[at]), len(self.hashes) - 1)
        same = self.hashes[place] == values[at]
        return at[same], place[same]

"""Word and shingle hashes of Arrow text columns with numpy, a megabyte of text at a time.

A word hash is a polynomial over the word's bytes modulo 2**64, taken from prefix sums, so no step loops over words.
Hashes depend on nothing but the bytes: all workers and all runs agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
SHINGLE = 5

_P, _Q = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_U = np.uint64

_bytes = np.arange(256)
#: Bytes with A-Z lower-cased.
LOWERED = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
#: Word bytes: digits, letters and everything beyond ASCII.
ALNUM = ((_bytes >= 48) & (_bytes <= 57)) | ((LOWERED >= 97) & (LOWERED <= 122)) | (_bytes >= 128)
#: Word bytes: all but space and the five ASCII controls that separate words.
VISIBLE = ~((_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13)))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every bit of the input moves every bit of the output."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[_U(1)], np.full(max(n - 1, 0), _U(base))]).cumprod(dtype=np.uint64)


_tables: dict[str, np.ndarray] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(n, BLOCK + 1)
        _tables["up"] = _powers(_P, size)
        _tables["down"] = _powers(pow(_P, -1, 1 << 64), size)
    return _tables["up"], _tables["down"]


class Slice(NamedTuple):
    """Consecutive rows of a batch: their bytes, and where each row's bytes begin."""

    first: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Word spans in a slice; words of row r are [bounds[r], bounds[r + 1])."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def slices(column: pa.Array, limit: int = BLOCK) -> Iterator[Slice]:
    """The rows of a text column in slices of at most ``limit`` bytes, or one row; NULL reads as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        begin = offsets[first]
        yield Slice(first, last - first, data[begin : offsets[last]], offsets[first : last + 1] - begin)
        first = last


def words(part: Slice, is_word: np.ndarray = ALNUM) -> Words:
    inside = is_word[part.data]
    n = len(inside)
    row_start = np.zeros(n + 1, bool)
    row_start[part.offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    after = np.concatenate([inside[1:], [False]]) if n else inside
    starts = np.flatnonzero(inside & (~before | row_start[:n]))
    ends = np.flatnonzero(inside & (~after | row_start[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, part.offsets))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per word of the lower-cased bytes. Prefix sums restart every megabyte, so memory stays bounded."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            base = int(starts[at])
            stop = max(int(np.searchsorted(ends, base + BLOCK, "right")), at + 1)
            block = LOWERED[data[base : ends[stop - 1]]].astype(np.uint64) + _U(1)
            up, down = power_tables(len(block) + 1)
            sums = np.concatenate([[_U(0)], np.cumsum(block * up[: len(block)], dtype=np.uint64)])
            s, e = starts[at:stop] - base, ends[at:stop] - base
            out[at:stop] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            at = stop
    return out


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and their bounds by row; a row of fewer words is one run of all its words."""
    counts = np.diff(bounds)
    with np.errstate(over="ignore"):
        weights = [_U(pow(_Q, j, 1 << 64)) for j in range(size)]
        runs = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
        for j, w in enumerate(weights):
            runs += hashes[j : j + len(runs)] * w
        row = np.repeat(np.arange(len(counts)), counts)
        whole = row[: len(runs)] == row[size - 1 :] if len(runs) else np.zeros(0, bool)
        out, owner = mix(runs[whole]), row[: len(runs)][whole]
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            extra = []
            for r in short:
                h = hashes[bounds[r] : bounds[r + 1]]
                extra.append(sum(int(x) * int(w) for x, w in zip(h, weights)) % (1 << 64))
            out = np.concatenate([out, mix(np.array(extra, np.uint64))])
            owner = np.concatenate([owner, short])
            order = np.argsort(owner, kind="stable")
            out, owner = out[order], owner[order]
    return out, np.searchsorted(owner, np.arange(len(counts) + 1))


def texts(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()

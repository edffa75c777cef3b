"""Words of whole texts as numpy arrays: positions and 64-bit hashes, without a Python loop over words.

Both word rules of this package are decided byte by byte in UTF-8, because every
character from U+0080 on is a word character in either of them:

* ``SPACED``: runs of anything but U+0020 and U+0009-U+000D,
* ``ALNUM``: runs of 0-9, a-z and everything from U+0080 on.

A-Z are lower-cased first, but for ``CASED``, which is ``SPACED`` without that. Hashes are polynomials modulo 2**64 over random byte
values, finished by a mixing step; two different words or word sequences collide
with a chance of about 2**-60.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACED = _LOWER.copy()
SPACED[[0x20, *range(0x09, 0x0E)]] = 0
SPACED[0] = 0x0B  # a NUL is a word character here; 0x0B, a separator, is free to stand for it
CASED = np.where(SPACED == 0, 0, np.where(SPACED == 0x0B, 0x0B, np.arange(256))).astype(np.uint8)
ALNUM = np.where((np.arange(256) >= 0x80) | ((_LOWER >= 0x30) & (_LOWER <= 0x39)) | ((_LOWER >= 0x61) & (_LOWER <= 0x7A)), _LOWER, 0).astype(np.uint8)

_rng = np.random.default_rng(20240611)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD1342543DE82EF95)
_STEP_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))
_powers: dict[int, np.ndarray] = {}

SLICE_BYTES = 1 << 18
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept unless they are very many."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = ((n >> 16) + 1) << 16
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 4 * SLICE_BYTES:
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finish of a 64-bit hash, so that every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts, in order. ``first[i]:first[i + 1]`` are the words of text i."""

    raw: np.ndarray  # bytes of all texts
    offset: np.ndarray  # where each text begins, and the end of the last
    data: np.ndarray  # the same bytes, lower-cased, separators 0
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def text(self, a: int, b: int) -> bytes:
        """Words a..b-1 (of one text), joined by single spaces."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b], strict=True))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every k consecutive words of one text, and the index of their first word."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hash * powers(_STEP, n), out=sums[1:])
        h = (sums[k:] - sums[:-k]) * powers(_STEP_INVERSE, n)[: n - k + 1]
        ok = np.ones(n - k + 1, bool)
        for back in range(1, k):  # not across the end of a text
            at = self.first[1:-1] - back
            ok[at[(at >= 0) & (at < len(ok))]] = False
        at = np.flatnonzero(ok)
        return mix(h[at] + np.uint64(k)), at


def sequence_hash(hashes: np.ndarray) -> int:
    """What ``Words.windows`` gives for a whole sequence."""
    with np.errstate(over="ignore"):
        total = np.sum(hashes * powers(_STEP, len(hashes)), dtype=np.uint64)
        return int(mix(np.asarray([total + np.uint64(len(hashes))], np.uint64))[0])


def scan(texts: pa.Array, table: np.ndarray) -> Words:
    """The words of an Arrow string array (null: no words)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[lo:hi] if hi > lo else np.zeros(0, np.uint8)
    offsets = offsets - lo if len(texts) else np.zeros(1, np.int64)
    data = table[raw]
    n = len(data)
    inside = data != 0
    begins = np.empty(n, bool)
    ends = np.empty(n, bool)
    if n:
        begins[0], ends[-1] = inside[0], inside[-1]
        np.logical_and(inside[1:], ~inside[:-1], out=begins[1:])
        np.logical_and(inside[:-1], ~inside[1:], out=ends[:-1])
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        begins[cut] = inside[cut]
        ends[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    sums = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUE[data] * powers(_BASE, n), out=sums[1:])
        h = mix((sums[end] - sums[start]) * powers(_INVERSE, n)[start]) if n else np.zeros(0, np.uint64)
    return Words(raw, offsets, data, start, end, np.searchsorted(start, offsets), h)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``limit`` bytes (one text at least)."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)
    give_back()


def give_back() -> None:
    """Returns freed memory to the system; Python workers are reused and would keep it."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)

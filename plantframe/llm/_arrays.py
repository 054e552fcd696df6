"""Array helpers for Arrow batches of text: words, hashes, minimal windows.

Everything works on the flat UTF-8 buffer of a batch, so a document costs no
Python call of its own.  Batches are cut into blocks of a few MB of text
(``text_blocks``); one block is what a task holds at a time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Text per block: some 25 arrays of 8 bytes a character stay near 60 MB.
BLOCK_BYTES = 300_000

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or have.size < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """``out[j] - out[i]`` times the inverse power ``i`` is the hash of ``codes[i:j]``."""
    out = np.zeros(codes.size + 1, np.uint64)
    np.cumsum(codes * _power(_P, codes.size), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each range of codes, whatever its place in the buffer."""
    return mix((sums[end] - sums[start]) * _power(_PINV, sums.size)[start] + (end - start).astype(np.uint64))


def run_hash(sums: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` codes from each place on."""
    n = max(sums.size - k, 0)
    return mix((sums[k:] - sums[:n]) * _power(_PINV, n) + U64(k))


def sliding(op: np.ufunc, x: np.ndarray, w: int) -> np.ndarray:
    """``op`` (minimum or maximum) over each ``w`` neighbours, by doubling."""
    if x.size < w:
        return x[:0]
    have, out = 1, x
    while have * 2 <= w:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[: x.size - w + 1], out[w - have:][: x.size - w + 1]) if have < w else out


def give_back() -> None:
    """Return freed memory to the system: workers are reused, and the allocator keeps what a large step has freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document bounds of a string column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a block holds one document or at most ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = text_buffer(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
            yield batch.slice(at, min(end, batch.num_rows) - at)
            at = end


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each document of a block.

    ``start``/``end``: byte range of a word; ``doc``: its document; ``first``:
    the first word of each document (one more entry at the end); ``code``: a
    64-bit hash of the word's bytes.
    """

    def __init__(self, raw: np.ndarray, bounds: np.ndarray):
        self.raw, self.bounds = raw, bounds
        inside = ~_SPACE[raw]
        before = np.empty(raw.size, bool)
        if raw.size:
            before[0] = False
            before[1:] = inside[:-1]
            before[bounds[:-1][bounds[:-1] < raw.size]] = False
        after = np.empty(raw.size, bool)
        if raw.size:
            after[-1] = False
            after[:-1] = inside[1:]
            cuts = bounds[1:-1]
            after[cuts[cuts > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(bounds) - 1), self.count)
        self.code = range_hash(prefix_sums(_BYTE_CODE[raw]), self.start, self.end)


def byte_codes(raw: np.ndarray) -> np.ndarray:
    return _BYTE_CODE[raw]


class Runs:
    """Windows of ``size`` units (words or bytes) grouped by the place of their least ``k``-gram (the anchor).

    Neighbouring windows of one document with the same anchor form a run.  The
    anchor depends on a window's units only, so two documents that share a
    window have it in runs of the same ``key``.  ``lo``/``hi``: first and last
    window of the run (index of its first unit), ``doc``: its document,
    ``content``: hash of all units that its windows cover, ``side``: hashes of
    4 bits of the ``(size - k) // 2`` units left and right of the anchor (0:
    the run ends before).  Runs that share a window share a side that is not 0,
    as a window has so many units on one side of its anchor.
    """

    def __init__(self, codes: np.ndarray, first: np.ndarray, size: int, k: int):
        self.size, self.sums = size, prefix_sums(codes)
        grams = run_hash(self.sums, k)
        n_windows = np.maximum(np.diff(first) - size + 1, 0)
        doc_of = np.repeat(np.arange(n_windows.size), n_windows)
        ahead = np.cumsum(n_windows) - n_windows
        window = np.arange(doc_of.size) + np.repeat(first[:-1] - ahead, n_windows)
        if not window.size:
            self.lo = self.hi = self.doc = np.zeros(0, np.int64)
            self.key = self.content = np.zeros(0, np.uint64)
            self.side = np.zeros(0, np.uint8)
            return
        place = U64((1 << int(codes.size).bit_length()) - 1)
        ranked = (grams & ~place) | np.arange(grams.size, dtype=np.uint64)
        least = sliding(np.minimum, ranked, size - k + 1)[window]
        new = np.ones(window.size, bool)
        new[1:] = (least[1:] != least[:-1]) | (doc_of[1:] != doc_of[:-1])
        at = np.flatnonzero(new)
        self.lo, self.hi, self.doc = window[at], window[np.append(at[1:], window.size) - 1], doc_of[at]
        anchor = (least[at] & place).astype(np.int64)
        self.key = grams[anchor]
        self.content = range_hash(self.sums, self.lo, self.hi + size)
        half = (size - k) // 2
        end = self.hi + size
        left = range_hash(self.sums, np.maximum(anchor - half, 0), anchor) % U64(15) + U64(1)
        right = range_hash(self.sums, np.minimum(anchor + k, end), np.minimum(anchor + k + half, end)) % U64(15) + U64(1)
        left[anchor - half < self.lo] = 0
        right[anchor + k + half > end] = 0
        self.side = (left | (right << U64(4))).astype(np.uint8)


def planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit values, byte by byte, so that equal high bytes lie together and compress."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(raw: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width).reshape(width, n).T
    return out.reshape(-1).view("<u8")

"""Vectorised word splitting and hashing inside tasks.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D`` (on UTF-8 text the same
as on code points).  The hash of a word is a polynomial over random 64-bit byte values, taken from
prefix sums of the whole buffer, so that a block of texts is hashed by a few array operations
instead of one Python call a word.  Two different words of a corpus with V words share a hash with
probability about V² / 2⁶²."""
from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
BATCH_ROWS = 512

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2⁶⁴."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def release() -> None:
    """Give freed memory back to the system, where the C library can: a worker process lives on between tasks."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[buf]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power_table(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def small(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def groups(sizes: Sequence[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of neighbouring texts with at most ``limit`` bytes together (or one text)."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n + 1
    if first < len(sizes):
        yield first, len(sizes)


def _pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """Cut a long text between words into pieces of about ``limit`` bytes."""
    at, n = 0, len(text)
    while at < n:
        end = min(at + limit, n)
        if end < n:
            rest = np.frombuffer(text, dtype=np.uint8, count=n - end, offset=end)
            for k in range(0, len(rest), limit):
                hit = np.flatnonzero(_SPACE[rest[k:k + limit]])
                if len(hit):
                    end += k + int(hit[0])
                    break
            else:
                end = n
        yield text[at:end]
        at = end


def word_hashes(texts: Sequence[bytes], limit: int = BLOCK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Words per text and the hashes of all words, text after text."""
    if sum(map(len, texts)) + len(texts) <= 2 * limit:
        buf = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        starts, ends = word_spans(buf)
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
        counts = np.diff(np.searchsorted(starts, bounds))
        return counts, span_hashes(buf, starts, ends)
    counts, parts = [], []
    for text in texts:
        total = 0
        for piece in _pieces(text, limit):
            buf = np.frombuffer(piece, dtype=np.uint8)
            starts, ends = word_spans(buf)
            parts.append(span_hashes(buf, starts, ends))
            total += len(starts)
        counts.append(total)
    return np.array(counts, dtype=np.int64), np.concatenate(parts) if parts else np.zeros(0, np.uint64)

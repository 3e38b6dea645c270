"""Array kernels over the raw UTF-8 bytes of Arrow string columns: batches, word spans, span hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
_HASH_BLOCK = 1 << 16
_R = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2^64
_R_INVERSE = pow(_R, -1, 1 << 64)
_BYTE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of the contamination rule: digits, lower-case letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Words of the shingle rule: everything but ASCII white space.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[32, 9, 10, 11, 12, 13]] = False


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the row offsets into them, starting at 0; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return buf, off - off[0]


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds at most ``limit`` bytes, or one longer row."""
    for batch in batches:
        _, off = flat(batch.column(column))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def word_spans(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte and row of every maximal run of word bytes; no run crosses a row."""
    inside = is_word[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(buf))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, _HASH_BLOCK + 4096)
        for name, base in (("up", _R), ("down", _R_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, wherever it stands. Spans ascend and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _HASH_BLOCK, "right")))
        base = starts[i]
        seg = buf[base:ends[j - 1]]
        up, down = _powers(len(seg) + 1)
        total = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(_BYTE[seg] * up[:len(seg)], out=total[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """An order-sensitive hash of aligned hash columns."""
    h = np.full(len(parts[0]), 0x2545F4914F6CDD1D, np.uint64)
    for p in parts:
        h = mix(h * np.uint64(_R) + p)
    return h


def row_slices(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row's entries in an ascending array of row numbers."""
    return np.searchsorted(rows, np.arange(n_rows + 1))

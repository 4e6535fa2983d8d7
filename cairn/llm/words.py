"""Words of Arrow string batches as 64-bit hashes, in numpy.

A word is a run of ``0-9``, ``a-z`` (``A-Z`` lower-cased) and any non-ASCII character; everything else separates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000


def byte_table() -> bytes:
    """Maps each UTF-8 byte to itself, lower-cased for A-Z, and to a space where no word may hold it."""
    keep = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
    return bytes(b if b in keep else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after last, bytes, byte offsets per row) of consecutive rows with about ``limit`` bytes.

    Nulls count as empty. A single longer text is a slice of its own.
    """
    column = column.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash per word, index of each row's first word plus the total)."""
    table = np.frombuffer(byte_table(), dtype=np.uint8)
    low = table[data]
    inside = low != 0x20
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    body = np.flatnonzero(inside)
    at = np.searchsorted(body, starts)
    lengths = np.diff(np.append(at, len(body)))
    place = np.arange(len(body)) - np.repeat(at, lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    sums = np.add.reduceat((low[body].astype(np.uint64) + np.uint64(1)) * powers[place], at)
    return mix(sums + lengths.astype(np.uint64)), first


def window_hashes(words: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words, by first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, seed, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k: k + n]
    return mix(out)


def doubled_window_hashes(words: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """As :func:`window_hashes` in a number of steps that grows with the logarithm of ``size``."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = np.uint64(0xD6E8FEB86659FD93)
    out, done = np.full(n, seed, np.uint64), 0
    power, width, step = mix(words + np.uint64(seed)), 1, np.array([base])
    while done < size:
        if size & width:
            out = out * step + power[done: done + n]
            done += width
        if done < size:
            power = power[: len(power) - width] * step + power[width:]
            width, step = width * 2, np.multiply(step, step)
    return mix(out)

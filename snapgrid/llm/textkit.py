"""Vectorised text primitives for Arrow batches: byte runs, their hashes, per-document reductions.

A batch of texts is one byte array with offsets, as Arrow holds it. Words are runs of member bytes; they
never cross a document border. Every step costs a fixed number of numpy passes, and no temporary array
holds more than a bounded number of bytes besides one mask byte for each byte of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
SLICE_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C55 | 1)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


_POWER = _powers(int(_BASE), 2 * BLOCK)
_INVERSE = _powers(pow(int(_BASE), -1, 1 << 64), 2 * BLOCK)
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def ascii_lower() -> np.ndarray:
    """Byte table that maps A-Z to a-z and leaves the rest."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def members(*ranges: tuple[int, int]) -> np.ndarray:
    """Byte table that is true inside the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


LOWER = ascii_lower()
#: Bytes of words that white space separates: all but space and tab to carriage return.
NOT_SPACE = ~members((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of digits, lower-case letters and everything outside ASCII.
ALNUM = members((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        if lengths.sum() != offsets[-1] - offsets[0]:  # a null with bytes behind it
            column = column.fill_null("")
            return texts(column)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` text bytes; a longer text has a slice of its own."""
    _, offsets = texts(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal member runs, and the index of each document's first run (n + 1 values)."""
    inside = member[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    opens[borders] = inside[borders]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] = inside[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; equal bytes have equal hashes wherever they stand.

    Runs are ordered and do not overlap. The sum of byte values times powers of an odd base, taken as
    differences of running sums and shifted back by the inverse power, is done block by block.
    """
    return spans_hash(_BYTE_VALUE, starts, ends, data)


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, index: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``values[starts:ends]`` (of ``values[index[...]]``, if given) for ordered spans without overlap."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)

    def own(low: int, high: int) -> np.ndarray:
        return values[low:high] if index is None else values[index[low:high]]

    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        if high - low > 2 * BLOCK:  # one run that no block holds
            out[i:j] = _long_run(own(low, high))
        else:
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(own(low, high) * _POWER[: high - low], out=total[1:])
            a, b = starts[i:j] - low, ends[i:j] - low
            out[i:j] = (total[b] - total[a]) * _INVERSE[a]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _long_run(values: np.ndarray) -> np.uint64:
    total = 0
    for at in range(0, len(values), BLOCK):
        part = values[at : at + BLOCK]
        value = int((part * _POWER[: len(part)]).sum(dtype=np.uint64))
        total = (total + value * pow(int(_BASE), at, 1 << 64)) % (1 << 64)
    return np.uint64(total)


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of code points of each document: bytes that are no UTF-8 continuation."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def groups(first: np.ndarray) -> np.ndarray:
    """The document of each run, from the documents' first runs."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(word_hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``width`` words, and each document's first window (n + 1 values).

    A document of fewer words, but not none, has its whole sequence as one window.
    """
    counts = np.diff(first)
    windows = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(windows)])
    if not len(word_hashes):
        return np.zeros(0, np.uint64), out_first
    at = np.repeat(first[:-1], windows) + np.arange(out_first[-1]) - np.repeat(out_first[:-1], windows)
    size = np.repeat(np.minimum(counts, width), windows)
    total = size.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    for k in range(width):
        step = np.uint64(pow(0x9FB21C651E98DF25, k + 1, 1 << 64))
        take = word_hashes[np.minimum(at + k, len(word_hashes) - 1)] * step
        if (size <= k).any():
            take[size <= k] = 0
        total += take
    return mix(total), out_first


def distinct_per_group(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each group, and the groups' new borders."""
    if not len(values):
        return values, np.zeros(len(first), np.int64)
    out = values.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[first[:-1][np.diff(first) > 0]] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], total[first]

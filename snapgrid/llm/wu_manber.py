"""Benchmark decontamination: multi-pattern search over words after Wu and Manber.

The patterns are the windows of ten words of the benchmark items (an item of fewer words is one pattern). A
shift table over hashed blocks of two words says how far the search may jump; a position whose block ends
some pattern is looked up in suffix-hash buckets, where the prefix hash narrows the candidates, and the
words themselves are compared one by one. Texts are scanned in segments side by side, each with its own
position, so the jumps of thousands of segments are one numpy step.

At scale: documents are read once and never shuffled. The benchmark is split into blocks of bounded size;
each block is one table set that travels with the tasks, and one scan after another adds its findings to
the row, so a larger benchmark means more scans, not more memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapgrid.llm import textkit as tk
from snapgrid.llm.frames import fresh_name, list_array, tidy

WINDOW = 10
#: Benchmark bytes that one set of search tables may hold.
BLOCK_BYTES = 8 << 20
_SEGMENT = 128
_TABLE_BITS = 18
_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of every text, and each text's first word."""
    low = tk.LOWER[data]
    starts, ends, first = tk.runs(low, offsets, tk.ALNUM)
    return tk.run_hashes(low, starts, ends), starts, ends, first


@dataclass
class Matcher:
    """Patterns of one length: their words, the items that have them, and the search tables."""

    length: int
    words: np.ndarray  # patterns x length
    items: np.ndarray  # numbers of items, pattern after pattern
    item_borders: np.ndarray
    shift: np.ndarray
    buckets: np.ndarray  # sorted hashes of (last block, first block)
    order: np.ndarray  # patterns in that order

    @property
    def block(self) -> int:
        return min(2, self.length)

    @staticmethod
    def build(words: np.ndarray, item: np.ndarray) -> "Matcher":
        """``words``: one row for each occurrence in an item, ``item``: its number."""
        length = words.shape[1]
        order = np.lexsort((item, *words.T[::-1]))
        words, item = words[order], item[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]).any(1)
        number = np.cumsum(new) - 1
        once = np.ones(len(words), bool)
        once[1:] = (number[1:] != number[:-1]) | (item[1:] != item[:-1])
        borders = np.concatenate([[0], np.cumsum(np.bincount(number[once]))])
        words = words[new]
        block = min(2, length)
        shift = np.full(1 << _TABLE_BITS, length - block + 1, np.int32)
        for end in range(block - 1, length):
            at = _cell(_block_hash(words[:, end], words[:, end - 1] if block == 2 else None))
            np.minimum.at(shift, at, length - 1 - end)
        key = _bucket_hash(words, block)
        by_key = np.argsort(key, kind="stable")
        return Matcher(length, words, item[once], borders, shift, key[by_key], by_key)

    def find(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last words and pattern numbers of all occurrences inside the documents."""
        m = self.length
        lows, highs = first[:-1] + m - 1, first[1:]
        pieces = np.maximum(0, -(-(highs - lows) // _SEGMENT))
        if not pieces.sum():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(lows, pieces) + nth * _SEGMENT
        stop = np.minimum(at + _SEGMENT, np.repeat(highs, pieces))
        before = None if self.block == 1 else np.concatenate([hashes[:1], hashes[:-1]])
        jump = self.shift[_cell(_block_hash(hashes, before))]
        found = []
        while len(at):
            step = jump[at]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            inside = at < stop
            at, stop = at[inside], stop[inside]
        ends = np.concatenate(found)
        window = hashes[ends[:, None] + np.arange(1 - m, 1)]
        key = _bucket_hash(window, self.block)
        low, high = np.searchsorted(self.buckets, key, "left"), np.searchsorted(self.buckets, key, "right")
        count = high - low
        which = np.repeat(np.arange(len(ends)), count)
        pattern = self.order[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        same = (window[which] == self.words[pattern]).all(1)
        return ends[which[same]], pattern[same]


def _block_hash(last: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    return last * _K1 if before is None else last * _K1 + before * _K2


def _cell(block_hash: np.ndarray) -> np.ndarray:
    return (block_hash >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _bucket_hash(words: np.ndarray, block: int) -> np.ndarray:
    if block == 1:
        return words[:, 0] * _K3
    return _block_hash(words[:, -1], words[:, -2]) * _K3 + _block_hash(words[:, 1], words[:, 0])


def matchers(item_texts: pa.Array, window: int = WINDOW) -> list[Matcher]:
    """One matcher for each pattern length that occurs. Items without words have no pattern."""
    hashes, _, _, first = words_of(*tk.texts(item_texts))
    by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for item, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b > a:
            rows = np.lib.stride_tricks.sliding_window_view(hashes[a:b], min(window, b - a))
            by_length.setdefault(rows.shape[1], []).append((rows, np.full(len(rows), item)))
    return [
        Matcher.build(np.concatenate([r for r, _ in parts]), np.concatenate([i for _, i in parts]))
        for _, parts in sorted(by_length.items())
    ]


def occurrences(column: pa.Array, found: list[Matcher]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First words of the texts, a mark for each word inside an occurrence, and distinct (text, item) pairs."""
    hashes, _, _, first = words_of(*tk.texts(column))
    change = np.zeros(len(hashes) + 1, np.int64)
    rows, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m in found:
        ends, pattern = m.find(hashes, first)
        np.add.at(change, ends - m.length + 1, 1)
        np.add.at(change, ends + 1, -1)
        row = np.searchsorted(first, ends, "right") - 1
        count = np.diff(m.item_borders)[pattern]
        start = np.repeat(m.item_borders[pattern], count) - np.repeat(np.cumsum(count) - count, count)
        rows.append(np.repeat(row, count))
        items.append(m.items[start + np.arange(count.sum())])
    pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(items)]), axis=1)
    return first, np.cumsum(change)[:-1] > 0, pairs[0], pairs[1]


def _scan(block: list[tuple[str | None, str | None]], names: dict[str, str], window: int):
    """Adds the findings of one benchmark block to the rows."""
    texts, ids = [text for _, text in block], [item for item, _ in block]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = matchers(pa.array(texts, pa.string()), window)
        for batch in batches:
            for part in tk.slices(batch, names["text"]):
                yield _added(part, found)

    def _added(part: pa.RecordBatch, found: list[Matcher]) -> pa.RecordBatch:
        first, hit, row, item = occurrences(part.column(names["text"]), found)
        old_items, old_hits = part.column(names["items"]).to_pylist(), part.column(names["hits"]).to_pylist()
        lists = [set(x or ()) for x in old_items]
        for r, i in zip(row.tolist(), item.tolist()):
            if ids[i] is not None:
                lists[r].add(ids[i])
        totals = np.concatenate([[0], np.cumsum(hit)])
        hits, n_hit = [], []
        for r, old in enumerate(old_hits):
            a, b = int(first[r]), int(first[r + 1])
            if old is None and totals[a] == totals[b]:
                hits.append(None)
                n_hit.append(0)
                continue
            own = hit[a:b]
            if old is not None:
                own = own | np.unpackbits(np.frombuffer(old, np.uint8), count=b - a).astype(bool)
            hits.append(np.packbits(own).tobytes())
            n_hit.append(int(own.sum()))
        columns = dict(zip(part.schema.names, part.columns))
        columns[names["n_words"]] = pa.array(np.diff(first).astype(np.int64))
        flat = [sorted(x) for x in lists]
        borders = np.concatenate([[0], np.cumsum([len(x) for x in flat], dtype=np.int64)])
        columns[names["items"]] = list_array(pa.array([i for x in flat for i in x], pa.string()), borders)
        columns[names["hits"]] = pa.array(hits, pa.binary())
        columns[names["n_hit"]] = pa.array(n_hit, pa.int64())
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return scan


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list]:
    """The items in groups of about ``block_bytes``, one at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    items = items.where("text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        yield [(r.item, r.text) for r in own.collect()]


@dataclass(frozen=True)
class Found:
    """Documents with their findings, and the names of the added columns."""

    rows: DataFrame
    names: dict[str, str]


def find_items(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> Found:
    """All columns of ``documents`` with ``n_words`` long, ``n_hit`` long, ``items`` array<string> (ids of the items that occur,
    sorted) and ``hits`` binary (a bit for each word inside an occurrence, null if none).

    Words are runs of digits, letters and non-ASCII characters, lower-cased in ASCII. Null and empty texts have
    no words and no items; an item without words occurs nowhere; items without an id mark words but are not
    listed; repeated items and rows of an id count once. Added columns take underscores where a name is taken.
    """
    names = {"text": text} | {n: fresh_name(n, documents.columns) for n in ("n_words", "n_hit", "items", "hits")}
    rows = documents.select(
        *[F.col(f"`{c}`") for c in documents.columns],
        F.lit(0).cast("long").alias(names["n_words"]),
        F.lit(0).cast("long").alias(names["n_hit"]),
        F.lit(None).cast("array<string>").alias(names["items"]),
        F.lit(None).cast("binary").alias(names["hits"]),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    for block in benchmark_blocks(benchmark, item_id, item_text, block_bytes):
        rows = rows.mapInArrow(tidy(_scan(block, names, window)), schema)
    return Found(rows, names)


def decontaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that contain no window of any item, with their own columns."""
    found = find_items(documents, benchmark, **options)
    return found.rows.where(F.col(f"`{found.names['hits']}`").isNull()).select(*[F.col(f"`{c}`") for c in documents.columns])

"""Packing of tokenised documents into training sequences: bounded-space online best fit.

Each partition keeps a fixed number of open windows. A document is cut into full windows and a rest; the rest
goes to the open window it fits best; when none fits, the fullest is emitted and a new one opened. What is
still open at the end of a partition is merged: the pieces of many partitions' leftovers are packed again,
largest first, by best fit.

At scale: documents are read once and not shuffled. Only the leftovers, a bounded number for each partition,
are moved, in groups of a bounded number of partitions, as rows of a few numbers. Token ids come from the
tokenizer library; each worker encodes a word once and looks it up afterwards.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapgrid.llm import textkit as tk
from snapgrid.llm.frames import sorted_groups, tidy
from snapgrid.session import materialize

_LETTERS = tk.members((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_DIGITS = tk.members((0x30, 0x39))
_SPACE = tk.members((0x20, 0x20), (0x09, 0x0D))
#: Bytes whose neighbours may change how a run is split: controls and the apostrophe of contractions.
_ODD = tk.members((0x00, 0x08), (0x0E, 0x1F), (0x27, 0x27), (0x7F, 0x7F))


#: Pieces that the library encodes in one call; its results are large while they last.
_AT_ONCE = 10_000


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space and never joins letters, digits and symbols.

    A text is split into runs of letters, single digits and runs of other symbols; every distinct run is
    encoded once and kept. Where a run's bytes do not settle how the tokenizer splits (apostrophes, controls,
    characters outside ASCII that are no letters), the whole stretch between white space is encoded instead.
    """

    def __init__(self, path: str, remember: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.remember = remember
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.safe = np.zeros(0, bool)
        self.borders = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint16)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for at in range(0, len(pieces), _AT_ONCE):
            lists = [x.ids for x in self.tokenizer.encode_batch_fast(pieces[at : at + _AT_ONCE], add_special_tokens=False)]
            ids.append(np.fromiter((i for x in lists for i in x), np.uint16))
            sizes.append(np.array([len(x) for x in lists], np.int64))
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        texts = [p.decode("utf-8", "replace") for p in pieces]
        safe = [t.isascii() or (t.isalpha() and t.lower().isalpha()) for t in texts]
        ids, borders = self._encode(texts)
        slots = np.arange(len(hashes)) + len(self.safe)
        self.ids = np.concatenate([self.ids, ids])
        self.borders = np.concatenate([self.borders, borders[1:] + self.borders[-1]])
        self.safe = np.concatenate([self.safe, np.array(safe, bool)])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known, self.slot = known[order], np.concatenate([self.slot, slots])[order]

    def _slots(self, hashes: np.ndarray, piece: Callable[[int], bytes]) -> np.ndarray:
        codes, distinct = pd.factorize(hashes)
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != distinct
        if new.any():
            if len(self.known) + int(new.sum()) > self.remember:
                self._forget()
                new[:] = True  # this slice needs all of its own
            example = np.full(len(distinct), -1, np.int64)
            example[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            self._learn(distinct[new], [piece(i) for i in example[new].tolist()])
            at = np.searchsorted(self.known, distinct)
        return self.slot[at][codes]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the texts' borders."""
        data, offsets = tk.texts(column)
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
        letter, digit, space = _LETTERS[data], _DIGITS[data], _SPACE[data]
        kind = np.where(letter, 1, np.where(space, 0, 2)).astype(np.int8)
        opens = np.ones(len(data), bool)
        opens[1:] = (kind[1:] != kind[:-1]) | digit[1:] | digit[:-1]
        opens[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(opens)
        ends = np.concatenate([starts[1:], [len(data)]])
        inked = kind[starts] != 0
        starts, ends = starts[inked], ends[inked]
        low = tk.LOWER[data]
        slots = self._slots(tk.run_hashes(low, starts, ends), lambda i: low[starts[i] : ends[i]].tobytes())
        odd = np.concatenate([[0], np.cumsum(_ODD[data])])
        unsafe = ~self.safe[slots] | (odd[ends] > odd[starts])
        ids, borders, counts = self._spread(slots)
        if unsafe.any():
            ids, counts = self._with_stretches(data, offsets, starts, unsafe, ids, borders, counts)
        first = np.searchsorted(starts, offsets)
        totals = np.concatenate([[0], np.cumsum(counts)])
        return ids, totals[first]

    def _spread(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = self.borders[slots + 1] - self.borders[slots]
        borders = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(self.borders[slots] - borders[:-1], counts) + np.arange(borders[-1])
        return self.ids[at], borders, counts

    def _with_stretches(self, data, offsets, starts, unsafe, ids, borders, counts):
        """Replace the ids of every stretch between white space that holds an unsafe run."""
        stretch_starts, stretch_ends, _ = tk.runs(data, offsets, ~_SPACE)
        of = np.searchsorted(stretch_starts, starts, "right") - 1
        wanted = np.unique(of[unsafe])
        first = np.searchsorted(of, wanted)
        last = np.searchsorted(of, wanted, "right")
        texts = [data[stretch_starts[w] : stretch_ends[w]].tobytes().decode("utf-8", "replace") for w in wanted]
        new_ids, new_borders = self._encode(texts)
        counts = counts.copy()
        pieces, at = [], 0
        for i, (a, b) in enumerate(zip(first.tolist(), last.tolist())):
            pieces.append(ids[at : borders[a]])
            pieces.append(new_ids[new_borders[i] : new_borders[i + 1]])
            at = borders[b]
            counts[a:b] = 0
            counts[a] = new_borders[i + 1] - new_borders[i]
        pieces.append(ids[at:])
        return np.concatenate(pieces), counts


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's own encoder; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


@dataclass(frozen=True)
class Settings:
    """``open_windows`` stay open in each partition; leftovers of ``merged`` partitions are packed together."""

    tokenizer: str
    size: int = 2048
    end_id: int = 1
    open_windows: int = 128
    merged: int = 64


class OpenWindows:
    """A fixed number of open windows: best fit, and the fullest goes when none fits."""

    def __init__(self, size: int, limit: int | None):
        self.size, self.limit = size, limit
        self.gaps: list[tuple[int, int]] = []  # (room left, window), ascending
        self.pieces: dict[int, list] = {}
        self.next = 0

    def place(self, piece, length: int) -> list | None:
        """Puts a piece in; returns the pieces of a window that is thereby finished, if any."""
        at = bisect_left(self.gaps, (length, -1))
        done = None
        if at == len(self.gaps):
            if self.limit is not None and len(self.gaps) >= self.limit:
                done = self.pieces.pop(self.gaps.pop(0)[1])
            window, room = self.next, self.size
            self.next += 1
            self.pieces[window] = []
        else:
            room, window = self.gaps.pop(at)
        self.pieces[window].append(piece)
        if room == length:
            full = self.pieces.pop(window)
            if done is None:
                return full
            raise AssertionError("a piece that fills a new window is cut off before")
        insort(self.gaps, (room - length, window))
        return done

    def rest(self) -> list[list]:
        return [self.pieces[w] for _, w in self.gaps]


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_COLUMNS = [c.split()[0] for c in _PIECE.split(", ")]


def _pack(settings: Settings):
    """Pieces with partition, window and offset; ``open`` marks the pieces of leftovers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(settings.tokenizer)
        windows = OpenWindows(settings.size, settings.open_windows)
        partition = TaskContext.get().partitionId()
        number = 0
        out: list[tuple] = []

        def emit(pieces: list, left: bool) -> None:
            nonlocal number
            offset = 0
            for p in pieces:
                out.append((*p, partition, number, offset, left))
                offset += p[2]
            number += 1

        for batch in batches:
            for part in tk.slices(batch, "text"):
                ids, borders = words.encode(part.column("text"))
                ids = ids.astype("<u4")
                end = np.array([settings.end_id], "<u4")
                for doc, a, b in zip(part.column("doc_id").to_pylist(), borders[:-1].tolist(), borders[1:].tolist()):
                    own = np.concatenate([ids[a:b], end])
                    for start in range(0, len(own), settings.size):
                        cut = own[start : start + settings.size]
                        piece = (doc, start, len(cut), zlib.crc32(cut.tobytes()), len(own))
                        if len(cut) == settings.size:
                            emit([piece], False)
                        elif (done := windows.place(piece, len(cut))) is not None:
                            emit(done, False)
                yield _rows(out)
                out.clear()
        for pieces in windows.rest():
            emit(pieces, True)
        yield _rows(out)

    return pack


_PACKED = f"{_PIECE}, part int, window long, offset long, open boolean"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    columns = list(zip(*rows)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in _PACKED.split(", ")]
    )


def _merge(settings: Settings):
    """Packs the pieces of each group of leftovers again, largest first."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bin"]):
            rows = list(zip(*[group.column(c).to_pylist() for c in _COLUMNS]))
            windows = OpenWindows(settings.size, None)
            full = [w for p in rows if (w := windows.place(p, p[2])) is not None]
            number = group.column("bin")[0].as_py()
            out = []
            for w, pieces in enumerate([*full, *windows.rest()]):
                offset = 0
                for p in pieces:
                    out.append((*p, number, w, offset, False))
                    offset += p[2]
            yield _rows(out)

    return merge


def packed(documents: DataFrame, settings: Settings, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece of a document: ``doc_id``, ``start`` and ``length`` in its ids, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id`` and ``offset`` there.

    Every document ends with ``end_id``; a null or empty text is that id alone. Only documents longer than a
    window are cut, every ``size`` ids; texts may be of any length. Of windows that fit equally well the first opened is
    taken. Repeated rows are packed each for itself; a null doc_id stays null; an empty table gives no rows. Other
    columns are not read.
    """
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    first = materialize(source.mapInArrow(tidy(_pack(settings)), _PACKED), "packing-first")
    left = first.where("open").withColumn("bin", F.floor(F.col("part") / settings.merged).cast("int"))
    left = left.repartition("bin").sortWithinPartitions("bin", F.desc("length"), "part", "window", "offset")
    merged = left.select(*_COLUMNS, "bin").mapInArrow(tidy(_merge(settings)), _PACKED)

    def numbered(rows: DataFrame, merged: int) -> DataFrame:
        high = F.shiftleft(F.lit(2).cast("long") * F.col("part") + merged, 32)
        return rows.select(*_COLUMNS, (high + F.col("window")).alias("sequence_id"), "offset")

    return numbered(first.where("not open"), 0).unionAll(numbered(merged, 1))

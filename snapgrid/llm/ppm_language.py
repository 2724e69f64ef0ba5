"""Language identification by prediction with partial matching over bytes.

Each language has counts of which byte class follows which context of up to three classes. A symbol's code
length is exact: from the longest known context down, every context that has not seen the symbol costs its
escape probability d / (t + d) (d distinct symbols among t), the first that has seen it costs c / (t + d). The
statistics are frozen: each language has sorted arrays of the symbols and contexts it has seen, with their costs.
The distinct runs of four classes of a slice of texts are looked up, then every byte takes its run's cost. The
language with the shortest code wins.

At scale: counting combines on the map side and reads every training text whole; no context that was seen is left
out, so a model grows with the distinct runs of four classes of each language, not with the corpus. Scoring is one
pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapgrid.llm import textkit as tk
from snapgrid.llm.frames import tidy
from snapgrid.session import materialize

ORDER = 3


def _classes() -> np.ndarray:
    """Letters without case, one class each for white space, digits and other ASCII, every byte beyond ASCII."""
    table = np.full(256, 2, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    table[0x30:0x3A] = 1
    for i in range(26):
        table[0x41 + i] = table[0x61 + i] = 3 + i
    table[0x80:0x100] = np.arange(29, 157)
    return table


CLASSES = _classes()
SYMBOLS = int(CLASSES.max()) + 1


def _history(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Class of every byte and of the bytes one, two and three before it; white space stands before a text."""
    out = [CLASSES[data].astype(np.int64)]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    for _ in range(ORDER):
        before = np.zeros(len(data), np.int64)
        before[1:] = out[-1][:-1]
        before[borders] = 0
        out.append(before)
    return out


def _gram(s0, s1, s2, s3) -> np.ndarray:
    return ((s3.astype(np.int64) * SYMBOLS + s2) * SYMBOLS + s1) * SYMBOLS + s0


def _found(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted array that is not empty, and whether the wanted numbers are there."""
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, three classes and the next), summed over a partition as far as memory allows."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return grams, np.bincount(where, np.concatenate([c for _, c in parts])).astype(np.int64)

    def flush():
        for lang, parts in held.items():
            grams, counts = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"]
            )
        held.clear()

    for batch in batches:
        for part in tk.slices(batch, "text"):
            langs = np.array(part.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                data, offsets = tk.texts(part.column("text").filter(pa.array(langs == lang)))
                s0, s1, s2, s3 = _history(data, offsets)
                grams, counts = np.unique(_gram(s0, s1, s2, s3).astype(np.uint32), return_counts=True)
                held.setdefault(lang, []).append((grams.astype(np.int64), counts))
                if len(held[lang]) > 16:
                    held[lang] = [merged(held[lang])]
        if sum(len(g) for parts in held.values() for g, _ in parts) > 4_000_000:
            yield from flush()
    yield from flush()


@dataclass
class Level:
    """What one language has seen with contexts of one length: sorted numbers of context and symbol, and of contexts."""

    grams: np.ndarray
    cost: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


@dataclass
class Model:
    """The levels of every language, by the length of their contexts."""

    languages: list[str]
    levels: list[list[Level]]

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last class of each run of four, under every language."""
        out = np.zeros((len(grams), len(self.languages)), np.float32)
        for lang, levels in enumerate(self.levels):
            left = np.arange(len(grams))
            for k in range(ORDER, -1, -1):
                level = levels[k]
                own = grams[left] % SYMBOLS ** (k + 1)
                at, seen = _found(level.grams, own)
                out[left[seen], lang] += level.cost[at[seen]]
                left, own = left[~seen], own[~seen] // SYMBOLS
                at, seen = _found(level.contexts, own)
                out[left[seen], lang] += level.escape[at[seen]]
            out[left, lang] += np.log2(SYMBOLS)
        return out

    def bits(self, column: pa.Array) -> np.ndarray:
        """Code length of every text under every language."""
        data, offsets = tk.texts(column)
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        full = np.flatnonzero(np.diff(offsets))
        # A long text is summed in pieces that overlap by the context alone.
        for low in range(0, len(data), tk.BLOCK):
            start = max(0, low - ORDER)
            part = data[start : low + tk.BLOCK]
            own = np.clip(offsets - start, 0, len(part))
            s0, s1, s2, s3 = (s[low - start :] for s in _history(part, own))
            cells, grams = pd.factorize(_gram(s0, s1, s2, s3))
            cost = self.costs(grams)
            inside = full[(offsets[full + 1] > low) & (offsets[full] < low + len(cells))]
            begins = np.maximum(offsets[inside] - low, 0)
            out[inside] += np.add.reduceat(cost[cells], begins, axis=0, dtype=np.float64)
        return out


#: Labelled rows of each language that a fit reads, about: the model grows with the languages, not with the rows.
ROWS_PER_LANGUAGE = 20_000


def train(documents: DataFrame, most: int = ROWS_PER_LANGUAGE) -> Model:
    """Counts over ``documents`` (``text`` and ``lang``, both not null) and the frozen costs.

    All rows of a language with up to ``most`` rows count; of others a share by a hash of id and text.
    """
    place = F.xxhash64(*[c for c in ("doc_id", "text") if c in documents.columns]).alias("place")
    rows = documents.select("lang", "text", place).where("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = {lang: most / n for lang, n in sizes.items() if n > most}
    if shares:
        share = F.create_map(*[F.lit(x) for pair in sorted(shares.items()) for x in pair])[F.col("lang")]
        rows = rows.where(F.pmod("place", F.lit(1 << 40)) < F.coalesce(share, F.lit(1.0)) * F.lit(float(1 << 40)))
    rows = rows.drop("place")
    grams = rows.mapInArrow(tidy(_count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    grams = materialize(grams, "ppm-grams")
    languages = [r.lang for r in grams.select("lang").distinct().orderBy("lang").collect()]
    levels = []
    for lang in languages:  # the runs of one language at a time reach the driver
        own = grams.where(F.col("lang") == lang).select("gram", "n").toArrow()
        levels.append(_levels(own.column("gram").to_numpy(), own.column("n").to_numpy()))
    return Model(languages, levels)


def _levels(grams: np.ndarray, n: np.ndarray) -> list[Level]:
    """Costs of what was seen, c / (t + d), and of escapes, d / (t + d), for every length of context."""
    out = []
    for k in range(ORDER + 1):
        own, where = np.unique(grams % SYMBOLS ** (k + 1), return_inverse=True)
        counts = np.bincount(where, n)
        contexts, of = np.unique(own // SYMBOLS, return_inverse=True)
        total, distinct = np.bincount(of, counts), np.bincount(of)
        cost = np.log2((total + distinct)[of] / counts)
        out.append(Level(own, cost.astype(np.float32), contexts, np.log2((total + distinct) / distinct).astype(np.float32)))
    return out


UNKNOWN = "und"
_ASCII_LETTERS = tk.members((0x41, 0x5A), (0x61, 0x7A))


def _lettered(column: pa.Array) -> np.ndarray:
    """Whether a text has a letter of any script."""
    data, offsets = tk.texts(column)
    total = np.concatenate([[0], np.cumsum(_ASCII_LETTERS[data])])
    out = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)).tolist():
        out[i] = any(c.isalpha() for c in column[i].as_py())
    return out


def predictions(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1) and ``bits`` (code length under the chosen language).

    The score is the language's share when every language's code length counts as its probability. Null and
    letterless texts, and all texts under a model of no language, are ``und`` with score 0. Equal code lengths
    go to the first language by name. Long texts are summed up in pieces; an empty table gives no rows. Repeated rows
    get equal results; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in tk.slices(batch, "text"):
                column = part.column("text")
                known = _lettered(column) if own.languages else np.zeros(part.num_rows, bool)
                bits = own.bits(column) if own.languages else np.zeros((part.num_rows, 1))
                best = bits.argmin(1)
                least = bits[np.arange(len(bits)), best]
                share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
                names = [own.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(names, pa.string()),
                        pa.array(np.where(known, share, 0.0)),
                        pa.array(np.where(known, least, 0.0)),
                    ],
                    ["doc_id", "lang_pred", "score", "bits"],
                )

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(tidy(predict), "doc_id long, lang_pred string, score double, bits double")

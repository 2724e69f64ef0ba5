"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered; one weight vector over hashed text features is shared by all grades, and ordered thresholds
cut its score: P(grade > k) = sigmoid(score - threshold k). The expected grade ranks documents, the tail
probability P(grade >= wanted) selects them.

Features are the distinct words of a text, their beginnings, and its shape (how much of it is letters, capitals, symbols,
repeated words, and how long it is). A lasso penalty leaves most weights at exactly zero, so a long text does
not gather noise, and the model is a short sorted list of hashes and weights.

At scale: fitting reads a bounded, documented sample of rated documents (about ``sample``, by a hash of their ids)
in one task; scoring is one pass over all documents without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapgrid.llm import textkit as tk
from snapgrid.llm.frames import bounded_sample, fresh_name, tidy
from snapgrid.session import materialize

#: Rated documents that a fit reads, about.
SAMPLE = 8_000
_WORD = tk.members((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Lengths in bytes of word beginnings that are features: inflected forms share them.
_PREFIXES = (4,)
_SHAPES = 6
#: Features that a gradient step handles at one time.
_BLOCK = 1 << 20
_EDGES = [
    np.array([0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5]),  # symbols among inked bytes
    np.array([0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8]),  # capitals among ASCII letters
    np.array([0.02, 0.05, 0.1, 0.2, 0.4]),  # digits among inked bytes
    np.array([0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]),  # distinct among all words
    np.array([2, 3, 4, 5, 6, 8, 10, 14]),  # mean bytes of a word
    np.array([1, 2, 4, 8, 16, 32, 64, 128, 512, 2048]),  # words
]


@dataclass
class Features:
    """Distinct feature hashes of each text; ``borders`` has one more value than there are texts."""

    hashes: np.ndarray
    borders: np.ndarray


def features(column: pa.Array) -> Features:
    """Word, word-beginning and shape features; a null, empty or wordless text has shape features alone."""
    data, offsets = tk.texts(column)
    low = tk.LOWER[data]
    starts, ends, first = tk.runs(low, offsets, _WORD)
    whole = tk.run_hashes(low, starts, ends)
    n_words, n_distinct = np.diff(first), np.diff(tk.distinct_per_group(whole, first)[1])
    parts = [whole]
    for length in _PREFIXES:
        longer = ends - starts > length
        begun = whole.copy()  # of a word that is no longer than its prefix: the word, which counts once
        begun[longer] = tk.mix(tk.run_hashes(low, starts[longer], starts[longer] + length) + np.uint64(length))
        parts.append(begun)
    words, borders = tk.distinct_per_group(np.stack(parts, axis=1).ravel(), first * len(parts))

    def share(member: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(member)])
        return total[offsets[1:]] - total[offsets[:-1]]

    upper = share((data >= 0x41) & (data <= 0x5A))
    letters = share((low >= 0x61) & (low <= 0x7A))
    digits = share((data >= 0x30) & (data <= 0x39))
    inked = share(tk.NOT_SPACE[data])
    symbols = inked - share(_WORD[low])
    lengths = np.concatenate([[0], np.cumsum(ends - starts)])
    mean = (lengths[first[1:]] - lengths[first[:-1]]) / np.maximum(n_words, 1)
    measures = [
        symbols / np.maximum(inked, 1),
        upper / np.maximum(letters, 1),
        digits / np.maximum(inked, 1),
        n_distinct / np.maximum(n_words, 1),
        mean,
        n_words,
    ]
    shapes = np.stack([np.searchsorted(e, m, "right") for e, m in zip(_EDGES, measures)], axis=1)
    # Repetition means something only together with length.
    shapes[:, 3] += 100 * np.minimum(shapes[:, 5] // 2, 4)
    shape_hashes = tk.mix(shapes.astype(np.uint64) + (np.arange(_SHAPES, dtype=np.uint64) + np.uint64(1)) * np.uint64(1 << 32))
    n = len(borders) - 1
    out_borders = borders + _SHAPES * np.arange(n + 1)
    out = np.empty(out_borders[-1], np.uint64)
    is_shape = np.zeros(len(out), bool)
    is_shape[(out_borders[1:, None] - 1 - np.arange(_SHAPES)).ravel()] = True
    out[~is_shape] = words
    out[is_shape] = shape_hashes.ravel()
    return Features(out, out_borders)


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the ordered thresholds between grades."""

    hashes: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, column: pa.Array) -> np.ndarray:
        found = features(column)
        if not len(self.hashes):
            return np.zeros(len(found.borders) - 1)
        at = np.minimum(np.searchsorted(self.hashes, found.hashes), len(self.hashes) - 1)
        value = np.where(self.hashes[at] == found.hashes, self.weights[at], 0.0)
        total = np.concatenate([[0], np.cumsum(value)])
        return total[found.borders[1:]] - total[found.borders[:-1]]

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every text and threshold; the expected grade is their sum."""
        return _sigmoid(scores[:, None] - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(
    column: pa.Array, grades: np.ndarray, n_grades: int, lasso: float = 4e-4, least: int = 3, steps: int = 400
) -> Model:
    """Cumulative-link weights by accelerated proximal gradient steps on the mean negative log-likelihood."""
    n = len(grades)
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    found = [features(part.column("text")) for part in tk.slices(batch, "text")]
    sizes = np.concatenate([np.diff(f.borders) for f in found]) if found else np.zeros(0, np.int64)
    codes, names = pd.factorize(np.concatenate([f.hashes for f in found]) if found else np.zeros(0, np.uint64))
    del found
    counts = np.bincount(codes, minlength=len(names))
    common = (counts >= least) & (counts < n)
    keep = common[codes]
    rows = np.repeat(np.arange(n, dtype=np.int32), sizes)[keep]
    order = np.argsort(names[common])
    number = np.zeros(len(names), np.int32)
    number[np.flatnonzero(common)[order]] = np.arange(len(order))
    columns = number[codes[keep]]
    names = names[common][order]
    del codes, number
    share = np.array([(grades > k).mean() for k in range(n_grades - 1)])
    share = np.clip(share, 1e-4, 1 - 1e-4)
    thresholds = -np.log(share / (1 - share))
    if not len(names) or n == 0:
        return Model(names[:0], np.zeros(0), thresholds)
    # Rarer grades weigh more, so that a few bad documents are not drowned by many good ones.
    weight = 1 / np.sqrt(np.maximum(np.bincount(grades, minlength=n_grades), 1))[grades]
    weight /= weight.sum()
    w = np.zeros(len(names))
    seen, old, momentum = w.copy(), w.copy(), 1.0
    step = 0.5 / max(1.0, np.sqrt(sizes.sum() / n))
    spread = np.ones(n_grades - 1)
    blocks = [slice(low, low + _BLOCK) for low in range(0, len(rows), _BLOCK)]
    for _ in range(steps):
        score = np.zeros(n)
        for at in blocks:
            score += np.bincount(rows[at], seen[columns[at]], n)
        slope, by_threshold = _slopes(score, thresholds, grades, n_grades)
        pull, gradient = weight * slope, np.zeros(len(names))
        for at in blocks:
            gradient += np.bincount(columns[at], pull[rows[at]], len(names))
        w = seen - step * 8 * gradient
        w = np.sign(w) * np.maximum(np.abs(w) - step * 8 * lasso, 0)
        thresholds = np.sort(thresholds - spread * (weight[:, None] * by_threshold).sum(0))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        seen, old, momentum = w + (momentum - 1) / following * (w - old), w, following
    used = w != 0
    return Model(names[used], w[used], thresholds)


def _slopes(score, thresholds, grades, n_grades) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the negative log-likelihood of every row by its score and by the thresholds.

    With F_k = sigmoid(threshold k - score) a row of grade g has probability F_g - F_{g-1}.
    """
    n = len(score)
    below = np.concatenate([np.zeros((n, 1)), _sigmoid(thresholds - score[:, None]), np.ones((n, 1))], axis=1)
    density = below * (1 - below)
    row = np.arange(n)
    p = np.maximum(below[row, grades + 1] - below[row, grades], 1e-9)
    high, low = density[row, grades + 1] / p, density[row, grades] / p
    by_threshold = np.zeros((n, n_grades + 1))
    by_threshold[row, grades + 1] -= high
    by_threshold[row, grades] += low
    return high - low, by_threshold[:, 1:-1]


def rated(labels: DataFrame) -> DataFrame:
    """``doc_id``, ``grade``: 0 toxic, 1 poor, 2 good. Ratings with a null are left out; the worst of several counts."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).alias("grade"))


def train(documents: DataFrame, ratings: DataFrame, n_grades: int = 3, sample: int = SAMPLE) -> Model:
    """Fit on about ``sample`` rated documents, chosen by a hash of their ids.

    ``ratings`` has ``doc_id`` and ``grade`` (0 to ``n_grades`` - 1). Without any rated document all texts score 0.
    """
    chosen = materialize(bounded_sample(ratings, sample, ["doc_id"]), "quality-sample")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most twice ``sample`` rows of two numbers.
    rows = rows.join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id", "text").alias("place"), "text", "grade")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            table = pa.Table.from_batches(held).sort_by("place")
            texts = table.column("text").cast(pa.large_string()).combine_chunks()
            model = fit(texts, table.column("grade").to_numpy().astype(np.int64), n_grades)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    one = rows.limit(3 * sample).select("place", "text", F.col("grade").cast("int").alias("grade"))
    found = one.mapInArrow(tidy(learn), "model binary").collect()
    if not found:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(n_grades - 1))
    return pickle.loads(found[0].model)


def graded(documents: DataFrame, model: Model, wanted: int = 2, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``documents`` with ``expected_grade`` and ``tail`` (P(grade >= ``wanted``)); and their names.

    A null text, and one without any word, has grade 0 and tail 0: there is nothing to train on. Added columns take
    underscores where a name is taken. Repeated rows get equal results. Texts of any length are read whole; an empty table
    stays empty.
    """
    names = {n: fresh_name(n, documents.columns) for n in ("expected_grade", "tail")}
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in documents.schema.fields]
        + [T.StructField(n, T.DoubleType(), True) for n in names.values()]
    )
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in tk.slices(batch, text):
                column = part.column(text)
                tails = own.tails(own.scores(column))
                data, offsets = tk.texts(column)
                _, _, first = tk.runs(tk.LOWER[data], offsets, _WORD)
                tails[np.diff(first) == 0] = 0.0
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(tails.sum(1)), pa.array(tails[:, wanted - 1])],
                    [*part.schema.names, *names.values()],
                )

    return documents.mapInArrow(tidy(score), schema), names


def kept(documents: DataFrame, model: Model, wanted: int = 2, least: float = 0.5) -> DataFrame:
    """The documents whose chance of at least the wanted grade is ``least`` or more, with their own columns."""
    rows, names = graded(documents, model, wanted)
    return rows.where(F.col(f"`{names['tail']}`") >= least).select(*[F.col(f"`{c}`") for c in documents.columns])



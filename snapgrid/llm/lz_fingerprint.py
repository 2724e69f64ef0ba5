"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into dictionary phrases (each the longest known phrase and one more character, or a single new
character). The hashes of the phrase set are reduced to their smallest values, a min-hash signature whose
overlap estimates how alike two phrase sets are, much like a compression distance would.

At scale: neighbours in id order are brought together by ranges of ids, each range with the first document of
the next, so texts are shuffled once and no task sees more than its ranges. Range borders are a fixed number of
approximate quantiles. Within a range rows stream by; only one row is held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapgrid.llm import textkit as tk
from snapgrid.llm.frames import tidy

#: Smallest hashes that make a signature.
KEPT = 64
#: Ranges of ids for each shuffle partition.
RANGES = 4


def phrases(text: str, known: list[str] | None = None) -> list[str]:
    """Phrases of ``text`` in order, continued behind the phrases already ``known`` of its beginning.

    An unfinished last phrase is none of them.
    """
    found = dict.fromkeys(known) if known else {}
    piece = ""
    for character in text[sum(map(len, found)) :] if found else text:
        piece += character
        if piece not in found:
            found[piece] = None
            piece = ""
    return list(found)


def beginning(found: list[str], end: int) -> list[str]:
    """The phrases that end at or before a place of the text."""
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
    return found[: int(np.searchsorted(ends, end, "right"))]


def signatures(sets: list[list[str]], kept: int = KEPT) -> list[np.ndarray]:
    """The ``kept`` smallest 32-bit hashes of each phrase set, sorted."""
    data, offsets = tk.texts(pa.array([p for own in sets for p in own], pa.large_string()))
    hashed = (tk.run_hashes(data, offsets[:-1], offsets[1:]) >> np.uint64(32)).astype(np.uint32)
    borders = np.concatenate([[0], np.cumsum([len(own) for own in sets], dtype=np.int64)])
    hashed, borders = tk.distinct_per_group(hashed, borders)
    return [hashed[a : min(a + kept, b)] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]


def likeness(x: np.ndarray, y: np.ndarray, kept: int = KEPT) -> float:
    """Share of the smallest hashes of both sets together that are in both; two empty sets are alike."""
    if not len(x) and not len(y):
        return 1.0
    merged = np.concatenate([x, y])
    merged.sort()
    twice = merged[1:] == merged[:-1]
    first = np.ones(len(merged), bool)
    first[1:] = ~twice
    rank = np.cumsum(first)
    return float(twice[rank[1:] <= kept].sum()) / min(int(rank[-1]), kept)


def written(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first characters of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range, own before borrowed, id: each own row with the row after it."""
    before = None  # range, id, text, phrases, signature, late
    for batch in batches:
        for part in tk.slices(batch, "text", 1 << 20):
            ranges, late = part.column("range").to_pylist(), part.column("late").to_pylist()
            ids, texts = part.column("doc_id").to_pylist(), [t or "" for t in part.column("text").to_pylist()]
            parses = [phrases(t) for t in texts]
            signs = signatures(parses)
            rows, new_parses = [], []
            for i, text in enumerate(texts):
                if before is not None and before[0] == ranges[i] and not before[5]:
                    new = edited(before[2], text)
                    same = new == before[2]
                    rows.append((before[1], before[2], before[4], signs[i], new, same))
                    kept = [] if same else beginning(before[3], len(before[2]) - len(before[2]) // 2)
                    new_parses.append([] if same else phrases(new, kept))
                before = (ranges[i], ids[i], text, parses[i], signs[i], late[i])
            if rows:
                yield _results(rows, signatures(new_parses))


def _results(rows: list[tuple], new_signs: list[np.ndarray]) -> pa.RecordBatch:
    out = []
    for (doc, text, sign, next_sign, new, same), new_sign in zip(rows, new_signs):
        new_sign = sign if same else new_sign
        digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
        near = likeness(sign, new_sign), likeness(sign, next_sign)
        out.append((doc, len(text), digest, written(sign), written(new_sign), *near))
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and how alike they are.

    The next document is the one with the next greater id (null ids first, equal ids by text); after the last comes
    the first. A null text counts as empty; an empty text has an empty fingerprint and is like another empty one.
    Equal texts have equal fingerprints. Repeated rows each give a row. Texts of any length are parsed whole; an empty
    table gives no rows. Rows of one id, or without one, are one task. Other columns are not read.
    """
    spark = documents.sparkSession
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    borders = source.agg(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0] or []
    borders = np.unique(np.array(borders, np.int64))

    def own_range(ids: pd.Series) -> pd.Series:
        values = ids.to_numpy(np.int64, na_value=np.iinfo(np.int64).min) if ids.hasnans else ids.to_numpy(np.int64)
        return pd.Series(np.searchsorted(borders, values, "left").astype(np.int32))

    range_of = F.pandas_udf(own_range, "int")
    firsts = source.select("doc_id", range_of("doc_id").alias("range")).groupBy("range")
    firsts = firsts.agg(F.min("doc_id").alias("first"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    firsts = sorted((r["range"], None if r["nulls"] else r["first"]) for r in firsts.collect())
    lender = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}

    def places(ids: pd.Series) -> pd.Series:
        own = own_range(ids)
        first = [lender.get(None if pd.isna(i) else int(i)) for i in ids]
        return pd.Series([[o * 2] if f is None else [o * 2, f * 2 + 1] for o, f in zip(own, first)])

    place = F.explode(F.pandas_udf(places, "array<int>")("doc_id"))
    rows = source.withColumn("place", place).select(
        F.floor(F.col("place") / 2).cast("int").alias("range"), (F.col("place") % 2).alias("late"), "doc_id", "text"
    )
    rows = rows.repartition("range").sortWithinPartitions("range", "late", "doc_id", "text")
    return rows.mapInArrow(tidy(_compare), _SCHEMA)

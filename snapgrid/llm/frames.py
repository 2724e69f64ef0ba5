"""Helpers between Spark and Arrow: groups out of sorted batches, joins with a size check, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapgrid.session import materialize

#: A side of at most this many rows of a few longs is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000


def sized_join(rows: DataFrame, lookup: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join with a narrow, stored lookup side: broadcast only after its count proved it small."""
    small = lookup.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(lookup) if small else lookup, on, how)


def tidy(function: Callable) -> Callable:
    """The same task function; when a task ends, the memory it has freed goes back to the system.

    Python workers are reused for later stages, whose tasks need room of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim is not None:
                trim(0)

    return run


def bounded_sample(rows: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """About ``n`` rows, never more than twice as many, in one partition: those whose hash of ``keys`` is low.

    The share follows from the table's count, so only rows of the sample leave their tasks.
    """
    total = rows.count()
    if total > n:
        low = F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < int((1 << 40) * (n / total))
        rows = rows.filter(low)
    return rows.limit(2 * n)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Whole groups, one after another, from batches sorted by ``keys`` (without nulls).

    Holds one batch and the rows of one group; the caller bounds the group size.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        change[0] = last is None or any(c[0] != v for c, v in zip(columns, last))
        last = [c[-1] for c in columns]
        cuts = np.flatnonzero(change)
        if not len(cuts):
            held.append(batch)
            continue
        if cuts[0] > 0:
            held.append(batch.slice(0, int(cuts[0])))
        if held:
            yield _joined(held)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield batch.slice(a, b - a)
        held = [batch.slice(int(cuts[-1]))]
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def connected_components(links: DataFrame, a: str, b: str, name: str, rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node that has a link.

    Alternates large and small stars until nothing changes: each step points nodes at smaller ones, and a
    minimum is combined on the map side, so a node with very many links is no hot task. Every round is a
    stored table; the driver sees counts alone.
    """
    edge = [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    edges = materialize(links.where(F.col(a) != F.col(b)).select(*edge).distinct(), f"{name}-links")
    shape = _shape(edges)
    for i in range(rounds):
        if shape[0] == 0:
            break
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v")))
        edges = materialize(small.where(F.col("u") != F.col("v")).distinct(), f"{name}-round{i}")
        before, shape = shape, _shape(edges)
        if before == shape:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _shape(edges: DataFrame) -> tuple:
    """Count and an order-free digest: equal for equal sets of edges."""
    digest = F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
    return tuple(edges.agg(F.count("*"), digest).first())


def fresh_name(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores appended until no column has it (Spark compares without case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def list_array(values: pa.Array, borders: np.ndarray) -> pa.ListArray:
    """Row i holds ``values[borders[i]:borders[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), values)


def take_columns(batch: pa.RecordBatch, schema: pa.Schema, results: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch's own columns and the results behind them, in the schema's order."""
    return pa.RecordBatch.from_arrays([*batch.columns, *results.values()], [*batch.schema.names, *results])

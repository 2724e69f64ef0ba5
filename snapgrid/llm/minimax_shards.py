"""Sharding: contiguous partition of ordered atomic groups that minimises the largest shard.

Groups (equal texts) stand in the order of their digests. The smallest capacity for which a greedy walk over
the running sums needs no more than the wanted shards is found by search: every round tries many capacities
at once, and each step of their walks is one aggregation (the last group that still fits). The cuts of the
best capacity are group digests, so a row's shard follows from its own digest and a handful of constants.

Only DataFrame operations. At scale: a group of very many copies is combined on the map side and no row is
joined with its group; running sums go through a fixed number of digest cells, so no task orders all groups;
places in a shard are numbered in cells of hashed ids with the cells' offsets added.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapgrid.session import materialize

#: Capacities tried in one round of the search.
TRIES = 64
#: Leading hexadecimal digits of a digest that make a cell of the running sums.
CELL_DIGITS = 3
#: Cells of a shard in which its rows are numbered.
SLOT_CELLS = 1024


def running_sums(groups: DataFrame) -> DataFrame:
    """``groups`` (``digest`` and ``size``) with ``upto``: the sum of all sizes up to each digest."""
    celled = groups.withColumn("cell", F.substring("digest", 1, CELL_DIGITS))
    cells = celled.groupBy("cell").agg(F.sum("size").alias("total"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("cell", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("cell").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    # At most 16 ** CELL_DIGITS rows, whatever the data.
    return celled.join(F.broadcast(offsets), "cell").select(
        "digest", "size", (F.col("before") + F.sum("size").over(inside)).alias("upto")
    )


def greedy_cuts(sums: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """For each capacity the running sums at which its greedy walk cuts, one for each shard."""
    at = [0] * len(capacities)
    cuts: list[list[int]] = [[] for _ in capacities]
    for _ in range(shards):
        limits = [a + c for a, c in zip(at, capacities)]
        fits = [F.max(F.when(F.col("upto") <= x, F.col("upto"))).alias(f"c{i}") for i, x in enumerate(limits)]
        found = sums.where(F.col("upto").between(min(at), max(limits))).agg(*fits).first()
        at = [max(a, f or 0) for a, f in zip(at, found)]
        for own, a in zip(cuts, at):
            own.append(a)
    return cuts


@dataclass(frozen=True)
class Plan:
    """The smallest capacity, and the digest of the last group of every shard but the last."""

    capacity: int
    last_digests: list[str]


def minimax_plan(groups: DataFrame, shards: int) -> Plan:
    """Cuts of the ordered groups (``digest``, ``size`` of one or more) into at most ``shards`` runs."""
    sums = materialize(running_sums(groups), "shards-sums")
    total, largest = sums.agg(F.sum("size"), F.max("size")).first()
    if not total:
        return Plan(0, [])
    low = max(math.ceil(total / shards), largest)
    high = math.ceil(total / shards) + largest  # a walk that closes every shard above the mean needs no more
    best: list[int] = []
    while True:
        step = max(1, math.ceil((high - low) / (TRIES - 1)))
        tried = sorted({min(high, low + i * step) for i in range(TRIES)})
        cuts = greedy_cuts(sums, tried, shards)
        fit = next(i for i, own in enumerate(cuts) if own[-1] == total)
        best, high = cuts[fit], tried[fit]
        if step == 1 or fit == 0:
            break
        low = tried[fit - 1] + 1
    inner = sorted({c for c in best[:-1] if c < total})
    rows = sums.where(F.col("upto").isin(inner)).select("upto", "digest").collect() if inner else []
    return Plan(high, [r.digest for r in sorted(rows)])


def shard_of(digest: Column, plan: Plan) -> Column:
    passed = [(digest > F.lit(d)).cast("int") for d in plan.last_digests]
    return sum(passed[1:], passed[0]) if passed else F.lit(0)


def sharded(documents: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes and one), ``text_crc32``, ``digest``, ``shard``, ``slot`` for every row.

    Equal texts share a shard, and no contiguous cut of the groups has a smaller largest shard. A null text counts
    as empty. Slots number the rows of a shard from 0 by cell of the hashed row, then by id; repeated rows take
    neighbouring slots. A null id is sharded by its text like any other. A text
    larger than all others together has a shard to itself; an empty table gives no rows. Other columns are not read.
    """
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(plain) + 1).cast("long").alias("size"),
        F.crc32(plain).alias("text_crc32"),
        F.md5(plain).alias("digest"),
    )
    rows = materialize(rows, "shards-rows")
    plan = minimax_plan(rows.groupBy("digest").agg(F.sum("size").alias("size")), shards)
    placed = rows.withColumn("shard", shard_of(F.col("digest"), plan)).withColumn(
        "cell", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SLOT_CELLS)).cast("int")
    )
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "digest"))
    # At most shards * SLOT_CELLS rows, whatever the data.
    return placed.join(F.broadcast(offsets), ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "digest", "shard", (F.col("before") + nth - 1).alias("slot")
    )

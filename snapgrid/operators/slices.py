"""Ordered computations that survive a hot key.

A window over one key puts all rows of that key into one task. Here the order axis is cut into
slices: the heavy window runs per (key, slice), a small table with one row per (key, slice) carries
the running state from slice to slice, and is joined back on (key, slice). The heavy rows are
shuffled and sorted once for window and join together; a key with a third of all rows spreads over as
many tasks as it has slices. The carry table is bounded: per key it has at most span / width rows.

The rows feed both the window and the carry table. Both readers are built on the same columns and
filters, so that Spark writes the shuffle below them once and reads it twice (ReusedExchange).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapgrid.functions.time import MINUTE_US
from snapgrid.operators.rows import lookup_join, quoted
from snapgrid.session import materialize

SLICE = "_slice"
BEFORE = (Window.unboundedPreceding, -1)
SO_FAR = (Window.unboundedPreceding, 0)

#: One task sorts what one entity does in this time: at most 300 million distinct microseconds, however
#: the rows are spread. The carry table has at most 105,120 rows per entity and year. Wider slices make
#: the carry table of an entity with frequent events smaller.
SLICE_MINUTES = 5


def time_slice(us: Column, minutes: int = SLICE_MINUTES) -> Column:
    """The start of the slice an instant (in microseconds) falls into."""
    return us - F.pmod(us, F.lit(minutes * MINUTE_US))


def placed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that have a key and a slice. Stated before a frame is read twice, so both readers agree."""
    for c in keys + [SLICE]:
        df = df.filter(F.col(c).isNotNull())
    return df


def running_sums(
    df: DataFrame, keys: list[str], order: str, columns: list[str], attach: DataFrame | None = None
) -> DataFrame:
    """Inclusive running sums per key along ``order`` for a frame that has a slice column.

    Adds ``<c>_run`` and the key's ``<c>_total``. ``attach`` is a lookup with one row per key: it is
    joined (inner) to the carry table, so its columns reach the heavy rows without a join of their own.
    """
    place = keys + [SLICE]
    rows = placed(df, keys)
    edges = rows.groupBy(*place).agg(*[F.sum(c).alias(c) for c in columns])
    along = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(*BEFORE)
    whole = Window.partitionBy(*keys)
    carry = edges.select(
        *place,
        *[F.coalesce(F.sum(c).over(along), F.lit(0)).alias(f"_{c}_before") for c in columns],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in columns],
    )
    added = []
    if attach is not None:
        added = [c for c in attach.columns if c not in keys]
        carry = carry.join(attach, keys)
    inside = Window.partitionBy(*place).orderBy(order).rowsBetween(*SO_FAR)
    local = rows.select("*", *[F.sum(c).over(inside).alias(f"_{c}_in") for c in columns])
    return local.join(carry, place).select(
        *df.columns,
        *[(F.col(f"_{c}_before") + F.col(f"_{c}_in")).alias(f"{c}_run") for c in columns],
        *[f"{c}_total" for c in columns],
        *added,
    )


def _ranges(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The table in ranges along ``order`` with sampled borders, sorted, ``name`` its place: the range's number above
    ``PLACE_BITS``, the row's below. Written once, so that every reader sees the same borders."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(quoted(c)) for c in order]
    ranged = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    return materialize(ranged.withColumn(name, F.monotonically_increasing_id()), "ranges")


#: How a row's place is written: the number of its partition above, its place there below.
PLACE_BITS = 33


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with ``name``: their number from 0 along ``order``; rows equal in it stand in any order.

    Ranges of rows are sorted apart; what travels between them is one count for each.
    """
    ranged = _ranges(df, order, name)
    slice_of = F.shiftright(name, PLACE_BITS).alias(SLICE)
    counts = ranged.groupBy(slice_of).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(SLICE).rowsBetween(*BEFORE)), F.lit(0))
    offsets = counts.select(SLICE, before.alias("_before"))  # one row for each shuffle partition
    inside = F.col(name).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    found = lookup_join(ranged.withColumn(SLICE, slice_of), offsets, [SLICE], "inner")
    kept = [F.col(quoted(c)) for c in df.columns]
    return found.select(*kept, (F.col("_before") + inside).alias(name))


#: A table of at most so many narrow rows is summed up in one task, sooner done than ranges of it.
ONE_TASK = 250_000


def ranked_sums(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Inclusive running sums of the whole table along ``order``, whose values are distinct.

    Adds ``<c>_run`` and ``<c>_total``. The table is written first, so its rows are computed once and can be counted.
    Beyond ``ONE_TASK`` rows it is cut into ranges with sampled borders, which hold like numbers of rows wherever the
    values lie; the sliced table is written too, so that every reader sees the same borders. What travels between
    slices is one row for each, as many as shuffle partitions, summed up by one window.
    """
    stored = materialize(df, "ranked")
    if stored.count() <= ONE_TASK:
        along, whole = Window.orderBy(order).rowsBetween(*SO_FAR), Window.partitionBy()
        return stored.select(
            "*",
            *[F.sum(c).over(along).alias(f"{c}_run") for c in columns],
            *[F.sum(c).over(whole).alias(f"{c}_total") for c in columns],
        )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = stored.repartitionByRange(parts, order).withColumn(SLICE, F.spark_partition_id())
    sliced = materialize(sliced, "slices")
    edges = sliced.groupBy(SLICE).agg(*[F.sum(c).alias(c) for c in columns])
    along, whole = Window.orderBy(SLICE).rowsBetween(*BEFORE), Window.partitionBy()
    carry = edges.select(
        SLICE,
        *[F.coalesce(F.sum(c).over(along), F.lit(0)).alias(f"_{c}_before") for c in columns],
        *[F.coalesce(F.sum(c).over(whole), F.lit(0)).alias(f"{c}_total") for c in columns],
    )
    inside = Window.partitionBy(SLICE).orderBy(order).rowsBetween(*SO_FAR)
    local = sliced.select("*", *[F.sum(c).over(inside).alias(f"_{c}_in") for c in columns])
    # The window has placed the rows by slice already, as the join needs them.
    return local.join(carry, SLICE).select(
        *df.columns,
        *[(F.col(f"_{c}_before") + F.col(f"_{c}_in")).alias(f"{c}_run") for c in columns],
        *[f"{c}_total" for c in columns],
    )


def as_of(
    instants: DataFrame, events: DataFrame, keys: list[str], ts: str, columns: list[str], minutes: int = SLICE_MINUTES
) -> DataFrame:
    """Each row of ``instants`` with the last event row of its key at or before it, its nulls included.

    A left join: every left row stays, copies of an instant and rows without a key or time too (those find
    nothing). Distinct instants and events travel together in one shuffle; no pair of rows is ever formed. Of
    several events at one instant the greatest row counts.
    """
    asked = instants
    us = F.unix_micros(ts)
    rows = events.select(*keys, us.alias("_us"), F.struct(*columns).alias("_row"), F.lit(0).alias("_ask"))
    nothing = F.lit(None).cast(rows.schema["_row"].dataType)
    marks = instants.select(*keys, us.alias("_us"), nothing.alias("_row"), F.lit(1).alias("_ask"))
    merged = (
        marks.unionByName(rows)
        .groupBy(*keys, "_us")
        .agg(F.max("_row").alias("_row"), F.max("_ask").alias("_ask"))
        .withColumn(SLICE, time_slice(F.col("_us"), minutes))
    )
    place = keys + [SLICE]
    both = placed(merged, keys)
    edges = both.groupBy(*place).agg(
        F.max_by("_row", F.when(F.col("_row").isNotNull(), F.col("_us"))).alias("_row"), F.max("_ask").alias("_ask")
    )
    along = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(*BEFORE)
    carry = edges.filter("_ask is not null").select(*place, F.last("_row", ignorenulls=True).over(along).alias("_before"))
    inside = Window.partitionBy(*place).orderBy("_us").rowsBetween(*SO_FAR)
    local = both.withColumn("_in", F.last("_row", ignorenulls=True).over(inside))
    found = local.filter("_ask = 1").join(carry, place)
    row = F.coalesce("_in", "_before")
    answers = found.select(*keys, F.timestamp_micros("_us").alias(ts), *[row[c].alias(c) for c in columns])
    # One answer for each distinct instant; a hot instant's copies are on the side that may be split.
    kept = [c for c in asked.columns if c not in columns]
    return lookup_join(asked.select(*kept), answers, [*keys, ts]).select(*kept, *columns)

"""Gap, segment and label-coverage diagnostics of an irregular time series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapgrid.functions.time import HOUR_US, MINUTE_US
from snapgrid.operators.describe import describe
from snapgrid.operators.rows import require_columns
from snapgrid.operators.slices import BEFORE, SLICE, SLICE_MINUTES, SO_FAR, placed, time_slice
from snapgrid.session import materialize, use_utc


def _instants(df: DataFrame, key: str, ts: str, slice_minutes: int) -> DataFrame:
    """Distinct instants per key with their number of rows; copies collapse on the map side."""
    counted = df.groupBy(F.col(key).alias("key"), F.unix_micros(ts).alias("us")).agg(F.count(F.lit(1)).alias("n"))
    return placed(counted.withColumn(SLICE, time_slice(F.col("us"), slice_minutes)), ["key"])


def instant_gaps(
    df: DataFrame, key: str, ts: str, max_gap_hours: float = 6.0, slice_minutes: int = SLICE_MINUTES
) -> DataFrame:
    """Per (key, instant): rows there, microseconds since the previous instant, running segment number.

    A segment goes on while the gap is at most ``max_gap_hours``.
    """
    limit = F.lit(int(max_gap_hours * HOUR_US))
    place = ["key", SLICE]
    rows = _instants(df, key, ts, slice_minutes)
    inside = Window.partitionBy(*place).orderBy("us")
    gapped = rows.withColumn("_gap", F.col("us") - F.lag("us").over(inside))
    broken = F.coalesce((F.col("_gap") > limit).cast("long"), F.lit(0))
    local = gapped.withColumn("_breaks", F.sum(broken).over(inside.rowsBetween(*SO_FAR)))
    edges = local.groupBy(*place).agg(
        F.min("us").alias("_first"), F.max("us").alias("_last"), F.max("_breaks").alias("_breaks"), F.sum("n").alias("_n")
    )
    # Every slice has rows; asking for it keeps both readers of the instants on the same columns.
    along = Window.partitionBy("key").orderBy(SLICE)
    linked = edges.filter("_n > 0").withColumn("_gap_in", F.col("_first") - F.lag("_last").over(along))
    opens = F.coalesce((F.col("_gap_in") > limit).cast("long"), F.lit(1))
    opened = linked.withColumn("_opens", opens).withColumn("_all", F.col("_opens") + F.col("_breaks"))
    before = F.coalesce(F.sum("_all").over(along.rowsBetween(*BEFORE)), F.lit(0))
    carry = opened.select(*place, "_gap_in", (before + F.col("_opens")).alias("_number"))
    return local.join(carry, place).select(
        "key",
        "us",
        "n",
        F.coalesce("_gap", "_gap_in").alias("gap_us"),
        (F.col("_number") + F.col("_breaks")).alias("segment_id"),
    )


def row_gaps(gaps: DataFrame) -> DataFrame:
    """Gaps in hours with the number of rows that have them: rows at one instant follow with gap 0."""
    step = F.struct((F.col("gap_us") / F.lit(float(HOUR_US))).alias("gap_hours"), F.lit(1).cast("long").alias("n"))
    zero = F.struct(F.lit(0.0).alias("gap_hours"), (F.col("n") - 1).alias("n"))
    held = F.filter(F.array(step, zero), lambda g: g["gap_hours"].isNotNull() & (g["n"] > 0))
    return gaps.select(F.explode(held).alias("_g")).select("_g.*")


def segment_lengths(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("key", "segment_id").agg(F.sum("n").alias("segment_length"))


def rows_per_year(df: DataFrame, ts: str) -> DataFrame:
    use_utc(df.sparkSession)
    return df.filter(F.col(ts).isNotNull()).groupBy(F.year(ts).alias("year")).agg(F.count(F.lit(1)).alias("timestamps"))


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def basic_counts(df: DataFrame, key: str, group: str | None = None) -> DataFrame:
    """Rows, distinct keys and distinct groups; the group count is null if the column is absent."""
    groups = F.countDistinct(group) if group and group in df.columns else F.lit(None).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_stations"), groups.alias("n_locations")
    )


def segment_totals(lengths: DataFrame, long_from: int = 10) -> DataFrame:
    return lengths.agg(
        F.count_if(F.col("segment_length") >= long_from).alias("n_segments_ge_10"),
        F.coalesce(F.max("segment_length"), F.lit(0)).alias("max_segment_len"),
    )


@dataclass(frozen=True)
class GapTables:
    """The gap report as tables."""

    counts: DataFrame
    per_year: DataFrame
    rows_per_key: DataFrame
    gap_hours: DataFrame
    segment_length: DataFrame
    segments: DataFrame


def gap_tables(
    df: DataFrame, ts: str = "snapshot_ts", key: str = "st_id", group: str | None = "st_location_id", max_gap_hours: float = 6.0
) -> GapTables:
    require_columns(df, [key, ts])
    gaps = materialize(instant_gaps(df, key, ts, max_gap_hours), "gaps")  # three tables read them
    lengths = segment_lengths(gaps)
    return GapTables(
        counts=basic_counts(df, key, group),
        per_year=rows_per_year(df, ts),
        rows_per_key=describe(rows_per_key(df, key), "rows"),
        gap_hours=describe(row_gaps(gaps), "gap_hours", "n"),
        segment_length=describe(lengths, "segment_length"),
        segments=segment_totals(lengths),
    )


def label_coverage(
    df: DataFrame,
    ts: str = "snapshot_ts",
    key: str = "st_id",
    travel_minutes: tuple[int, ...] = (5, 10, 15, 30, 60),
    tolerance_minutes: int = 2,
    slice_minutes: int | None = None,
) -> DataFrame:
    """Share of rows with another observation of the key near ``t + travel`` (ends included), a line for each time.

    No self-join: the latest instant up to the end of the tolerance window is a frame that only grows,
    and there is a match if it is not before the window's start. Rows just after a slice are repeated
    into the slices that look ahead to them, at most ``reach / slice + 2`` times. A window that lies before the
    row is the same on the reversed time axis.
    By default a slice is as wide as the reach: a row is there twice, and one task holds what one entity
    does in twice the reach.
    """
    require_columns(df, [key, ts])
    ahead = sorted({t for t in travel_minutes if t + tolerance_minutes >= 0})
    behind = sorted({-t for t in travel_minutes if t + tolerance_minutes < 0})
    counted = _instants(df, key, ts, SLICE_MINUTES).drop(SLICE)
    totals = _matched_rows(counted, ahead, "", tolerance_minutes, slice_minutes)
    if behind:
        reversed_axis = counted.withColumn("us", -F.col("us"))
        earlier = _matched_rows(reversed_axis, behind, "-", tolerance_minutes, slice_minutes).drop("total_rows")
        totals = totals.join(F.broadcast(earlier))  # one row each
    lines = F.array(*[F.struct(F.lit(t).alias("t"), F.col(f"`m{t}`").alias("m")) for t in travel_minutes])
    return totals.select("total_rows", F.explode(lines).alias("_l")).select(
        F.col("_l.t").alias("travel_time_min"),
        F.lit(tolerance_minutes).alias("tolerance_min"),
        F.col("_l.m").alias("matched_rows"),
        "total_rows",
        F.when(F.col("total_rows") > 0, F.col("_l.m") / F.col("total_rows")).otherwise(F.lit(0.0)).alias("match_rate"),
    )


def _matched_rows(
    counted: DataFrame, times: list[int], sign: str, tolerance_minutes: int, slice_minutes: int | None
) -> DataFrame:
    """One row: all rows, and for each time those with an instant near it, as ``m<sign><time>``."""
    reach_minutes = max(times, default=0) + tolerance_minutes
    slice_minutes = slice_minutes or max(SLICE_MINUTES, reach_minutes)
    rows = counted.withColumn(SLICE, time_slice(F.col("us"), slice_minutes))
    first = time_slice(F.col("us") - F.lit(reach_minutes * MINUTE_US), slice_minutes)
    views = F.sequence(first, F.col(SLICE), F.lit(slice_minutes * MINUTE_US))
    seen = rows.withColumn("_view", F.explode(views))
    view = Window.partitionBy("key", "_view").orderBy("us")
    found = []
    for t in times:
        end, start = (t + tolerance_minutes) * MINUTE_US, (t - tolerance_minutes) * MINUTE_US
        latest = F.max("us").over(view.rangeBetween(Window.unboundedPreceding, end))
        found.append((latest >= F.col("us") + F.lit(start)).cast("long").alias(f"m{sign}{t}"))
    probes = seen.select("n", SLICE, "_view", *found).filter(F.col("_view") == F.col(SLICE))
    return probes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        *[F.coalesce(F.sum(F.col(f"`m{sign}{t}`") * F.col("n")), F.lit(0)).alias(f"m{sign}{t}") for t in times],
    )


def occupied_rate(df: DataFrame, state: str = "available_ports") -> DataFrame:
    """Share of rows whose state is zero; a null state counts as not zero."""
    return df.agg(F.avg(F.coalesce((F.col(state) == 0).cast("double"), F.lit(0.0))).alias("occupied_rate"))

"""Bucketing of snapshots and the dense time grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapgrid.functions.time import clock_features, floor_to, minutes_between, parse_instant
from snapgrid.operators.rows import latest_per_key, modes, require_columns
from snapgrid.schema import GRID_MINUTES, LOCAL_ZONE, STALE_CAP_MINUTES, STATE_COLUMNS, STATIC_COLUMNS
from snapgrid.session import use_utc


def strict_instants(df: DataFrame, ts: str) -> DataFrame:
    """Parse ``ts`` to an instant and fail the job on the first value that is none.

    The check is a filter on the rows, so it runs even where nothing reads the column afterwards.
    """
    use_utc(df.sparkSession)
    kind = dict(df.dtypes)[ts]
    parsed = F.col(ts) if kind == "timestamp" else parse_instant(F.col(ts))
    message = F.concat(F.lit(f"invalid timestamp in {ts}: "), F.coalesce(F.col(ts).cast("string"), F.lit("null")))
    valid = F.when(parsed.isNotNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.filter(valid).withColumn(ts, parsed)


def bucket_latest(
    df: DataFrame, key: str = "st_id", snapshot_ts: str = "snapshot_ts", minutes: int = GRID_MINUTES
) -> DataFrame:
    """The last snapshot of every (key, bucket), with the bucket start as ``ts``.

    A hot key collapses here on the map side: afterwards a key has at most one row per bucket of its
    time span (52,560 a year at ten minutes), which is what bounds the per-key windows downstream.
    """
    timed = strict_instants(df, snapshot_ts)
    bucketed = timed.withColumn("ts", floor_to(F.col(snapshot_ts), minutes))
    return latest_per_key(bucketed, [key, "ts"], [snapshot_ts])


def grid_rows(
    buckets: DataFrame,
    key: str = "st_id",
    state: list[str] = STATE_COLUMNS,
    minutes: int = GRID_MINUTES,
    stale_after: int = STALE_CAP_MINUTES,
    fresh_only: bool = False,
    attach: DataFrame | None = None,
) -> DataFrame:
    """One row per key and grid step from its first to its last bucket, state carried forward.

    Every bucket row is expanded up to the next one, so there is no spine and no join: one shuffle on
    the key. State is nulled once older than ``stale_after`` minutes. ``fresh_only`` leaves out stale
    steps at the source, for consumers that would drop them anyway. ``attach`` (one row per key) joins
    before the expansion, on rows the window has already partitioned and sorted by key.
    """
    # A fixed number of partitions: sizes before the expansion say nothing about the work after it,
    # so they must not be merged by size.
    parts = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets.repartition(parts, key)
    along = Window.partitionBy(key).orderBy("ts")
    filled = along.rowsBetween(Window.unboundedPreceding, 0)
    step = F.make_interval(mins=F.lit(minutes))
    following = F.lead("ts").over(along)
    last_step = F.greatest(F.coalesce(following - step, F.col("ts")), F.col("ts"))
    if fresh_only:
        last_step = F.least(last_step, F.col("ts") + F.make_interval(mins=F.lit(stale_after // minutes * minutes)))
    origin = buckets.select(
        key,
        F.col("ts").alias("_origin"),
        *[F.last(c, ignorenulls=True).over(filled).alias(c) for c in state],
        last_step.alias("_until"),
    )
    added = []
    if attach is not None:
        added = [c for c in attach.columns if c != key]
        origin = origin.join(attach, key, "left")
    if 1440 % minutes:
        rows = origin.withColumn("ts", F.explode(F.sequence("_origin", "_until", step)))
    else:
        # Two levels: days, then steps within a day, so a gap of years never becomes one huge array.
        day = F.make_interval(hours=F.lit(24))
        days = origin.withColumn("_from", F.explode(F.sequence("_origin", "_until", day)))
        day_end = F.least(F.col("_until"), F.col("_from") + day - step)
        rows = days.withColumn("ts", F.explode(F.sequence("_from", day_end, step)))
    age = minutes_between(F.col("ts"), F.col("_origin"))
    stale = age > stale_after
    return rows.select(
        key,
        "ts",
        *[F.when(~stale, F.col(c)).alias(c) for c in state],
        *added,
        (F.col("ts") == F.col("_origin")).cast("int").alias("is_observed"),
        stale.cast("int").alias("is_stale"),
        age.alias("age_minutes"),
    )


def dense_grid(
    buckets: DataFrame,
    key: str = "st_id",
    state: list[str] = STATE_COLUMNS,
    static: list[str] = STATIC_COLUMNS,
    minutes: int = GRID_MINUTES,
    stale_after: int = STALE_CAP_MINUTES,
    zone: str = LOCAL_ZONE,
    static_until=None,
    fresh_only: bool = False,
    clock_digits: int | None = None,
) -> DataFrame:
    """The model table: grid rows, the key's typical static values and clock features.

    ``static_until`` limits the static values to buckets before an instant, so that they know nothing
    of the validation period; by default they come from the whole history. ``clock_digits`` rounds the cyclic
    clock features.
    """
    use_utc(buckets.sparkSession)
    require_columns(buckets, [key, "ts", *state, *static])
    # Stated before the buckets are read twice, so that both readers share one shuffle.
    buckets = buckets.filter(F.col(key).isNotNull())
    statics = None
    if static:
        known = buckets if static_until is None else buckets.filter(F.col("ts") < F.lit(static_until))
        statics = modes(known, key, static)
    rows = grid_rows(buckets, key, state, minutes, stale_after, fresh_only, statics)
    freshness = ["is_observed", "is_stale", "age_minutes"]
    clock = clock_features(F.col("ts"), zone, clock_digits)
    return rows.select(
        key, "ts", *state, *static, *freshness, *[value.alias(name) for name, value in clock.items()]
    )

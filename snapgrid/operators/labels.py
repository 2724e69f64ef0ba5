"""Labels at future horizons and leak-free temporal splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapgrid.functions.time import MINUTE_US, grid_steps
from snapgrid.operators.slices import ranked_sums
from snapgrid.schema import GRID_MINUTES, STALE_CAP_MINUTES


def label_inputs(
    features: list[str], key: str = "st_id", ts: str = "ts", age: str = "age_minutes", state: str = "available_ports"
) -> list[str]:
    """What labelling and training read of a dense grid: where and when, how old, the state and the features."""
    return list(dict.fromkeys([key, ts, age, state, *features]))


def with_labels(
    grid: DataFrame,
    horizons: list[int],
    key: str = "st_id",
    state: str = "available_ports",
    minutes: int = GRID_MINUTES,
) -> DataFrame:
    """Rows that have a state, with the state at each horizon as ``<state>_in_<horizon>``.

    Labels are looked up by instant, not by row offset, so rows without a state (stale ones) are left
    out before the shuffle, at the scan if the grid is a table. All horizons share one window, which is
    per key and bounded: a key has at most one row per grid step.
    """
    along = Window.partitionBy(key).orderBy(F.unix_micros("ts"))
    ahead = {h: grid_steps(h, minutes)[1] * MINUTE_US for h in horizons}
    found = [F.first(state).over(along.rangeBetween(us, us)).alias(f"{state}_in_{h}") for h, us in ahead.items()]
    return grid.filter(F.col(state).isNotNull()).select("*", *found)


def eligible_rows(
    labelled: DataFrame, horizon_minutes: int, state: str = "available_ports", stale_after: int = STALE_CAP_MINUTES
) -> DataFrame:
    """Rows fit to learn from: state fresh enough, label known. ``target`` = the labelled state is zero."""
    label = F.col(f"{state}_in_{horizon_minutes}")
    fit = labelled.filter((F.col("age_minutes") <= stale_after) & F.col(state).isNotNull() & label.isNotNull())
    others = [c for c in labelled.columns if c.startswith(f"{state}_in_")]
    return fit.select("*", label.alias(f"{state}_at_label"), (label == 0).cast("byte").alias("target")).drop(*others)


def horizon_labels(
    grid: DataFrame,
    horizon_minutes: int,
    key: str = "st_id",
    state: str = "available_ports",
    minutes: int = GRID_MINUTES,
    stale_after: int = STALE_CAP_MINUTES,
) -> tuple[DataFrame, int]:
    """The eligible rows of one horizon with label and target, and the horizon in whole grid steps."""
    labelled = with_labels(grid, [horizon_minutes], key, state, minutes)
    return eligible_rows(labelled, horizon_minutes, state, stale_after), grid_steps(horizon_minutes, minutes)[1]


def split_point(df: DataFrame, ts: str = "ts", mode: str = "timestamps", share: float = 0.8) -> DataFrame:
    """One row: ``cut_us`` in microseconds (rows before it train), ``first_us`` and ``distinct_ts``.

    ``timestamps`` cuts the sorted distinct instants, ``rows`` cuts at the row-weighted quantile with
    linear interpolation. Rows are counted per instant first; ranks come from sliced running sums.
    """
    if mode not in ("timestamps", "rows"):
        raise ValueError(f"unknown split mode: {mode}")
    rows_there = F.count(F.lit(1)) if mode == "rows" else F.lit(1).cast("long")
    instants = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.unix_micros(ts).alias("us"))
        .agg(rows_there.alias("n"))
    )
    ranked = ranked_sums(instants, "us", ["n"])
    n, run = F.col("n_total"), F.col("n_run")
    facts = [F.min("us").alias("first_us"), F.count(F.lit(1)).alias("distinct_ts")]
    if mode == "timestamps":
        rank = F.greatest(F.lit(1), F.least(F.floor(n * F.lit(share)), n - 1))
        return ranked.agg(F.min(F.when(run > rank, F.col("us"))).alias("cut_us"), *facts)
    position = (n - 1) * F.lit(share)
    low = F.floor(position)
    ends = ranked.agg(
        F.min(F.when(run > low, F.col("us"))).alias("lo"),
        F.min(F.when(run > F.least(low + 1, n - 1), F.col("us"))).alias("hi"),
        F.max(position - low).alias("part"),
        *facts,
    )
    cut = F.floor(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part"))
    return ends.select(cut.alias("cut_us"), "first_us", "distinct_ts")


def split_instant(df: DataFrame, ts: str = "ts", mode: str = "timestamps", share: float = 0.8) -> int:
    """The split point as a number; one row reaches the driver. An empty side is an error.

    The cut is never after the last instant, so only the training side can be empty.
    """
    point = split_point(df, ts, mode, share).first()
    if point["distinct_ts"] < 2:
        raise ValueError("a temporal split needs at least two distinct timestamps")
    if point["first_us"] >= point["cut_us"]:
        raise ValueError("the temporal split left one side empty")
    return point["cut_us"]


def split_train_valid(
    df: DataFrame, ts: str = "ts", mode: str = "timestamps", share: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """Two frames, every training instant before every validation instant; neither is empty."""
    cut = split_instant(df, ts, mode, share)
    us = F.unix_micros(ts)
    return df.filter(us < F.lit(cut)), df.filter(us >= F.lit(cut))


def label_split(df: DataFrame, cut_us: int, ts: str = "ts") -> DataFrame:
    """Mark the side of the split instead of making two frames."""
    side = F.when(F.unix_micros(ts) < F.lit(cut_us), F.lit("train")).otherwise(F.lit("valid"))
    return df.withColumn("split", side)

"""Exact distributed describe: counts, moments and interpolated percentiles.

The built-in exact percentile keeps every distinct value in one reducer. Here values are counted
first, and ranks come from running sums over ranges of like numbers of distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapgrid.operators.rows import quoted
from snapgrid.operators.slices import ranked_sums

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _counted(df: DataFrame, value: str, weight: str | None) -> DataFrame:
    held = F.col(quoted(value))
    rows = df.filter(held.isNotNull())
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        rows = rows.filter(~F.isnan(held))
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        rows.groupBy(held.alias("value"))
        .agg(n.alias("n"))
        .filter("n > 0")
    )


def describe(
    df: DataFrame, value: str, weight: str | None = None, percentiles: dict[str, float] = QUARTILES
) -> DataFrame:
    """count, mean, sample std, min, percentiles (linear interpolation) and max, as one row.

    Nulls and NaN do not count. ``weight`` counts a row several times. The mean rides on the carry
    table, so the spread is taken about the true mean, without a second pass and without cancellation.
    """
    counted = _counted(df, value, weight).withColumn("_nv", F.col("n") * F.col("value").cast("double"))
    ranked = ranked_sums(counted, "value", ["n", "_nv"])
    mean = F.col("_nv_total") / F.col("n_total")
    off = F.col("value").cast("double") - mean
    exprs: list[Column] = [
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.max(mean).alias("mean"),
        F.sum(F.col("n") * off * off).alias("_m2"),
        F.min("value").cast("double").alias("min"),
        F.max("value").cast("double").alias("max"),
    ]
    for name, p in percentiles.items():
        position = (F.col("n_total") - 1) * F.lit(p)
        low = F.floor(position)
        exprs += [
            F.min(F.when(F.col("n_run") > low, F.col("value"))).cast("double").alias(f"_{name}_lo"),
            F.min(F.when(F.col("n_run") > F.least(low + 1, F.col("n_total") - 1), F.col("value")))
            .cast("double")
            .alias(f"_{name}_hi"),
            F.max(position - low).alias(f"_{name}_f"),
        ]
    stats = ranked.agg(*exprs)
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_m2") / (F.col("count") - 1)))
    between = []
    for p in percentiles:
        low, high, part = F.col(f"_{p}_lo"), F.col(f"_{p}_hi"), F.col(f"_{p}_f")
        between.append(F.when(part == 0, low).otherwise(low + (high - low) * part).alias(p))
    return stats.select("count", "mean", std.alias("std"), "min", *between, "max")


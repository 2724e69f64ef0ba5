"""Row-level operators: first and last per key, duplicates, contracts, joins with a hot side.

Picks per key are aggregations, not row numbers: they combine on the map side, so a key that holds a
third of all rows arrives at its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapgrid.session import use_utc


def quoted(name: str) -> str:
    """A column name as a reference: dots and spaces in it are part of the name."""
    return "`" + name.replace("`", "``") + "`"


def _pick(df: DataFrame, keys: list[str], order: list[str], latest: bool) -> DataFrame:
    """The greatest or smallest row per key, compared by ``order`` first, then by its other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = []
    for i, c in enumerate(order):
        # Null sorts lowest by itself, which is right for the latest row and wrong for the first.
        value = F.col(quoted(c))
        ordered += [value] if latest else [value.isNull().alias(f"_null{i}"), value]
    row = F.struct(*ordered, *[F.col(quoted(c)) for c in rest])
    by = [F.col(quoted(k)) for k in keys]
    picked = df.groupBy(*by).agg((F.max(row) if latest else F.min(row)).alias("_best"))
    return picked.select(*[F.col(quoted(c)) if c in keys else F.col(f"_best.{quoted(c)}").alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key along ``order``; equal rows in order fall back to the row's other values."""
    return _pick(df, keys, order, latest=True)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key along ``order``; a null order value counts as last."""
    return _pick(df, keys, order, latest=False)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Each whole row that occurs more than once, with the number of copies after the first."""
    counted = df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg((F.count(F.lit(1)) - 1).alias("extra_copies"))
    return counted.filter("extra_copies > 0")


def first_copies(df: DataFrame, place: str) -> DataFrame:
    """One of each set of equal rows, with the least ``place`` among them; the place itself is not compared."""
    same = [c for c in df.columns if c != place]
    found = df.groupBy(*[F.col(quoted(c)) for c in same]).agg(F.min(quoted(place)).alias(place))
    return found.select(*[F.col(quoted(c)) for c in df.columns])


def duplicate_report(df: DataFrame, id_column: str) -> DataFrame:
    """Total rows, distinct ids (nulls not counted) and rows that repeat an earlier row."""
    counted = df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.countDistinct(quoted(id_column)).alias("distinct_ids"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Fail with the sorted list of missing columns, else pass the frame on."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise KeyError(f"required columns are missing: {missing}")
    return df


def same_columns(columns: list[str], expected: list[str], source: str = "table") -> None:
    """Strict column set in any order: nothing missing, nothing extra."""
    have, want = set(columns), set(expected)
    if have != want:
        raise ValueError(f"{source}: columns differ, missing {sorted(want - have)}, unexpected {sorted(have - want)}")


def replace_column(df: DataFrame, target: str, source: str) -> DataFrame:
    """Put ``source`` in the place of ``target`` and drop ``source``."""
    require_columns(df, [target, source])
    return df.withColumn(target, F.col(quoted(source))).drop(source)


def prefix_columns(df: DataFrame, prefix: str, keep_prefixed: bool = False) -> DataFrame:
    names = [c if keep_prefixed and c.startswith(prefix) else prefix + c for c in df.columns]
    return df.toDF(*names)


def lookup_join(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join many rows to a lookup with one row per key, where some keys may be hot.

    A plain join: adaptive execution splits the row side of a hot key, or of rows without a key, at run time,
    by measured size and whatever the rows look like, so copies of one row are no special case and nothing is
    counted beforehand. Only the row side may be split, hence the join types.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    return rows.join(lookup, on, how)


def modes(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Most frequent value per key and column: smallest on ties, nulls ignored, null if all are null.

    Equal tuples are counted first, so what is taken apart per column is the set of distinct tuples,
    not the rows; every step combines on the map side.
    """
    use_utc(df.sparkSession)  # values pass through text
    types = {f.name: f.dataType for f in df.schema.fields}
    tuples = df.groupBy(key, *columns).agg(F.count(F.lit(1)).alias("_n"))
    pieces = [F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)]
    # The first piece keeps a key whose columns are all null.
    present = F.array(F.struct(F.lit(-1).alias("i"), F.lit("").alias("v")), *pieces)
    counted = (
        tuples.select(key, "_n", F.explode(present).alias("_p"))
        .select(key, F.col("_p.i").alias("_i"), F.col("_p.v").alias("_v"), "_n")
        .filter("_v is not null")
        .groupBy(key, "_i", "_v")
        .agg(F.sum("_n").alias("_n"))
    )
    picks = []
    for i, c in enumerate(columns):
        mine = F.col("_i") == i
        typed = F.when(mine, F.col("_v")).cast(types[c])
        picks.append(F.min(F.when(mine, F.struct((-F.col("_n")).alias("n"), typed.alias("v"))))["v"].alias(c))
    return counted.groupBy(key).agg(*picks)

"""Table profiles: shape, nulls, value counts, columns, daily records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapgrid.operators.rows import lookup_join, quoted, require_columns
from snapgrid.session import materialize, use_utc

MISSING = "<NA>"
#: Pieces of tuples that one task counts: sizes before the tuples are taken apart say nothing about them.
TASK_PIECES = 500_000
#: At most so many names for each column are frequent.
FREQUENT = 1000


def column_inventory(df: DataFrame) -> DataFrame:
    """(position, column, type) from the schema; reads no data."""
    lines = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(lines, "position int, column string, type string")


def table_shape(df: DataFrame, by: str | None = None) -> DataFrame:
    """Rows and columns, for the whole table or per value of ``by`` (such as the source file)."""
    width = F.lit(len(df.columns) - (1 if by else 0)).cast("long").alias("n_columns")
    counted = df.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(*([by] if by else []), "n_rows", width)


def null_counts(df: DataFrame, by: str | None = None) -> DataFrame:
    """(column, nulls) from one aggregation over all columns."""
    columns = [c for c in df.columns if c != by]
    keys = [by] if by else []
    counted = df.groupBy(*keys).agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    lines = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)]
    )
    return counted.select(*keys, F.explode(lines).alias("_l")).select(*keys, "_l.column", "_l.nulls")


def value_counts(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(column, value, count) for every column, values as text, null as ``<NA>``.

    Values are counted per task before the shuffle, so a frequent value is no hot spot.
    """
    columns = [c for c in df.columns if c not in exclude]
    pieces = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING)).alias("value")
            )
            for c in columns
        ]
    )
    return (
        df.select(F.explode(pieces).alias("_p"))
        .groupBy(F.col("_p.column").alias("column"), F.col("_p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def daily_records(df: DataFrame, ts: str = "snapshot_ts") -> DataFrame:
    """Records per UTC day from the first to the last day, days without any as 0.

    The spine is made from the counts themselves: each day fills the gap up to the next one.
    """
    use_utc(df.sparkSession)
    require_columns(df, [ts])
    days = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias("day"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    ends = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    spine = ends.filter("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return spine.join(days, "day", "left").select("day", F.coalesce("records", F.lit(0)).alias("records"))


def _names(columns: list[str]) -> Column:
    """The names ``<column>_<value>`` that a row holds."""
    names = [F.concat(F.lit(f"{c}_"), F.col(quoted(c)).cast("string")) for c in columns]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def _held_names(columns: list[str]) -> Column:
    """These names and the empty name, which every row holds."""
    return F.concat(F.array(F.lit("")), _names(columns))


def indicator_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, rows, total): how many rows hold each category indicator, of how many in all."""
    held = df.select(F.explode(_held_names(columns)).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
    total = held.filter("name = ''").select(F.col("rows").alias("total"))
    # One row.
    return held.filter("name <> ''").join(F.broadcast(total))


def one_hot_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of category indicators that occur together, as (a, b, rows, corr).

    Pairs that never meet have no row: theirs follows from :func:`indicator_counts` alone, and there are as many
    of them as the square of the number of values. Rows collapse to counts of distinct tuples, written once; joint counts
    come from the pieces of each tuple, whose number is the same in every task. A constant indicator has no correlation (null).
    """
    counted = df.groupBy(*[F.col(quoted(c)) for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    tuples = materialize(counted, "tuples")
    spread = tuples.repartition(1 + tuples.count() * len(columns) ** 2 // TASK_PIECES, *[F.col(quoted(c)) for c in columns])
    held = spread.select("_n", _names(columns).alias("_h"))
    single = held.select(F.explode("_h").alias("name"), "_n").groupBy("name").agg(F.sum("_n").cast("double").alias("held"))
    joint = (
        held.select("_n", F.explode("_h").alias("a"), "_h")
        .select("_n", "a", F.explode("_h").alias("b"))
        .groupBy("a", "b")
        .agg(F.sum("_n").alias("rows"))
    )
    # One row.
    total = tuples.agg(F.sum("_n").cast("double").alias("N"))
    rows = _with_count(_with_count(joint.join(F.broadcast(total)), single, total, "a", "b"), single, total, "b", "a")
    pa, pb = F.col("na") / F.col("N"), F.col("nb") / F.col("N")
    cov = F.col("rows") / F.col("N") - pa * pb
    scale = F.sqrt(pa * (1 - pa) * pb * (1 - pb))
    return rows.select("a", "b", "rows", F.when(scale > 0, cov / scale).alias("corr"))


def _with_count(pairs: DataFrame, single: DataFrame, total: DataFrame, side: str, other: str) -> DataFrame:
    """The pairs with the count of the name on one ``side`` as ``n<side>``.

    Names that more than one row in ``FREQUENT`` holds are few, whatever the table: they go to every task. Their pairs would
    be the hot keys of the join that finds the other counts, so they go along there by the name on the ``other`` side.
    """
    often = single.join(F.broadcast(total)).filter(F.col("held") * FREQUENT > F.col("N"))
    known = pairs.join(F.broadcast(often.select(F.col("name").alias(side), F.col("held").alias("_often"))), side, "left")
    keyed = known.withColumn("_key", F.when(F.col("_often").isNull(), F.col(side)).otherwise(F.col(other)))
    found = lookup_join(keyed, single.select(F.col("name").alias("_key"), F.col("held").alias("_found")), ["_key"])
    return found.withColumn(f"n{side}", F.coalesce("_often", "_found")).drop("_key", "_often", "_found")

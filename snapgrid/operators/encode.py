"""One-hot encoding and variance selection: column sets that depend on the data.

A column for each value takes one look at the data to fix the schema; the transformation is a plain select. For any
number of values there is the sparse form: a dictionary of the values as a table, and a row for each one of the matrix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapgrid.functions.values import number
from snapgrid.operators.rows import lookup_join, quoted
from snapgrid.operators.slices import numbered


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) of the non-null values, for all columns in one pass."""
    pieces = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(pieces).alias("_p"))
        .select("_p.column", "_p.value")
        .filter("value is not null")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def categories(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """The sorted values of each named column: they become column names, so they are the schema of a result.

    Which columns are encoded is the caller's choice; no count of values decides.
    """
    if not columns:
        return {}
    out: dict[str, list[str]] = {c: [] for c in columns}
    for row in category_counts(df, columns).select("column", "value").toLocalIterator():
        out[row["column"]].append(row["value"])
    return {c: sorted(values) for c, values in out.items()}


def categorical_columns(df: DataFrame, time: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != time]


def one_hot(df: DataFrame, time: str = "snapshot_ts", values: dict[str, list[str]] | None = None) -> DataFrame:
    """Every text column but the time becomes 0/1 columns ``<column>_<value>`` after the others.

    Null is zero in all of them. A text column without any value stays as it is. A boolean column with
    nulls is encoded as ``_False`` and ``_True``, one without nulls is left alone.
    """
    booleans = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    if values is None:
        values = categories(df, categorical_columns(df, time))
        if booleans:
            nulls = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in booleans]).first()
            some = category_counts(df, booleans).collect()
            for c in booleans:
                held = sorted(r["value"] for r in some if r["column"] == c)
                if nulls[c] and held:
                    values[c] = held
    encoded = [c for c in df.columns if values.get(c)]
    lead = [time] if time in df.columns else []
    kept = lead + [c for c in df.columns if c not in encoded and c != time]
    flags = []
    for c in encoded:
        for v in values[c]:
            shown = v.capitalize() if c in booleans else v
            hit = F.col(quoted(c)).cast("string") == F.lit(v)
            flags.append(F.coalesce(hit.cast("int"), F.lit(0)).alias(f"{c}_{shown}"))
    return df.select(*[F.col(f"`{c}`") for c in kept], *flags)


def encodable(df: DataFrame, time: str = "snapshot_ts") -> list[str]:
    """The columns that one-hot encoding takes apart: text but the time, and booleans with nulls.

    One row reaches the driver, and only if there are booleans.
    """
    booleans = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    chosen = set(categorical_columns(df, time))
    if booleans:
        nulls = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(c) for c in booleans]).first()
        chosen |= {c for c in booleans if nulls[c]}
    return [c for c in df.columns if c in chosen]


def _cells(df: DataFrame, columns: list[str]) -> Column:
    """One (column's place, column, value) for each of the columns; booleans are spelled ``True`` and ``False``."""
    cells = []
    for i, c in enumerate(columns):
        value = F.col(quoted(c)).cast("string")
        if isinstance(df.schema[c].dataType, T.BooleanType):
            value = F.initcap(value)
        cells.append(F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), value.alias("value")))
    return F.array(*cells)


def value_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``indicator`` (from 0, by column, then value), ``column``, ``value`` and ``count`` of every value that occurs.

    A table, however many values there are: numbers come from ranges of sorted values, nothing is collected.
    """
    if not columns:
        none = "indicator long, column string, value string, count long"
        return df.sparkSession.createDataFrame([], none)
    seen = df.select(F.inline(_cells(df, columns))).filter("value is not null")
    counted = seen.groupBy("place", "column", "value").agg(F.count(F.lit(1)).alias("count"))
    return numbered(counted, ["place", "value"], "indicator").select("indicator", "column", "value", "count")


def indicators(df: DataFrame, row_id: list[str], columns: list[str], dictionary: DataFrame) -> DataFrame:
    """The ones of the one-hot matrix: the row's ``row_id`` columns and the ``indicator``. Nulls have none.

    The rows meet the dictionary in a plain join, whose row side adaptive execution splits where a value is hot.
    """
    keys = [F.col(quoted(k)) for k in row_id]
    if not columns:
        return df.select(*keys, F.lit(None).cast("long").alias("indicator")).limit(0)
    cells = df.select(*keys, F.inline(_cells(df, columns))).filter("value is not null")
    found = lookup_join(cells.drop("place"), dictionary.select("indicator", "column", "value"), ["column", "value"], "inner")
    return found.select(*keys, "indicator")


def indicator_variance(dictionary: DataFrame, rows: int, threshold: float = 0.0) -> DataFrame:
    """The dictionary's indicators that vary more than ``threshold`` over so many rows, with their population variance.

    A column of zeros and ones varies by its share of ones alone, so the counts say it all.
    """
    ones = F.col("count") / F.lit(rows)
    spread = dictionary.withColumn("variance", ones * (1 - ones))
    return spread.filter((F.col("variance") > threshold) & (F.col("count") < rows))


@dataclass(frozen=True)
class Selection:
    selected: list[str]
    dropped: list[str]
    non_numeric: list[str]


def variance_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls after numeric coercion, population variance, range), in one aggregation."""
    exprs = []
    for i, c in enumerate(columns):
        kind = df.schema[c].dataType
        n = F.lit(None).cast("double")  # times and nested values are not numeric
        if isinstance(kind, (T.NumericType, T.BooleanType, T.StringType)):
            n = number(F.col(f"`{c}`"), text=isinstance(kind, T.StringType))
        exprs += [
            F.count_if(n.isNull()).alias(f"n{i}"),
            F.var_pop(n).alias(f"v{i}"),
            (F.max(n) - F.min(n)).alias(f"r{i}"),
        ]
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("nulls"),
            F.col(f"v{i}").alias("variance"),
            F.col(f"r{i}").alias("spread"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*exprs).select(F.explode(F.array(*lines)).alias("_l")).select("_l.*")


def select_by_variance(
    df: DataFrame, threshold: float = 0.0, time: str = "snapshot_ts", keep: tuple[str, ...] = ()
) -> tuple[DataFrame, Selection]:
    """Keep the columns that are numeric without nulls and vary more than ``threshold``.

    Values and order stay, the time column comes first. ``keep`` protects columns a later stage needs.
    """
    columns = [c for c in df.columns if c != time]
    stats = {r["column"]: r for r in variance_stats(df, columns).collect()} if columns else {}
    numeric = [c for c in columns if stats[c]["nulls"] == 0 and stats[c]["variance"] is not None]

    def varies(c: str) -> bool:
        return stats[c]["variance"] > threshold and (threshold > 0 or stats[c]["spread"] > 0)

    selected = [c for c in columns if c in keep or (c in numeric and varies(c))]
    if not any(c in numeric and varies(c) for c in columns):
        raise ValueError(f"no feature varies more than {threshold}")
    report = Selection(
        selected, [c for c in numeric if c not in selected], [c for c in columns if c not in numeric and c not in keep]
    )
    lead = [time] if time in df.columns else []
    return df.select(*[F.col(f"`{c}`") for c in lead + selected]), report

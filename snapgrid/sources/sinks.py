"""Sinks: stage tables, CSV exports, models and metrics."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapgrid.functions.time import iso_text
from snapgrid.operators.rows import quoted
from snapgrid.session import use_utc


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write Parquet (snappy) and return the written table, which also cuts the lineage."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_counted(df: DataFrame, path: str, key: str) -> tuple[int, int]:
    """Write a table and report its rows and distinct keys. An empty table is an error.

    The rows are counted while they are written; the keys from the written table's key column alone.
    """
    seen = Observation()
    table = write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    if not seen.get["rows"]:
        raise ValueError(f"no rows to write to {path}")
    return seen.get["rows"], table.select(key).distinct().count()


def in_order(df: DataFrame, sort: list[str]) -> DataFrame:
    """Sorted by columns, descending where a name starts with a minus; nulls last either way."""
    keys = [F.col(quoted(c[1:])).desc_nulls_last() if c.startswith("-") else F.col(quoted(c)).asc_nulls_last() for c in sort]
    return df.orderBy(*keys)


def write_csv(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    """CSV export with ISO instants; sorted only on request (see :func:`in_order`)."""
    use_utc(df.sparkSession)
    instants = {f.name: iso_text(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    text = df.withColumns(instants) if instants else df
    text = in_order(text, sort) if sort else text
    text.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def rewrite_table(spark: SparkSession, source: str, target: str, change) -> DataFrame:
    """Table maintenance: read, change, write to a new place (a table cannot overwrite its own input)."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target must differ")
    return write_table(change(spark.read.parquet(source)), target)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """The one-row metrics record as JSON."""
    metrics.coalesce(1).write.mode("overwrite").json(path)

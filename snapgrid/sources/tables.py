"""Tabular sources: stage tables, column-checked unions, file selection."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapgrid.functions.time import parse_instant
from snapgrid.operators.grid import strict_instants
from snapgrid.operators.rows import lookup_join, quoted, require_columns, same_columns
from snapgrid.operators.slices import numbered
from snapgrid.session import use_utc

#: JSON cells hold commas, quotes and line breaks.
CSV_OPTIONS = {"header": True, "escape": '"'}
#: Where a row comes from: file, start of its block, place in the task that read the block.
ORIGIN = ["_file", "_block", "_row"]
PLACE_BITS = 33
#: A list of at most so many blocks, a path and two numbers each, is broadcast.
BROADCAST_BLOCKS = 200_000


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    )


def breaks_by_file(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, breaks): whether quoted cells of a CSV file hold line breaks.

    A cell that goes on in the next line leaves a line with an odd number of quotes, as doubled ones inside a cell come
    in pairs; a file without such a line may be split anywhere. One pass over lines, combined on the map side.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return _lines(spark, paths).groupBy("path").agg((F.max(quotes % 2) == 1).alias("breaks"))


def has_breaks(spark: SparkSession, paths: str | list[str]) -> bool:
    """Whether any of the files has a quoted cell with a line break."""
    return not breaks_by_file(spark, paths).filter("breaks").isEmpty()


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, line_breaks: bool | None = None
) -> DataFrame:
    """CSV with a header: typed by ``schema``, all text without one (types are not guessed).

    Files without line breaks inside cells are split, others are read whole, one task for each. ``line_breaks`` says
    which they are; by default one more pass finds out.
    """
    whole = has_breaks(spark, paths) if line_breaks is None else line_breaks
    reader = spark.read.options(**CSV_OPTIONS, multiLine=whole)
    return (reader.schema(schema) if schema else reader).csv(paths)


def read_csv_inferred(spark: SparkSession, paths: str | list[str], line_breaks: bool | None = None) -> DataFrame:
    """CSV with types inferred from the data, at the price of one more pass over it."""
    whole = has_breaks(spark, paths) if line_breaks is None else line_breaks
    return spark.read.options(**CSV_OPTIONS, multiLine=whole, inferSchema=True).csv(paths)


def with_origin(scan: DataFrame) -> DataFrame:
    """A scan's rows with the columns of ``ORIGIN``; to be called on the scan itself."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias(ORIGIN[0]),
        F.col("_metadata.file_block_start").alias(ORIGIN[1]),
        F.monotonically_increasing_id().alias(ORIGIN[2]),
    )


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """The columns of ``ORIGIN`` as one number that grows in file order: files by path, then rows as they stand.

    Only the list of blocks is sorted; a block is read by one task, in order. The list goes to every task once its
    count has proved it small, so rows do not move; a longer one is joined by shuffle.
    """
    blocks = numbered(df.select(*ORIGIN[:2]).distinct(), ORIGIN[:2], "_nth")
    small = blocks.count() <= BROADCAST_BLOCKS
    inside = F.col(ORIGIN[2]).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    place = F.shiftleft("_nth", PLACE_BITS) + inside
    found = lookup_join(df, F.broadcast(blocks) if small else blocks, ORIGIN[:2], "inner")
    return found.withColumn(name, place).drop(*ORIGIN, "_nth")


def list_files(spark: SparkSession, folder: str, pattern: str = "*", prefixes: tuple[str, ...] = ()) -> list[str]:
    """Sorted file paths by name pattern and name prefix; an empty selection is an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    name = F.substring_index("path", "/", -1)
    if prefixes:
        files = files.filter(reduce(lambda a, b: a | b, [name.startswith(p) for p in prefixes]))
    paths = sorted(row["path"] for row in files.collect())
    if not paths:
        raise FileNotFoundError(f"no files match {pattern} {prefixes} in {folder}")
    return paths


def tables_in(spark: SparkSession, folder: str) -> list[str]:
    """The CSV files of a folder, sorted; none if there is no such folder."""
    try:
        return list_files(spark, folder, "*.csv")
    except FileNotFoundError:
        return []
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def union_checked(frames: list[DataFrame], reference: list[str] | None = None) -> DataFrame:
    """Union all by name of frames with equal column sets, in the reference order (default: the first's)."""
    reference = reference or frames[0].columns
    for i, frame in enumerate(frames):
        same_columns(frame.columns, reference, f"input {i}")
    return reduce(DataFrame.unionByName, [frame.select(*reference) for frame in frames])


@dataclass(frozen=True)
class FileGroup:
    """CSV files with one header that are read alike: whole, or split into tasks."""

    columns: tuple[str, ...]
    line_breaks: bool
    paths: list[str]


def file_groups(spark: SparkSession, paths: list[str]) -> list[FileGroup]:
    """Files by header and by whether cells hold line breaks; a group shares one scan, so a plan has one leaf for
    each, not for each file. Groups come in the order of their first file.

    Two distributed passes over lines: the first line of every file is the one at the start of its first block.
    """
    lines = _lines(spark, paths).withColumn("place", F.monotonically_increasing_id())
    first = lines.filter("block = 0").groupBy("path").agg(F.min_by("value", "place").alias("header"))
    known = first.join(breaks_by_file(spark, paths), "path")
    grouped = known.groupBy("header", "breaks").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    groups: dict[tuple, list[str]] = {}
    for row in sorted(grouped, key=lambda r: r["paths"][0]):
        columns = next(csv.reader([row["header"]], doublequote=True))
        groups.setdefault((tuple(columns), row["breaks"]), []).extend(row["paths"])
    return [FileGroup(columns, breaks, files) for (columns, breaks), files in groups.items()]


def read_group(spark: SparkSession, group: FileGroup) -> DataFrame:
    """The files of a group as text columns, with their ``source_file`` and the columns of ``ORIGIN``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in group.columns])
    scan = with_origin(read_csv(spark, group.paths, schema, group.line_breaks))
    return scan.withColumn("source_file", F.substring_index(ORIGIN[0], "/", -1))


def read_checked(
    spark: SparkSession, paths: list[str], reference: list[str] | None = None, place: str | None = None
) -> DataFrame:
    """Many CSV files with the same columns, in any order, as one frame; with ``place``, each row's number in file order
    as a column of that name."""
    groups = file_groups(spark, paths)
    reference = reference or list(groups[0].columns)
    frames = []
    for group in groups:
        same_columns(list(group.columns), reference, group.paths[0])
        frames.append(read_group(spark, group).select(*[F.col(quoted(c)) for c in reference], *ORIGIN))
    rows = reduce(DataFrame.unionByName, frames)
    return rows.drop(*ORIGIN) if place is None else in_file_order(rows, place)


def read_stage(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    schema: T.StructType | None = None,
    ts: str | None = None,
    bad_ts: str = "drop",
    line_breaks: bool | None = None,
) -> DataFrame:
    """A stage table: Parquet at ``path``, CSV at ``path + '.csv'`` if there is no such path, else an error.

    A path that exists without a readable table, such as an interrupted stage, is an error too.

    Only ``columns`` are read. Unparseable values of ``ts`` drop their row or fail the job.
    """
    use_utc(spark)
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise  # a folder without a table is a broken stage, not an absent one
        try:
            text = f"{path}.csv"
            df = read_csv(spark, text, schema, line_breaks) if schema else read_csv_inferred(spark, text, line_breaks)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(f"no stage table at {path} or {path}.csv") from None
    if columns:
        df = require_columns(df, columns).select(*columns)
    if ts:
        if bad_ts == "fail":
            return strict_instants(df, ts)
        if dict(df.dtypes)[ts] != "timestamp":
            df = df.withColumn(ts, parse_instant(F.col(ts)))
        df = df.filter(F.col(ts).isNotNull())
    return df

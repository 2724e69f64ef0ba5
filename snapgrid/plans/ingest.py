"""From raw snapshots to the locations, stations and ports tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapgrid.operators.nested import flatten, opening_hours, unnest
from snapgrid.operators.rows import first_copies, prefix_columns, quoted
from snapgrid.schema import PORT_ITEM, STATION_ITEM, StagePaths
from snapgrid.sources.sinks import write_table
from snapgrid.sources.snapshots import PATTERN, read_snapshots
from snapgrid.sources.tables import file_groups, in_file_order, list_files, read_checked, read_group, tables_in, union_checked

HOURS = "opening_hours"
STATIONS = "stations"
#: The number of a row in file order; of several copies the first one's.
PLACE = "place"
#: Fields of children in JSON text that no schema names, as one text.
REST = "more_fields"
PORT_LIFT = {
    "status": ("port_status", "status", "string"),
    "authentication_id": ("authentications", "authentication_id", "string"),
    "payment_required": ("authentications", "payment_required", "boolean"),
}


#: Years whose tables come with opening hours as columns.
PREFIXES = ("2022_", "2023_")


def convert_snapshots(spark: SparkSession, json_folder: str, target: str, record: T.StructType | None = None) -> DataFrame:
    """All JSON documents as one flat table; columns name each row's source file and number it in file order.

    The list of stations stays typed, other lists become JSON text.
    """
    return write_table(flatten(read_snapshots(spark, json_folder, record, place=PLACE), keep=(STATIONS,)), target)


def tables_with_hours(spark: SparkSession, table_folder: str) -> DataFrame:
    """All CSV tables that have nested opening hours as one frame, the hours as columns, by source file."""
    groups = file_groups(spark, list_files(spark, table_folder, "*.csv"))
    nested = [opening_hours(read_group(spark, group)) for group in groups if HOURS in group.columns]
    if not nested:
        raise FileNotFoundError(f"no tables with opening hours in {table_folder}")
    return in_file_order(union_checked(nested), PLACE)


def derive_opening_hours(spark: SparkSession, table_folder: str, target: str) -> DataFrame:
    """The tables with derived hours, written in one job; a column names each row's source file."""
    return write_table(tables_with_hours(spark, table_folder), target)


def _after(df: DataFrame, part: int) -> DataFrame:
    """The rows numbered behind those of all earlier parts."""
    return df.withColumn(PLACE, F.col(PLACE) + F.lit(part << 61))


def consolidate_locations(
    spark: SparkSession, raw_folder: str, with_hours: DataFrame, prefixes: tuple[str, ...] = PREFIXES
) -> DataFrame:
    """Raw tables of the named years and those with derived hours as one table without duplicate rows.

    ``loc_place`` numbers the rows in file order, those with derived hours after the others.
    """
    raw = read_checked(spark, list_files(spark, raw_folder, "*.csv", prefixes), place=PLACE)
    later = _after(with_hours.drop("source_file"), 1)
    return first_copies(prefix_columns(union_checked([raw, later], raw.columns), "loc_"), f"loc_{PLACE}")


def _as_text(df: DataFrame) -> DataFrame:
    """All columns but the number as text, lists as JSON text, as a CSV table has them."""
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    texts = [F.to_json(F.col(quoted(c))) if c in nested else F.col(quoted(c)).cast("string") for c in df.columns if c != PLACE]
    return df.select(*[t.alias(c) for t, c in zip(texts, [c for c in df.columns if c != PLACE])], PLACE)


def locations(spark: SparkSession, paths: StagePaths, prefixes: tuple[str, ...] = PREFIXES) -> DataFrame:
    """Documents and CSV tables of the raw folders as one table of location versions without duplicate rows.

    Stages on the way: the converted documents, and everything with opening hours as columns. In file order come the
    tables of the named years, then tables whose hours are still nested, then documents. Without CSV tables all columns
    keep the types of the documents; with them the documents' values become text as in a CSV file, and columns must agree.
    """
    converted = convert_snapshots(spark, paths.path("raw_json"), paths.path("converted"))
    documents = opening_hours(converted)
    groups = file_groups(spark, found) if (found := tables_in(spark, paths.path("raw_tables"))) else []
    nested = [opening_hours(read_group(spark, g)) for g in groups if HOURS in g.columns]
    if nested:
        earlier = in_file_order(union_checked(nested), PLACE)
        documents = union_checked([earlier, _after(_as_text(documents), 1)], earlier.columns)
    hours = write_table(documents, paths.path("opening_hours")).drop("source_file")
    named = [p for p in found if p.rsplit("/", 1)[1].startswith(prefixes)]
    everything = hours
    if named:
        raw = read_checked(spark, named, place=PLACE)
        everything = union_checked([raw, _after(hours if nested else _as_text(hours), 1)], raw.columns)
    return first_copies(prefix_columns(everything, "loc_"), f"loc_{PLACE}")


def locations_from_snapshots(
    spark: SparkSession, json_folder: str, record: T.StructType | None = None, pattern: str = PATTERN
) -> DataFrame:
    """The same table straight from the JSON documents, typed all the way; stations stay an array, ``loc_place`` is each
    row's number in file order."""
    raw = read_snapshots(spark, json_folder, record, pattern=pattern, place=PLACE).drop("source_file")
    return first_copies(prefix_columns(flatten(opening_hours(raw), keep=(STATIONS,)), "loc_"), f"loc_{PLACE}")


def extract_stations(locations: DataFrame, child: T.StructType = STATION_ITEM) -> DataFrame:
    """One row per station of every location version."""
    rows = unnest(locations, "loc_stations", child, ["loc_id"], rest=REST)
    return prefix_columns(rows, "st_").withColumnRenamed("st_loc_id", "st_location_id")


def extract_ports(stations: DataFrame, child: T.StructType = PORT_ITEM) -> DataFrame:
    """One row per port of every station version, with its first status and authentication."""
    rows = unnest(stations, "st_ports", child, ["st_id", "st_location_id"], PORT_LIFT, rest=REST)
    return prefix_columns(rows, "port_", keep_prefixed=True).withColumnsRenamed(
        {"port_st_id": "port_station_id", "port_st_location_id": "port_station_location_id"}
    )

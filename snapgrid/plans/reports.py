"""Report jobs: gap report, port study, table profile, daily coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapgrid.functions.time import int_list
from snapgrid.functions.values import file_tag, safe_name
from snapgrid.operators import gaps, profile, rows, studies
from snapgrid.schema import StagePaths
from snapgrid.sources.sinks import write_csv
from snapgrid.sources.tables import read_stage

# The attributes of a port that a study compares.
PORT_ATTRIBUTES = ["port_connector_type", "port_power_kw", "port_charging_mechanism"]


def gap_report(
    spark: SparkSession,
    path: str,
    time_col: str = "snapshot_ts",
    station_col: str = "st_id",
    location_col: str = "st_location_id",
    gap_hours: float = 6.0,
    label_times_min: str = "5,10,15,30,60",
    label_tolerance_min: int = 2,
    output_csv: str = "",
) -> dict[str, DataFrame]:
    """All tables of the gap report for a stage table; invalid timestamps fail the job."""
    df = read_stage(spark, path, ts=time_col, bad_ts="fail")
    found = gaps.gap_tables(df, time_col, station_col, location_col, gap_hours)
    tables = dict(vars(found))
    if "available_ports" in df.columns:
        tables["occupied_rate"] = gaps.occupied_rate(df)
    coverage = gaps.label_coverage(df, time_col, station_col, tuple(int_list(label_times_min)), label_tolerance_min)
    tables["label_coverage"] = coverage
    if output_csv:
        write_csv(coverage, output_csv, sort=["travel_time_min"])
    return tables


def port_study(ports: DataFrame) -> dict[str, DataFrame]:
    """How connector, power and mechanism vary over ports, stations and time."""
    summary = studies.distinct_per_group(ports, "port_station_id", PORT_ATTRIBUTES)
    return {
        "duplicates": rows.duplicate_report(ports, "port_id"),
        "duplicate_rows": rows.duplicate_rows(ports),
        "totals": studies.varying_totals(summary, PORT_ATTRIBUTES),
        "varying_stations": studies.varying_groups(summary, PORT_ATTRIBUTES),
        "combos": studies.combo_frequencies(ports, PORT_ATTRIBUTES, "port_id"),
        "correlation": profile.one_hot_correlation(ports, PORT_ATTRIBUTES),
        "multi_combo_stations": studies.multi_combo_groups(ports, PORT_ATTRIBUTES, "port_id", "port_station_id"),
        "changed_ports": studies.change_history(ports, "port_id", PORT_ATTRIBUTES, ["port_last_updated", "port_status"]),
    }


def table_profile(df: DataFrame, exclude: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    return {
        "columns": profile.column_inventory(df),
        "shape": profile.table_shape(df),
        "nulls": profile.null_counts(df),
        "values": profile.value_counts(df, exclude),
    }


def export_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Each table of a report as CSV in a folder of its own, whose name is safe for any file system; the paths by name.

    Names that become the same that way get a number.
    """
    taken: dict[str, str] = {}
    for name, table in tables.items():
        safe = safe_name(name)
        path = f"{folder.rstrip('/')}/{safe}"
        while path in taken.values():
            path += "_2"
        write_csv(table, path)
        taken[name] = path
    return taken


# Nested columns that a profile of a stage table leaves out.
NOT_PROFILED = {"locations": ("loc_stations",), "stations": ("st_ports",)}


def stage_profile(spark: SparkSession, paths: StagePaths, entity: str = "stations") -> dict[str, DataFrame]:
    """Profile of a named stage table: locations, stations, ports or the selected time series."""
    stage = {"timeseries": "selected"}.get(entity, entity)
    if stage not in ("locations", "stations", "ports", "selected"):
        raise ValueError(f"unknown stage table: {entity}")
    return table_profile(read_stage(spark, paths.path(stage)), NOT_PROFILED.get(entity, ()))


def raw_profile(raw: DataFrame) -> dict[str, DataFrame]:
    """Shape and nulls per raw file, with a short title: one scan grouped by file instead of a loop."""
    tagged = raw.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("file"))
    found = {"shape": profile.table_shape(tagged, "file"), "nulls": profile.null_counts(tagged, "file")}
    return {name: table.withColumn("title", file_tag(F.col("file"))) for name, table in found.items()}


def daily_coverage(spark: SparkSession, path: str, ts: str = "snapshot_ts") -> DataFrame:
    """Records per day of a stage table; a table without any valid time is an error."""
    df = read_stage(spark, path, ts=ts)
    if df.select(ts).isEmpty():
        raise ValueError(f"no valid values in {ts}")
    return profile.daily_records(df, ts)

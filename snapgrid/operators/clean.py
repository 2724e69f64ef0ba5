"""Cleaning of location versions and of the port status log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapgrid.functions.ports import MOTORCYCLE_NOTE
from snapgrid.functions.time import minutes_of_day, parse_instant
from snapgrid.functions.values import differs, truth_flag
from snapgrid.operators.rows import latest_per_key
from snapgrid.session import use_utc


def clean_locations(
    locations: DataFrame,
    key: str = "loc_id",
    updated: str = "loc_last_updated",
    flags: tuple[str, ...] = ("loc_onstreet_location",),
    hours: tuple[str, ...] = ("loc_opening_hours_hour_begin", "loc_opening_hours_hour_end"),
    place: str = "loc_place",
) -> DataFrame:
    """Parse the update time, turn flag text into 0/1 and hours into minutes, one row per version.

    Of several rows of one version the last in file order stays, by the number in ``place``, which does not reach the
    result; in a table without that column the greatest row does. Flag and hour columns that the table lacks are
    skipped.
    """
    use_utc(locations.sparkSession)
    have = set(locations.columns)
    changed = {f"{updated}_parsed": parse_instant(F.col(updated))}
    changed |= {c: truth_flag(F.col(c)) for c in flags if c in have}
    changed |= {c: minutes_of_day(F.col(c)) for c in hours if c in have}
    order = [f"{updated}_parsed", *([place] if place in have else [])]
    return latest_per_key(locations.withColumns(changed), [key, updated], order).drop(place)


def clean_ports(
    ports: DataFrame,
    key: str = "port_id",
    updated: str = "port_last_updated",
    notes: str = "port_notes",
    excluded_note: str = MOTORCYCLE_NOTE,
) -> DataFrame:
    """Drop rows without a valid update time, keep one row per (port, update), drop excluded notes."""
    use_utc(ports.sparkSession)
    parsed = ports.withColumn(f"{updated}_parsed", parse_instant(F.col(updated)))
    valid = parsed.filter(F.col(f"{updated}_parsed").isNotNull())
    versions = latest_per_key(valid, [key, updated], [f"{updated}_parsed"])
    if notes in versions.columns:
        versions = versions.filter(differs(F.col(notes), excluded_note))
    return versions

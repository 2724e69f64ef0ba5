"""As-of state: what every station looked like at each instant one of its ports changed.

Ports are never crossed with instants. Each port event becomes a change (+1, 0, -1) of every station
count; changes are summed per (station, instant) and accumulated over time. All windows run per time
slice, with the state at the slice border carried in, so neither a hot port nor a hot station sits in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapgrid.functions.ports import AVAILABLE, port_flags
from snapgrid.functions.values import safe_rate
from snapgrid.operators.clean import clean_locations, clean_ports
from snapgrid.operators.rows import first_per_key, lookup_join, quoted
from snapgrid.operators.slices import BEFORE, SLICE, SLICE_MINUTES, SO_FAR, placed, running_sums, time_slice

FLAGS = ["dc", "ccs", "chademo", "type2", "wall"]
COUNTS = ["seen", "avail", "avail_dc", *FLAGS]

# Columns that the station series leaves out.
LEFT_OUT = [
    "st_label",
    "st_ports",
    "st_notes",
    "loc_stations",
    "loc_address_address_string",
    "loc_last_updated",
    "loc_last_updated_parsed",
]


def _port_events(
    ports: DataFrame, station: str, port: str, ts: str, status: str, attributes: tuple[str, str, str], slice_minutes: int
) -> DataFrame:
    """One row per (station, port, instant): ``free`` (null = status unknown) and the flag bits.

    Everything is packed into one integer so that the copies of an instant, should there be any,
    collapse in a hash aggregation on the map side.
    """
    flags = port_flags(*[F.col(c) for c in attributes])
    bits = sum((flags[f] * F.lit(1 << i) for i, f in enumerate(FLAGS)), F.lit(0))
    known, free = F.lit(1 << len(FLAGS)), F.lit(1 << (len(FLAGS) + 1))
    told = known + F.when(F.col(status) == AVAILABLE, free).otherwise(0)
    code = bits + F.when(F.col(status).isNull(), 0).otherwise(told)
    rows = ports.filter(F.col(station).isNotNull() & F.col(port).isNotNull() & F.col(ts).isNotNull())
    packed = rows.groupBy(
        F.col(station).alias("station"), F.col(port).alias("port"), F.col(ts).alias("ts")
    ).agg(F.max(code).alias("code"))
    has_status = F.col("code").bitwiseAND(known) > 0
    return packed.select(
        "station",
        "port",
        "ts",
        time_slice(F.unix_micros("ts"), slice_minutes).alias(SLICE),
        F.when(has_status, (F.col("code").bitwiseAND(free) > 0).cast("int")).alias("free"),
        F.col("code").bitwiseAND(F.lit((1 << len(FLAGS)) - 1)).alias("bits"),
    )


def _bit(bits: Column, flag: str) -> Column:
    return F.shiftright(bits, FLAGS.index(flag)).bitwiseAND(F.lit(1))


def _counts(free: Column, bits: Column) -> dict[str, Column]:
    """What one port adds to its station, given its filled status and its attributes."""
    bits = F.coalesce(bits, F.lit(0))
    avail = F.coalesce(free, F.lit(0))
    return {
        "seen": free.isNotNull().cast("int"),
        "avail": avail,
        "avail_dc": avail * _bit(bits, "dc"),
        **{f: _bit(bits, f) for f in FLAGS},
    }


def port_states(
    ports: DataFrame,
    station: str = "port_station_id",
    port: str = "port_id",
    ts: str = "port_last_updated_parsed",
    status: str = "port_status",
    attributes: tuple[str, str, str] = ("port_power_kw", "port_connector_type", "port_charging_mechanism"),
    slice_minutes: int = SLICE_MINUTES,
) -> DataFrame:
    """Every port event with the port's state before and after it.

    A missing status keeps the last known one (``free``), while attributes hold whatever the row says,
    nulls included (``bits``).
    """
    place = ["station", "port", SLICE]
    events = placed(_port_events(ports, station, port, ts, status, attributes, slice_minutes), place[:2])
    edges = events.groupBy(*place).agg(
        F.max_by("free", F.when(F.col("free").isNotNull(), F.col("ts"))).alias("free"),
        F.max_by("bits", "ts").alias("bits"),
    )
    along = Window.partitionBy("station", "port").orderBy(SLICE)
    carry = edges.select(
        *place,
        F.last("free", ignorenulls=True).over(along.rowsBetween(*BEFORE)).alias("_free_in"),
        F.lag("bits").over(along).alias("_bits_in"),
    )
    inside = Window.partitionBy(*place).orderBy("ts")
    known = F.last("free", ignorenulls=True)
    local = events.select(
        *place,
        "ts",
        "bits",
        known.over(inside.rowsBetween(*SO_FAR)).alias("_free"),
        known.over(inside.rowsBetween(*BEFORE)).alias("_free_before"),
        F.lag("bits").over(inside).alias("_bits_before"),
    )
    return local.join(carry, place).select(
        *place,
        "ts",
        F.coalesce("_free", "_free_in").alias("free"),
        "bits",
        F.coalesce("_free_before", "_free_in").alias("free_before"),
        F.coalesce("_bits_before", "_bits_in").alias("bits_before"),
    )


def station_states(
    ports: DataFrame,
    station: str = "port_station_id",
    port: str = "port_id",
    ts: str = "port_last_updated_parsed",
    status: str = "port_status",
    attributes: tuple[str, str, str] = ("port_power_kw", "port_connector_type", "port_charging_mechanism"),
    slice_minutes: int = SLICE_MINUTES,
    attach: DataFrame | None = None,
) -> DataFrame:
    """Counts and flags per (station, instant of change).

    ``total_ports`` is the number of ports that ever report a status, at every instant: a port not yet
    seen counts as unavailable. ``attach`` (one row per ``station``) limits the stations and adds its
    columns.
    """
    states = port_states(ports, station, port, ts, status, attributes, slice_minutes)
    after = _counts(F.col("free"), F.col("bits"))
    before = _counts(F.col("free_before"), F.col("bits_before"))
    # Placed for the running sums already: copies are gone, so there is little to combine before the shuffle.
    changes = (
        states.select("station", SLICE, "ts", *[(after[c] - before[c]).alias(c) for c in COUNTS])
        .repartition("station", SLICE)
        .groupBy("station", SLICE, "ts")
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
    )
    lookup = attach.withColumnRenamed(station, "station") if attach is not None else None
    run = running_sums(changes, ["station"], "ts", COUNTS, lookup)
    # The total is seen_total; naming seen_run too keeps both readers of the changes on the same columns.
    total, avail = F.greatest("seen_total", "seen_run"), F.col("avail_run")
    out = {
        "total_ports": total,
        "available_ports": avail,
        "unavailable_ports": total - avail,
        "unavailable_rate": safe_rate(total - avail, total),
        "total_ac_ports": total - F.col("dc_run"),
        "total_dc_ports": F.col("dc_run"),
        "available_ac_ports": avail - F.col("avail_dc_run"),
        "available_dc_ports": F.col("avail_dc_run"),
        "is_ac_available": avail > F.col("avail_dc_run"),
        "is_dc_available": F.col("avail_dc_run") > 0,
        "has_dc_fast": F.col("dc_run") > 0,
        "has_ccs": F.col("ccs_run") > 0,
        "has_chademo": F.col("chademo_run") > 0,
        "has_type2": F.col("type2_run") > 0,
        "has_wall_outlet": F.col("wall_run") > 0,
    }
    typed = [
        (value if name == "unavailable_rate" else value.cast("int")).alias(name) for name, value in out.items()
    ]
    extra = [c for c in lookup.columns if c != "station"] if lookup is not None else []
    return run.select(F.col("station").alias(station), F.col("ts").alias("snapshot_ts"), *typed, *extra)


def port_totals(
    ports: DataFrame, station: str = "port_station_id", port: str = "port_id", status: str = "port_status"
) -> DataFrame:
    """Ports per station that report a status at least once."""
    reported = F.when(F.col(status).isNotNull(), F.col(port))
    return ports.filter(F.col(station).isNotNull()).groupBy(station).agg(F.countDistinct(reported).alias("total_ports"))


def statuses_over_time(
    ports: DataFrame,
    port_ids: list,
    station: str = "port_station_id",
    port: str = "port_id",
    ts: str = "port_last_updated_parsed",
    status: str = "port_status",
) -> DataFrame:
    """Wide export: per (station, instant) one column per listed port with its last known status.

    The column list is the caller's, so the width is fixed before the job runs.
    """
    rows = ports.withColumn(SLICE, time_slice(F.unix_micros(ts)))
    place = [station, SLICE]
    names = [f"port_{p}" for p in port_ids]
    wide = placed(rows, [station]).groupBy(*place, F.col(ts).alias("snapshot_ts")).agg(
        *[F.max(F.when(F.col(port) == p, F.col(status))).alias(n) for p, n in zip(port_ids, names)]
    )
    edges = wide.groupBy(*place).agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("snapshot_ts"))).alias(n) for n in names]
    )
    along = Window.partitionBy(station).orderBy(SLICE).rowsBetween(*BEFORE)
    carry = edges.select(*place, *[F.last(n, ignorenulls=True).over(along).alias(f"_{n}") for n in names])
    inside = Window.partitionBy(*place).orderBy("snapshot_ts").rowsBetween(*SO_FAR)
    local = wide.select(*place, "snapshot_ts", *[F.last(n, ignorenulls=True).over(inside).alias(n) for n in names])
    filled = [F.coalesce(n, f"_{n}").alias(n) for n in names]
    return local.join(carry, place).select(station, "snapshot_ts", *filled)


def station_lookup(locations: DataFrame, stations: DataFrame) -> DataFrame:
    """One row per station: its own attributes and those of its location's earliest version.

    On a name clash the location wins; a station without a known location keeps null there.
    """
    first_location = first_per_key(locations, ["loc_id"], ["loc_last_updated_parsed"])
    place = first_location.drop(*LEFT_OUT).withColumnRenamed("loc_id", "_loc_id")
    own = [c for c in stations.columns if c not in LEFT_OUT and c not in place.columns]
    # Versions of a station carry no time of their own: the smallest row is the documented choice.
    first_station = first_per_key(stations.select(*[F.col(quoted(c)) for c in own]).filter("st_id is not null"), ["st_id"], [])
    stations_of = first_station.withColumn("_loc_id", F.col("st_location_id"))
    return lookup_join(stations_of, place, ["_loc_id"]).drop("_loc_id")


PORT_COLUMNS = [
    "port_id",
    "port_station_id",
    "port_last_updated",
    "port_status",
    "port_connector_type",
    "port_power_kw",
    "port_charging_mechanism",
    "port_notes",
]


def station_timeseries(
    locations: DataFrame, stations: DataFrame, ports: DataFrame, slice_minutes: int = SLICE_MINUTES
) -> DataFrame:
    """The station series: state at every instant of change with station and location attributes.

    Columns that do not reach the result, the nested lists above all, are dropped before the first
    shuffle. Rows of 2021 and before 1971 are left out only at the end, after they have fed the state.
    """
    needed = locations.drop(*[c for c in LEFT_OUT if c != "loc_last_updated"])
    lookup = station_lookup(clean_locations(needed), stations).withColumnRenamed("st_id", "port_station_id")
    log = clean_ports(ports.select(*[c for c in PORT_COLUMNS if c in ports.columns]))
    states = station_states(log, slice_minutes=slice_minutes, attach=lookup)
    named = states.withColumnRenamed("port_station_id", "st_id")
    kept = (F.year("snapshot_ts") != 2021) & (F.col("snapshot_ts") >= F.lit("1971-01-01").cast("timestamp"))
    return named.filter(kept)

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapgrid.operators import clean, slices, state

T0 = dt.datetime(2024, 1, 1)
SCHEMA = (
    "port_station_id int, port_id int, port_last_updated_parsed timestamp, port_status string, "
    "port_connector_type string, port_power_kw double, port_charging_mechanism string"
)


def log(spark, rows):
    """(station, port, minute, status[, connector[, power[, mechanism]]])."""
    full = [(s, p, T0 + dt.timedelta(minutes=m), *rest, *[None] * (4 - len(rest))) for s, p, m, *rest in rows]
    return spark.createDataFrame(full, SCHEMA)


def series(df, **options):
    got = state.station_states(df, **options).orderBy("port_station_id", "snapshot_ts").collect()
    return [r.asDict() for r in got]


def minutes(row):
    return int((row["snapshot_ts"] - T0).total_seconds() // 60)


def test_unseen_port_counts_as_unavailable(spark):
    got = series(log(spark, [(1, 1, 1, "AVAILABLE"), (1, 2, 5, "AVAILABLE")]))
    assert [(r["total_ports"], r["available_ports"], r["unavailable_ports"], r["unavailable_rate"]) for r in got] == [
        (2, 1, 1, 0.5),
        (2, 2, 0, 0.0),
    ]
    assert [r["total_ac_ports"] for r in got] == [2, 2]


def test_port_without_any_status_is_not_counted(spark):
    got = series(log(spark, [(1, 1, 1, "AVAILABLE"), (1, 2, 2, None), (1, 2, 3, None)]))
    assert [(minutes(r), r["total_ports"], r["available_ports"]) for r in got] == [(1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_missing_status_keeps_the_last_one_but_attributes_do_not(spark):
    got = series(log(spark, [(1, 1, 1, "AVAILABLE", "CHADEMO", 50.0), (1, 1, 2, None, None, None)]))
    assert [(r["available_ports"], r["has_chademo"], r["total_dc_ports"], r["available_dc_ports"]) for r in got] == [
        (1, 1, 1, 1),
        (1, 0, 0, 0),
    ]
    assert [r["available_ac_ports"] for r in got] == [0, 1]


def test_moved_port_is_two_ports(spark):
    got = series(log(spark, [(1, 1, 1, "AVAILABLE"), (2, 1, 5, "AVAILABLE"), (1, 9, 9, "BUSY")]))
    assert [(r["port_station_id"], minutes(r), r["available_ports"]) for r in got] == [(1, 1, 1), (1, 9, 1), (2, 5, 1)]


def naive(rows):
    """The definition, cell by cell: every port of a station at every instant of the station."""
    out = []
    for st in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == st), key=lambda r: r[2])
        ports = sorted({r[1] for r in mine})
        counted = {r[1] for r in mine if r[3] is not None}
        for t in sorted({r[2] for r in mine}):
            avail = dc = avail_dc = 0
            connectors = set()
            for p in ports:
                past = [r for r in mine if r[1] == p and r[2] <= t]
                known = [r for r in past if r[3] is not None]
                free = bool(known) and known[-1][3] == "AVAILABLE"
                last = past[-1] if past else (None,) * 7
                is_dc = (last[5] or 0) > 22 or last[4] in ("CCS_TYPE_2", "CHADEMO") or last[6] == "CABLE"
                connectors.add(last[4])
                avail, dc, avail_dc = avail + free, dc + is_dc, avail_dc + (free and is_dc)
            n = len(counted)
            out.append(
                (st, t, n, avail, n - avail, round((n - avail) / n if n else 0, 2), n - dc, dc, avail - avail_dc, avail_dc)
                + (int(avail > avail_dc), int(avail_dc > 0), int(dc > 0))
                + tuple(int(bool(connectors & s)) for s in ({"CCS_TYPE_2"}, {"CHADEMO"}, {"TYPE_2", "MENNEKES"}, {"WALL_OUTLET"}))
            )
    return out


@pytest.mark.parametrize("slice_minutes", [1, 7, 60, 100_000])
def test_random_logs_match_the_definition(spark, slice_minutes):
    rng = random.Random(slice_minutes)
    rows, used = [], set()
    while len(rows) < 260:
        # Port 1 of station 1 is hot: it has a third of all rows.
        st, port = (1, 1) if rng.random() < 0.35 else (rng.randint(1, 3), rng.randint(1, 5))
        minute = rng.randint(-90, 400)
        if (st, port, minute) in used:
            continue
        used.add((st, port, minute))
        silent = st == 2 and port == 5
        rows.append(
            (
                st,
                port,
                minute,
                None if silent else rng.choice(["AVAILABLE", "AVAILABLE", "BUSY", None]),
                rng.choice(["CCS_TYPE_2", "CHADEMO", "TYPE_2", "MENNEKES", "WALL_OUTLET", None]),
                rng.choice([None, 7.0, 22.0, 50.0]),
                rng.choice(["CABLE", "SOCKET", None]),
            )
        )
    got = [
        (r["port_station_id"], minutes(r), *list(r.values())[2:]) for r in series(log(spark, rows), slice_minutes=slice_minutes)
    ]
    assert got == naive(rows)


def test_as_of_matches_the_definition(spark):
    rng = random.Random(3)
    keys = [1] * 4 + [2, 3]
    events = [(rng.choice(keys), T0 + dt.timedelta(minutes=rng.randint(0, 600)), rng.choice([None, 1, 2, 3])) for _ in range(150)]
    asks = [(rng.choice(keys), T0 + dt.timedelta(minutes=rng.randint(-30, 700))) for _ in range(150)]
    e = spark.createDataFrame(events, "k int, t timestamp, v int")
    a = spark.createDataFrame(asks, "k int, t timestamp")
    got = {(r["k"], r["t"]): r["v"] for r in slices.as_of(a, e, ["k"], "t", ["v"], minutes=20).collect()}
    want = {}
    for k, t in set(asks):
        past = sorted((x for x in events if x[0] == k and x[1] <= t), key=lambda x: (x[1], -1 if x[2] is None else x[2]))
        want[k, t] = past[-1][2] if past else None
    assert got == want


def test_wide_statuses(spark):
    df = log(spark, [(1, 1, 0, "AVAILABLE"), (1, 2, 70, "BUSY"), (1, 1, 140, None), (1, 1, 210, "BUSY")])
    got = state.statuses_over_time(df, [1, 2]).orderBy("snapshot_ts").collect()
    assert [(r["port_1"], r["port_2"]) for r in got] == [
        ("AVAILABLE", None),
        ("AVAILABLE", "BUSY"),
        ("AVAILABLE", "BUSY"),
        ("BUSY", "BUSY"),
    ]


def inputs(spark, ports):
    locations = spark.createDataFrame(
        [
            (10, "2023-01-02T00:00:00Z", "true", "8:30", "later", "S"),
            (10, "2023-01-01T00:00:00Z", "TRUE ", "24:00", "first", "S"),
            (10, None, "false", None, "none", "S"),
        ],
        "loc_id long, loc_last_updated string, loc_onstreet_location string, loc_opening_hours_hour_begin string, "
        "loc_name string, loc_stations string",
    )
    stations = spark.createDataFrame(
        [(1, 10, "label", "x"), (2, 99, "label", "y"), (3, 10, "label", "no ports")],
        "st_id long, st_location_id long, st_label string, st_kind string",
    )
    text = spark.createDataFrame(
        ports, "port_station_id long, port_id long, port_last_updated string, port_status string, port_notes string"
    ).withColumns({c: F.lit(None).cast("string") for c in ("port_connector_type", "port_power_kw", "port_charging_mechanism")})
    return locations, stations, text


def test_station_timeseries(spark):
    tables = inputs(
        spark,
        [
            (1, 1, "2021-12-31T00:00:00Z", "AVAILABLE", None),
            (1, 2, "2022-01-01T00:00:00Z", "BUSY", None),
            (1, 2, "1970-01-02T00:00:00Z", "BUSY", None),
            (1, 3, "2022-01-02T00:00:00Z", "AVAILABLE", "MOTORCYCLE_ONLY"),
            (1, 3, "not a time", "AVAILABLE", None),
            (2, 7, "2022-01-01T00:00:00Z", "AVAILABLE", "OTHER"),
            (8, 8, "2022-01-01T00:00:00Z", "AVAILABLE", None),
        ],
    )
    df = state.station_timeseries(*tables)
    assert "loc_id" not in df.columns and not set(state.LEFT_OUT) & set(df.columns)
    got = {r["st_id"]: r for r in df.collect()}
    assert df.count() == 2 and set(got) == {1, 2}
    first = got[1]
    # The state of 2021 and of 1970 is carried although these rows are gone.
    assert (first["snapshot_ts"], first["available_ports"], first["total_ports"]) == (dt.datetime(2022, 1, 1), 1, 2)
    assert (first["loc_name"], first["loc_onstreet_location"], first["loc_opening_hours_hour_begin"]) == ("first", 1, 1440)
    assert first["st_kind"] == "x" and first["st_location_id"] == 10
    assert got[2]["loc_name"] is None and got[2]["st_location_id"] == 99


def test_clean_ports_without_notes_column(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01T00:00:00Z", "a"), (1, "2024-01-01T00:00:00Z", "b"), (1, None, "c")],
        "port_id int, port_last_updated string, port_status string",
    )
    assert [r["port_status"] for r in clean.clean_ports(df).collect()] == ["b"]


def test_as_of_is_a_left_join(spark):
    events = spark.createDataFrame([(1, T0, 5), (None, T0, 6)], "k int, t timestamp, v int")
    later = T0 + dt.timedelta(minutes=9)
    asks = [(1, later, "a"), (1, later, "a"), (1, later, "b"), (None, later, "c"), (1, None, "d"), (2, later, "e")]
    df = spark.createDataFrame(asks, "k int, t timestamp, w string")
    got = sorted(((r["w"], r["v"]) for r in slices.as_of(df, events, ["k"], "t", ["v"]).collect()), key=str)
    assert got == [("a", 5), ("a", 5), ("b", 5), ("c", None), ("d", None), ("e", None)]

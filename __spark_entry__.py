"""

Every query reads whole tables. ``events`` plays two parts: entity snapshots (``snap``: user = entity)
and a port status log (``port_log``: user = port, ten users = station).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

if str(Path(__file__).resolve().parent) not in sys.path:
    sys.path.insert(0, str(Path(__file__).resolve().parent))

from snapgrid.functions.ports import is_dc_fast
from snapgrid.functions.time import clock_features, floor_to, minutes_of_day, month_label
from snapgrid.functions.values import differs, file_tag, number, round_half_even, truth_flag
from snapgrid.operators import (
    classify,
    clean,
    describe,
    encode,
    gaps,
    grid,
    labels,
    metrics,
    nested,
    profile,
    quality,
    rows,
    slices,
    state,
    studies,
    trees,
)
from snapgrid.plans import ingest, reports
from snapgrid.session import instants, materialize, shared_folder, use_utc
from snapgrid.sources.sinks import rewrite_table, write_counted, write_csv, write_table
from snapgrid.sources.snapshots import read_snapshots
from snapgrid.sources.tables import read_checked, read_csv, read_stage, union_checked

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return run

    return register


# ---------------------------------------------------------------- inputs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return instants(use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet"))


def naive(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps, as the SQL side returns them."""
    zoned = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c) for c in df.columns])


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def bigints(df: DataFrame) -> DataFrame:
    small = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegerType, T.ByteType))}
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in small else F.col(c) for c in df.columns])


def finished(df: DataFrame) -> DataFrame:
    return naive(bigints(rounded(df)))


def snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("st_id"),
        F.col("ts").alias("snapshot_ts"),
        (k % 4).cast("double").alias("available_ports"),
        "value",
        "event_type",
    )


SNAP = """snap AS (
  SELECT user_id AS st_id, ts AS snapshot_ts,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS DOUBLE) AS available_ports,
         value, event_type
  FROM events)"""

# How the port log is derived from events.
CONNECTORS = ["CCS_TYPE_2", "CHADEMO", "TYPE_2", "MENNEKES", "WALL_OUTLET"]


def port_log(spark: SparkSession, sf_dir: str, moved: bool = False) -> DataFrame:
    """The parameter ``k`` gives connector (every sixth: none), mechanism and power; 'error' hides the status.

    ``moved`` puts a fourth of the events each into 1970 and 2021.
    """
    events = table(spark, sf_dir, "events")
    if moved:
        target = F.when(F.col("event_id") % 4 == 0, 1970).when(F.col("event_id") % 4 == 1, 2021)
        years = F.coalesce(target - F.year("ts"), F.lit(0))
        events = events.withColumn("ts", F.col("ts") + F.make_interval(years=years))
    k = F.get_json_object("props", "$.k").cast("int")
    names = F.array(*[F.lit(c) for c in CONNECTORS])
    status = F.when(F.col("event_type") == "view", F.lit("AVAILABLE")).when(
        F.col("event_type") != "error", F.upper("event_type")
    )
    return events.select(
        F.col("user_id").alias("port_id"),
        F.floor(F.col("user_id") / 10).cast("long").alias("port_station_id"),
        F.col("ts").alias("port_last_updated_parsed"),
        status.alias("port_status"),
        F.get(names, k % 6).alias("port_connector_type"),
        F.when(k % 9 == 0, F.lit("CABLE")).otherwise(F.lit("SOCKET")).alias("port_charging_mechanism"),
        (k / F.lit(2.0)).alias("port_power_kw"),
    )


LOG = """raw_log AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
log AS (
  SELECT user_id AS port_id, CAST(floor(user_id / 10) AS BIGINT) AS port_station_id, ts,
         CASE WHEN event_type = 'view' THEN 'AVAILABLE'
              WHEN event_type <> 'error' THEN upper(event_type) END AS port_status,
         CASE k % 6 WHEN 0 THEN 'CCS_TYPE_2' WHEN 1 THEN 'CHADEMO' WHEN 2 THEN 'TYPE_2'
                    WHEN 3 THEN 'MENNEKES' WHEN 4 THEN 'WALL_OUTLET' END AS port_connector_type,
         CASE WHEN k % 9 = 0 THEN 'CABLE' ELSE 'SOCKET' END AS port_charging_mechanism,
         k / CAST(2 AS DOUBLE) AS port_power_kw
  FROM raw_log)"""

STATE = ["available_ports", "value"]
STATIC = ["event_type"]

BUCKETS = (
    SNAP
    + """,
b AS (
  SELECT st_id, time_bucket(INTERVAL '10 minutes', snapshot_ts) AS ts, snapshot_ts, available_ports, value, event_type
  FROM snap
  QUALIFY row_number() OVER (
    PARTITION BY st_id, time_bucket(INTERVAL '10 minutes', snapshot_ts)
    ORDER BY snapshot_ts DESC, available_ports DESC, value DESC, event_type DESC) = 1)"""
)

# The grid as spine + join + fill: a formulation independent of the Spark plan.
GRID = (
    BUCKETS
    + """,
ends AS (SELECT st_id, min(ts) AS lo, max(ts) AS hi FROM b GROUP BY st_id),
spine AS (SELECT st_id, unnest(generate_series(lo, hi, INTERVAL '10 minutes')) AS ts FROM ends),
seen AS (SELECT s.st_id, s.ts, b.ts AS obs_ts, b.available_ports, b.value
         FROM spine s LEFT JOIN b ON b.st_id = s.st_id AND b.ts = s.ts),
filled AS (
  SELECT st_id, ts, obs_ts,
         last_value(available_ports IGNORE NULLS) OVER w AS available_ports,
         last_value(value IGNORE NULLS) OVER w AS value,
         date_diff('minute', last_value(obs_ts IGNORE NULLS) OVER w, ts) AS age
  FROM seen
  WINDOW w AS (PARTITION BY st_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
grid AS (
  SELECT st_id, ts,
         CASE WHEN age <= 30 THEN available_ports END AS available_ports,
         CASE WHEN age <= 30 THEN value END AS value,
         CAST(obs_ts IS NOT NULL AS BIGINT) AS is_observed,
         CAST(age > 30 AS BIGINT) AS is_stale,
         CAST(age AS DOUBLE) AS age_minutes
  FROM filled)"""
)

MODE = """counted AS (SELECT st_id, event_type, count(*) AS n FROM b GROUP BY ALL),
typical AS (SELECT st_id, event_type FROM counted
            QUALIFY row_number() OVER (PARTITION BY st_id ORDER BY n DESC, event_type) = 1)"""


def snap_grid(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    buckets = grid.bucket_latest(snap(spark, sf_dir))
    return grid.dense_grid(buckets, state=STATE, static=STATIC, **options)


# ---------------------------------------------------------------- grid and labels


@query(
    "bucket_latest",
    f"WITH {BUCKETS} SELECT st_id, ts, snapshot_ts, available_ports, value, event_type FROM b",
)
def _bucket_latest(spark, sf_dir):
    return finished(grid.bucket_latest(snap(spark, sf_dir)))


@query(
    "dense_grid",
    f"""WITH {GRID}, {MODE}
SELECT st_id, ts, available_ports, round(value, 6) AS value, event_type, is_observed, is_stale, age_minutes,
       hour, dayofweek,
       round(sin(2 * pi() * hour / 24), 6) + 0.0 AS sin_hour, round(cos(2 * pi() * hour / 24), 6) + 0.0 AS cos_hour,
       round(sin(2 * pi() * dayofweek / 7), 6) + 0.0 AS sin_dow, round(cos(2 * pi() * dayofweek / 7), 6) + 0.0 AS cos_dow
FROM (SELECT g.*, t.event_type,
             CAST(date_part('hour', timezone('Europe/Madrid', timezone('UTC', g.ts))) AS BIGINT) AS hour,
             CAST(date_part('isodow', timezone('Europe/Madrid', timezone('UTC', g.ts))) - 1 AS BIGINT) AS dayofweek
      FROM grid g JOIN typical t ON t.st_id = g.st_id)""",
)
def _dense_grid(spark, sf_dir):
    # Rounded before the expansion; ages are whole minutes.
    buckets = rounded(grid.bucket_latest(snap(spark, sf_dir)))
    cells = naive(bigints(grid.dense_grid(buckets, state=STATE, static=STATIC, clock_digits=6)))
    return cells.withColumns({c: F.col(c) + 0.0 for c in ("sin_hour", "cos_hour", "sin_dow", "cos_dow")})


@query(
    "dense_grid_summary",
    f"""WITH {GRID}
SELECT st_id, count(*) AS grid_rows, CAST(sum(is_observed) AS BIGINT) AS observed,
       CAST(sum(is_stale) AS BIGINT) AS stale, CAST(sum(age_minutes) AS BIGINT) AS total_age,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM grid GROUP BY st_id""",
)
def _dense_grid_summary(spark, sf_dir):
    cells = grid.grid_rows(grid.bucket_latest(snap(spark, sf_dir)), state=STATE)
    return finished(
        cells.groupBy("st_id").agg(
            F.count(F.lit(1)).alias("grid_rows"),
            F.sum("is_observed").alias("observed"),
            F.sum("is_stale").alias("stale"),
            F.sum("age_minutes").cast("long").alias("total_age"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


@query(
    "clock_features",
    """WITH local AS (SELECT event_id, timezone('Europe/Madrid', timezone('UTC', ts)) AS t FROM events),
parts AS (SELECT event_id, CAST(date_part('hour', t) AS BIGINT) AS hour,
                 CAST(date_part('isodow', t) - 1 AS BIGINT) AS dayofweek FROM local)
SELECT event_id, hour, dayofweek,
       round(sin(2 * pi() * hour / 24), 6) AS sin_hour, round(cos(2 * pi() * hour / 24), 6) AS cos_hour,
       round(sin(2 * pi() * dayofweek / 7), 6) AS sin_dow, round(cos(2 * pi() * dayofweek / 7), 6) AS cos_dow
FROM parts""",
)
def _clock_features(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    clock = [v.alias(n) for n, v in clock_features(F.col("ts"), "Europe/Madrid").items()]
    # Adding zero turns -0.0 into 0.0.
    return finished(events.select("event_id", *clock)).select(
        "event_id", "hour", "dayofweek", *[(F.col(c) + 0.0).alias(c) for c in ("sin_hour", "cos_hour", "sin_dow", "cos_dow")]
    )


@query(
    "fixed_floor",
    """SELECT event_id, time_bucket(INTERVAL '10 minutes', ts) AS bucket, date_trunc('day', ts) AS day,
       strftime(ts, '%Y-%m') AS month FROM events""",
)
def _fixed_floor(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return finished(
        events.select(
            "event_id",
            floor_to(F.col("ts"), 10).alias("bucket"),
            F.date_trunc("day", "ts").alias("day"),
            month_label(F.col("ts")).alias("month"),
        )
    )


def _labels_sql(steps: int) -> str:
    return f"""WITH {GRID},
labelled AS (SELECT *, lead(available_ports, {steps}) OVER (PARTITION BY st_id ORDER BY ts) AS available_ports_at_label
             FROM grid)
SELECT st_id, ts, age_minutes, available_ports, available_ports_at_label,
       CAST(available_ports_at_label = 0 AS BIGINT) AS target
FROM labelled
WHERE age_minutes <= 30 AND available_ports IS NOT NULL AND available_ports_at_label IS NOT NULL"""


def labelled(spark: SparkSession, sf_dir: str, horizon: int) -> DataFrame:
    cells = grid.grid_rows(grid.bucket_latest(snap(spark, sf_dir)), state=STATE, fresh_only=True)
    wanted = ["st_id", "ts", "age_minutes", "available_ports", "available_ports_at_label", "target"]
    return labels.horizon_labels(cells, horizon)[0].select(*wanted)


for _h in (10, 20, 30):
    query(f"horizon_labels_{_h}", _labels_sql(_h // 10))(
        lambda spark, sf_dir, h=_h: finished(labelled(spark, sf_dir, h))
    )

_head, _tail = _labels_sql(2).replace("WITH ", "", 1).rsplit("\nSELECT st_id", 1)
HORIZON_20 = f"{_head},\nh AS (SELECT st_id{_tail})"


def _split_sql(cut: str) -> str:
    return f"""WITH {HORIZON_20}, {cut}
SELECT CASE WHEN epoch_us(h.ts) < cut.us THEN 'train' ELSE 'valid' END AS split, count(*) AS "rows",
       CAST(sum(target) AS BIGINT) AS positive, round(avg(CAST(target AS DOUBLE)), 6) AS positive_rate,
       count(DISTINCT st_id) AS n_stations, min(h.ts) AS first_ts, max(h.ts) AS last_ts
FROM h, cut GROUP BY ALL"""


def _split(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    rows_20 = materialize(labelled(spark, sf_dir, 20), "labelled-20")  # read twice: for the cut and for its sides
    sided = labels.label_split(rows_20, labels.split_instant(rows_20, mode=mode))
    return finished(metrics.split_counts(sided))


@query(
    "split_timestamps",
    _split_sql(
        """d AS (SELECT DISTINCT ts FROM h), n AS (SELECT count(*) AS n FROM d),
r AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS i FROM d),
cut AS (SELECT epoch_us(r.ts) AS us FROM r, n
        WHERE r.i = greatest(1, least(CAST(floor(n.n * CAST(0.8 AS DOUBLE)) AS BIGINT), n.n - 1)))"""
    ),
)
def _split_timestamps(spark, sf_dir):
    return _split(spark, sf_dir, "timestamps")


@query(
    "split_rows",
    _split_sql(
        """cut AS (SELECT CAST(floor(quantile_cont(CAST(epoch_us(ts) AS DOUBLE), 0.8)) AS BIGINT) AS us FROM h)"""
    ),
)
def _split_rows(spark, sf_dir):
    return _split(spark, sf_dir, "rows")


# ---------------------------------------------------------------- gaps and coverage

GAPS = f"""WITH {SNAP},
g AS (SELECT st_id, snapshot_ts,
             (epoch_us(snapshot_ts) - lag(epoch_us(snapshot_ts)) OVER w) / CAST(3600000000 AS DOUBLE) AS gap_hours
      FROM snap WINDOW w AS (PARTITION BY st_id ORDER BY snapshot_ts)),
s AS (SELECT *, sum(CASE WHEN gap_hours IS NULL OR gap_hours > 6 THEN 1 ELSE 0 END)
             OVER (PARTITION BY st_id ORDER BY snapshot_ts) AS segment_id FROM g),
len AS (SELECT st_id, segment_id, count(*) AS segment_length FROM s GROUP BY ALL),
per AS (SELECT st_id, count(*) AS "rows" FROM snap GROUP BY st_id)"""


def _describe_sql(source: str, column: str) -> str:
    return f"""{GAPS}
SELECT count({column}) AS count, round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS std,
       round(CAST(min({column}) AS DOUBLE), 6) AS min, round(quantile_cont(CAST({column} AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST({column} AS DOUBLE), 0.75), 6) AS p75,
       round(CAST(max({column}) AS DOUBLE), 6) AS max
FROM {source} WHERE {column} IS NOT NULL"""


@query(
    "gap_stats",
    f"""{GAPS}
SELECT 'n_rows' AS measure, count(*) AS n FROM snap
UNION ALL SELECT 'n_stations', count(DISTINCT st_id) FROM snap
UNION ALL SELECT 'n_segments_ge_10', count(*) FILTER (segment_length >= 10) FROM len
UNION ALL SELECT 'max_segment_len', max(segment_length) FROM len""",
)
def _gap_stats(spark, sf_dir):
    found = gaps.gap_tables(snap(spark, sf_dir), group=None)
    parts = [
        frame.unpivot([], list(frame.columns), "measure", "n") for frame in (found.counts.drop("n_locations"), found.segments)
    ]
    return parts[0].unionByName(parts[1])


@query("gap_hours_describe", _describe_sql("g", "gap_hours"))
def _gap_hours_describe(spark, sf_dir):
    found = gaps.instant_gaps(snap(spark, sf_dir), "st_id", "snapshot_ts")
    return finished(describe.describe(gaps.row_gaps(found), "gap_hours", "n"))


@query("segment_length_describe", _describe_sql("len", "segment_length"))
def _segment_length_describe(spark, sf_dir):
    found = gaps.instant_gaps(snap(spark, sf_dir), "st_id", "snapshot_ts")
    return finished(describe.describe(gaps.segment_lengths(found), "segment_length"))


@query("rows_per_key_describe", _describe_sql("per", '"rows"'))
def _rows_per_key_describe(spark, sf_dir):
    return finished(describe.describe(gaps.rows_per_key(snap(spark, sf_dir), "st_id"), "rows"))


@query("segments", f"{GAPS} SELECT st_id, CAST(segment_id AS BIGINT) AS segment_id, segment_length FROM len")
def _segments(spark, sf_dir):
    lengths = gaps.segment_lengths(gaps.instant_gaps(snap(spark, sf_dir), "st_id", "snapshot_ts"))
    return lengths.withColumnRenamed("key", "st_id")


@query(
    "rows_per_year",
    "SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS timestamps FROM orders GROUP BY ALL",
)
def _rows_per_year(spark, sf_dir):
    return finished(gaps.rows_per_year(table(spark, sf_dir, "orders"), "o_orderdate"))


@query(
    "label_coverage",
    f"""WITH {SNAP},
h AS (SELECT CAST(unnest([5, 10, 15, 30, 60]) AS BIGINT) AS dt),
hit AS (
  SELECT h.dt, s.st_id, s.snapshot_ts,
         EXISTS (SELECT 1 FROM snap o WHERE o.st_id = s.st_id
                 AND epoch_us(o.snapshot_ts) BETWEEN epoch_us(s.snapshot_ts) + (h.dt - 2) * 60000000
                                                 AND epoch_us(s.snapshot_ts) + (h.dt + 2) * 60000000) AS found
  FROM snap s, h)
SELECT CAST(dt AS BIGINT) AS travel_time_min, CAST(2 AS BIGINT) AS tolerance_min,
       count(*) FILTER (found) AS matched_rows, count(*) AS total_rows,
       round(count(*) FILTER (found) / CAST(count(*) AS DOUBLE), 6) AS match_rate
FROM hit GROUP BY dt""",
)
def _label_coverage(spark, sf_dir):
    return finished(gaps.label_coverage(snap(spark, sf_dir)))


@query(
    "daily_records",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL),
spine AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL '1 day')) AS DATE) AS day FROM d)
SELECT spine.day, coalesce(d.n, 0) AS records FROM spine LEFT JOIN d ON d.day = spine.day""",
)
def _daily_records(spark, sf_dir):
    return profile.daily_records(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "occupied_rate",
    f"WITH {SNAP} SELECT round(avg(CAST(available_ports = 0 AS DOUBLE)), 6) AS occupied_rate FROM snap",
)
def _occupied_rate(spark, sf_dir):
    return finished(gaps.occupied_rate(snap(spark, sf_dir)))


# ---------------------------------------------------------------- as-of state

DC = """(coalesce(port_power_kw, 0) > 22 OR coalesce(port_connector_type IN ('CCS_TYPE_2', 'CHADEMO'), false)
         OR coalesce(port_charging_mechanism = 'CABLE', false))"""

# Every instant of a station against every port of it, then two as-of joins: the naive form.
NAIVE_STATE = f"""WITH {LOG},
inst AS (SELECT DISTINCT port_station_id, ts FROM log),
ports AS (SELECT DISTINCT port_station_id, port_id FROM log),
cells AS (SELECT i.port_station_id, i.ts, p.port_id FROM inst i JOIN ports p ON p.port_station_id = i.port_station_id),
att AS (
  SELECT c.*, e.port_connector_type AS connector, coalesce({DC.replace("port_", "e.port_")}, false) AS dc
  FROM cells c ASOF LEFT JOIN log e
    ON e.port_station_id = c.port_station_id AND e.port_id = c.port_id AND c.ts >= e.ts),
known AS (SELECT * FROM log WHERE port_status IS NOT NULL),
full_state AS (
  SELECT a.*, coalesce(k.port_status = 'AVAILABLE', false) AS free
  FROM att a ASOF LEFT JOIN known k
    ON k.port_station_id = a.port_station_id AND k.port_id = a.port_id AND a.ts >= k.ts),
totals AS (SELECT port_station_id, count(DISTINCT port_id) AS total FROM known GROUP BY ALL),
s AS (
  SELECT f.port_station_id, f.ts, any_value(t.total) AS total, count(*) FILTER (free) AS avail,
         count(*) FILTER (dc) AS dc, count(*) FILTER (free AND dc) AS avail_dc,
         coalesce(bool_or(connector = 'CCS_TYPE_2'), false) AS ccs,
         coalesce(bool_or(connector = 'CHADEMO'), false) AS chademo,
         coalesce(bool_or(connector IN ('TYPE_2', 'MENNEKES')), false) AS type2,
         coalesce(bool_or(connector = 'WALL_OUTLET'), false) AS wall
  FROM full_state f JOIN totals t ON t.port_station_id = f.port_station_id GROUP BY ALL)"""


@query(
    "station_state",
    f"""{NAIVE_STATE}
SELECT port_station_id, ts AS snapshot_ts, total AS total_ports, avail AS available_ports,
       total - avail AS unavailable_ports,
       round_even((total - avail) / CAST(total AS DOUBLE), 2) AS unavailable_rate,
       total - dc AS total_ac_ports, dc AS total_dc_ports, avail - avail_dc AS available_ac_ports,
       avail_dc AS available_dc_ports, CAST(avail > avail_dc AS BIGINT) AS is_ac_available,
       CAST(avail_dc > 0 AS BIGINT) AS is_dc_available, CAST(dc > 0 AS BIGINT) AS has_dc_fast,
       CAST(ccs AS BIGINT) AS has_ccs, CAST(chademo AS BIGINT) AS has_chademo, CAST(type2 AS BIGINT) AS has_type2,
       CAST(wall AS BIGINT) AS has_wall_outlet
FROM s""",
)
def _station_state(spark, sf_dir):
    return finished(state.station_states(port_log(spark, sf_dir)))


@query(
    "port_states",
    f"""WITH {LOG},
filled AS (
  SELECT *, last_value(port_status IGNORE NULLS) OVER w AS status
  FROM log WINDOW w AS (PARTITION BY port_station_id, port_id ORDER BY ts
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT port_station_id, port_id, ts, CAST(status = 'AVAILABLE' AS BIGINT) AS free,
       CAST(lag(status) OVER (PARTITION BY port_station_id, port_id ORDER BY ts) = 'AVAILABLE' AS BIGINT) AS free_before
FROM filled""",
)
def _port_states(spark, sf_dir):
    found = state.port_states(port_log(spark, sf_dir)).select(
        F.col("station").alias("port_station_id"), F.col("port").alias("port_id"), "ts", "free", "free_before"
    )
    return finished(found)


@query(
    "as_of_attributes",
    """WITH bought AS (SELECT user_id, ts, value, event_id FROM events WHERE event_type = 'purchase')
SELECT e.user_id, e.ts, b.value, b.event_id FROM events e
ASOF LEFT JOIN bought b ON b.user_id = e.user_id AND e.ts >= b.ts""",
)
def _as_of_attributes(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    bought = events.filter("event_type = 'purchase'")
    return naive(slices.as_of(events.select("user_id", "ts"), bought, ["user_id"], "ts", ["value", "event_id"]))


@query(
    "as_of_repeated",
    """WITH bought AS (SELECT user_id, ts, value, event_id FROM events WHERE event_type = 'purchase'),
asked AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id, date_trunc('day', ts) AS ts, event_type FROM events)
SELECT a.user_id, a.ts, a.event_type, b.value, b.event_id FROM asked a
ASOF LEFT JOIN bought b ON b.user_id = a.user_id AND a.ts >= b.ts""",
)
def _as_of_repeated(spark, sf_dir):
    """Instants that repeat, and rows without a key: a left join keeps them all."""
    events = table(spark, sf_dir, "events")
    asked = events.select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.date_trunc("day", "ts").alias("ts"),
        "event_type",
    )
    bought = events.filter("event_type = 'purchase'").select("user_id", "ts", "value", "event_id")
    return naive(slices.as_of(asked, bought, ["user_id"], "ts", ["value", "event_id"]))


@query(
    "port_totals",
    f"""WITH {LOG} SELECT port_station_id, count(DISTINCT port_id) FILTER (port_status IS NOT NULL) AS total_ports
FROM log GROUP BY ALL""",
)
def _port_totals(spark, sf_dir):
    return state.port_totals(port_log(spark, sf_dir))


SLOTS = list(range(10))


@query(
    "status_wide",
    f"""WITH {LOG},
wide AS (SELECT port_station_id, ts,
                {", ".join(f"max(port_status) FILTER (port_id % 10 = {i}) AS p{i}" for i in SLOTS)}
         FROM log GROUP BY ALL)
SELECT port_station_id, ts AS snapshot_ts,
       {", ".join(f"last_value(p{i} IGNORE NULLS) OVER w AS port_{i}" for i in SLOTS)}
FROM wide WINDOW w AS (PARTITION BY port_station_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _status_wide(spark, sf_dir):
    """All ports: a station has ten, one column per place in the station."""
    log = port_log(spark, sf_dir)
    return finished(state.statuses_over_time(log.withColumn("port_id", F.col("port_id") % 10), SLOTS))


@query("dc_flag", f"WITH {LOG} SELECT port_id, ts, CAST({DC} AS BIGINT) AS is_dc FROM log")
def _dc_flag(spark, sf_dir):
    log = port_log(spark, sf_dir)
    dc = is_dc_fast(F.col("port_power_kw"), F.col("port_connector_type"), F.col("port_charging_mechanism"))
    return finished(log.select("port_id", F.col("port_last_updated_parsed").alias("ts"), dc.cast("int").alias("is_dc")))


# The whole station series: suppliers play the stations, nations their locations.
SERIES_DIMS = """dims AS (
  SELECT s_suppkey AS st_id, CAST(s_nationkey AS BIGINT) AS st_location_id, s_name AS st_label, n_name AS loc_name,
         CAST(n_regionkey AS BIGINT) AS loc_region
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey)"""


def _series_sql(state_sql: str, dims: str, where: str = "") -> str:
    return state_sql + f""", {dims}
SELECT d.st_id, s.ts AS snapshot_ts, s.total AS total_ports, s.avail AS available_ports,
       total - avail AS unavailable_ports,
       round_even((total - avail) / CAST(total AS DOUBLE), 2) AS unavailable_rate,
       total - dc AS total_ac_ports, dc AS total_dc_ports, avail - avail_dc AS available_ac_ports,
       avail_dc AS available_dc_ports, CAST(avail > avail_dc AS BIGINT) AS is_ac_available,
       CAST(avail_dc > 0 AS BIGINT) AS is_dc_available, CAST(dc > 0 AS BIGINT) AS has_dc_fast,
       CAST(ccs AS BIGINT) AS has_ccs, CAST(chademo AS BIGINT) AS has_chademo, CAST(type2 AS BIGINT) AS has_type2,
       CAST(wall AS BIGINT) AS has_wall_outlet,
       d.st_location_id, d.loc_name, d.loc_region
FROM s JOIN dims d ON d.st_id = s.port_station_id {where}"""


def _series(spark, sf_dir, stations: DataFrame, log: DataFrame) -> DataFrame:
    locations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("loc_id"),
        F.lit("2020-01-01T00:00:00Z").alias("loc_last_updated"),
        F.col("n_name").alias("loc_name"),
        F.col("n_regionkey").cast("long").alias("loc_region"),
    )
    ports = log.withColumn("port_last_updated", F.date_format("port_last_updated_parsed", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    return finished(state.station_timeseries(locations, stations, ports.drop("port_last_updated_parsed")))


def _stations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("st_id"),
        F.col("s_nationkey").cast("long").alias("st_location_id"),
        F.col("s_name").alias("st_label"),
    )


@query("station_timeseries", _series_sql(NAIVE_STATE, SERIES_DIMS))
def _station_timeseries(spark, sf_dir):
    return _series(spark, sf_dir, _stations(spark, sf_dir), port_log(spark, sf_dir))


# Some events move to 1970 and to 2021, some stations get a second version.
SHIFTED = """(SELECT * REPLACE (CASE WHEN event_id % 4 = 0 THEN ts + to_years(CAST(1970 - year(ts) AS INTEGER))
                                WHEN event_id % 4 = 1 THEN ts + to_years(CAST(2021 - year(ts) AS INTEGER)) ELSE ts END AS ts)
   FROM events)"""
VERSION_DIMS = """versions AS (
  SELECT s_suppkey AS st_id, CAST(s_nationkey AS BIGINT) AS st_location_id, s_name AS st_label FROM supplier
  UNION ALL SELECT s_suppkey, CAST(24 - s_nationkey AS BIGINT), s_name || ' new' FROM supplier WHERE s_suppkey % 3 = 0),
first AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY st_id ORDER BY st_location_id, st_label) = 1),
dims AS (SELECT st_id, st_location_id, st_label, n_name AS loc_name, CAST(n_regionkey AS BIGINT) AS loc_region
         FROM first LEFT JOIN nation ON n_nationkey = st_location_id)"""


@query(
    "station_timeseries_years",
    _series_sql(
        NAIVE_STATE.replace("FROM events)", f"FROM {SHIFTED})", 1),
        VERSION_DIMS,
        "WHERE year(s.ts) <> 2021 AND s.ts >= TIMESTAMP '1971-01-01'",
    ),
)
def _station_timeseries_years(spark, sf_dir):
    """Rows of 2021 and before 1971 feed the state and are left out of the series."""
    log = port_log(spark, sf_dir, moved=True)
    stations = _stations(spark, sf_dir)
    newer = stations.filter("st_id % 3 = 0").select(
        "st_id", (24 - F.col("st_location_id")).alias("st_location_id"), F.concat("st_label", F.lit(" new")).alias("st_label")
    )
    return _series(spark, sf_dir, stations.unionByName(newer), log)


# ---------------------------------------------------------------- rows, filters, joins


@query(
    "dedup_latest",
    """SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                           ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1""",
)
def _dedup_latest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return finished(rows.latest_per_key(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate"]))


@query(
    "first_per_key",
    """SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber FROM
  (SELECT l_suppkey, nullif(l_shipdate, TIMESTAMP '1995-01-01') AS l_shipdate, l_orderkey,
          CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate ASC NULLS LAST, l_orderkey, l_linenumber) = 1""",
)
def _first_per_key(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        F.nullif("l_shipdate", F.lit("1995-01-01 00:00:00").cast("timestamp")).alias("l_shipdate"),
    )
    return finished(rows.first_per_key(items, ["l_suppkey"], ["l_shipdate"]))


@query(
    "first_copies",
    'SELECT o_custkey, o_orderstatus, min(o_orderkey) AS "place", date_trunc(\'year\', o_orderdate) AS "year" FROM orders GROUP BY ALL',
)
def _first_copies(spark, sf_dir):
    """One of each set of equal rows, numbered by the first of them; the number itself is not compared."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", F.col("o_orderkey").alias("place"), F.date_trunc("year", "o_orderdate").alias("year")
    )
    return naive(rows.first_copies(orders, "place"))


@query("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def _distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_type").distinct()


@query(
    "dup_report",
    """WITH t AS (SELECT l_suppkey, l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(DISTINCT l_suppkey) AS distinct_ids,
       CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM t""",
)
def _dup_report(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber")
    return rows.duplicate_report(items, "l_suppkey")


@query(
    "duplicate_rows",
    """SELECT lang, source, n_chars, count(*) - 1 AS extra_copies FROM documents GROUP BY text, lang, source, n_chars
HAVING count(*) > 1""",
)
def _duplicate_rows(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("text", "lang", "source", "n_chars")
    return rows.duplicate_rows(documents).drop("text")


@query(
    "null_safe_filter",
    """SELECT event_id, nullif(event_type, 'error') AS note FROM events
WHERE nullif(event_type, 'error') IS DISTINCT FROM 'click'""",
)
def _null_safe_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("note"))
    return events.filter(differs(F.col("note"), "click"))


@query(
    "clean_locations",
    """WITH t AS (
  SELECT o_custkey AS loc_id, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%dT%H:%M:%SZ') AS loc_last_updated,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS loc_onstreet_location,
         CASE WHEN o_orderkey % 29 < 24 THEN (o_orderkey % 29) * 60 + o_orderkey % 60
              WHEN o_orderkey % 29 = 24 AND o_orderkey % 60 = 0 THEN 1440 END AS loc_opening_hours_hour_begin,
         date_trunc('quarter', o_orderdate) AS loc_last_updated_parsed, o_orderkey
  FROM orders)
SELECT loc_id, loc_last_updated, CAST(loc_onstreet_location AS BIGINT) AS loc_onstreet_location,
       CAST(loc_opening_hours_hour_begin AS BIGINT) AS loc_opening_hours_hour_begin, loc_last_updated_parsed
FROM t QUALIFY row_number() OVER (PARTITION BY loc_id, loc_last_updated
  ORDER BY o_orderkey % 7919 DESC, o_orderkey DESC) = 1""",
)
def _clean_locations(spark, sf_dir):
    """Versions written as files in an order of their own: of several rows of one version the last in file order stays."""
    hour, minute = F.col("o_orderkey") % 29, F.col("o_orderkey") % 60
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("loc_id"),
        F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("loc_last_updated"),
        F.when(F.col("o_orderstatus") == "F", F.lit(" True ")).when(F.col("o_orderstatus") == "O", F.lit("no")).alias("loc_onstreet_location"),
        F.format_string("%d:%02d", hour, minute).alias("loc_opening_hours_hour_begin"),
        (F.col("o_orderkey") % 7919).alias("turn"),
        "o_orderkey",
    )
    path = f"{shared_folder(spark).rstrip('/')}/versions-{uuid.uuid4().hex}"
    write_csv(raw, path, ["turn", "o_orderkey"])
    read = read_checked(spark, [path], raw.columns, place="loc_place").drop("turn", "o_orderkey")
    return finished(clean.clean_locations(read.withColumn("loc_id", F.col("loc_id").cast("long"))))


@query(
    "clean_ports",
    """WITH t AS (
  SELECT user_id AS port_id, ts, nullif(event_type, 'error') AS port_notes, value FROM events
  WHERE event_type <> 'signup')
SELECT port_id, ts AS port_last_updated_parsed, port_notes, value FROM t WHERE port_notes IS DISTINCT FROM 'click'""",
)
def _clean_ports(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    raw = events.select(
        F.col("user_id").alias("port_id"),
        F.when(F.col("event_type") == "signup", F.lit("unknown")).otherwise(text).alias("port_last_updated"),
        F.nullif("event_type", F.lit("error")).alias("port_notes"),
        "value",
    )
    return naive(clean.clean_ports(raw, excluded_note="click").drop("port_last_updated"))


@query(
    "clean_ports_versions",
    """WITH t AS (
  SELECT user_id AS port_id, date_trunc('day', ts) AS upd, nullif(event_type, 'error') AS port_notes, value FROM events),
v AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY port_id, upd
        ORDER BY port_notes DESC NULLS LAST, value DESC NULLS LAST) = 1)
SELECT port_id, upd AS port_last_updated_parsed, port_notes, value FROM v WHERE port_notes IS DISTINCT FROM 'view'""",
)
def _clean_ports_versions(spark, sf_dir):
    """Several rows of one port and time: the greatest stays, and only then the note filter applies."""
    raw = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("port_id"),
        F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("port_last_updated"),
        F.nullif("event_type", F.lit("error")).alias("port_notes"),
        "value",
    )
    return naive(clean.clean_ports(raw, excluded_note="view").drop("port_last_updated"))


@query(
    "opening_minutes",
    """WITH t AS (SELECT o_orderkey, o_orderkey % 29 AS h, o_orderkey % 67 AS m FROM orders)
SELECT o_orderkey, CAST(CASE WHEN h < 24 AND m < 60 THEN h * 60 + m WHEN h = 24 AND m = 0 THEN 1440 END AS BIGINT)
  AS minutes FROM t""",
)
def _opening_minutes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = F.format_string("%d:%02d", F.col("o_orderkey") % 29, F.col("o_orderkey") % 67)
    return finished(orders.select("o_orderkey", minutes_of_day(text).alias("minutes")))


@query(
    "scalar_values",
    """SELECT p_partkey, CAST(p_type = 'ECONOMY' AS BIGINT) AS flag, CAST(p_size AS DOUBLE) AS size,
       round_even(p_size / CAST(40 AS DOUBLE), 2) AS share, CAST(NULL AS DOUBLE) AS bad
FROM part""",
)
def _scalar_values(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    flag = truth_flag(F.when(F.col("p_type") == "ECONOMY", F.lit(" TRUE")).otherwise(F.col("p_type")))
    return part.select(
        "p_partkey",
        flag.cast("long").alias("flag"),
        number(F.col("p_size").cast("string")).alias("size"),
        round_half_even(F.col("p_size") / 40.0).alias("share"),
        number(F.col("p_name")).alias("bad"),
    )


@query(
    "station_dim_join",
    """SELECT s_suppkey, s_name, n_name, r_name FROM supplier
LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def _station_dim_join(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    suppliers = rows.lookup_join(table(spark, sf_dir, "supplier"), nation, ["s_nationkey"])
    return rows.lookup_join(suppliers, region, ["n_regionkey"]).select("s_suppkey", "s_name", "n_name", "r_name")


@query(
    "left_join_default",
    """SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL) ON o_custkey = c_custkey""",
)
def _left_join_default(spark, sf_dir):
    counts = gaps.rows_per_key(table(spark, sf_dir, "orders"), "o_custkey").withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return customers.join(counts, "c_custkey", "left").select("c_custkey", F.coalesce("rows", F.lit(0)).alias("n_orders"))


@query(
    "union_checked",
    "SELECT o_orderkey, o_custkey, o_orderdate, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders",
)
def _union_checked(spark, sf_dir):
    """Two inputs with different column order; together they are the whole table."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate").cast("long"))
    early = orders.filter("year < 1998").select("o_orderkey", "o_custkey", "o_orderdate", "year")
    late = orders.filter("year >= 1998").select("year", "o_orderdate", "o_custkey", "o_orderkey")
    return finished(union_checked([early, late]))


@query(
    "csv_stage",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       '{"a,b": "' || o_orderstatus || '"}' AS note FROM orders""",
)
def _csv_stage(spark, sf_dir):
    """The whole table written as CSV (with JSON cells), read back with the column check and cast."""
    orders = table(spark, sf_dir, "orders")
    note = F.concat(F.lit('{"a,b": "'), F.col("o_orderstatus"), F.lit('"}'))
    path = f"{shared_folder(spark).rstrip('/')}/orders-{uuid.uuid4().hex}"
    write_csv(orders.withColumn("note", note), path)
    text = read_checked(spark, [path], [*orders.columns, "note"])
    types = {f.name: f.dataType for f in orders.schema.fields}
    return naive(text.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else c for c in text.columns]))


@query(
    "stage_from_csv",
    """SELECT o_orderkey, o_orderdate AS updated, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders
WHERE o_orderstatus <> 'P'""",
)
def _stage_from_csv(spark, sf_dir):
    """A stage that exists as CSV only: typed by its values, two columns and the time, rows without a valid time dropped."""
    orders = table(spark, sf_dir, "orders")
    path = f"{shared_folder(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    updated = F.when(F.col("o_orderstatus") == "P", F.lit("none")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    write_csv(orders.withColumn("updated", updated), f"{path}.csv")
    read = read_stage(spark, path, ["o_orderkey", "updated", "o_totalprice"], ts="updated")
    return finished(read)


@query("written_counts", 'SELECT count(*) AS "rows", count(DISTINCT l_suppkey) AS keys FROM lineitem')
def _written_counts(spark, sf_dir):
    """Rows and keys of a stage as its sink counts them while it writes, after a round of table maintenance."""
    folder = f"{shared_folder(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    counted = write_counted(table(spark, sf_dir, "lineitem"), f"{folder}/a", "l_suppkey")
    changed = rewrite_table(spark, f"{folder}/a", f"{folder}/b", lambda df: rows.replace_column(df.withColumn("kept", F.col("l_suppkey")), "l_suppkey", "kept"))
    again = changed.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("l_suppkey").alias("keys"))
    return again.filter((F.col("rows") == counted[0]) & (F.col("keys") == counted[1]))


@query(
    "renamed_columns",
    """SELECT o_orderkey AS "o_orderkey", o_custkey AS "o_custkey", upper(o_orderstatus) || '!' AS "o_orderstatus",
       CAST(o_orderkey % 7 AS BIGINT) AS "o_week", '2024_' || o_orderkey % 5 AS "o_tag" FROM orders""",
)
def _renamed_columns(spark, sf_dir):
    """Prefixes for columns that have none yet, one column put in the place of another, tags from file names."""
    name = F.concat(F.lit("2024_"), (F.col("o_orderkey") % 5).cast("string"), F.lit("_locations.v1.csv"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_orderkey") % 7).cast("long").alias("week"), file_tag(name).alias("tag"),
        F.concat(F.upper("o_orderstatus"), F.lit("!")).alias("marked"),
    )
    return rows.prefix_columns(rows.replace_column(orders, "o_orderstatus", "marked"), "o_", keep_prefixed=True)


@query(
    "gap_report",
    f"""WITH {SNAP},
h AS (SELECT CAST(unnest([10, 30]) AS BIGINT) AS dt),
hit AS (
  SELECT h.dt, s.st_id, s.snapshot_ts,
         EXISTS (SELECT 1 FROM snap o WHERE o.st_id = s.st_id
                 AND epoch_us(o.snapshot_ts) BETWEEN epoch_us(s.snapshot_ts) + (h.dt - 3) * 60000000
                                                 AND epoch_us(s.snapshot_ts) + (h.dt + 3) * 60000000) AS found
  FROM snap s, h)
SELECT CAST(dt AS BIGINT) AS travel_time_min, CAST(3 AS BIGINT) AS tolerance_min,
       count(*) FILTER (found) AS matched_rows, count(*) AS total_rows,
       round(count(*) FILTER (found) / CAST(count(*) AS DOUBLE), 6) AS match_rate
FROM hit GROUP BY dt""",
)
def _gap_report(spark, sf_dir):
    """The report job over a written stage, its options as text, and the coverage table it exports, read back."""
    folder = f"{shared_folder(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    write_table(snap(spark, sf_dir), f"{folder}/stage")
    reports.gap_report(spark, f"{folder}/stage", label_times_min="10, 30", label_tolerance_min=3, output_csv=f"{folder}/coverage")
    kinds = {"match_rate": "double"}
    back = read_csv(spark, f"{folder}/coverage")
    return rounded(back.select(*[F.col(c).cast(kinds.get(c, "long")).alias(c) for c in back.columns]))


@query(
    "profile_report",
    """SELECT 'nulls' AS "table", 'o_orderstatus' AS "column", CAST(NULL AS VARCHAR) AS "value", count(*) FILTER (o_orderstatus = 'P') AS n FROM orders
UNION ALL SELECT 'nulls', 'o_orderpriority', NULL, 0
UNION ALL SELECT 'shape', 'n_rows', NULL, count(*) FROM orders UNION ALL SELECT 'shape', 'n_columns', NULL, 2
UNION ALL SELECT 'values', 'o_orderstatus', coalesce(nullif(o_orderstatus, 'P'), '<NA>'), count(*) FROM orders GROUP BY ALL
UNION ALL SELECT 'values', 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL""",
)
def _profile_report(spark, sf_dir):
    """A stage's profile exported as CSV tables and read back as one."""
    orders = table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_orderpriority")
    folder = f"{shared_folder(spark).rstrip('/')}/profile-{uuid.uuid4().hex}"
    found = reports.table_profile(orders)
    shape = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in ("n_rows", "n_columns")]))
    none, value = F.lit(None).cast("string").alias("value"), F.col("value")
    told = {
        "nulls": found["nulls"].select("column", none, F.col("nulls").alias("n")),
        "shape": found["shape"].select(shape).select("column", none, "n"),
        "values": found["values"].select("column", value, F.col("count").alias("n")),
    }
    paths = reports.export_tables(told, folder)
    read = [read_csv(spark, path).select(F.lit(name).alias("table"), "column", "value", F.col("n").cast("long").alias("n")) for name, path in paths.items()]
    return union_checked(read)


@query(
    "daily_coverage",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL),
spine AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL '1 day')) AS DATE) AS day FROM d)
SELECT spine.day, coalesce(d.n, 0) AS records FROM spine LEFT JOIN d ON d.day = spine.day""",
)
def _daily_coverage(spark, sf_dir):
    """The same counts from a written stage, whose time column is text there."""
    path = f"{shared_folder(spark).rstrip('/')}/daily-{uuid.uuid4().hex}"
    write_table(table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at")), path)
    return reports.daily_coverage(spark, path, "at")


@query(
    "metric_gate",
    """WITH s AS (SELECT doc_id % 8 AS part, quality AS y, (doc_id * 37 + quality * 23) % 101 / CAST(101 AS DOUBLE) AS p FROM labels),
m AS (SELECT part, CASE WHEN part <> 3 THEN part * 10 END AS horizon, avg((p - y) * (p - y)) AS brier,
  avg(-(y * ln(greatest(p, 2.220446049250313e-16)) + (1 - y) * ln(1 - p))) AS logloss,
  CASE WHEN part > 0 THEN part / CAST(8 AS DOUBLE) END AS auc FROM s GROUP BY part)
SELECT 'horizons present' AS "rule", count(*) FILTER (horizon IS NULL) AS violations FROM m
UNION ALL SELECT 'auc', count(*) FILTER (auc < 0.5) FROM m
UNION ALL SELECT 'logloss', count(*) FILTER (NOT logloss <= 1.5) FROM m
UNION ALL SELECT 'brier', count(*) FILTER (NOT brier BETWEEN 0 AND 1) FROM m
UNION ALL SELECT 'not empty', CAST(count(*) = 0 AS BIGINT) FROM m""",
)
def _metric_gate(spark, sf_dir):
    """The quality limits over metrics records of eight parts: one without a horizon, some with a low AUC, one with none."""
    score = ((F.col("doc_id") * 37 + F.col("quality") * 23) % 101) / F.lit(101.0)
    part = (F.col("doc_id") % 8).alias("part")
    labels_ = table(spark, sf_dir, "labels").select(part, F.col("quality").alias("y"), score.alias("p"))
    loss = -(F.col("y") * F.log(F.greatest("p", F.lit(metrics.CLIP))) + (1 - F.col("y")) * F.log(1 - F.col("p")))
    records = labels_.groupBy("part").agg(F.avg((F.col("p") - F.col("y")) ** 2).alias("brier"), F.avg(loss).alias("logloss"))
    horizon = F.when(F.col("part") != 3, F.col("part") * 10)
    auc = F.when(F.col("part") > 0, F.col("part") / F.lit(8.0)).alias("auc")
    gated = records.select(
        horizon.alias("requested_horizon_minutes"), horizon.alias("effective_horizon_minutes"), auc, "logloss", "brier"
    )
    return quality.metric_gate(gated)


@query(
    "export_sorted",
    """SELECT row_number() OVER (ORDER BY nullif(o_orderpriority, '5-LOW') DESC NULLS LAST, o_totalprice, o_orderkey) AS place, o_orderkey
FROM orders""",
)
def _export_sorted(spark, sf_dir):
    """The order of an export, descending and ascending keys mixed, as it stands in the written files."""
    orders = table(spark, sf_dir, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    path = f"{shared_folder(spark).rstrip('/')}/sorted-{uuid.uuid4().hex}"
    write_csv(orders.select("o_orderkey", "priority", "o_totalprice"), path, ["-priority", "o_totalprice", "o_orderkey"])
    return written_order(spark, path).select("place", F.col("o_orderkey").cast("long").alias("o_orderkey"))


def written_order(spark: SparkSession, path: str) -> DataFrame:
    """The lines of written CSV files with their ``place`` from 1. Files are in order, and so are the blocks and lines of each.

    A task reads a block in order, so its lines have numbers in a row; only the list of blocks is sorted and summed up.
    """
    scan = spark.read.option("header", True).csv(path)
    block = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = materialize(scan.select("*", *block, F.monotonically_increasing_id().alias("line")), "lines")
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("line").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file", "block").rowsBetween(*slices.BEFORE)), F.lit(0))
    starts = blocks.select("file", "block", (before - F.col("first") + 1).alias("start"))
    # One row for each block of a file.
    found = lines.join(F.broadcast(starts), ["file", "block"])
    return found.select(*scan.columns, (F.col("start") + F.col("line")).alias("place"))


# ---------------------------------------------------------------- nested data

#: Rows that one document holds at most, if these are dealt evenly. The number of documents grows with the rows.
DOCUMENT_ROWS = 500_000


def document_part(rows: int) -> Column:
    """The part of its group that a row's document holds, dealt by the row's place, so that copies spread too."""
    return F.pmod(F.monotonically_increasing_id(), F.lit(1 + rows // DOCUMENT_ROWS))


@query(
    "json_flatten",
    """SELECT event_id, user_id, ts AS when_ts, event_type AS what_kind, value AS what_value,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS what_props_k FROM events""",
)
def _json_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    props = F.from_json("props", "struct<k:bigint>")
    doc = events.select(
        F.struct(F.col("ts")).alias("when"),
        F.struct(F.col("event_type").alias("kind"), "value", props.alias("props")).alias("what"),
        "event_id",
        "user_id",
    )
    return naive(nested.flatten(doc))


@query(
    "json_mixed_shapes",
    """SELECT c_custkey AS id, c_name AS label, CAST(c_nationkey AS BIGINT) AS address_nation, CAST(c_acctbal AS DOUBLE) AS address_balance,
       CAST(NULL AS VARCHAR) AS phones, CAST(NULL AS VARCHAR) AS region, 'customers' AS shape FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, '["' || s_suppkey || '","x"]', NULL, 'suppliers' FROM supplier
UNION ALL SELECT n_nationkey, n_name, NULL, NULL, NULL, 'region ' || n_regionkey, 'nations' FROM nation""",
)
def _json_mixed_shapes(spark, sf_dir):
    """Documents of all shapes, written as files: envelopes of customers, lists of suppliers, one nation in each.

    Only suppliers have phones, only nations (lone records) a region; the envelope's own fields are no columns. With more
    rows there are more documents, not larger ones.
    """
    customer, supplier, nation = (table(spark, sf_dir, name) for name in ("customer", "supplier", "nation"))
    of_customer = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("label"), F.lit("customers").alias("shape"),
        F.struct(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").cast("double").alias("balance")).alias("address"),
    )
    phones = F.array(F.col("s_suppkey").cast("string"), F.lit("x")).alias("phones")
    address = F.struct(F.col("s_nationkey").alias("nation")).alias("address")
    of_supplier = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"), F.lit("suppliers").alias("shape"), address, phones)
    of_nation = F.struct(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("label"), F.lit("nations").alias("shape"),
        F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("region"),
    )
    customer, supplier = (df.withColumn("part", document_part(df.count())) for df in (customer, supplier))
    enveloped = customer.groupBy("c_nationkey", "part").agg(F.collect_list(of_customer).alias("locations"))
    documents = [
        enveloped.select(F.to_json(F.struct("locations", F.lit("now").alias("exported"))).alias("value")),
        supplier.groupBy("s_nationkey", "part").agg(F.to_json(F.collect_list(of_supplier)).alias("value")).select("value"),
        nation.select(F.to_json(of_nation).alias("value")),
    ]
    path = f"{shared_folder(spark).rstrip('/')}/documents-{uuid.uuid4().hex}"
    for group in documents:
        group.write.mode("append").option("maxRecordsPerFile", 1).text(path)
    flat = nested.flatten(read_snapshots(spark, path, pattern="*.txt"))
    return flat.select("id", "label", "address_nation", "address_balance", "phones", "region", "shape")


@query(
    "snapshot_chain",
    """SELECT l_orderkey * 10 + l_linenumber AS port_id, CASE WHEN l_returnflag = 'R' THEN 'RATED' END AS port_connector_type,
  CAST(l_quantity AS DOUBLE) AS port_power_kw, 'S' || l_linestatus AS port_status, l_linenumber % 2 = 0 AS port_payment_required,
  o_orderkey AS port_station_id, CAST(o_custkey AS BIGINT) AS port_station_location_id,
  CAST(c_nationkey AS VARCHAR) AS loc_address_postal_code, lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0') || ':00' AS loc_opening_hours_hour_begin,
  CASE WHEN c_custkey % 3 = 2 THEN 'only here ' || c_custkey END AS loc_remark
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
)
def _snapshot_chain(spark, sf_dir):
    """Nested documents to locations, stations and ports: customers hold orders, orders hold line items.

    Each nation's customers are documents of three kinds: envelopes, lists, and lists whose records have a field of their
    own. With more line items there are more documents, not larger ones.
    """
    items = table(spark, sf_dir, "lineitem")
    lines = items.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.struct(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.when(F.col("l_returnflag") == "R", F.lit("RATED")).alias("connector_type"),
            F.col("l_quantity").cast("double").alias("power_kw"),
            F.array(F.struct(F.concat(F.lit("S"), F.col("l_linestatus")).alias("status"))).alias("port_status"),
            F.struct((F.col("l_linenumber") % 2 == 0).alias("payment_required")).alias("authentications"),
        ).alias("port"),
    )
    ports = lines.groupBy("o_orderkey").agg(F.collect_list("port").alias("ports"))
    orders = table(spark, sf_dir, "orders").join(ports, "o_orderkey")
    station = F.struct(F.col("o_orderkey").alias("id"), F.lit("s").alias("label"), "ports")
    stations = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list(station).alias("stations"))
    kind = F.col("c_custkey") % 3
    hours = F.array(F.struct(F.concat(F.lpad((F.col("c_custkey") % 24).cast("string"), 2, "0"), F.lit(":00")).alias("hour_begin")))
    record = F.struct(
        F.col("c_custkey").alias("id"),
        F.lit("2024-01-01T00:00:00Z").alias("last_updated"),
        F.struct(F.col("c_nationkey").cast("string").alias("postal_code")).alias("address"),
        F.when(kind == 2, F.concat(F.lit("only here "), F.col("c_custkey").cast("string"))).alias("remark"),
        hours.alias("opening_hours"),
        "stations",
    )
    customer = table(spark, sf_dir, "customer").withColumn("part", document_part(items.count()))
    found = customer.join(stations, "c_custkey").groupBy("c_nationkey", kind.alias("kind"), "part")
    text = F.to_json("records")
    shaped = F.when(F.col("kind") == 0, F.concat(F.lit('{"locations":'), text, F.lit(',"made":"now"}'))).otherwise(text)
    path = f"{shared_folder(spark).rstrip('/')}/chain-{uuid.uuid4().hex}"
    found.agg(F.collect_list(record).alias("records")).select(shaped.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    locations = materialize(ingest.locations_from_snapshots(spark, path, pattern="*.txt"), "chain-locations")
    unnested = ingest.extract_ports(ingest.extract_stations(locations))
    versions = locations.select(
        F.col("loc_id").alias("port_station_location_id"), "loc_address_postal_code", "loc_opening_hours_hour_begin", "loc_remark"
    )
    return rows.lookup_join(unnested, versions, ["port_station_location_id"], "inner").select(
        "port_id", "port_connector_type", "port_power_kw", "port_status", "port_payment_required", "port_station_id",
        "port_station_location_id", "loc_address_postal_code", "loc_opening_hours_hour_begin", "loc_remark",
    )


CHILD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("port_status", T.ArrayType(T.StructType([T.StructField("status", T.StringType())]))),
        T.StructField("address", T.StructType([T.StructField("code", T.LongType())])),
    ]
)


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a JSON list: an object, a number (no child), and a second object."""
    text = F.concat(
        F.lit('[{"id": '), F.col("event_id"), F.lit(', "kind": "'), F.col("event_type"),
        F.lit('", "coordinates": {"x": 1}, "port_status": [{"status": "A'), F.col("user_id"),
        F.lit('"}, {"status": "Z"}], "address": '), F.col("props"), F.lit('}, 7, {"id": '),
        -F.col("event_id"), F.lit(', "port_status": []}]'),
    )
    return table(spark, sf_dir, "events").select("user_id", text.alias("children"))


@query(
    "json_unnest",
    """SELECT event_id AS id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS address_k,
       'A' || user_id AS status, user_id FROM events
UNION ALL SELECT -event_id, NULL, NULL, NULL, user_id FROM events""",
)
def _json_unnest(spark, sf_dir):
    address = T.StructType([T.StructField("k", T.LongType())])
    child = T.StructType([f for f in CHILD.fields if f.name != "address"] + [T.StructField("address", address)])
    found = nested.unnest(
        packed(spark, sf_dir), "children", child, ["user_id"], {"status": ("port_status", "status", "string")}, separator="_"
    )
    return found.select("id", "kind", "address_k", "status", "user_id")


@query(
    "json_unnest_rest",
    """SELECT event_id AS id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'A' || user_id AS "owner" FROM events
UNION ALL SELECT -event_id, user_id, NULL, NULL FROM events""",
)
def _json_unnest_rest(spark, sf_dir):
    """The schema names the id alone; the other fields of an item arrive as one text."""
    text = F.concat(
        F.lit('[{"id": '), F.col("event_id"), F.lit(', "owner": "A'), F.col("user_id"), F.lit('", "props": '),
        F.col("props"), F.lit('}, 7, {"id": '), -F.col("event_id"), F.lit("}]"),
    )
    cells = table(spark, sf_dir, "events").select("user_id", text.alias("children"))
    child = T.StructType([T.StructField("id", T.LongType())])
    found = nested.unnest(cells, "children", child, ["user_id"], rest="more")
    more = F.col("more")
    return found.select(
        "id",
        "user_id",
        F.get_json_object(more, "$.props.k").cast("long").alias("k"),
        F.get_json_object(more, "$.owner").alias("owner"),
    )


@query(
    "json_unnest_typed",
    """SELECT event_id AS id, ts AS extra_when, value AS extra_value, user_id FROM events""",
)
def _json_unnest_typed(spark, sf_dir):
    """A typed list brings fields that the given schema does not name."""
    events = table(spark, sf_dir, "events")
    item = F.struct(F.col("event_id").alias("id"), F.struct(F.col("ts").alias("when"), "value").alias("extra"))
    child = T.StructType([T.StructField("id", T.LongType())])
    return naive(nested.unnest(events.select("user_id", F.array(item, F.lit(None)).alias("children")), "children", child, ["user_id"], separator="_"))


@query(
    "opening_hours",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderkey % 7 AS VARCHAR) END AS opening_hours_weekday_begin,
       CAST(NULL AS VARCHAR) AS opening_hours_weekday_end,
       CASE WHEN o_orderkey % 3 < 2 THEN (o_orderkey % 24) || ':00' END AS opening_hours_hour_begin,
       CAST(NULL AS VARCHAR) AS opening_hours_hour_end
FROM orders""",
)
def _opening_hours(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    rule = F.concat(
        F.lit('{"weekday_begin": '), F.col("o_orderkey") % 7, F.lit(', "hour_begin": "'),
        F.col("o_orderkey") % 24, F.lit(':00"}'),
    )
    kind = F.col("o_orderkey") % 3
    text = F.when(kind == 0, F.concat(F.lit("["), rule, F.lit(", {}]"))).when(kind == 1, rule)
    return nested.opening_hours(orders.withColumn("opening_hours", text))


# ---------------------------------------------------------------- studies

ATTRIBUTES = ["port_connector_type", "port_power_kw", "port_charging_mechanism"]


@query(
    "distinct_per_group",
    f"""WITH {LOG} SELECT port_station_id, count(DISTINCT port_connector_type) AS port_connector_type_unique,
  count(DISTINCT port_power_kw) AS port_power_kw_unique,
  count(DISTINCT port_charging_mechanism) AS port_charging_mechanism_unique FROM log GROUP BY ALL""",
)
def _distinct_per_group(spark, sf_dir):
    return studies.distinct_per_group(port_log(spark, sf_dir), "port_station_id", ATTRIBUTES)


@query(
    "combo_freq",
    """SELECT p_brand, p_type, count(DISTINCT p_partkey) AS count FROM part GROUP BY ALL""",
)
def _combo_freq(spark, sf_dir):
    return studies.combo_frequencies(table(spark, sf_dir, "part"), ["p_brand", "p_type"], "p_partkey")


COMBOS = f"""WITH {LOG},
combos AS (SELECT port_station_id, port_connector_type, port_power_kw, port_charging_mechanism,
                  count(DISTINCT port_id) AS count FROM log
           WHERE port_connector_type IS NOT NULL GROUP BY ALL)"""


@query("combo_freq_by_group", f"{COMBOS} SELECT * FROM combos")
def _combo_freq_by_group(spark, sf_dir):
    return studies.combo_frequencies(port_log(spark, sf_dir), ATTRIBUTES, "port_id", "port_station_id")


@query(
    "multi_combo_groups",
    """WITH combos AS (SELECT l_suppkey, l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS count
                  FROM lineitem GROUP BY ALL),
n AS (SELECT l_suppkey, count(DISTINCT l_orderkey) AS entities FROM lineitem GROUP BY ALL)
SELECT c.*, n.entities FROM combos c JOIN n ON n.l_suppkey = c.l_suppkey
WHERE c.l_suppkey IN (SELECT l_suppkey FROM combos GROUP BY ALL HAVING count(*) > 1)""",
)
def _multi_combo_groups(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return studies.multi_combo_groups(items, ["l_returnflag", "l_linestatus"], "l_orderkey", "l_suppkey")


@query(
    "varying_groups",
    """WITH u AS (SELECT p_brand, count(DISTINCT p_type) AS p_type_unique, count(DISTINCT p_size) AS p_size_unique
         FROM part GROUP BY ALL)
SELECT * FROM u WHERE p_type_unique > 1 OR p_size_unique > 1""",
)
def _varying_groups(spark, sf_dir):
    summary = studies.distinct_per_group(table(spark, sf_dir, "part"), "p_brand", ["p_type", "p_size"])
    return studies.varying_groups(summary, ["p_type", "p_size"])


@query(
    "varying_totals",
    """WITH u AS (SELECT o_custkey, count(DISTINCT o_orderstatus) AS a, count(DISTINCT o_orderpriority) AS b
         FROM orders GROUP BY ALL)
SELECT count(*) AS groups, count(*) FILTER (a > 1) AS o_orderstatus_vary,
       count(*) FILTER (b > 1) AS o_orderpriority_vary FROM u""",
)
def _varying_totals(spark, sf_dir):
    columns = ["o_orderstatus", "o_orderpriority"]
    return studies.varying_totals(studies.distinct_per_group(table(spark, sf_dir, "orders"), "o_custkey", columns), columns)


@query(
    "change_history",
    f"""WITH {LOG},
k AS (SELECT port_id FROM (SELECT DISTINCT port_id, port_connector_type, port_charging_mechanism FROM log)
      GROUP BY ALL HAVING count(*) > 1)
SELECT port_id, port_connector_type, port_charging_mechanism, ts, port_status, count(*) AS copies FROM log
WHERE port_id IN (SELECT port_id FROM k) GROUP BY ALL""",
)
def _change_history(spark, sf_dir):
    log = port_log(spark, sf_dir).withColumnRenamed("port_last_updated_parsed", "ts")
    return naive(
        studies.change_history(log, "port_id", ["port_connector_type", "port_charging_mechanism"], ["ts", "port_status"])
    )


# ---------------------------------------------------------------- encoding and profiles


@query(
    "onehot",
    """SELECT o_orderdate, o_orderkey, CAST(o_orderstatus = 'F' AS BIGINT) AS o_orderstatus_F,
       CAST(o_orderstatus = 'O' AS BIGINT) AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS BIGINT) AS o_orderstatus_P
FROM orders""",
)
def _onehot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return finished(encode.one_hot(orders, "o_orderdate"))


#: Text columns of the orders: one with a value for each row, one of few values, and a flag with nulls.
MATRIX_SQL = """x AS (SELECT o_orderkey, 'order ' || o_orderkey AS label, nullif(o_orderpriority, '5-LOW') AS urgency,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS closed FROM orders),
cell AS (SELECT o_orderkey, 0 AS place, 'label' AS "column", label AS "value" FROM x
  UNION ALL SELECT o_orderkey, 1, 'urgency', urgency FROM x WHERE urgency IS NOT NULL
  UNION ALL SELECT o_orderkey, 2, 'closed', CASE WHEN closed THEN 'True' ELSE 'False' END FROM x WHERE closed IS NOT NULL),
dictionary AS (SELECT row_number() OVER (ORDER BY place, "value") - 1 AS indicator, "column", "value", count(*) AS "count"
  FROM cell GROUP BY place, "column", "value")"""


def _matrix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str], DataFrame]:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("label"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("urgency"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("closed"),
    )
    columns = encode.encodable(orders)
    return orders, columns, materialize(encode.value_dictionary(orders, columns), "dictionary")


@query(
    "onehot_sparse",
    f"""WITH {MATRIX_SQL}
SELECT o_orderkey, indicator, "column", "value" FROM cell JOIN dictionary USING ("column", "value")""",
)
def _onehot_sparse(spark, sf_dir):
    """The ones of a one-hot matrix with more columns than rows: each row's indicators, with what they stand for."""
    orders, columns, dictionary = _matrix(spark, sf_dir)
    ones = encode.indicators(orders, ["o_orderkey"], columns, dictionary)
    return rows.lookup_join(ones, dictionary.drop("count"), ["indicator"], "inner").select("o_orderkey", "indicator", "column", "value")


@query(
    "onehot_sparse_variance",
    f"""WITH {MATRIX_SQL}, size AS (SELECT count(*) AS n FROM orders)
SELECT indicator, "column", "value", "count", round("count" / n * (1 - "count" / n), 9) AS variance
FROM dictionary, size WHERE "count" / n * (1 - "count" / n) > 0.01""",
)
def _onehot_sparse_variance(spark, sf_dir):
    """Selection among the columns of that matrix, from the dictionary alone."""
    orders, _, dictionary = _matrix(spark, sf_dir)
    return rounded(encode.indicator_variance(dictionary, orders.count(), 0.01), 9)


def _pieces_sql(source: str, columns: list[str]) -> str:
    pieces = "\n  UNION ALL ".join(f"SELECT i, '{c}_' || {c} AS name FROM num WHERE {c} IS NOT NULL" for c in columns)
    return f"""num AS (SELECT *, row_number() OVER () AS i FROM {source}),
piece AS (
  {pieces}),
one AS (SELECT name, count(*) AS n FROM piece GROUP BY ALL),
size AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {source})"""


def _pairs_sql(source: str, columns: list[str]) -> str:
    """Indicators that occur together, counted in a self-join of all pieces."""
    return f"""{_pieces_sql(source, columns)},
two AS (SELECT x.name AS a, y.name AS b, count(*) AS n FROM piece x JOIN piece y ON x.i = y.i GROUP BY ALL)
SELECT two.a, two.b, two.n AS "rows",
       round((size.n * two.n - CAST(p.n AS DOUBLE) * q.n)
             / nullif(sqrt(CAST(p.n AS DOUBLE) * (size.n - p.n) * q.n * (size.n - q.n)), 0), 6) + 0.0 AS corr
FROM two JOIN one p ON two.a = p.name JOIN one q ON two.b = q.name, size"""


def _pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    found = rounded(profile.one_hot_correlation(df, columns))
    return found.withColumn("corr", F.col("corr") + 0.0)


@query("onehot_corr", "WITH " + _pairs_sql("lineitem", ["l_returnflag", "l_linestatus"]))
def _onehot_corr(spark, sf_dir):
    return _pairs(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


# A column with more than ten thousand values.
WIDE = ["l_orderkey", "l_returnflag"]


@query("onehot_corr_wide", "WITH " + _pairs_sql("lineitem", WIDE))
def _onehot_corr_wide(spark, sf_dir):
    return _pairs(table(spark, sf_dir, "lineitem"), WIDE)


@query(
    "indicator_counts",
    f"""WITH {_pieces_sql("lineitem", WIDE)}
SELECT name, one.n AS "rows", CAST(size.n AS BIGINT) AS total FROM one, size""",
)
def _indicator_counts(spark, sf_dir):
    return profile.indicator_counts(table(spark, sf_dir, "lineitem"), WIDE)


@query(
    "variance_select_stats",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls,
  round(var_pop(CAST({c} AS DOUBLE)), 4) AS variance, round(CAST(max({c}) - min({c}) AS DOUBLE), 4) AS spread FROM lineitem"""
        for c in ("l_linenumber", "l_quantity", "l_discount", "l_tax")
    ),
)
def _variance_select_stats(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return rounded(encode.variance_stats(items, ["l_linenumber", "l_quantity", "l_discount", "l_tax"]), 4)


@query(
    "variance_select",
    "SELECT l_shipdate, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem",
)
def _variance_select(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.lit(7).alias("constant"),
        "l_returnflag",
        F.nullif("l_linenumber", F.lit(1)).alias("with_null"),
        "l_shipdate",
    )
    return finished(encode.select_by_variance(items, time="l_shipdate")[0])


@query(
    "null_counts",
    """SELECT 'o_orderkey' AS "column", count(*) FILTER (o_orderkey IS NULL) AS nulls FROM orders
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (nullif(o_orderstatus, 'P') IS NULL) FROM orders
UNION ALL SELECT 'o_totalprice', count(*) FILTER (o_totalprice IS NULL) FROM orders""",
)
def _null_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return profile.null_counts(
        orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_totalprice")
    )


@query(
    "column_profile",
    """SELECT CAST(0 AS BIGINT) AS position, 's_suppkey' AS "column", 'bigint' AS type,
       count(*) FILTER (s_suppkey IS NULL) AS nulls FROM supplier
UNION ALL SELECT 1, 's_name', 'string', count(*) FILTER (s_name IS NULL) FROM supplier
UNION ALL SELECT 2, 's_nationkey', 'int', count(*) FILTER (s_nationkey IS NULL) FROM supplier
UNION ALL SELECT 3, 's_acctbal', 'double', count(*) FILTER (s_acctbal < 0) FROM supplier""",
)
def _column_profile(spark, sf_dir):
    known = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal"))
    suppliers = table(spark, sf_dir, "supplier").withColumn("s_acctbal", known)
    return bigints(profile.column_inventory(suppliers).join(profile.null_counts(suppliers), "column"))


@query("table_shape", "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM part")
def _table_shape(spark, sf_dir):
    return profile.table_shape(table(spark, sf_dir, "part"))


@query(
    "table_shape_by_source",
    "SELECT source, count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns FROM documents GROUP BY ALL",
)
def _table_shape_by_source(spark, sf_dir):
    return profile.table_shape(table(spark, sf_dir, "documents"), "source")


@query(
    "value_counts",
    """SELECT 'o_orderstatus' AS "column", coalesce(nullif(o_orderstatus, 'P'), '<NA>') AS value, count(*) AS count
FROM orders GROUP BY ALL
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL
UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY ALL""",
)
def _value_counts(spark, sf_dir):
    status = F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", status, "o_orderpriority")
    return profile.value_counts(orders, exclude=("o_orderkey",))


@query(
    "mode_static",
    """WITH c AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
d AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
m AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_linenumber) = 1),
o AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1)
SELECT m.l_suppkey, CAST(m.l_linenumber AS BIGINT) AS l_linenumber, o.l_returnflag
FROM m JOIN o ON o.l_suppkey = m.l_suppkey""",
)
def _mode_static(spark, sf_dir):
    return finished(rows.modes(table(spark, sf_dir, "lineitem"), "l_suppkey", ["l_linenumber", "l_returnflag"]))


@query(
    "describe_values",
    """SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
       round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, max(l_extendedprice) AS max FROM lineitem""",
)
def _describe_values(spark, sf_dir):
    return rounded(describe.describe(table(spark, sf_dir, "lineitem"), "l_extendedprice"), 4)


# ---------------------------------------------------------------- quality and models


@query(
    "contract_violations",
    """SELECT 'quantity >= 10' AS "rule", count(*) FILTER (NOT l_quantity >= 10) AS violations FROM lineitem
UNION ALL SELECT 'discount in [0, 0.05]', count(*) FILTER (NOT l_discount BETWEEN 0 AND CAST(0.05 AS DOUBLE)) FROM lineitem
UNION ALL SELECT 'discount <= tax', count(*) FILTER (l_discount > l_tax) FROM lineitem
UNION ALL SELECT 'not empty', CAST(count(*) = 0 AS BIGINT) FROM lineitem""",
)
def _contract_violations(spark, sf_dir):
    return quality.contract_violations(
        table(spark, sf_dir, "lineitem"),
        {
            "quantity >= 10": F.col("l_quantity") >= 10,
            "discount in [0, 0.05]": F.col("l_discount").between(0.0, 0.05),
            "discount <= tax": F.col("l_discount") <= F.col("l_tax"),
        },
    )


LINE_CONTRACT = quality.Contract(
    (
        quality.Field("l_orderkey", "bigint", low=0),
        quality.Field("l_quantity", "bigint", low=5),
        quality.Field("l_discount", "double", low=0.0, high=0.05),
        quality.Field("l_tax", "double", nullable=True),
        quality.Field("l_linenumber", "bigint", coerce=False),
        quality.Field("l_returnflag", "string", among=("A", "N")),
        quality.Field("l_shipdate", "timestamp"),
        quality.Field("l_comment", "string"),
    ),
    (
        quality.Rule("discount <= tax", "l_discount <= l_tax", ("l_discount", "l_tax")),
        quality.Rule("comment not blank", "trim(l_comment) <> ''", ("l_comment",)),
    ),
    strict=True,
    least=100_000_000,
)


@query(
    "contract_report",
    """WITH x AS (SELECT *, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_tax END AS tax FROM lineitem),
n AS (SELECT count(*) FILTER (l_suppkey % 10 = 3) AS no_number, count(*) FILTER (l_suppkey % 10 <> 3 AND l_quantity < 5) AS few,
  count(*) FILTER (l_discount > 0.05) AS much, count(*) FILTER (NOT coalesce(l_discount <= tax, false)) AS over,
  count(*) FILTER (l_returnflag = 'R') AS flags, count(*) FILTER (l_partkey % 11 = 0) AS no_time,
  count(*) FILTER (l_partkey % 13 = 0 AND l_partkey % 11 <> 0) AS null_time FROM x)
SELECT rule, CAST(violations AS BIGINT) AS violations FROM n, LATERAL (VALUES
  ('l_orderkey present', 0), ('l_orderkey is bigint', 0), ('l_orderkey not null', 0), ('l_orderkey >= 0', 0),
  ('l_quantity present', 0), ('l_quantity is bigint', no_number), ('l_quantity not null', 0), ('l_quantity >= 5', few),
  ('l_discount present', 0), ('l_discount is double', 0), ('l_discount not null', 0), ('l_discount >= 0.0', 0), ('l_discount <= 0.05', much),
  ('l_tax present', 0), ('l_tax is double', 0),
  ('l_linenumber present', 0), ('l_linenumber is bigint', 1),
  ('l_returnflag present', 0), ('l_returnflag is string', 0), ('l_returnflag not null', 0), ('l_returnflag among 2 values', flags),
  ('l_shipdate present', 0), ('l_shipdate is timestamp', no_time), ('l_shipdate not null', null_time),
  ('l_comment present', 1), ('comment not blank', 1), ('l_suppkey unexpected', 1),
  ('discount <= tax', over), ('rows >= 100000000', 1)) AS v(rule, violations)""",
)
def _contract_report(spark, sf_dir):
    """One declaration against a table that breaks it: a value of the wrong type, a column of the wrong type, one too few,
    one too many, values out of bounds, rows that break a rule, too few rows."""
    quantity = F.when(F.col("l_suppkey") % 10 == 3, F.lit("some")).otherwise(F.col("l_quantity").cast("long").cast("string"))
    shipped = F.when(F.col("l_partkey") % 11 == 0, F.lit("soon")).when(F.col("l_partkey") % 13 != 0, F.lit("2024-01-01T00:00:00Z"))
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", quantity.alias("l_quantity"), "l_discount", F.when(F.col("l_suppkey") % 7 != 0, F.col("l_tax")).alias("l_tax"),
        F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_returnflag", shipped.alias("l_shipdate"), "l_suppkey",
    )
    return quality.contract_report(items, LINE_CONTRACT)


@query("invalid_instants", "SELECT count(*) FILTER (event_type = 'error') AS invalid FROM events")
def _invalid_instants(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("ts").cast("string"))
    return quality.invalid_instants(table(spark, sf_dir, "events").select(text.alias("t")), "t")


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic pseudo score with ties, against the quality label."""
    score = ((F.col("doc_id") * 37 + F.col("quality") * 23) % 101) / F.lit(101.0)
    return table(spark, sf_dir, "labels").select(F.col("quality").alias("target"), score.alias("score"))


SCORED = """WITH s AS (SELECT quality AS y, ((doc_id * 37 + quality * 23) % 101) / CAST(101 AS DOUBLE) AS p FROM labels)"""


@query(
    "auc_exact",
    f"""{SCORED},
r AS (SELECT y, rank() OVER (ORDER BY p) AS lo, count(*) OVER (PARTITION BY p) AS ties FROM s),
t AS (SELECT sum(CASE WHEN y = 1 THEN lo + (ties - 1) / CAST(2 AS DOUBLE) END) AS ranks,
             CAST(count(*) FILTER (y = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (y = 0) AS DOUBLE) AS n FROM r)
SELECT round((ranks - p * (p + 1) / 2) / (p * n), 6) AS auc FROM t""",
)
def _auc_exact(spark, sf_dir):
    return rounded(metrics.exact_auc(scored_labels(spark, sf_dir)))


@query(
    "binary_metrics",
    f"""{SCORED},
c AS (SELECT y, greatest(least(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16) AS q, p,
             CAST(p >= CAST(0.5 AS DOUBLE) AS INT) AS hit FROM s),
t AS (SELECT count(*) AS n, avg(CAST(y AS DOUBLE)) AS positive_rate,
             avg(-(y * ln(q) + (1 - y) * ln(1 - q))) AS logloss, avg((p - y) * (p - y)) AS brier,
             CAST(count(*) FILTER (hit = 1 AND y = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (hit = 1 AND y = 0) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (hit = 0 AND y = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (hit = 0 AND y = 1) AS DOUBLE) AS fn
      FROM c)
SELECT n AS "rows", round(positive_rate, 6) AS positive_rate, round(logloss, 6) AS logloss, round(brier, 6) AS brier,
       round((tp + tn) / n, 6) AS accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM t""",
)
def _binary_metrics(spark, sf_dir):
    return rounded(metrics.binary_metrics(scored_labels(spark, sf_dir)))


@query(
    "impute_features",
    """SELECT event_id, coalesce(CAST(nullif(value, CAST(0.01 AS DOUBLE)) AS DOUBLE), -1.0) AS value,
       CAST(CASE WHEN event_type = 'view' THEN 1 ELSE -1 END AS DOUBLE) AS seen,
       CAST(nullif(value, CAST(0.01 AS DOUBLE)) IS NULL AS BIGINT) AS value_missing,
       CAST(event_type <> 'view' AS BIGINT) AS seen_missing FROM events""",
)
def _impute_features(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("value", F.lit(0.01)).alias("value"),
        F.when(F.col("event_type") == "view", F.lit(1.0)).alias("seen"),
    )
    filled, _ = classify.impute_features(events, ["value", "seen"], ["value", "seen"])
    return bigints(filled)


MODEL_FEATURES = [
    "is_observed", "is_stale", "age_minutes", "hour", "dayofweek", "sin_hour", "cos_hour", "sin_dow", "cos_dow",
]


# A model set by hand, in whole numbers and one division, so that both sides compute the same scores.
FIXED_SCORES = f"""WITH {GRID},
labelled AS (SELECT *, lead(available_ports, 2) OVER (PARTITION BY st_id ORDER BY ts) AS later FROM grid),
s AS (SELECT CAST(later = 0 AS INT) AS y,
             (5 + 30 * CAST(available_ports = 0 AS INT) + 2 * is_observed + age_minutes / 10) / CAST(64 AS DOUBLE) AS p
      FROM labelled WHERE age_minutes <= 30 AND available_ports IS NOT NULL AND later IS NOT NULL)"""


def fixed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = grid.grid_rows(grid.bucket_latest(snap(spark, sf_dir)), state=STATE, fresh_only=True)
    rows_20 = labels.horizon_labels(cells, 20)[0]
    points = 5 + 30 * (F.col("available_ports") == 0).cast("int") + 2 * F.col("is_observed") + F.col("age_minutes") / 10
    return materialize(rows_20.select("target", (points / F.lit(64.0)).alias("score")), "fixed-scores")


@query(
    "fixed_model_metrics",
    f"""{FIXED_SCORES},
r AS (SELECT y, rank() OVER (ORDER BY p) AS lo, count(*) OVER (PARTITION BY p) AS ties FROM s),
a AS (SELECT sum(CASE WHEN y = 1 THEN lo + (ties - 1) / CAST(2 AS DOUBLE) END) AS ranks,
             CAST(count(*) FILTER (y = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (y = 0) AS DOUBLE) AS n FROM r),
c AS (SELECT y, p, CAST(p >= CAST(0.5 AS DOUBLE) AS INT) AS hit FROM s),
t AS (SELECT count(*) AS n, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS logloss, avg((p - y) * (p - y)) AS brier,
             CAST(count(*) FILTER (hit = y) AS DOUBLE) AS right_ones FROM c)
SELECT t.n AS "rows", round((ranks - a.p * (a.p + 1) / 2) / (a.p * a.n), 6) AS auc, round(logloss, 6) AS logloss,
       round(brier, 6) AS brier, round(right_ones / t.n, 6) AS accuracy FROM t, a""",
)
def _fixed_model_metrics(spark, sf_dir):
    """All metrics of a horizon for scores that need no training."""
    scored = fixed_scores(spark, sf_dir)
    found = metrics.binary_metrics(scored).select("rows", "logloss", "brier", "accuracy")
    # One row each.
    return rounded(found.join(F.broadcast(metrics.exact_auc(scored))))


@query(
    "training_facts",
    f"""WITH {HORIZON_20},
d AS (SELECT DISTINCT ts FROM h), n AS (SELECT count(*) AS n FROM d),
r AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS i FROM d),
cut AS (SELECT r.ts FROM r, n
        WHERE r.i = greatest(1, least(CAST(floor(n.n * CAST(0.8 AS DOUBLE)) AS BIGINT), n.n - 1))),
x AS (SELECT h.*, h.ts < cut.ts AS early FROM h, cut)
SELECT CAST(20 AS BIGINT) AS requested_horizon_minutes, CAST(20 AS BIGINT) AS effective_horizon_minutes,
       count(*) AS rows_horizon, count(*) FILTER (early) AS rows_train, count(*) FILTER (NOT early) AS rows_valid,
       round(avg(CAST(target AS DOUBLE)) FILTER (early), 6) AS positive_rate_train,
       round(avg(CAST(target AS DOUBLE)) FILTER (NOT early), 6) AS positive_rate_valid,
       count(DISTINCT st_id) FILTER (early) AS n_stations_train,
       count(DISTINCT st_id) FILTER (NOT early) AS n_stations_valid,
       round((count(*) FILTER (early) - sum(target) FILTER (early)) / CAST(sum(target) FILTER (early) AS DOUBLE), 6) AS class_weight
FROM x""",
)
def _training_facts(spark, sf_dir):
    """What a training run knows before it fits: sides of the split, class shares, class weight."""
    cells = snap_grid(spark, sf_dir, fresh_only=True)
    settings = classify.TrainSettings(features=MODEL_FEATURES, balance_classes=True)
    ready = classify.prepared(classify.training_table(cells, [20], settings), 20, settings)
    wanted = [
        "requested_horizon_minutes", "effective_horizon_minutes", "rows_horizon", "rows_train", "rows_valid",
        "positive_rate_train", "positive_rate_valid", "n_stations_train", "n_stations_valid",
    ]
    facts = {name: ready.facts[name] for name in wanted} | {"class_weight": ready.weight}
    return rounded(spark.range(1).select(*[F.lit(v).alias(n) if isinstance(v, float) else F.lit(v).cast("long").alias(n) for n, v in facts.items()]))


@query("gbt_train_score")
def _gbt_train_score(spark, sf_dir):
    """Trains on the whole labelled grid (few rounds) and returns the metrics record."""
    settings = classify.TrainSettings(rounds=5, depth=3, features=MODEL_FEATURES)
    return classify.train_horizon(snap_grid(spark, sf_dir, fresh_only=True), 20, settings)[2]


@query("gbt_train_full")
def _gbt_train_full(spark, sf_dir):
    """The same at full size: up to 800 rounds of depth 6, ended by patience, scored at the best round."""
    return classify.train_horizon(snap_grid(spark, sf_dir, fresh_only=True), 20, classify.TrainSettings(features=MODEL_FEATURES))[2]


STUMP_FEATURES = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]


def _stump_sql() -> str:
    """One round of depth one from margin zero: every gradient is a half or minus a half, every curvature a quarter."""
    cells = "\n  UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, CAST({c} AS DOUBLE) AS v, g FROM x" for i, c in enumerate(STUMP_FEATURES))
    return f"""WITH x AS (SELECT nullif(l_linenumber, 1) AS l_linenumber, l_quantity, CASE WHEN l_discount > 0.02 THEN l_discount END AS l_discount,
  l_tax, CASE WHEN l_returnflag = 'R' THEN -0.5 ELSE 0.5 END AS g FROM lineitem),
cell AS (
  {cells}),
sums AS (SELECT f, feature, v, sum(g) AS g, count(*) * 0.25 AS h FROM cell GROUP BY ALL),
along AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER p AS ga, sum(h) OVER p AS ha,
  coalesce(sum(g) FILTER (v IS NULL) OVER p, 0) AS gn, coalesce(sum(h) FILTER (v IS NULL) OVER p, 0) AS hn FROM sums
  WINDOW w AS (PARTITION BY f ORDER BY v NULLS LAST ROWS UNBOUNDED PRECEDING), p AS (PARTITION BY f)),
side AS (SELECT f, feature, v, m, ga, ha, gl + CASE WHEN m THEN gn ELSE 0 END AS g, hl + CASE WHEN m THEN hn ELSE 0 END AS h
  FROM along, (VALUES (false), (true)) AS s(m) WHERE v IS NOT NULL),
best AS (SELECT *, g * g / (h + 1) + (ga - g) * (ga - g) / (ha - h + 1) - ga * ga / (ha + 1) AS gain FROM side
  WHERE h >= 1 AND ha - h >= 1 ORDER BY gain DESC, f, v, m LIMIT 1)
SELECT 0 AS tree, 1 AS node, feature, v AS threshold, m AS missing_left, round(gain, 6) AS gain, CAST(NULL AS DOUBLE) AS "value" FROM best
UNION ALL SELECT 0, 2, NULL, NULL, NULL, NULL, round(-0.3 * g / (h + 1), 9) FROM best
UNION ALL SELECT 0, 3, NULL, NULL, NULL, NULL, round(-0.3 * (ga - g) / (ha - h + 1), 9) FROM best"""


@query("boosted_stump", _stump_sql())
def _boosted_stump(spark, sf_dir):
    """One round of boosting, one split: the feature, the threshold, the side of missing values and both leaf values."""
    items = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_linenumber", F.lit(1)).alias("l_linenumber"), "l_quantity",
        F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("l_discount"), "l_tax",
        (F.col("l_returnflag") == "R").cast("double").alias("label"), F.lit(1.0).alias("weight"), F.lit(False).alias("is_valid"),
    )
    settings = trees.BoostSettings(rounds=1, depth=1, learning_rate=0.3, row_share=1.0, column_share=1.0)
    nodes = trees.node_frame(spark, trees.boost(items, STUMP_FEATURES, settings)[0])
    return nodes.select(
        "tree", "node", "feature", "threshold", "missing_left", F.round("gain", 6).alias("gain"), F.round("value", 9).alias("value")
    )


#: Three trees set by hand; the third one is beyond the best round.
HAND_MADE = [
    trees.Node(0, 1, "l_quantity", 20.0, False, 2, 3), trees.Node(0, 2, value=-0.5),
    trees.Node(0, 3, "l_discount", 0.04, True, 6, 7), trees.Node(0, 6, value=0.25), trees.Node(0, 7, value=1.5),
    trees.Node(1, 0, "l_linenumber", 3.0, True, 1, 2), trees.Node(1, 1, value=0.125), trees.Node(1, 2, value=-0.75),
    trees.Node(2, 0, value=100.0),
]


@query(
    "node_table_score",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_discount > 0.02 THEN l_discount END AS d FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(1 / (1 + exp(-(
    CASE WHEN l_quantity <= 20 THEN -0.5 WHEN coalesce(d <= 0.04, true) THEN 0.25 ELSE 1.5 END
    + CASE WHEN coalesce(nullif(l_linenumber, 2) <= 3, true) THEN 0.125 ELSE -0.75 END))), 12) AS score FROM x""",
)
def _node_table_score(spark, sf_dir):
    """A written table of nodes cut to its first two rounds, applied to whole rows, missing values among them."""
    nodes = trees.read_nodes(trees.first_rounds(materialize(trees.node_frame(spark, HAND_MADE), "nodes"), 2))
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("line"), F.nullif("l_linenumber", F.lit(2)).alias("l_linenumber"),
        "l_quantity", F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("l_discount"),
    )
    scored = trees.with_scores(items, nodes)
    return scored.select("l_orderkey", F.col("line").alias("l_linenumber"), F.round("score", 12).alias("score"))


@query("port_study_correlation", f"WITH {LOG}, " + _pairs_sql("log", ATTRIBUTES))
def _port_study_correlation(spark, sf_dir):
    found = rounded(reports.port_study(_study_log(spark, sf_dir))["correlation"])
    return found.withColumn("corr", F.col("corr") + 0.0)


def _study_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return port_log(spark, sf_dir).withColumn("port_last_updated", F.col("port_last_updated_parsed").cast("string"))


# ---------------------------------------------------------------- contract


def entry(spark: SparkSession) -> DataFrame:
    """For each entity, on a ten-minute grid: is its state zero twenty minutes later?"""
    return _QUERIES["horizon_labels_20"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_CORPUS_QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**_ORACLES, **_CORPUS_ORACLES}


# The corpus operators and their pipeline are an optional part of the library: they may be absent, not broken.
_CORPUS_QUERIES: dict[str, Query] = {}
_CORPUS_ORACLES: dict[str, str] = {}
try:
    import corpus_pipeline
    from snapgrid.llm.queries import ORACLES, QUERIES

    _CORPUS_QUERIES |= {**QUERIES, "pipeline": corpus_pipeline.run}
    _CORPUS_ORACLES |= ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "snapgrid.llm", "snapgrid.llm.queries"):
        raise

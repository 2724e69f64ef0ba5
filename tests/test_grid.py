import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from snapgrid.functions.time import clock_features
from snapgrid.operators import grid, labels
from snapgrid.schema import DENSE_COLUMNS, STATE_COLUMNS, STATIC_COLUMNS


def snapshots(spark, rows):
    return spark.createDataFrame(rows, "st_id int, snapshot_ts string, available_ports int")


def station(spark, rows):
    """Buckets with all state and static columns: (st_id, ts, five states)."""
    df = spark.createDataFrame(rows, "st_id int, ts string, " + ", ".join(f"{c} double" for c in STATE_COLUMNS))
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withColumns({c: F.lit(1) for c in STATIC_COLUMNS})


def test_last_snapshot_of_a_bucket_wins(spark):
    df = snapshots(
        spark,
        [(1, "2025-01-01T00:01:00Z", 1), (1, "2025-01-01T00:08:00Z", 2), (1, "2025-01-01T00:11:00Z", 3)],
    )
    got = grid.bucket_latest(df).orderBy("ts").collect()
    assert [(r["ts"], r["available_ports"]) for r in got] == [
        (dt.datetime(2025, 1, 1, 0, 0), 2),
        (dt.datetime(2025, 1, 1, 0, 10), 3),
    ]


def test_invalid_timestamp_fails(spark):
    with pytest.raises(Exception, match="invalid timestamp"):
        grid.bucket_latest(snapshots(spark, [(1, "yesterday", 1)])).collect()


def test_dense_grid_freshness(spark):
    df = station(
        spark,
        [(1, "2025-01-01 00:00:00", 1.0, 0.0, 0.0, 1.0, 0.0), (1, "2025-01-01 00:50:00", 0.0, 1.0, 1.0, 0.0, 0.0)],
    )
    got = grid.dense_grid(df).orderBy("ts").collect()
    assert list(got[0].asDict()) == DENSE_COLUMNS
    assert [r["age_minutes"] for r in got] == [0, 10, 20, 30, 40, 0]
    assert [r["is_stale"] for r in got] == [0, 0, 0, 0, 1, 0]
    assert [r["is_observed"] for r in got] == [1, 0, 0, 0, 0, 1]
    assert all(got[4][c] is None for c in STATE_COLUMNS)
    assert [r["available_ports"] for r in got] == [1, 1, 1, 1, None, 0]
    fresh = grid.dense_grid(df, fresh_only=True).orderBy("ts").collect()
    assert fresh == [r for r in got if not r["is_stale"]]


def test_observed_null_state_is_filled(spark):
    df = station(
        spark,
        [
            (1, "2025-01-01 00:00:00", 1.0, 0.0, 0.0, 1.0, 0.0),
            (1, "2025-01-01 00:10:00", None, 5.0, 0.0, 1.0, 0.0),
        ],
    )
    got = grid.dense_grid(df).orderBy("ts").collect()
    assert [(r["available_ports"], r["unavailable_ports"], r["is_observed"]) for r in got] == [(1, 0, 1), (1, 5, 1)]


def test_long_gap_and_odd_step(spark):
    df = spark.createDataFrame([(1, "2020-01-01 00:00:00", 1), (1, "2025-01-01 00:07:00", 2)], "st_id int, ts string, s int")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = dt.datetime(2020, 1, 1), dt.datetime(2025, 1, 1, 0, 7)
    for minutes in (1, 7):
        cells = grid.grid_rows(df, state=["s"], minutes=minutes)
        want = int((last - first).total_seconds() // 60 // minutes) + 1
        span = cells.agg(F.count("*"), F.countDistinct("ts"), F.sum("is_observed")).first()
        # With a step that does not meet the last bucket, that bucket still is a row of its own.
        assert span[0] == span[1] and span[2] == 2 and span[0] in (want, want + 1)


def test_static_until(spark):
    df = spark.createDataFrame(
        [(1, "2025-01-01 00:00:00", 1, "a"), (1, "2025-01-01 00:10:00", 1, "b"), (1, "2025-01-01 00:20:00", 1, "b")],
        "st_id int, ts string, s int, c string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    everything = grid.dense_grid(df, state=["s"], static=["c"]).select("c").distinct().collect()
    early = grid.dense_grid(df, state=["s"], static=["c"], static_until=dt.datetime(2025, 1, 1, 0, 5))
    assert everything == [("b",)] and early.select("c").distinct().collect() == [("a",)]


def test_missing_columns(spark):
    with pytest.raises(KeyError, match="available_ac_ports"):
        grid.dense_grid(spark.createDataFrame([(1, 1)], "st_id int, ts int"))


def dense(spark, rows):
    df = spark.createDataFrame(rows, "st_id int, ts string, age_minutes double, available_ports double")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def test_horizon_rounds_up_and_labels(spark):
    rows = [(s, f"2025-01-01 00:{m}:00", 5.0, float(v)) for s, vs in ((1, (1, 0, 1)), (2, (0, 1, 0))) for m, v in zip(("00", "10", "20"), vs)]
    got, effective = labels.horizon_labels(dense(spark, rows), 15)
    assert effective == 20
    assert {(r["st_id"], r["ts"].minute): r["target"] for r in got.collect()} == {(1, 0): 0, (2, 0): 1}


def test_eligibility_boundary(spark):
    rows = [
        (1, "2025-01-01 00:00:00", 30.0, 1.0),
        (1, "2025-01-01 00:10:00", 40.0, 1.0),
        (1, "2025-01-01 00:20:00", 0.0, None),
        (1, "2025-01-01 00:30:00", 0.0, 1.0),
    ]
    got, _ = labels.horizon_labels(dense(spark, rows), 10)
    assert [r["ts"].minute for r in got.collect()] == [0]


@pytest.mark.parametrize("mode", ["timestamps", "rows"])
def test_split_is_ordered_and_complete(spark, mode):
    rows = [(i % 3, f"2025-01-01 0{i // 6}:{i % 6}0:00", 0.0, 1.0) for i in range(30)]
    df = dense(spark, rows)
    train, valid = labels.split_train_valid(df, mode=mode)
    assert train.agg(F.max("ts")).first()[0] < valid.agg(F.min("ts")).first()[0]
    assert train.count() + valid.count() == 30
    if mode == "timestamps":
        assert train.count() == 24


def test_split_needs_two_instants(spark):
    df = dense(spark, [(i, "2025-01-01 00:00:00", 0.0, 1.0) for i in range(4)])
    for mode in ("timestamps", "rows"):
        with pytest.raises(ValueError):
            labels.split_train_valid(df, mode=mode)
    with pytest.raises(ValueError, match="unknown split mode"):
        labels.split_point(df, mode="random")


def test_row_split_with_an_empty_side(spark):
    rows = [(i, "2025-01-01 00:00:00", 0.0, 1.0) for i in range(19)] + [(0, "2025-01-01 00:10:00", 0.0, 1.0)]
    with pytest.raises(ValueError, match="one side empty"):
        labels.split_train_valid(dense(spark, rows), mode="rows")
    assert [d.count() for d in labels.split_train_valid(dense(spark, rows))] == [19, 1]


def test_rows_off_the_grid_do_not_break_it(spark):
    df = spark.createDataFrame([(1, "2025-01-01 00:00:00", 1), (1, "2025-01-01 00:04:00", 2)], "st_id int, ts string, s int")
    got = grid.grid_rows(df.withColumn("ts", F.col("ts").cast("timestamp")), state=["s"])
    assert [r["s"] for r in got.orderBy("ts").collect()] == [1, 2]


def test_static_features_do_not_multiply_rows(spark):
    df = station(spark, [(s, f"2025-01-01 0{h}:00:00", 1.0, 0.0, 0.0, 1.0, 0.0) for s in (1, 2) for h in (0, 3, 4)])
    got = grid.dense_grid(df)
    per = got.groupBy("st_id").agg(F.count("*").alias("n"), F.countDistinct("ts").alias("d")).collect()
    assert {(r["n"], r["d"]) for r in per} == {(25, 25)}


def test_session_zone_does_not_matter(spark):
    rows = [(1, "2024-12-31 23:58:00", 1), (1, "2025-01-01 00:21:00", 2)]
    results = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = snapshots(spark, rows)
        cells = grid.dense_grid(grid.bucket_latest(df), state=["available_ports"], static=[])
        results.append(sorted(map(tuple, cells.withColumn("ts", F.unix_micros("ts")).collect())))
    assert results[0] == results[1] and len(results[0]) == 4 and results[0][0][1] == 1735689000000000


@pytest.mark.parametrize("one_task", [True, False])
def test_ranked_sums_either_way(spark, monkeypatch, one_task):
    from snapgrid.operators import slices

    monkeypatch.setattr(slices, "ONE_TASK", 10**6 if one_task else 0)
    df = spark.range(3_000).select((F.col("id") * 7 % 3_000).alias("v"), (F.col("id") % 5).alias("n"), F.lit(0.5).alias("w"))
    rows = sorted(slices.ranked_sums(df, "v", ["n", "w"]).collect(), key=lambda r: r["v"])
    total = 0
    for i, r in enumerate(rows):
        total += r["n"]
        assert (r["v"], r["n_run"], r["w_run"], r["n_total"], r["w_total"]) == (i, total, (i + 1) / 2, 6_000, 1_500)


def test_ranked_sums_in_even_slices(spark, monkeypatch):
    """Slices follow the data: ids close together, far from zero, spread over all of them."""
    from snapgrid.operators import slices
    from snapgrid.operators.slices import SLICE, ranked_sums

    monkeypatch.setattr(slices, "ONE_TASK", 0)
    df = spark.range(10**9, 10**9 + 20_000, 1, 4).select(F.col("id").alias("v"), (F.col("id") % 7).alias("n"))
    got = ranked_sums(df, "v", ["n"])
    # What meets in one place is one row for each slice; the rows' own window is inside a slice.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1
    assert re.match(r"[^\n]*\n[ +-]*HashAggregate\(keys=\[_slice", plan.split("SinglePartition")[1])
    rows = got.orderBy("v").collect()
    total, run = sum(r["n"] for r in rows), 0
    for r in rows:
        run += r["n"]
        assert (r["n_run"], r["n_total"]) == (run, total)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.repartitionByRange(parts, "v").groupBy(F.spark_partition_id().alias(SLICE)).count().collect()
    assert len(sliced) == parts and max(r["count"] for r in sliced) < 2 * 20_000 / parts
    assert ranked_sums(df.limit(0), "v", ["n"]).collect() == []


def test_a_bad_time_fails_even_if_nothing_reads_it(spark):
    df = spark.createDataFrame([(1, "2025-01-01 00:00:00"), (2, "soon")], "v int, t string")
    strict = grid.strict_instants(df, "t")
    for act in (strict.count, lambda: strict.agg(F.sum("v")).collect(), lambda: strict.select("v").collect()):
        with pytest.raises(Exception, match="invalid timestamp in t: soon"):
            act()
    assert grid.strict_instants(df.limit(1).coalesce(1).filter("v = 1"), "t").count() == 1


def test_clock_features_are_looked_up(spark):
    """no sine and no decimal rounding for each row; the values are those of the clock."""
    hours = [0, -1, 24 * 181, 24 * 19_000 + 1, 24 * 2_000_000 + 5, *range(470_000, 470_000 + 24 * 7)]
    df = spark.createDataFrame([(h,) for h in hours], "h long").select("h", F.timestamp_seconds(F.col("h") * 3600 + 59).alias("ts"))
    found = df.select("h", *[v.alias(n) for n, v in clock_features(F.col("ts"), "UTC", 6).items()])
    for row in found.collect():
        hour, day = row["h"] % 24, (row["h"] // 24 + 3) % 7
        assert (row["hour"], row["dayofweek"]) == (hour, day)
        want = [f(2 * math.pi * x / n) for x, n in ((hour, 24), (day, 7)) for f in (math.sin, math.cos)]
        assert [row[c] for c in ("sin_hour", "cos_hour", "sin_dow", "cos_dow")] == pytest.approx(want, abs=6e-7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SIN(" not in plan and "round(" not in plan

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapgrid.operators import describe, gaps

T0 = dt.datetime(2023, 12, 30)


def frame(spark, rows):
    return spark.createDataFrame([(k, T0 + dt.timedelta(microseconds=us), 0) for k, us in rows], "st_id int, snapshot_ts timestamp, available_ports int")


def pandas_like(values):
    q = np.percentile(values, [25, 50, 75])
    std = statistics.stdev(values) if len(values) > 1 else None
    return len(values), statistics.fmean(values), std, min(values), *q, max(values)


def check(row, values):
    for got, want in zip(row, pandas_like(values)):
        assert got == (None if want is None else pytest.approx(want, rel=1e-9, abs=1e-9))


HOUR = 3_600_000_000


def test_segment_boundary(spark):
    df = frame(spark, [(1, 0), (1, 6 * HOUR), (1, 12 * HOUR + 1), (2, 0), (2, 6 * HOUR + 1)])
    got = gaps.segment_lengths(gaps.instant_gaps(df, "st_id", "snapshot_ts"))
    assert {tuple(r) for r in got.collect()} == {(1, 1, 2), (1, 2, 1), (2, 1, 1), (2, 2, 1)}


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(300):
        key = 1 if rng.random() < 0.4 else rng.randint(2, 6)
        rows.append((key, rng.choice([rng.randint(0, 400) * 60_000_000, rng.randint(0, 30) * HOUR, 5 * HOUR])))
    return rows


@pytest.mark.parametrize("slice_minutes", [3, 60, 100_000])
def test_gaps_match_the_definition(spark, slice_minutes):
    rows = random_rows(slice_minutes)
    found = gaps.instant_gaps(frame(spark, rows), "st_id", "snapshot_ts", 1.0, slice_minutes)
    all_gaps, lengths = [], []
    for key in {k for k, _ in rows}:
        us = sorted(u for k, u in rows if k == key)
        here = [(b - a) / HOUR for a, b in zip(us, us[1:])]
        all_gaps += here
        run = 1
        for g in here:
            if g > 1.0:
                lengths.append(run)
                run = 0
            run += 1
        lengths.append(run)
    check(describe.describe(gaps.row_gaps(found), "gap_hours", "n").first(), all_gaps)
    segments = gaps.segment_lengths(found)
    assert sorted(r["segment_length"] for r in segments.collect()) == sorted(lengths)
    totals = gaps.segment_totals(segments).first()
    assert tuple(totals) == (sum(n >= 10 for n in lengths), max(lengths))
    numbers = segments.groupBy("key").agg(F.sort_array(F.collect_list("segment_id"))).collect()
    assert all(r[1] == list(range(1, len(r[1]) + 1)) for r in numbers)


@pytest.mark.parametrize("slice_minutes", [None, 4, 33])
def test_coverage_matches_the_definition(spark, slice_minutes):
    rows = random_rows(11)
    times = (0, 1, 5, 15, 60, 5, -1, -7, -30)
    got = gaps.label_coverage(frame(spark, rows), travel_minutes=times, slice_minutes=slice_minutes).collect()
    by_key = {}
    for k, u in rows:
        by_key.setdefault(k, []).append(u)
    for r in got:
        lo, hi = (r["travel_time_min"] - 2) * 60_000_000, (r["travel_time_min"] + 2) * 60_000_000
        want = sum(any(u + lo <= o <= u + hi for o in by_key[k]) for k, u in rows)
        assert (r["matched_rows"], r["total_rows"], r["tolerance_min"]) == (want, len(rows), 2)
        assert r["match_rate"] == pytest.approx(want / len(rows))
    assert [r["travel_time_min"] for r in got] == list(times)


def test_coverage_ends_are_inclusive(spark):
    minute = 60_000_000
    for offset, hit in ((3 * minute, 1), (7 * minute, 1), (3 * minute - 1, 0), (7 * minute + 1, 0)):
        got = gaps.label_coverage(frame(spark, [(1, 0), (1, offset)]), travel_minutes=(5,)).first()
        assert got["matched_rows"] == hit


def test_coverage_of_nothing(spark):
    got = gaps.label_coverage(frame(spark, [(1, 0)]).limit(0), travel_minutes=(5, 10)).collect()
    assert [(r["total_rows"], r["match_rate"]) for r in got] == [(0, 0.0), (0, 0.0)]
    assert gaps.label_coverage(frame(spark, [(1, 0)]), travel_minutes=(-5,)).first()["matched_rows"] == 0


def test_describe_edge_cases(spark):
    one = spark.createDataFrame([(3,)], "v int")
    assert tuple(describe.describe(one, "v").first()) == (1, 3.0, None, 3.0, 3.0, 3.0, 3.0, 3.0)
    none = describe.describe(one.limit(0), "v").first()
    assert none["count"] == 0 and none["mean"] is None and none["p50"] is None
    values = [-5.5, -5.5, 0.0, 1e-9, 2.0, 1e15, 3.0, None, -1e12]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    check(describe.describe(df, "v").first(), [v for v in values if v is not None])


def test_describe_ignores_nan_and_takes_infinity(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,), (float("inf"),)], "v double")
    row = describe.describe(df, "v").first()
    assert (row["count"], row["min"], row["p50"], row["max"]) == (3, 1.0, 3.0, float("inf"))


def test_gap_tables(spark):
    df = frame(spark, [(1, 0), (1, HOUR), (2, 0)])
    found = gaps.gap_tables(df)
    assert tuple(found.counts.first()) == (3, 2, None)
    assert {tuple(r) for r in found.per_year.collect()} == {(2023, 3)}
    assert found.rows_per_key.first()["mean"] == 1.5
    assert tuple(found.segments.first()) == (0, 2)
    assert gaps.occupied_rate(df).first()[0] == 1.0
    with pytest.raises(KeyError):
        gaps.gap_tables(df.drop("st_id"))

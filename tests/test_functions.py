import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapgrid.functions import ports, time, values

UTC = dt.timezone.utc


def column(spark, values_, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values_)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_minutes_of_day(spark):
    texts = ["8:30", "0:00", "24:00", "25:00", "08:30:00", None, "23:59", "8:5", "", " 7:15 "]
    assert column(spark, texts, "string", time.minutes_of_day) == [510, 0, 1440, None, None, None, 1439, 485, None, 435]


def test_parse_instant_accepts_iso_variants_row_by_row(spark):
    got = column(spark, ["2025-01-01T00:00:00Z", "2025-01-01 00:00:00.5", "soon", None], "string", time.parse_instant)
    assert got[0] == dt.datetime(2025, 1, 1) and got[1] == dt.datetime(2025, 1, 1, 0, 0, 0, 500000)
    assert got[2:] == [None, None]


def test_rounding_half_even_on_binary_double(spark):
    assert column(spark, [1 / 8, 23 / 40, 3 / 8], "double", values.round_half_even) == [0.12, 0.57, 0.38]


def test_safe_rate_without_denominator(spark):
    df = spark.createDataFrame([(0, 0), (1, 2)], "a int, b int")
    got = [r[0] for r in df.select(values.safe_rate(F.col("a"), F.col("b"))).collect()]
    assert got == [0.0, 0.5]


def test_truth_flag(spark):
    assert column(spark, [" True ", "false", "yes", None], "string", values.truth_flag) == [1, 0, 0, 0]


def test_number(spark):
    assert column(spark, ["1.5", "x", None, "nan", " 2 "], "string", values.number) == [1.5, None, None, None, 2.0]
    guarded = column(spark, ["1.5", "x", None, "-3e2", "."], "string", lambda c: values.number(c, text=True))
    assert guarded == [1.5, None, None, -300.0, None]


def test_floor_over_the_autumn_hour(spark):
    texts = ["2024-10-27T00:35:00Z", "2024-10-27T01:35:00Z"]
    floor = column(spark, texts, "string", lambda c: time.floor_to(time.parse_instant(c), 10))
    assert floor == [dt.datetime(2024, 10, 27, 0, 30), dt.datetime(2024, 10, 27, 1, 30)]
    hours = column(
        spark, texts, "string", lambda c: time.clock_features(time.parse_instant(c), "Europe/Madrid")["hour"]
    )
    assert hours == [2, 2]


def test_floor_before_epoch(spark):
    got = column(spark, ["1969-12-31T23:59:00Z"], "string", lambda c: time.floor_to(time.parse_instant(c), 10))
    assert got == [dt.datetime(1969, 12, 31, 23, 50)]


def test_clock_features(spark):
    df = spark.sql("select timestamp'2025-01-06 05:00:00' as ts").withColumns(
        time.clock_features(F.col("ts"), "Europe/Madrid")
    )
    row = df.first()
    assert (row["hour"], row["dayofweek"]) == (6, 0)
    assert row["sin_hour"] == pytest.approx(1.0) and row["cos_hour"] == pytest.approx(0.0, abs=1e-12)
    assert (row["sin_dow"], row["cos_dow"]) == (0.0, 1.0)


def test_grid_steps_and_int_list():
    assert time.grid_steps(15, 10) == (2, 20)
    assert time.grid_steps(30, 10) == (3, 30)
    assert time.int_list(" 5, 10,,30 ") == [5, 10, 30]
    assert time.int_list("") == []


def test_dc_fast(spark):
    rows = [
        ("TYPE_2", "SOCKET", "11", False),
        ("TYPE_2", "SOCKET", "50", True),
        ("CCS_TYPE_2", "SOCKET", "7", True),
        ("TYPE_2", "CABLE", "7", True),
        ("CHADEMO", "SOCKET", "11", True),
        ("TYPE_2", "SOCKET", "22", False),
        (None, None, None, False),
        ("TYPE_2", "SOCKET", "fast", False),
    ]
    df = spark.createDataFrame(rows, "c string, m string, p string, want boolean")
    got = df.select(ports.is_dc_fast(F.col("p"), F.col("c"), F.col("m")).alias("got"), "want").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_differs_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), ("MOTORCYCLE_ONLY",), ("OTHER",)], "n string")
    assert df.filter(values.differs(F.col("n"), "MOTORCYCLE_ONLY")).count() == 2


def test_names(spark):
    assert values.safe_name("a b/c-d_é") == "a_b_c-d_é"
    assert column(spark, ["2022_05_loc.csv", "x.csv"], "string", values.file_tag) == ["2022_05", "x"]

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapgrid.operators import encode, metrics, profile, quality, rows, studies
from snapgrid.operators.slices import numbered
from snapgrid.plans import reports


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_one_hot(spark):
    df = spark.createDataFrame(
        [("t1", "b", True, None, None, 1), ("t2", None, None, None, None, 2), ("t3", "a", False, None, None, 3)],
        "snapshot_ts string, c string, f boolean, empty string, g boolean, n int",
    ).withColumn("solid", F.col("n") > 1)
    got = encode.one_hot(df)
    assert got.columns == ["snapshot_ts", "empty", "g", "n", "solid", "c_a", "c_b", "f_False", "f_True"]
    rows = {r["n"]: (r["c_a"], r["c_b"], r["f_False"], r["f_True"]) for r in got.collect()}
    assert rows == {1: (0, 1, 0, 1), 2: (0, 0, 0, 0), 3: (1, 0, 1, 0)}
    assert [k for _, k in got.dtypes][-4:] == ["int"] * 4


def test_any_number_of_categories(spark):
    df = spark.range(12_000).select(F.col("id").cast("string").alias("c.d"))
    assert len(encode.categories(df, ["c.d"])["c.d"]) == 12_000
    assert encode.one_hot(df.limit(3).coalesce(1), values={"c.d": ["0", "1"]}).columns == ["c.d_0", "c.d_1"]


def test_sparse_form_equals_the_wide_one(spark):
    """Numbers follow the order of the wide columns; nulls have no row; a boolean without nulls is left alone."""
    df = spark.createDataFrame(
        [("t1", "b", True, None, None, 1), ("t2", None, None, None, None, 2), ("t3", "a", False, None, None, 3), ("t4", "b", True, "", None, 4)],
        "snapshot_ts string, c string, f boolean, e string, g boolean, n int",
    ).withColumn("solid", F.col("n") > 1)
    columns = encode.encodable(df)
    assert columns == ["c", "f", "e", "g"]
    found = encode.value_dictionary(df, columns)
    names = {r["indicator"]: f"{r['column']}_{r['value']}" for r in found.collect()}
    assert [names[i] for i in range(len(names))] == ["c_a", "c_b", "f_False", "f_True", "e_"]
    ones = {(r["n"], names[r["indicator"]]) for r in encode.indicators(df, ["n"], columns, found).collect()}
    wide = encode.one_hot(df).collect()
    assert ones == {(r["n"], c) for r in wide for c in names.values() if r[c]}
    kept = {r["indicator"]: r["variance"] for r in encode.indicator_variance(found, 4, 0.2).collect()}
    assert kept == {1: 0.25, 3: 0.25}
    nothing = encode.value_dictionary(df, [])
    assert nothing.count() == 0 and encode.indicators(df, ["n"], [], nothing).count() == 0


def test_rows_are_numbered_in_order(spark):
    df = spark.range(5_000).select((F.col("id") * 37 % 1_000).alias("a b"), F.col("id"))
    got = sorted(numbered(df, ["a b", "id"], "place").collect(), key=lambda r: r["place"])
    assert [r["place"] for r in got] == list(range(5_000))
    assert [(r["a b"], r["id"]) for r in got] == sorted((r["a b"], r["id"]) for r in got)
    assert numbered(df.limit(0), ["id"], "place").count() == 0


def test_variance_selection(spark):
    df = spark.createDataFrame(
        [("a", 1, 7, "a", 1, "1.5"), ("b", 2, 7, "b", None, "2"), ("c", 3, 7, "c", 3, "-1e1")],
        "snapshot_ts string, signal int, constant int, text_col string, with_na int, number_text string",
    )
    got, report = encode.select_by_variance(df)
    assert got.columns == ["snapshot_ts", "signal", "number_text"] and got.count() == 3
    assert got.first()["number_text"] == "1.5"
    assert report.dropped == ["constant"] and report.non_numeric == ["text_col", "with_na"]
    kept, _ = encode.select_by_variance(df, keep=("constant", "with_na"))
    assert kept.columns == ["snapshot_ts", "signal", "constant", "with_na", "number_text"]
    assert encode.select_by_variance(df, threshold=1.0)[0].columns == ["snapshot_ts", "number_text"]
    with pytest.raises(ValueError, match="no feature"):
        encode.select_by_variance(df.select("snapshot_ts", "constant"))


def test_profiles(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), (None, 2)], "c string, n int")
    assert tuple(profile.table_shape(df).first()) == (3, 2)
    assert as_set(profile.table_shape(df, "c")) == {("a", 2, 1), (None, 1, 1)}
    assert as_set(profile.null_counts(df)) == {("c", 1), ("n", 1)}
    assert as_set(profile.null_counts(df, "c")) == {("a", "n", 1), (None, "n", 0)}
    assert as_set(profile.value_counts(df)) == {("c", "a", 2), ("c", "<NA>", 1), ("n", "2", 2), ("n", "<NA>", 1)}
    assert as_set(profile.value_counts(df, ("c",))) == {("n", "2", 2), ("n", "<NA>", 1)}
    assert as_set(profile.column_inventory(df)) == {(0, "c", "string"), (1, "n", "int")}
    assert set(reports.table_profile(df)) == {"columns", "shape", "nulls", "values"}


def test_daily_records(spark):
    df = spark.sql(
        "select explode(array(timestamp'2025-01-01 23:59:59', timestamp'2025-01-01', timestamp'2025-01-04', null)) as snapshot_ts"
    )
    got = [(str(r["day"]), r["records"]) for r in profile.daily_records(df).orderBy("day").collect()]
    assert got == [("2025-01-01", 2), ("2025-01-02", 0), ("2025-01-03", 0), ("2025-01-04", 1)]
    assert profile.daily_records(df.limit(0)).count() == 0
    with pytest.raises(KeyError):
        profile.daily_records(df, "other")


def test_correlation_with_constant(spark):
    rng = np.random.default_rng(5)
    data = [(str(a), "only", int(b)) for a, b in zip(rng.choice(list("xy"), 60), rng.integers(0, 3, 60))]
    data += [(None, "only", 1), ("x", "only", None)]
    df = spark.createDataFrame(data, "a string, k string, b int")
    found = profile.one_hot_correlation(df, ["a", "k", "b"]).collect()
    got = {(r["a"], r["b"]): r["corr"] for r in found}
    counts = {r["name"]: r["rows"] for r in profile.indicator_counts(df, ["a", "k", "b"]).collect()}
    n = len(data)
    # Indicators of one column never meet: their correlation follows from the counts.
    for a, x in counts.items():
        for b, y in counts.items():
            if (a, b) not in got:
                got[a, b] = -x * y / np.sqrt(float(x * (n - x) * y * (n - y))) if x < n and y < n else None
    flags = {f"{c}_{v}": [float(r[i] == v) for r in data] for i, c in enumerate("akb") for v in {r[i] for r in data} - {None}}
    assert len(got) == len(flags) ** 2
    for (a, b), corr in got.items():
        if "k_only" in (a, b):
            assert corr is None
        else:
            assert corr == pytest.approx(np.corrcoef(flags[a], flags[b])[0, 1])


PORTS = [
    (1, 1, "TYPE_2", 11.0, "SOCKET", "2024-01-01", "AVAILABLE"),
    (1, 1, "TYPE_2", 22.0, "SOCKET", "2024-01-02", "BUSY"),
    (1, 2, "CHADEMO", 50.0, None, "2024-01-01", "BUSY"),
    (2, 3, "TYPE_2", 11.0, "SOCKET", "2024-01-01", None),
    (2, 4, "TYPE_2", 11.0, "SOCKET", "2024-01-01", "BUSY"),
    (2, 4, "TYPE_2", None, "SOCKET", None, "BUSY"),
]


def ports(spark):
    return spark.createDataFrame(
        PORTS,
        "port_station_id int, port_id int, port_connector_type string, port_power_kw double, "
        "port_charging_mechanism string, port_last_updated string, port_status string",
    )


def test_port_study(spark):
    found = reports.port_study(ports(spark))
    assert tuple(found["totals"].first()) == (2, 1, 1, 0)
    assert as_set(found["varying_stations"]) == {(1, 2, 3, 1)}
    assert as_set(found["combos"]) == {("TYPE_2", 11.0, "SOCKET", 3), ("TYPE_2", 22.0, "SOCKET", 1)}
    assert as_set(found["multi_combo_stations"]) == {(1, "TYPE_2", 11.0, "SOCKET", 1, 2), (1, "TYPE_2", 22.0, "SOCKET", 1, 2)}
    changed = found["changed_ports"].collect()
    assert {r["port_id"] for r in changed} == {1, 4} and len(changed) == 4
    assert {r["copies"] for r in changed} == {1}
    twice = reports.port_study(ports(spark).union(ports(spark)))["changed_ports"]
    assert twice.count() == 4 and twice.agg(F.sum("copies")).first()[0] == 8
    assert tuple(found["duplicates"].first()) == (6, 4, 0) and found["duplicate_rows"].count() == 0


def test_combo_without_null_keys(spark):
    got = studies.combo_frequencies(ports(spark), ["port_connector_type", "port_charging_mechanism"], "port_id", "port_station_id")
    assert as_set(got) == {(1, "TYPE_2", "SOCKET", 1), (2, "TYPE_2", "SOCKET", 2)}


def test_contracts(spark):
    good = ("2025-01-01", 1, 10, 2, 1, 1, 0.5)
    df = spark.createDataFrame(
        [good, ("2025-01-01", 1, None, 2, 3, -1, 1.5)],
        "snapshot_ts string, st_id int, st_location_id int, total_ports int, available_ports int, unavailable_ports int, unavailable_rate double",
    )
    broken = {r["rule"]: r["violations"] for r in quality.contract_violations(df, quality.series_rules()).collect()}
    assert {k for k, v in broken.items() if v} == {
        "st_location_id not null",
        "unavailable_ports >= 0",
        "unavailable_rate in [0, 1]",
        "available_ports <= total_ports",
    }
    with pytest.raises(ValueError, match="contract broken"):
        quality.enforce(quality.contract_violations(df, quality.series_rules()))
    quality.enforce(quality.contract_violations(df.filter("st_location_id = 10"), quality.series_rules()))
    empty = quality.contract_violations(df.limit(0), quality.series_rules()).filter("violations > 0").collect()
    assert [r["rule"] for r in empty] == ["not empty"]
    rows.same_columns(df.columns, df.columns[::-1])
    with pytest.raises(ValueError, match="missing \\[\\], unexpected"):
        rows.same_columns(df.columns, ["st_id"])


def test_metric_gate(spark):
    schema = "requested_horizon_minutes int, effective_horizon_minutes int, auc double, logloss double, brier double"
    good = spark.createDataFrame([(10, 10, 0.5, 1.5, 0.0), (15, 20, None, 0.1, 1.0)], schema)
    quality.enforce(quality.metric_gate(good))
    bad = spark.createDataFrame([(10, 10, 0.49, 1.51, 1.01)], schema)
    assert quality.metric_gate(bad).filter("violations > 0").count() == 3


def brute_auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [1, 17])
def test_auc(spark, digits):
    rng = np.random.default_rng(digits)
    pairs = [(int(y), float(round(s, digits))) for y, s in zip(rng.integers(0, 2, 200), rng.random(200))] + [(1, 1.0), (0, 0.0)]
    df = spark.createDataFrame(pairs, "target int, score double")
    assert metrics.exact_auc(df).first()[0] == pytest.approx(brute_auc(pairs))
    assert metrics.exact_auc(df.filter("target = 1")).first()[0] is None


def test_binary_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.5), (0, 0.1), (0, 0.0)], "target int, score double")
    r = metrics.binary_metrics(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (0.6, 0.5, 0.5, 0.5)
    assert r["balanced_accuracy"] == pytest.approx((0.5 + 2 / 3) / 2)
    assert r["brier"] == pytest.approx((0.01 + 0.36 + 0.25 + 0.01) / 5)
    assert r["logloss"] == pytest.approx(-(math.log(0.9) + math.log(0.4) + math.log(0.5) + math.log(0.9)) / 5)
    none = metrics.binary_metrics(spark.createDataFrame([(0, 0.0), (0, 0.2)], "target int, score double")).first()
    assert (none["precision"], none["recall"], none["f1"], none["balanced_accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_contract_report(spark):
    df = spark.createDataFrame(
        [(1, "3", 1.0, float("nan"), True, None), (2, "x", 2.5, 0.5, None, "2024-01-01T00:00:00Z"), (None, " 7 ", 3.0, 2.0, False, "never")],
        "id long, `text n` string, whole double, rate double, flag boolean, at string",
    ).withColumn("list", F.array(F.lit(1)))
    contract = quality.Contract(
        (
            quality.Field("id", "bigint"), quality.Field("text n", "bigint", low=4), quality.Field("whole", "int"),
            quality.Field("rate", "double", high=1.0), quality.Field("flag", "int", nullable=True), quality.Field("at", "timestamp", nullable=True),
            quality.Field("list", "bigint"), quality.Field("id2", "bigint"),
        ),
        (quality.Rule("more", "`text n` > id", ("text n", "id")), quality.Rule("lists", "size(list) > 0", ("list",))),
    )
    got = {r["rule"]: r["violations"] for r in quality.contract_report(df, contract).collect()}
    assert {rule: n for rule, n in got.items() if n} == {
        "id not null": 1, "text n is bigint": 1, "text n >= 4": 1, "whole is int": 1, "rate not null": 1, "rate <= 1.0": 1,
        "at is timestamp": 1, "list is bigint": 1, "id2 present": 1, "more": 2, "lists": 1,
    }
    assert "flag not null" not in got and got["flag is int"] == 0 and got["rows >= 1"] == 0
    strict = quality.contract_report(df.select("id").limit(0), quality.Contract((), strict=True))
    assert {tuple(r) for r in strict.collect()} == {("id unexpected", 1), ("rows >= 1", 1)}
    with pytest.raises(ValueError, match="id2 present"):
        quality.enforce(quality.contract_report(df, contract))


def test_series_contract_compares_types(spark):
    good = spark.sql(
        "select timestamp'2024-01-01' as snapshot_ts, 1L as st_id, 2L as st_location_id, 2 as total_ports, 1 as available_ports, "
        "1 as unavailable_ports, 0.5D as unavailable_rate, 'x' as other"
    )
    quality.enforce(quality.contract_report(good, quality.SERIES_CONTRACT))
    for column, value, rule in [("st_id", "'a1'", "st_id is bigint"), ("total_ports", "1.5D", "total_ports is bigint"), ("snapshot_ts", "5", "snapshot_ts is timestamp")]:
        with pytest.raises(ValueError, match=rule):
            quality.enforce(quality.contract_report(good.withColumn(column, F.expr(value)), quality.SERIES_CONTRACT))


def test_correlation_in_tasks_of_bounded_size(spark, monkeypatch):
    """the pieces of tuples are dealt by their number, and a name of every second row is no key of a join."""
    df = spark.createDataFrame([(i // 2, "x" if i % 2 else f"y{i}", None if i % 3 else 1) for i in range(200)], "a int, b string, k int")
    columns = ["a", "b", "k"]
    monkeypatch.setattr(profile, "FREQUENT", 1)
    plain = sorted(profile.one_hot_correlation(df, columns).collect())
    monkeypatch.setattr(profile, "FREQUENT", 10)
    monkeypatch.setattr(profile, "TASK_PIECES", 100)
    found = profile.one_hot_correlation(df, columns)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ", 19), REPARTITION_BY_NUM" in plan
    rows = sorted(found.collect())
    assert rows == plain
    names = [[f"{c}_{r[c]}" for c in columns if r[c] is not None] for r in df.collect()]
    pairs = Counter((x, y) for held in names for x in held for y in held)
    assert {(r["a"], r["b"]): r["rows"] for r in rows} == pairs

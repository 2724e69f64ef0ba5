import datetime as dt
import json
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from snapgrid.operators import classify, labels, quality
from snapgrid.plans import batch, reports
from snapgrid.schema import FEATURE_COLUMNS, StagePaths
from snapgrid.session import shared_folder

QUICK = classify.TrainSettings(rounds=3, depth=2)


def dense(spark, rows, value):
    """A dense table with all features; ``value(station, step)`` is the state."""
    t0 = dt.datetime(2025, 1, 1)
    data = [(s, t0 + dt.timedelta(minutes=10 * i), float(value(s, i))) for s in range(3) for i in range(rows)]
    df = spark.createDataFrame(data, "st_id int, ts timestamp, available_ports double")
    features = {c: F.lit(0.0) for c in FEATURE_COLUMNS}
    features["hour"] = F.hour("ts").cast("double")
    features["loc_address_postal_code"] = F.when(F.col("st_id") > 0, F.lit("08001"))
    return df.withColumns(features)


def test_required_columns_are_unique():
    columns = labels.label_inputs(FEATURE_COLUMNS)
    assert len(columns) == len(set(columns)) and columns[:4] == ["st_id", "ts", "age_minutes", "available_ports"]


def test_one_class_fails(spark):
    with pytest.raises(ValueError, match="only one class"):
        classify.train_horizon(dense(spark, 12, lambda s, i: 1), 10, QUICK)


def test_no_eligible_rows_fails(spark):
    with pytest.raises(ValueError, match="no eligible rows"):
        classify.train_horizon(dense(spark, 1, lambda s, i: 1), 10, QUICK)


def test_training_learns_the_clock(spark):
    table = dense(spark, 300, lambda s, i: 0 if (i // 6) % 24 < 8 else 2)
    settings = classify.TrainSettings(rounds=20, depth=3, learning_rate=0.5, balance_classes=True)
    model, scored, metrics = classify.train_horizon(table, 15, settings)
    row = metrics.first()
    assert row["effective_horizon_minutes"] == 20 and row["rows_horizon"] == 298 * 3
    assert row["rows_train"] + row["rows_valid"] == row["rows_horizon"] == row["rows_train"] + scored.count()
    assert row["auc"] > 0.9 and row["logloss"] < 0.5 and row["scale_pos_weight_value"] > 1
    assert row["feature_list"] == FEATURE_COLUMNS and row["n_stations_valid"] == 3
    quality.enforce(quality.metric_gate(metrics))
    assert scored.filter("score < 0 or score > 1").isEmpty()


def test_trees_by_aggregations_learn_the_clock(spark, tmp_path):
    table = dense(spark, 300, lambda s, i: 0 if (i // 6) % 24 < 8 else 2)
    settings = classify.TrainSettings(rounds=4, depth=2, learning_rate=0.5, balance_classes=True, column_share=1.0)
    labelled = classify.training_table(table, [20], settings)
    nodes, scored, metrics = classify.train_trees(labelled, 20, settings)
    row, other = metrics.first(), classify.train_labelled(labelled, 20, settings)[2].first()
    assert metrics.columns == classify.train_labelled(labelled, 20, settings)[2].columns
    assert row["rows_train"] == other["rows_train"] and row["best_iteration"] == max(n.tree for n in nodes)
    assert row["auc"] > 0.9 and scored.count() == row["rows_valid"]
    paths = StagePaths(str(tmp_path))
    table.write.parquet(paths.path("dense"))
    assert batch.train(spark, paths, classify.TrainSettings(rounds=1, depth=1), by_aggregations=True).count() == 3
    assert spark.read.parquet(f"{paths.path('nodes')}/horizon_30m").count() in (1, 3)


def test_stale_rows_are_dropped_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "dense")
    dense(spark, 5, lambda s, i: i).withColumn("unused", F.lit("x")).write.parquet(path)
    labelled = labels.with_labels(spark.read.parquet(path), [10, 20, 30])
    row = labels.eligible_rows(labelled, 30).select("st_id", "ts", "target")
    plan = row._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(available_ports)" in plan and "unused" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_impute(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0)], "a double, b double")
    got, names = classify.impute_features(df, ["a", "b"], ["a"])
    assert names == ["a", "b", "a_missing"]
    assert [(r["a"], r["a_missing"]) for r in got.collect()] == [(1.0, 0), (-1.0, 1)]


def snapshot_files(folder, days=4):
    """Snapshots every 20 minutes of 3 locations with 2 stations of 2 ports."""
    folder.mkdir(parents=True)
    rng = random.Random(1)
    t0 = dt.datetime(2024, 3, 30)
    for step in range(days * 72):
        now = (t0 + dt.timedelta(minutes=20 * step)).isoformat() + "Z"
        locations = []
        for loc in range(3):
            stations = []
            for st in range(2):
                ports = [
                    {
                        "id": loc * 100 + st * 10 + p,
                        "connector_type": ["TYPE_2", "CHADEMO"][p],
                        "power_kw": [11, 50][st],
                        "charging_mechanism": "SOCKET",
                        "last_updated": now,
                        "notes": None,
                        "port_status": [{"status": rng.choice(["AVAILABLE", "IN_USE"])}],
                        "authentications": [],
                    }
                    for p in range(2)
                ]
                stations.append({"id": loc * 10 + st, "label": "s", "ports": ports})
            locations.append(
                {
                    "id": loc,
                    "last_updated": now,
                    "onstreet_location": "true" if loc else "false",
                    "coordinates": {"latitude": 41.0 + loc, "longitude": 2.0},
                    "address": {"address_string": "x", "postal_code": f"0800{loc}"},
                    "opening_hours": [{"weekday_begin": 1, "weekday_end": 7, "hour_begin": "0:00", "hour_end": "24:00"}],
                    "stations": stations,
                }
            )
        (folder / f"2024_{step:04d}.json").write_text(json.dumps({"locations": locations}))


def test_whole_chain(spark, tmp_path):
    paths = StagePaths(str(tmp_path))
    snapshot_files(tmp_path / "raw" / "json", days=3)
    metrics = batch.run(spark, paths, QUICK)
    assert {r["horizon"] for r in metrics.select("horizon").collect()} == {10, 20, 30}
    series = spark.read.parquet(paths.path("timeseries"))
    assert series.filter("available_ports + unavailable_ports != total_ports or total_ports != 2").isEmpty()
    assert series.count() == 6 * 3 * 72
    # Every text column is encoded, those with a value for each location too.
    dictionary = spark.read.parquet(paths.path("encoded_dictionary"))
    texts = [c for c, kind in series.dtypes if kind == "string"]
    counts = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.sum("count").alias("n")).collect()}
    assert counts == {c: series.filter(F.col(c).isNotNull()).count() for c in texts if series.filter(F.col(c).isNotNull()).count()}
    ones = spark.read.parquet(paths.path("encoded_indicators"))
    assert ones.count() == sum(counts.values())
    chosen = spark.read.parquet(paths.path("selected_dictionary"))
    assert {r["column"] for r in chosen.select("column").distinct().collect()} >= {"loc_address_postal_code"}
    assert spark.read.parquet(paths.path("selected_indicators")).join(chosen, "indicator").count() == chosen.agg(F.sum("count")).first()[0]
    dense_table = spark.read.parquet(paths.path("dense"))
    per = dense_table.groupBy("st_id").agg(F.count("*").alias("n"), F.countDistinct("ts").alias("d"), F.min("ts"), F.max("ts"))
    for r in per.collect():
        assert r["n"] == r["d"] == (r[4] - r[3]).total_seconds() / 600 + 1
    assert dense_table.agg(F.sum("is_stale")).first()[0] == 0
    assert dense_table.filter("is_observed = 0").count() > 0
    PipelineModel.load(f"{paths.path('models')}/horizon_10m")
    nodes = spark.read.parquet(f"{paths.path('nodes')}/horizon_10m")
    assert nodes.agg(F.max("tree")).first()[0] == metrics.filter("horizon = 10").first()["best_iteration"]
    tables = reports.gap_report(spark, paths.path("selected"), output_csv=str(tmp_path / "coverage"))
    assert {"gap_hours", "label_coverage", "occupied_rate"} <= set(tables)
    assert tables["gap_hours"].first()["p50"] == pytest.approx(1 / 3)
    profile = reports.stage_profile(spark, paths)
    assert profile["shape"].first()["n_rows"] == 6 * 3 * 72
    assert "st_ports" not in {r["column"] for r in profile["values"].select("column").distinct().collect()}
    assert reports.daily_coverage(spark, paths.path("selected")).count() == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "coverage")).count() == 5


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_patience():
    falling = [1 / (i + 1) for i in range(50)]
    assert classify.best_round(falling, 30) == (49, False)
    assert classify.best_round(falling[:10] + [1.0] * 30, 30) == (9, True)
    assert classify.best_round(falling[:10] + [1.0] * 29 + [0.0], 30) == (39, False)
    assert classify.best_round([0.5, 0.5, 0.4, 0.6, 0.4], 2) == (2, True)


def test_equal_rows_are_fitted_as_blocks(spark, monkeypatch):
    table = dense(spark, 300, lambda s, i: 0 if (i // 6) % 24 < 8 or (s + i) % 11 == 0 else 2)
    settings = classify.TrainSettings(rounds=3, depth=3, learning_rate=0.5, balance_classes=True, row_share=1.0, column_share=1.0)
    labelled = classify.training_table(table, [20], settings)
    start = classify.prepared(labelled, 20, settings)
    kind, n = [*start.features, "label"], start.facts["rows_train"]
    kinds = start.ready.filter("not is_valid").select(*kind).distinct().count()
    fitted = []
    plain = Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, params=None: fitted.append(df) or plain(self, df, params))
    scores = []
    for most in (n, 3 * kinds, 1):
        monkeypatch.setattr(classify, "FIT_ROWS", most)
        _, scored, metrics = classify.train_labelled(labelled, 20, settings)
        scores.append(({(r["st_id"], r["ts"]): r["score"] for r in scored.collect()}, metrics.first()["best_iteration"]))
    rows, several, single = fitted
    assert rows.count() == n > 5 * kinds and single.count() == kinds < several.count() < n / 2
    sums = [{tuple(r)[:-1]: round(r["w"], 6) for r in df.groupBy(*kind).agg(F.sum("weight").alias("w")).collect()} for df in fitted]
    assert sums[0] == sums[1] == sums[2] and len(sums[0]) == kinds
    # Without draws the trees are those of the rows.
    for found, best in scores[1:]:
        assert best == scores[0][1] and found == pytest.approx(scores[0][0], abs=1e-9)

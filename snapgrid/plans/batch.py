"""The whole chain. Each stage writes its table and the next one reads it, so no lineage outlives a
stage and a lost executor never costs more than the stage it worked on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapgrid.operators import classify, encode, grid, labels, quality, rows, state, trees
from snapgrid.plans.ingest import extract_ports, extract_stations, locations
from snapgrid.schema import HORIZON_MINUTES, STATE_COLUMNS, STATIC_COLUMNS, StagePaths
from snapgrid.session import use_utc
from snapgrid.sources.sinks import save_model, write_counted, write_metrics, write_table
from snapgrid.sources.tables import read_stage

#: The number of a row of the series, which its indicators refer to.
ROW = "row_id"
SERIES_COLUMNS = ["snapshot_ts", "st_id", *STATE_COLUMNS, *STATIC_COLUMNS]


def ingest(spark: SparkSession, paths: StagePaths) -> None:
    """Documents converted, opening hours derived, all location tables consolidated, stations and ports unnested."""
    versions = write_table(locations(spark, paths), paths.path("locations"))
    stations = write_table(extract_stations(versions), paths.path("stations"))
    write_table(extract_ports(stations), paths.path("ports"))


def timeseries(spark: SparkSession, paths: StagePaths) -> DataFrame:
    tables = [read_stage(spark, paths.path(stage)) for stage in ("locations", "stations", "ports")]
    return write_table(state.station_timeseries(*tables), paths.path("timeseries"))


def encoded(spark: SparkSession, paths: StagePaths, wide: tuple[str, ...] = ()) -> DataFrame:
    """One-hot encoding of every text column of the series (and of booleans with nulls).

    Names and descriptions have a value for nearly every station, so the matrix is kept as its ones: the table
    ``encoded_dictionary`` numbers the values, ``encoded_indicators`` has a row for each ``row_id`` of the series and
    value it has. Columns named by ``wide`` become a column for each value instead. Text that a later stage reads
    stays in the series, other encoded text leaves it.
    """
    series = read_stage(spark, paths.path("timeseries"))
    flags = encode.one_hot(series, values=encode.categories(series, list(wide)))
    kept = write_table(flags.withColumn(ROW, F.monotonically_increasing_id()), paths.path("encoded_rows"))
    columns = encode.encodable(kept, "snapshot_ts")
    dictionary = write_table(encode.value_dictionary(kept, columns), paths.path("encoded_dictionary"))
    write_table(encode.indicators(kept, [ROW], columns, dictionary), paths.path("encoded_indicators"))
    gone = [c for c in columns if c not in SERIES_COLUMNS]
    return write_table(kept.drop(*gone), paths.path("encoded"))


def selected(spark: SparkSession, paths: StagePaths, threshold: float = 0.0) -> DataFrame:
    """The columns and the indicators that vary more than ``threshold``."""
    series = read_stage(spark, paths.path("encoded"))
    found = encode.select_by_variance(series.drop(ROW), threshold, keep=tuple(SERIES_COLUMNS))[0].columns
    table = write_table(series.select(ROW, *[F.col(rows.quoted(c)) for c in found]), paths.path("selected"))
    quality.enforce(quality.contract_report(table, quality.SERIES_CONTRACT))
    varying = encode.indicator_variance(read_stage(spark, paths.path("encoded_dictionary")), table.count(), threshold)
    kept = write_table(varying, paths.path("selected_dictionary")).select("indicator")
    ones = read_stage(spark, paths.path("encoded_indicators"))
    write_table(rows.lookup_join(ones, kept, ["indicator"], "left_semi"), paths.path("selected_indicators"))
    return table


def dense(spark: SparkSession, paths: StagePaths, static_until=None) -> tuple[int, int]:
    """Rows and stations written. ``static_until`` keeps later data out of the static columns."""
    series = read_stage(spark, paths.path("selected"), columns=SERIES_COLUMNS)
    table = grid.dense_grid(grid.bucket_latest(series), static_until=static_until)
    return write_counted(table, paths.path("dense"), "st_id")


def train(
    spark: SparkSession,
    paths: StagePaths,
    settings: classify.TrainSettings = classify.TrainSettings(),
    by_aggregations: bool = False,
) -> DataFrame:
    """One model and one metrics record per horizon; returns all metrics records.

    Beside each model stands the table of its nodes up to the best round, which is what scores rows (``trees.with_scores``).
    With ``by_aggregations`` the trees are boosted by ``trees.boost``, and the nodes are the model.
    """
    columns = labels.label_inputs(settings.features)
    grid_table = read_stage(spark, paths.path("dense"), columns=columns, ts="ts")
    table = classify.training_table(grid_table, HORIZON_MINUTES, settings)
    for horizon in HORIZON_MINUTES:
        if by_aggregations:
            found, _, metrics = classify.train_trees(table, horizon, settings)
            nodes = trees.node_frame(spark, found)
        else:
            model, _, metrics = classify.train_labelled(table, horizon, settings)
            save_model(model, f"{paths.path('models')}/horizon_{horizon}m")
            nodes = trees.first_rounds(classify.model_nodes(model), metrics.first()["best_iteration"] + 1)
        write_table(nodes, f"{paths.path('nodes')}/horizon_{horizon}m")
        write_metrics(metrics, f"{paths.path('metrics')}/horizon={horizon}")
    return spark.read.json(paths.path("metrics"))


def run(spark: SparkSession, paths: StagePaths, settings: classify.TrainSettings = classify.TrainSettings()) -> DataFrame:
    use_utc(spark)
    ingest(spark, paths)
    timeseries(spark, paths)
    encoded(spark, paths)
    selected(spark, paths)
    dense(spark, paths)
    metrics = train(spark, paths, settings)
    quality.enforce(quality.metric_gate(metrics))
    return metrics

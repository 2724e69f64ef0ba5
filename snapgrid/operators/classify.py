"""Gradient-boosted classifiers per horizon with ``pyspark.ml``."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, fields

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapgrid.functions.time import grid_steps
from snapgrid.operators.labels import eligible_rows, label_inputs, label_split, split_point, with_labels
from snapgrid.operators.metrics import binary_metrics, exact_auc, split_counts
from snapgrid.operators.trees import BoostSettings, Node, boost, first_rounds, read_nodes, with_scores
from snapgrid.schema import FEATURE_COLUMNS, GRID_MINUTES
from snapgrid.session import materialize, shared_folder

SENTINEL = -1.0
#: Trees are grown on the rows themselves up to this number, on blocks of equal rows beyond it.
FIT_ROWS = 1 << 19


@dataclass(frozen=True)
class TrainSettings:
    """Fixed values of the model; ``rounds`` is an upper bound, ``patience`` rounds without gain end sooner."""

    rounds: int = 800
    learning_rate: float = 0.05
    depth: int = 6
    row_share: float = 0.8
    column_share: float = 0.8
    min_gain: float = 0.0
    patience: int = 30
    seed: int = 42
    threshold: float = 0.5
    balance_classes: bool = False
    split_mode: str = "timestamps"
    features: list[str] = field(default_factory=lambda: list(FEATURE_COLUMNS))


def impute_features(df: DataFrame, features: list[str], nullable: list[str]) -> tuple[DataFrame, list[str]]:
    """Trees here do not route nulls: a sentinel and a 0/1 indicator stand in for each nullable feature."""
    flags = {f"{c}_missing": F.col(c).isNull().cast("int") for c in nullable}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(SENTINEL)) for c in nullable}
    return df.withColumns(flags).withColumns(filled), features + list(flags)


def classifier(settings: TrainSettings, features: list[str], rounds: int) -> Pipeline:
    assemble = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    boost = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=rounds,
        stepSize=settings.learning_rate,
        maxDepth=settings.depth,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=str(settings.column_share),
        minInfoGain=settings.min_gain,
        seed=settings.seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[assemble, boost])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


def training_table(
    grid: DataFrame,
    horizons: list[int],
    settings: TrainSettings = TrainSettings(),
    key: str = "st_id",
    state: str = "available_ports",
) -> DataFrame:
    """Features as floats and the labels of all horizons, written once to the shared folder.

    Text features are numbers in text (postal codes); what is no number counts as missing.
    """
    labelled = with_labels(grid, horizons, key, state)
    floats = {c: F.col(c).try_cast("float") for c in settings.features}
    kept = [*label_inputs(settings.features, key, state=state), *[f"{state}_in_{h}" for h in horizons]]
    return materialize(labelled.select(*kept).withColumns(floats), "labelled")


def train_horizon(
    grid: DataFrame,
    horizon_minutes: int,
    settings: TrainSettings = TrainSettings(),
    key: str = "st_id",
    state: str = "available_ports",
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """One horizon straight from the dense grid."""
    labelled = training_table(grid, [horizon_minutes], settings, key, state)
    return train_labelled(labelled, horizon_minutes, settings, key, state)


@dataclass(frozen=True)
class Prepared:
    """What a fit of one horizon starts from; everything in it follows from the table alone."""

    ready: DataFrame
    features: list[str]
    weight: float
    facts: dict


def prepared(
    labelled: DataFrame,
    horizon_minutes: int,
    settings: TrainSettings = TrainSettings(),
    key: str = "st_id",
    state: str = "available_ports",
) -> Prepared:
    """Eligible rows of one horizon, split, imputed and weighted, with the counts of both sides.

    All counts come from one aggregation. A feature without nulls in either part stays as it is.
    """
    effective = grid_steps(horizon_minutes, GRID_MINUTES)[1]
    table = eligible_rows(labelled, horizon_minutes, state)
    point = split_point(table, mode=settings.split_mode).first()
    if not point["distinct_ts"]:
        raise ValueError(f"no eligible rows for horizon {horizon_minutes} min")
    sided = label_split(table, point["cut_us"])
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in settings.features]
    counts = {r["split"]: r for r in split_counts(sided, key, "target", "split", "ts", *nulls).collect()}
    if len(counts) < 2:
        raise ValueError("the temporal split left one side empty")
    nullable = [c for c in settings.features if any(r[f"null_{c}"] for r in counts.values())]
    positive = counts["train"]["positive"]
    negative = counts["train"]["rows"] - positive
    if not positive or not negative:
        raise ValueError(f"horizon {horizon_minutes} min: only one class ({positive} positive, {negative} negative)")
    weight = negative / positive if settings.balance_classes else 1.0
    filled, features = impute_features(sided, settings.features, nullable)
    ready = filled.select(
        key,
        "ts",
        "target",
        *features,
        F.col("target").cast("double").alias("label"),
        (F.col("split") == "valid").alias("is_valid"),
        F.when(F.col("target") == 1, F.lit(weight)).otherwise(F.lit(1.0)).alias("weight"),
    )
    # Names of the metrics record.
    facts = {
        "requested_horizon_minutes": horizon_minutes,
        "effective_horizon_minutes": effective,
        "rows_horizon": counts["train"]["rows"] + counts["valid"]["rows"],
        "rows_train": counts["train"]["rows"],
        "rows_valid": counts["valid"]["rows"],
        "positive_rate_train": counts["train"]["positive_rate"],
        "positive_rate_valid": counts["valid"]["positive_rate"],
        "n_stations_train": counts["train"]["n_stations"],
        "n_stations_valid": counts["valid"]["n_stations"],
        "use_scale_pos_weight": settings.balance_classes,
        "scale_pos_weight_value": float(weight),
        "classification_threshold": settings.threshold,
    }
    return Prepared(ready, features, weight, facts)


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """The round (from 0) with the least loss before ``patience`` rounds in a row brought none better, and whether
    the losses reach that far."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            return best, True
    return best, False


def fit_rows(start: Prepared, key: str = "st_id", most: int | None = None) -> DataFrame:
    """The training rows as trees are grown on them: above ``most``, equal rows (features and label) are put together in
    blocks that weigh as much as their rows.

    Splits and leaves take sums of weights and gradients, and equal rows have equal gradients in every round, so blocks grow
    the trees of their rows; all rows count. Only the share of rows that a round sees is drawn by blocks. Each kind of row
    is therefore dealt by station and instant to as many blocks as ``most`` has room for; beyond that many kinds, each is
    one block. Clock, freshness and flags have few values together, however long the table is.
    """
    most = FIT_ROWS if most is None else most
    train = start.ready.filter("not is_valid")
    if start.facts["rows_train"] <= most:
        return train
    kind = [*start.features, "label"]
    kinds = train.agg(F.approx_count_distinct(F.xxhash64(*kind))).first()[0]
    block = F.pmod(F.xxhash64(key, F.unix_micros("ts")), F.lit(max(1, most // kinds))).alias("_block")
    blocks = train.groupBy(*kind, block).agg(F.sum("weight").alias("weight"))
    # One part for each core, in a fixed order: rounds draw by place.
    cores = train.sparkSession.sparkContext.defaultParallelism
    dealt = blocks.repartition(cores, *kind, "_block").sortWithinPartitions(*kind, "_block")
    return materialize(dealt.drop("_block"), "fit-rows")


def fit_best(start: Prepared, settings: TrainSettings, key: str = "st_id") -> tuple[PipelineModel, int]:
    """Boosting until the loss on the validation side has not gained for ``patience`` rounds, and the number of rounds
    up to the best one.

    Rounds are tried in doubling numbers. The model keeps those beyond the best, nothing is fitted again: scoring takes
    the first rounds of its nodes.
    """
    train, valid = fit_rows(start, key), start.ready.filter("is_valid")
    rounds = min(settings.rounds, 2 * settings.patience)
    while True:
        model = classifier(settings, start.features, rounds).fit(train)
        assembled = model.stages[0].transform(valid)
        best, settled = best_round(model.stages[1].evaluateEachIteration(assembled), settings.patience)
        if settled or rounds == settings.rounds:
            return model, best + 1
        rounds = min(settings.rounds, 2 * rounds)


def model_nodes(model: PipelineModel) -> DataFrame:
    """The trees of a fitted ensemble as a table of nodes (see :mod:`snapgrid.operators.trees`).

    Read from the model as it is saved; each tree's weight is part of its values. The ensemble's score is the
    logistic function of twice its sum, so the values are doubled.
    """
    spark = SparkSession.active()
    boosted, names = model.stages[-1], model.stages[0].getInputCols()
    path = f"{shared_folder(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    boosted.write().save(path)
    weights = F.array(*[F.lit(w) for w in boosted.treeWeights])
    split = F.col("nodeData.split")
    leaf = F.col("nodeData.leftChild") < 0
    column = F.get(F.array(*[F.lit(n) for n in names]), split["featureIndex"])

    def inner(value: Column) -> Column:
        return F.when(~leaf, value)

    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        inner(column).alias("feature"),
        inner(split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        inner(F.lit(False)).alias("missing_left"),
        inner(F.col("nodeData.leftChild")).alias("left"),
        inner(F.col("nodeData.rightChild")).alias("right"),
        inner(F.col("nodeData.gain")).alias("gain"),
        F.when(leaf, 2 * F.get(weights, F.col("treeID")) * F.col("nodeData.prediction")).alias("value"),
    )


def train_labelled(
    labelled: DataFrame,
    horizon_minutes: int,
    settings: TrainSettings = TrainSettings(),
    key: str = "st_id",
    state: str = "available_ports",
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Split, fit and score one horizon: the model, scored validation rows and a metrics row.

    The model has the rounds beyond the best too; the scores are those of the best (``best_iteration``, from 0). No label or score is collected: all metrics come from two aggregations.
    """
    start = prepared(labelled, horizon_minutes, settings, key, state)
    model, rounds = fit_best(start, settings, key)
    nodes = read_nodes(first_rounds(model_nodes(model), rounds))
    return model, *evaluated(start, nodes, rounds, horizon_minutes, settings, key)


def train_trees(
    labelled: DataFrame,
    horizon_minutes: int,
    settings: TrainSettings = TrainSettings(),
    key: str = "st_id",
    state: str = "available_ports",
) -> tuple[list[Node], DataFrame, DataFrame]:
    """The same with trees boosted by aggregations: the nodes up to the best round, scored rows and a metrics row.

    Leaf values have an L2 term, each tree sees its own share of rows and features.
    """
    start = prepared(labelled, horizon_minutes, settings, key, state)
    shared = {f.name for f in fields(BoostSettings)} & {f.name for f in fields(TrainSettings)}
    nodes, _ = boost(start.ready, start.features, BoostSettings(**{name: getattr(settings, name) for name in shared}))
    return nodes, *evaluated(start, nodes, max(n.tree for n in nodes) + 1, horizon_minutes, settings, key)


def evaluated(
    start: Prepared, nodes: list[Node], rounds: int, horizon_minutes: int, settings: TrainSettings, key: str
) -> tuple[DataFrame, DataFrame]:
    """The validation rows with their scores, and the metrics row."""
    scored = with_scores(start.ready.filter("is_valid"), nodes).select(key, "ts", "target", "score")
    measured = materialize(scored, f"scores-{horizon_minutes}")
    facts = start.facts | {"best_iteration": rounds - 1}
    auc = exact_auc(measured).first()["auc"]
    rest = binary_metrics(measured, threshold=settings.threshold)
    metrics = rest.select(
        *[F.lit(v).alias(k) for k, v in facts.items()],
        F.array(*[F.lit(c) for c in settings.features]).alias("feature_list"),
        F.lit(auc).cast("double").alias("auc"),
        *[c for c in rest.columns if c not in ("rows", "positive_rate")],
    )
    return measured, metrics

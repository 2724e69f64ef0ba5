"""Trees as tables of nodes: boosted by aggregations, cut to their first rounds, scored by column expressions.

A node is a row: its tree and number, and either a split (``feature``, ``threshold``, the numbers of both children, where
missing values go) or a ``value``. Values at most the threshold go left. A row's margin is the sum of the
values it reaches, its score the logistic function of that. A table of nodes grows with the model, not with the data: it
may be read on the driver, and becomes one expression there.

Boosting needs gradients and curvatures summed up by (node, feature, value) and nothing else, so one level of a tree
is one aggregation, combined on the map side, whatever the number of rows; what is left is bounded by nodes,
features and bins. A feature with at most ``bins`` distinct values is split at any of them, others at quantiles.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapgrid.operators.metrics import CLIP
from snapgrid.operators.rows import quoted
from snapgrid.session import materialize

NODES = (
    "tree int, node int, feature string, threshold double, missing_left boolean, left int, right int, gain double, value double"
)


@dataclass(frozen=True)
class Node:
    tree: int
    node: int
    feature: str | None = None
    threshold: float | None = None
    missing_left: bool | None = None
    left: int | None = None
    right: int | None = None
    gain: float | None = None
    value: float | None = None


def node_frame(spark: SparkSession, nodes: Iterable[Node]) -> DataFrame:
    return spark.createDataFrame([tuple(vars(n).values()) for n in nodes], NODES)


def read_nodes(nodes: DataFrame) -> list[Node]:
    """A model's nodes, on the driver."""
    return [Node(*row) for row in nodes.select(*[part.split()[0] for part in NODES.split(", ")]).collect()]


def first_rounds(nodes: DataFrame, rounds: int) -> DataFrame:
    """The ensemble as it stood after so many rounds."""
    return nodes.filter(F.col("tree") < rounds)


def _number(value: float) -> str:
    if math.isinf(value):
        return f"double('{'-' if value < 0 else ''}Infinity')"
    return f"{value!r}D"


def _walk(held: dict[int, Node], at: int, leaf, columns: dict[str, str]) -> str:
    """Nested conditions from a node down; ``leaf`` says what stands where a node has no children."""
    node = held[at]
    if node.feature is None:
        return leaf(node)
    left, right = (_walk(held, child, leaf, columns) for child in (node.left, node.right))
    name = columns.get(node.feature, quoted(node.feature))
    there = f"coalesce({name} <= {_number(node.threshold)}, {'true' if node.missing_left else 'false'})"
    return f"CASE WHEN {there} THEN {left} ELSE {right} END"


def _by_tree(nodes: Iterable[Node]) -> dict[int, dict[int, Node]]:
    trees: dict[int, dict[int, Node]] = {}
    for n in nodes:
        trees.setdefault(n.tree, {})[n.node] = n
    return dict(sorted(trees.items()))


def margin(nodes: Iterable[Node], columns: dict[str, str] | None = None) -> Column:
    """The sum of the values a row reaches, tree by tree, as one expression. The root has the least number of a tree."""
    parts = [_walk(tree, min(tree), lambda n: _number(n.value), columns or {}) for tree in _by_tree(nodes).values()]
    if not parts:
        return F.lit(0.0)
    # One flat list: a chain of additions would be as deep as there are trees.
    return F.expr(f"aggregate(array({', '.join(parts)}), 0D, (s, x) -> s + x)")


def logistic(margin_: Column) -> Column:
    return 1 / (1 + F.exp(-margin_))


def with_scores(df: DataFrame, nodes: Iterable[Node], name: str = "score") -> DataFrame:
    """The rows with the model's score. A null or NaN feature is missing and goes where its node sends it."""
    nodes = list(nodes)
    used = sorted({n.feature for n in nodes if n.feature is not None})
    inner = {f: f"_feature{i}" for i, f in enumerate(used)}
    plain = df.withColumns({inner[f]: F.nullif(F.col(quoted(f)).cast("double"), F.lit(float("nan"))) for f in used})
    return plain.withColumn(name, logistic(margin(nodes, inner))).drop(*inner.values())


# ---------------------------------------------------------------- boosting


@dataclass(frozen=True)
class BoostSettings:
    """``rounds`` is an upper bound, ``patience`` rounds without gain on the validation side end sooner.

    Each tree sees a share of the rows, drawn by a hash of their place, and of the features. ``l2`` weighs against large values, ``min_hessian`` is the least curvature of a side of a split.
    """

    rounds: int = 800
    learning_rate: float = 0.05
    depth: int = 6
    l2: float = 1.0
    min_gain: float = 0.0
    min_hessian: float = 1.0
    bins: int = 256
    patience: int = 30
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    stored: int = 8


def _stacked(df: DataFrame, features: list[str], columns: list[str]) -> DataFrame:
    """One row for each feature: ``_f`` its place, ``_v`` its value, and ``columns``."""
    cells = F.array(*[F.struct(F.lit(i).alias("_f"), F.col(quoted(f)).alias("_v")) for i, f in enumerate(features)])
    return df.select(*columns, F.inline(cells))


def cut_points(df: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """The values at which a feature may be split, ascending: all of them if these are few, else quantiles.

    At most ``bins`` for each feature reach the driver.
    """
    stacked = _stacked(df, features, []).filter("_v is not null")
    values = stacked.groupBy("_f", "_v").agg(F.count(F.lit(1)).alias("_n"))
    sizes = materialize(values, "cut-points")
    many = {r["_f"] for r in sizes.groupBy("_f").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bins).collect()}
    cuts: dict[str, list[float]] = {f: [] for f in features}
    for row in sizes.filter(~F.col("_f").isin(list(many))).select("_f", "_v").collect():
        cuts[features[row["_f"]]].append(row["_v"])
    if many:
        at = [i / bins for i in range(1, bins + 1)]
        found = stacked.filter(F.col("_f").isin(list(many))).groupBy("_f")
        for row in found.agg(F.percentile_approx("_v", at, 100 * bins).alias("q")).collect():
            cuts[features[row["_f"]]] = list(row["q"])
    return {f: sorted(set(c)) for f, c in cuts.items()}


def _binned(column: str, cuts: list[float]) -> str:
    """The least cut point that is not below the value, found by halving; infinity beyond the last, null stays."""
    if not cuts:
        return f"CASE WHEN {column} IS NOT NULL THEN double('Infinity') END"

    def halves(low: int, high: int) -> str:
        if low == high:
            return _number(cuts[low]) if low < len(cuts) else "double('Infinity')"
        middle = (low + high) // 2
        return f"CASE WHEN {column} <= {_number(cuts[middle])} THEN {halves(low, middle)} ELSE {halves(middle + 1, high)} END"

    return f"CASE WHEN {column} IS NOT NULL THEN {halves(0, len(cuts))} END"


def _quality(g: Column, h: Column, l2: float) -> Column:
    return g * g / (h + F.lit(l2))


def _best_splits(sums: DataFrame, settings: BoostSettings) -> DataFrame:
    """The best split of each node from sums by (node, feature, value): the greatest gain, then the first feature, the
    least threshold, missing values to the right. Nodes without one that pays come with a null ``split``."""
    along = Window.partitionBy("_node", "_f").orderBy(F.col("_v").asc_nulls_last())
    so_far, whole = along.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("_node", "_f")
    missing = F.col("_v").isNull()
    at = sums.select(
        "*",
        *[F.sum(c).over(so_far).alias(f"{c}_left") for c in ("g", "h")],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in ("g", "h")],
        *[F.coalesce(F.sum(F.when(missing, F.col(c))).over(whole), F.lit(0.0)).alias(f"{c}_none") for c in ("g", "h")],
    )
    sides = F.array(*[F.struct(F.lit(left).alias("missing_left")) for left in (False, True)])
    each = at.filter(~missing & ~F.col("_v").isin(float("inf"))).select("*", F.inline(sides))
    g = F.col("g_left") + F.when(F.col("missing_left"), F.col("g_none")).otherwise(0.0)
    h = F.col("h_left") + F.when(F.col("missing_left"), F.col("h_none")).otherwise(0.0)
    other_g, other_h = F.col("g_all") - g, F.col("h_all") - h
    gain = _quality(g, h, settings.l2) + _quality(other_g, other_h, settings.l2) - _quality(F.col("g_all"), F.col("h_all"), settings.l2)
    pays = (h >= settings.min_hessian) & (other_h >= settings.min_hessian) & (gain > settings.min_gain)
    split = F.struct(
        gain.alias("gain"), (-F.col("_f")).alias("f"), (-F.col("_v")).alias("v"), (~F.col("missing_left")).alias("missing_right"),
        g.alias("g"), h.alias("h"), other_g.alias("other_g"), other_h.alias("other_h"),
    )
    best = each.groupBy("_node").agg(F.max(F.when(pays, split)).alias("split"))
    totals = sums.filter("_f = 0").groupBy("_node").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    return totals.join(best, "_node", "left").select("_node", "g", "h", "split")


def _grown(df: DataFrame, tree: int, features: list[str], settings: BoostSettings) -> list[Node]:
    """One tree over rows with ``_g`` and ``_h``: one aggregation for each level."""
    nodes: dict[int, Node] = {1: Node(tree, 1, value=0.0)}
    ahead = [1]

    def leaf(g: float, h: float) -> float:
        return -settings.learning_rate * g / (h + settings.l2)

    for level in range(settings.depth):
        place = _walk(nodes, 1, lambda n: str(n.node) if n.node in ahead else "cast(null as int)", {})
        here = df.select("_g", "_h", *[F.col(quoted(f)) for f in features], F.expr(place).alias("_node")).filter("_node is not null")
        sums = _stacked(here, features, ["_node", "_g", "_h"]).groupBy("_node", "_f", "_v").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"))
        found = _best_splits(sums, settings).collect()
        ahead = []
        for row in found:
            at, split = row["_node"], row["split"]
            if split is None:
                nodes[at] = Node(tree, at, value=leaf(row["g"], row["h"]))
                continue
            nodes[at] = Node(
                tree, at, features[-split["f"]], -split["v"], not split["missing_right"], 2 * at, 2 * at + 1, split["gain"]
            )
            nodes[2 * at] = Node(tree, 2 * at, value=leaf(split["g"], split["h"]))
            nodes[2 * at + 1] = Node(tree, 2 * at + 1, value=leaf(split["other_g"], split["other_h"]))
            ahead += [2 * at, 2 * at + 1]
        if not ahead:
            break
    return [nodes[k] for k in sorted(nodes)]


def weighted_logloss(df: DataFrame, margin_: Column, label: str, weight: str) -> DataFrame:
    p = F.greatest(F.least(logistic(margin_), F.lit(1 - CLIP)), F.lit(CLIP))
    loss = -(F.col(label) * F.log(p) + (1 - F.col(label)) * F.log(1 - p))
    return df.agg((F.sum(F.col(weight) * loss) / F.sum(weight)).alias("logloss"))


def boost(
    df: DataFrame,
    features: list[str],
    settings: BoostSettings = BoostSettings(),
    label: str = "label",
    weight: str = "weight",
    is_valid: str = "is_valid",
) -> tuple[list[Node], list[float]]:
    """Boosted trees up to the best round on the rows marked valid, and the loss after each round tried.

    Labels are 0 and 1. Null features are missing. Without valid rows all rounds count. Rows are binned and written
    once; the margins of ``stored`` rounds are expressions before they are written too.
    """
    numbers = [F.nullif(F.col(quoted(f)).cast("double"), F.lit(float("nan"))).alias(f) for f in features]
    own = [F.col(quoted(label)).cast("double").alias("_y"), F.col(quoted(weight)).cast("double").alias("_w"), F.col(quoted(is_valid)).alias("_valid")]
    plain = materialize(df.select(*numbers, *own), "boost-rows")
    cuts = cut_points(plain.filter("not _valid"), features, settings.bins)
    bins = [F.expr(_binned(quoted(f), cuts[f])).alias(f) for f in features]
    place = F.monotonically_increasing_id().alias("_place")
    rows = materialize(plain.select(*bins, "_y", "_w", "_valid", F.lit(0.0).alias("_margin"), place), "boost-bins")
    kept: list[Node] = []
    losses: list[float] = []
    held, best = 0, 0
    for round_ in range(settings.rounds):
        recent = [n for n in kept if n.tree >= held]
        if round_ - held == settings.stored:
            now = (F.col("_margin") + margin(recent)).alias("_margin")
            rows = materialize(rows.select(*[F.col(quoted(f)) for f in features], "_y", "_w", "_valid", now, "_place"), "boost-margins")
            held, recent = round_, []
        p = logistic(F.col("_margin") + margin(recent))
        gradients = {"_g": F.col("_w") * (p - F.col("_y")), "_h": F.col("_w") * p * (1 - p)}
        drawn = F.pmod(F.xxhash64("_place", F.lit(round_), F.lit(settings.seed)), F.lit(1 << 20)) < settings.row_share * (1 << 20)
        several = max(1, round(settings.column_share * len(features)))
        chosen = set(random.Random(f"{settings.seed}-{round_}").sample(features, several))
        used = [f for f in features if f in chosen]
        kept += _grown(rows.filter("not _valid").filter(drawn).withColumns(gradients), round_, used, settings)
        told = weighted_logloss(rows.filter("_valid"), F.col("_margin") + margin([n for n in kept if n.tree >= held]), "_y", "_w").first()[0]
        if told is None:
            best = round_
            continue
        losses.append(told)
        best = min(range(len(losses)), key=losses.__getitem__)
        if round_ - best >= settings.patience:
            break
    return [n for n in kept if n.tree <= best], losses

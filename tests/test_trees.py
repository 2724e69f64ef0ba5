import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapgrid.operators import classify, trees
from snapgrid.operators.trees import BoostSettings, Node, boost, cut_points, first_rounds, logistic, margin, node_frame, read_nodes, with_scores


def walked(nodes, row):
    """The sum of values a row (a dict) reaches."""
    total = 0.0
    for tree in sorted({n.tree for n in nodes}):
        held = {n.node: n for n in nodes if n.tree == tree}
        node = held[min(held)]
        while node.feature is not None:
            value = row[node.feature]
            left = node.missing_left if value is None or math.isnan(value) else value <= node.threshold
            node = held[node.left if left else node.right]
        total += node.value
    return total


def grown(x, g, h, tree, names, s):
    """A tree by trying every threshold on every feature."""
    nodes = {1: Node(tree, 1, value=0.0)}
    ahead = {1: np.arange(len(g))}
    quality = lambda a, b: a * a / (b + s.l2)
    leaf = lambda i: -s.learning_rate * g[i].sum() / (h[i].sum() + s.l2)
    for _ in range(s.depth):
        below = {}
        for at, rows in ahead.items():
            best = None
            for f in range(len(names)):
                v = x[rows, f]
                for t in np.unique(v[~np.isnan(v)]):
                    for missing_left in (False, True):
                        left = np.where(np.isnan(v), missing_left, v <= t)
                        a, b = rows[left], rows[~left]
                        if h[a].sum() < s.min_hessian or h[b].sum() < s.min_hessian:
                            continue
                        gain = quality(g[a].sum(), h[a].sum()) + quality(g[b].sum(), h[b].sum()) - quality(g[rows].sum(), h[rows].sum())
                        if gain > s.min_gain and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, t, missing_left, a, b)
            if best is None:
                nodes[at] = Node(tree, at, value=leaf(rows))
                continue
            gain, f, t, missing_left, a, b = best
            nodes[at] = Node(tree, at, names[f], t, missing_left, 2 * at, 2 * at + 1, gain)
            for child, part in ((2 * at, a), (2 * at + 1, b)):
                nodes[child] = Node(tree, child, value=leaf(part))
                below[child] = part
        ahead = below
    return [nodes[k] for k in sorted(nodes)]


def table(n, seed=0, missing=0.1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = rng.randrange(12), rng.choice([0.5, 1.5, 7.0]), rng.random()
        y = float(rng.random() < 1 / (1 + math.exp(-(a - 6 + 2 * (b > 1)))))
        rows.append((None if rng.random() < missing else float(a), float("nan") if rng.random() < missing else b, c, y, 1.0 + (y > 0), rng.random() < 0.3))
    return rows


SCHEMA = "a double, `b b` double, c double, label double, weight double, is_valid boolean"


def test_boosting_equals_trying_every_split(spark):
    rows = table(400)
    s = BoostSettings(rounds=4, depth=3, row_share=1.0, column_share=1.0, learning_rate=0.3, stored=2, bins=20)
    names = ["a", "b b"]
    nodes, losses = boost(spark.createDataFrame(rows, SCHEMA).repartition(5), names, s)
    x = np.array([[math.nan if v is None else v for v in r[:2]] for r in rows])
    y, w, valid = (np.array([r[i] for r in rows]) for i in (3, 4, 5))
    m, want, told = np.zeros(len(rows)), [], []
    for tree in range(4):
        p = 1 / (1 + np.exp(-m))
        keep = np.flatnonzero(~valid)
        want += grown(x[keep], (w * (p - y))[keep], (w * p * (1 - p))[keep], tree, names, s)
        m = np.array([walked(want, dict(zip(names, r))) for r in x])
        p = 1 / (1 + np.exp(-m))
        told.append(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p)))[valid].sum() / w[valid].sum())
    assert losses == pytest.approx(told)
    want = [n for n in want if n.tree <= int(np.argmin(told))]
    assert [(n.tree, n.node, n.feature, n.threshold, n.left) for n in nodes] == [(n.tree, n.node, n.feature, n.threshold, n.left) for n in want]
    assert [n.value or 0 for n in nodes] == pytest.approx([n.value or 0 for n in want])


def test_early_end_and_shares(spark):
    """Patience ends a fit on noise, and the nodes end at the best round; rows and features are drawn the same each time."""
    rng = random.Random(1)
    rows = [(rng.random(), rng.random(), rng.random(), float(rng.random() < 0.5), 1.0, i % 2 == 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    s = BoostSettings(rounds=30, depth=2, patience=3, learning_rate=0.5, bins=8)
    nodes, losses = boost(df, ["a", "b b", "c"], s)
    best = int(np.argmin(losses))
    assert len(losses) == best + 4 < 30 and max(n.tree for n in nodes) == best
    assert boost(df, ["a", "b b", "c"], s)[0] == nodes


def test_cut_points(spark):
    df = spark.range(10_000).select((F.col("id") % 7).cast("double").alias("few"), F.col("id").cast("double").alias("many"), F.lit(None).cast("double").alias("none"))
    cuts = cut_points(df, ["few", "many", "none"], 16)
    assert cuts["few"] == [0, 1, 2, 3, 4, 5, 6] and cuts["none"] == []
    assert len(cuts["many"]) == 16 and cuts["many"][-1] == 9_999
    assert max(abs(c - 625 * (i + 1)) for i, c in enumerate(cuts["many"])) <= 10
    held = df.select("many", F.expr(trees._binned("many", cuts["many"])).alias("bin")).collect()
    assert all(r["bin"] == min(c for c in cuts["many"] if c >= r["many"]) for r in held)
    assert df.limit(1).select(F.expr(trees._binned("1e9D", [1.0, 2.0]))).first()[0] == math.inf


def test_scores_follow_the_nodes(spark):
    rng = random.Random(3)
    nodes = [Node(0, 1, "b b", 1.0, True, 4, 9), Node(0, 4, value=0.5), Node(0, 9, "a", 3.0, False, 10, 11), Node(0, 10, value=-1.0), Node(0, 11, value=2.0)]
    nodes += [Node(t, 0, value=t / 10) for t in range(1, 400)]
    rows = table(100, 3)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("_feature0", F.lit("own"))
    got = with_scores(df.drop("_feature0"), nodes).collect()
    for r in got:
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-walked(nodes, {"a": r["a"], "b b": r["b b"]}))))
    kept = read_nodes(first_rounds(node_frame(spark, nodes), 3))
    assert sorted({n.tree for n in kept}) == [0, 1, 2]
    assert with_scores(df, []).select("score").distinct().collect() == [(0.5,)]
    assert rng


def test_nodes_of_a_fitted_model_score_as_it_does(spark):
    rows = [(float(r[2] * 3), r[1] if r[1] == r[1] else 0.0, r[2], r[3], r[4], r[5]) for r in table(600, 5, 0)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    s = classify.TrainSettings(depth=3, learning_rate=0.2, features=["a", "b b", "c"])
    model = classify.classifier(s, s.features, 6).fit(df)
    nodes = classify.model_nodes(model)
    assert {c: k for c, k in nodes.dtypes} == {c: k for c, k in node_frame(spark, []).dtypes}
    both = with_scores(classify.score(model, df).withColumnRenamed("score", "theirs"), read_nodes(nodes))
    assert both.filter(F.abs(F.col("score") - F.col("theirs")) > 1e-12).isEmpty()
    # Cut to its first rounds it is the model that fewer rounds give.
    shorter = classify.classifier(s, s.features, 4).fit(df)
    both = with_scores(classify.score(shorter, df).withColumnRenamed("score", "theirs"), read_nodes(first_rounds(nodes, 4)))
    assert both.filter(F.abs(F.col("score") - F.col("theirs")) > 1e-12).isEmpty()
    assert both.select(logistic(margin(read_nodes(nodes)))).count() == 600

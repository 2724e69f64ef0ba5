"""Exact binary classification metrics as aggregations; labels and scores never leave the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapgrid.operators.slices import ranked_sums

#: Probabilities are clipped to this distance from 0 and 1 in the log-loss (double machine epsilon).
CLIP = 2.220446049250313e-16


def _share(part: Column, whole: Column) -> Column:
    """Ratio that is 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def exact_auc(df: DataFrame, label: str = "target", score: str = "score") -> DataFrame:
    """Tie-aware area under the ROC curve; null if only one class occurs.

    Rows collapse to one per distinct score; negatives below a score come from sliced running sums.
    """
    positive = (F.col(label) == 1).cast("long")
    by_score = (
        df.groupBy(F.col(score).alias("value"))
        .agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    )
    ranked = ranked_sums(by_score, "value", ["pos", "neg"])
    below = F.col("neg_run") - F.col("neg") / F.lit(2.0)
    share = F.col("pos") / F.col("pos_total") * below / F.col("neg_total")
    both = (F.col("pos_total") > 0) & (F.col("neg_total") > 0)
    return ranked.agg(F.sum(F.when(both, share)).alias("auc"))


def binary_metrics(
    df: DataFrame, label: str = "target", score: str = "score", threshold: float = 0.5
) -> DataFrame:
    """log-loss, Brier score and the threshold metrics, in one aggregation."""
    y = F.col(label).cast("double")
    p = F.col(score).cast("double")
    clipped = F.greatest(F.least(p, F.lit(1 - CLIP)), F.lit(CLIP))
    loss = -(y * F.log(clipped) + (1 - y) * F.log(1 - clipped))
    hit = (p >= threshold).cast("int")
    cells = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(y).alias("positive_rate"),
        F.avg(loss).alias("logloss"),
        F.avg((p - y) * (p - y)).alias("brier"),
        F.count_if((hit == 1) & (y == 1)).alias("tp"),
        F.count_if((hit == 1) & (y == 0)).alias("fp"),
        F.count_if((hit == 0) & (y == 0)).alias("tn"),
        F.count_if((hit == 0) & (y == 1)).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    recalls = [F.try_divide(tp.cast("double"), tp + fn), F.try_divide(tn.cast("double"), tn + fp)]
    present = F.filter(F.array(*recalls), lambda r: r.isNotNull())
    balanced = F.aggregate(present, F.lit(0.0), lambda a, r: a + r, lambda a: F.try_divide(a, F.size(present)))
    return cells.select(
        "rows",
        "positive_rate",
        "logloss",
        "brier",
        _share(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        balanced.alias("balanced_accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def split_counts(
    df: DataFrame, key: str = "st_id", label: str = "target", split: str = "split", ts: str = "ts", *extra: Column
) -> DataFrame:
    """Rows, positives, positive rate, distinct keys and time span per side of a split."""
    y = F.col(label).cast("long")
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(y).alias("positive"),
        F.avg(y.cast("double")).alias("positive_rate"),
        F.countDistinct(key).alias("n_stations"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        *extra,
    )

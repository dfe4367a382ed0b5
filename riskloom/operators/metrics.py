"""Classifier evaluation over long score tables: ``by`` names the model, one job for all models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ranks import label_counts, pair_sum


def long_scores(wide: DataFrame, id_col: str, label: str, scores: Mapping[str, str]) -> DataFrame:
    """``id, y, model, score`` from a wide score table; ``scores`` maps model name to column."""
    names = list(scores)
    renamed = wide.select(
        F.col(id_col).cast("string").alias("id"), F.col(label).cast("int").alias("y"),
        *[F.col(scores[m]).cast("double").alias(m) for m in names],
    )
    return renamed.unpivot(["id", "y"], names, "model", "score")


def apply_thresholds(long: DataFrame, thresholds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds ``pred``: 1 where the score reaches the model's threshold (one row per model)."""
    return long.join(F.broadcast(thresholds.select(*by, "threshold")), list(by)).withColumn(
        "pred", F.when(F.col("score") >= F.col("threshold"), 1).otherwise(0)
    )


def confusion(pred: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, tn, fp, fn, tp``."""
    y, p = F.col("y"), F.col("pred")
    return pred.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def classification_metrics(table: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 next to the four counts; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return table.withColumns({
        "accuracy": ratio_or_zero(tn + tp, tn + fp + fn + tp),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    })


def confusion_cells(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Confusion counts as one row per cell: ``by, actual, predicted, n``."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
        for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ])
    return table.select(*by, F.inline(cells))


def error_class(y: Column, pred: Column) -> Column:
    """``FP``, ``FN`` or null for a correct prediction."""
    return F.when((pred == 1) & (y == 0), "FP").when((pred == 0) & (y == 1), "FN")


def predicted_rates(pred: DataFrame, by: Sequence[str]) -> DataFrame:
    return pred.groupBy(*by).agg(
        (F.avg("pred") * 100).alias("pct_predicted"), (F.avg("y") * 100).alias("pct_real")
    )


def score_diagnostics(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """Range, moments, distinct values and share at the maximum; flags a constant score."""
    by = list(by)
    points = long.groupBy(*by, "score").agg(F.count("*").alias("_n"))
    moments = long.groupBy(*by).agg(F.avg("score").alias("mean"),
                                    F.stddev_samp("score").alias("sd"))
    shape = points.groupBy(*by).agg(
        F.min("score").alias("min"), F.max("score").alias("max"),
        F.count("*").alias("n_distinct"),
        (F.max_by("_n", "score") / F.sum("_n") * 100).alias("pct_at_max"),
    )
    return shape.join(moments, by).withColumn("constant_score", F.col("n_distinct") == 1)


def _wide_int(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def auc(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, n_pos, n_neg, auc``: share of positive-negative pairs in the right order, ties half.
    Pairs are counted in integers, so the value is exact up to the last division. Null for one
    class only."""
    points = label_counts(long, by)
    sums = points.groupBy(*by).agg(
        F.first("n_pos_total").alias("n_pos"), F.first("n_neg_total").alias("n_neg"),
        pair_sum(F.col("n_pos"), 2 * F.col("n_neg_below") + F.col("n_neg")).alias("_twice"),
    )
    pairs = 2.0 * F.col("n_pos") * F.col("n_neg")
    return sums.select(
        *by, "n_pos", "n_neg", F.when(pairs > 0, F.col("_twice") / pairs).alias("auc")
    )


def roc_points(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per distinct score used as a cut (predict 1 at or above it): ``by, threshold, tp,
    fp, tpr, fpr``."""
    points = label_counts(long, by)
    tp = F.col("n_pos_total") - F.col("n_pos_below")
    fp = F.col("n_neg_total") - F.col("n_neg_below")
    return points.select(
        *by, F.col("score").alias("threshold"), "n_pos", "n_neg", "n_pos_total", "n_neg_total",
        tp.alias("tp"), fp.alias("fp"),
        (tp / F.col("n_pos_total")).alias("tpr"), (fp / F.col("n_neg_total")).alias("fpr"),
    )


def thin_roc(points: DataFrame, by: Sequence[str], steps: int = 100) -> DataFrame:
    """At most one point per model and 1/steps of false-positive rate, for drawing."""
    cell = F.floor(F.col("fpr") * steps)
    return points.groupBy(*by, cell.alias("cell")).agg(
        F.max(F.struct("tp", "threshold", "tpr", "fpr")).alias("_p")
    ).select(*by, "_p.threshold", "_p.tpr", "_p.fpr")


def average_precision(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sum over cuts of (recall step) x precision; not the trapezoidal area."""
    gain = F.col("n_pos") / F.col("n_pos_total") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return (
        roc_points(long, by).where(F.col("n_pos_total") > 0)
        .groupBy(*by).agg(F.sum(gain).alias("average_precision"))
    )


def youden_thresholds(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cut with the largest TPR - FPR per model, ties to the highest cut. ``degenerate`` marks a
    model for which no cut is better than none."""
    # In 64 bits where all pairs of a model can be counted in them, else in decimals.
    tp, fp, n_pos, n_neg = (F.col(c) for c in ("tp", "fp", "n_pos_total", "n_neg_total"))
    short = F.try_multiply(n_pos, n_neg).isNotNull()
    gain = F.when(short, F.try_multiply(tp, n_neg) - F.try_multiply(fp, n_pos))
    wide = F.when(~short, _wide_int(tp) * _wide_int(n_neg) - _wide_int(fp) * _wide_int(n_pos))
    best = roc_points(long, by).groupBy(*by).agg(
        F.max(F.struct(gain.alias("gain"), wide.alias("wide"), "threshold", "tpr", "fpr")).alias("_b")
    )
    return best.select(
        *by, "_b.threshold", (F.col("_b.tpr") - F.col("_b.fpr")).alias("youden_j"),
        F.coalesce(F.col("_b.gain") <= 0, F.col("_b.wide") <= 0).alias("degenerate"),
    )


def as_dict(table: DataFrame, key: str, value: str) -> dict:
    """A fitted table with one row per model, as a dictionary on the driver."""
    return {r[key]: r[value] for r in table.select(key, value).collect()}

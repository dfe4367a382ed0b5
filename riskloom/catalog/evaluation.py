"""Evaluation of scores: areas, curves, thresholds, confusion tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import sources
from riskloom.catalog import views as v
from riskloom.catalog.ordering import AREAS
from riskloom.catalog.registry import query
from riskloom.operators import metrics

CUTS = [("a_bal", 8.0), ("b_bal", 8.0), ("a_price", 250000.0), ("b_price", 250000.0),
        ("a_mix", 420.0), ("b_mix", 420.0)]

PRED = f"""{v.TALL}, pred AS (SELECT id, y, model, CASE WHEN score >= CASE substr(model, 3)
    WHEN 'bal' THEN 8.0 WHEN 'price' THEN 250000.0 ELSE 420.0 END THEN 1 ELSE 0 END AS pred
  FROM tall),
conf AS (SELECT model, count(*) FILTER (y = 0 AND pred = 0) AS tn,
  count(*) FILTER (y = 0 AND pred = 1) AS fp, count(*) FILTER (y = 1 AND pred = 0) AS fn,
  count(*) FILTER (y = 1 AND pred = 1) AS tp FROM pred GROUP BY model)"""


def predicted(spark, d):
    cuts = sources.small_table(spark, CUTS, "model string, threshold double")
    return metrics.apply_thresholds(v.scores_tall(spark, d, passes=1), cuts, ["model"])


@query("a15_confusion_counts", f"WITH {PRED} SELECT * FROM conf")
def _(spark, d):
    return metrics.confusion(predicted(spark, d), ["model"])


@query("a16_predicted_rate", f"""WITH {PRED} SELECT model, avg(pred) * 100 AS pct_predicted,
  avg(y) * 100 AS pct_real FROM pred GROUP BY model""", "pct_predicted pct_real")
def _(spark, d):
    return metrics.predicted_rates(predicted(spark, d), ["model"])


@query("e02_exact_auc", f"WITH {AREAS} SELECT * FROM areas", "auc", 9)
def _(spark, d):
    return metrics.auc(v.scores_tall(spark, d), ["model"])


@query("e03_classification_metrics", f"""WITH {PRED} SELECT model, tn, fp, fn, tp,
  (tn + tp) / (tn + fp + fn + tp)::DOUBLE AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END AS f1
  FROM conf""", "accuracy precision recall f1")
def _(spark, d):
    return metrics.classification_metrics(metrics.confusion(predicted(spark, d), ["model"]))


@query("e04_average_precision", f"""WITH {v.POINTS} SELECT model,
  sum(n_pos / p::DOUBLE * (p - pos_below) / (p - pos_below + n - neg_below)) AS average_precision
  FROM points GROUP BY model""", "average_precision", 9)
def _(spark, d):
    return metrics.average_precision(v.scores_tall(spark, d), ["model"])


@query("e05_roc_points", f"""WITH {v.POINTS} SELECT model, score AS threshold,
  (p - pos_below) / p::DOUBLE AS tpr, (n - neg_below) / n::DOUBLE AS fpr FROM points""",
       "threshold tpr fpr", 5)
def _(spark, d):
    return metrics.roc_points(v.scores_tall(spark, d), ["model"]).select(
        "model", "threshold", "tpr", "fpr"
    )


YOUDEN = f"""{v.POINTS}, best AS (SELECT model, threshold, gain, p, n FROM (
    SELECT model, score AS threshold, p, n, (p - pos_below)::HUGEINT * n
      - (n - neg_below)::HUGEINT * p AS gain FROM points)
    QUALIFY row_number() OVER (PARTITION BY model ORDER BY gain DESC, threshold DESC) = 1),
cuts AS (SELECT model, threshold, CAST(gain AS DOUBLE) / (p::DOUBLE * n) AS youden_j,
  gain <= 0 AS degenerate FROM best)"""


@query("e06_youden_threshold", f"WITH {YOUDEN} SELECT * FROM cuts", "threshold youden_j")
def _(spark, d):
    return metrics.youden_thresholds(v.scores_tall(spark, d), ["model"])


@query("e07_confusion_table", f"""WITH {PRED} SELECT model, y AS actual, pred AS predicted,
  count(*) AS n FROM pred GROUP BY model, y, pred""")
def _(spark, d):
    table = metrics.confusion(predicted(spark, d), ["model"])
    return metrics.confusion_cells(table, ["model"]).where(F.col("n") > 0)


@query("e08_final_table", f"""WITH {AREAS}, f AS (SELECT model, 2 * tp / (2 * tp + fp + fn)::DOUBLE
    AS f1 FROM ({'WITH ' + PRED + ' SELECT * FROM conf'}))
  SELECT substr(model, 1, 1) AS run, substr(model, 3) AS kind, auc, f1 FROM areas
  JOIN f USING (model) ORDER BY auc DESC""", "auc f1", 9)
def _(spark, d):
    areas = metrics.auc(v.scores_tall(spark, d), ["model"])
    rates = metrics.classification_metrics(metrics.confusion(predicted(spark, d), ["model"]))
    return areas.join(rates, "model").select(
        F.substring("model", 1, 1).alias("run"), F.expr("substr(model, 3)").alias("kind"),
        "auc", "f1",
    ).orderBy(F.desc("auc"))


@query("p21_better_of_two", f"""WITH {AREAS} SELECT substr(a.model, 3) AS kind, a.auc AS auc_a,
  b.auc AS auc_b, CASE WHEN a.auc > b.auc THEN 'a' ELSE 'b' END AS better,
  greatest(a.auc, b.auc) / least(a.auc, b.auc) AS ratio
  FROM areas a JOIN areas b ON substr(a.model, 3) = substr(b.model, 3) AND a.model < b.model""",
       "auc_a auc_b ratio", 9)
def _(spark, d):
    areas = metrics.auc(v.scores_tall(spark, d), ["model"]).select(
        F.substring("model", 1, 1).alias("run"), F.expr("substr(model, 3)").alias("kind"), "auc"
    )
    wide = areas.groupBy("kind").pivot("run", ["a", "b"]).agg(F.first("auc"))
    return wide.select(
        "kind", F.col("a").alias("auc_a"), F.col("b").alias("auc_b"),
        F.when(F.col("a") > F.col("b"), "a").otherwise("b").alias("better"),
        (F.greatest("a", "b") / F.least("a", "b")).alias("ratio"),
    )


@query("e09_threshold_table", f"""WITH {YOUDEN} SELECT substr(model, 3) AS kind,
  max(threshold) FILTER (model LIKE 'a%') AS a, max(threshold) FILTER (model LIKE 'b%') AS b
  FROM cuts GROUP BY 1""", "a b")
def _(spark, d):
    cuts = metrics.youden_thresholds(v.scores_tall(spark, d), ["model"])
    return cuts.select(
        F.substring("model", 1, 1).alias("run"), F.expr("substr(model, 3)").alias("kind"),
        "threshold",
    ).groupBy("kind").pivot("run", ["a", "b"]).agg(F.first("threshold"))


@query("r10_roc_curve_thinned", f"""WITH {v.POINTS}, c AS (SELECT model, score AS threshold,
    p - pos_below AS tp, (p - pos_below) / p::DOUBLE AS tpr, (n - neg_below) / n::DOUBLE AS fpr
    FROM points)
  SELECT model, threshold, tpr, fpr FROM c QUALIFY row_number() OVER (
    PARTITION BY model, floor(fpr * 100) ORDER BY tp DESC, threshold DESC) = 1""",
       "threshold tpr fpr", 5)
def _(spark, d):
    points = metrics.roc_points(v.scores_tall(spark, d), ["model"])
    return metrics.thin_roc(points, ["model"])

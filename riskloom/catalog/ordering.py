"""Ranks, cumulative counts, samples, splits, sorts and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.columns import SPLIT
from riskloom.catalog.registry import query
from riskloom.operators import metrics, profile, ranks, sampling


@query("w01_midrank", f"""WITH {v.TALL} SELECT id, model,
  rank() OVER (PARTITION BY model ORDER BY score)
  + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::DOUBLE AS midrank FROM tall""",
       "midrank", 3)
def _(spark, d):
    return ranks.midranks(v.scores_tall(spark, d), ["model"], "score", "id").select("id", "model", "midrank")


@query("w02_cumulative_counts", f"""WITH {v.POINTS} SELECT model, score AS threshold,
  p - pos_below AS tp, n - neg_below AS fp FROM points""", "threshold", 5)
def _(spark, d):
    return metrics.roc_points(v.scores_tall(spark, d), ["model"]).select(
        "model", "threshold", "tp", "fp"
    )


@query("w04_stratified_split", f"WITH {SPLIT} SELECT id, split FROM split")
def _(spark, d):
    return sampling.stratified_split(v.loan(spark, d), "id", "y")


@query("f01_split_table", f"WITH {SPLIT} SELECT split, count(*) AS n FROM split GROUP BY split")
def _(spark, d):
    split = sampling.stratified_split(v.loan(spark, d), "id", "y")
    return split.groupBy("split").agg(F.count("*").alias("n"))


SAMPLE = f"""{v.LOAN}, ranked AS (SELECT *, row_number() OVER (PARTITION BY y
    ORDER BY md5('42:' || id)) AS pos, count(*) OVER (PARTITION BY y) AS n_class,
    count(*) OVER () AS n_all FROM loan),
  sample AS (SELECT id, y FROM ranked
    WHERE pos <= round_even(n_class * least(1.0::DOUBLE, 3000.0::DOUBLE / n_all), 0))"""


@query("w05_stratified_sample", f"WITH {SAMPLE} SELECT id, y FROM sample")
def _(spark, d):
    return sampling.stratified_sample(v.loan(spark, d), "id", "y", 3000).select("id", "y")


@query("w06_pick_per_class", f"""WITH {v.SCORES} SELECT id, error_class FROM (SELECT id,
    CASE WHEN a_mix >= 420 AND y = 0 THEN 'FP' WHEN a_mix < 420 AND y = 1 THEN 'FN' END
    AS error_class FROM scores) WHERE error_class IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY error_class ORDER BY md5('7:' || id)) <= 3""")
def _(spark, d):
    pred = F.when(F.col("a_mix") >= 420, 1).otherwise(0)
    wrong = v.scores(spark, d).select(
        "id", metrics.error_class(F.col("y"), pred).alias("error_class")
    ).where(F.col("error_class").isNotNull())
    return sampling.pick_per_class(wrong, "id", "error_class", 3)


@query("o01_sorted", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice""")
def _(spark, d):
    return v.table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice")


@query("o02_top_n", """SELECT o_orderkey, o_totalprice FROM orders
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def _(spark, d):
    return v.table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    ).limit(20)


AREAS = f"""{v.POINTS}, areas AS (SELECT model, any_value(p) AS n_pos, any_value(n) AS n_neg,
    CAST(sum(n_pos::HUGEINT * (2 * neg_below + n_neg)) AS DOUBLE)
      / (2.0::DOUBLE * any_value(p) * any_value(n)) AS auc
  FROM (SELECT model, score, n_pos, n_neg, neg_below, p, n FROM points) GROUP BY model)"""


@query("o03_top_two_models", f"""WITH {AREAS} SELECT substr(model, 1, 1) AS run, model, auc,
  CAST(row_number() OVER (PARTITION BY substr(model, 1, 1) ORDER BY auc DESC, model) AS INTEGER)
  AS rank FROM areas QUALIFY rank <= 2""", "auc", 9)
def _(spark, d):
    areas = metrics.auc(v.scores_tall(spark, d), ["model"]).select(
        F.substring("model", 1, 1).alias("run"), "model", "auc"
    )
    return profile.top_per_group(areas, ["run"], [F.desc("auc"), F.asc("model")], 2)


@query("o04_best_and_worst", f"""WITH {AREAS} SELECT arg_max(model, auc) AS best,
  arg_min(model, auc) AS worst FROM areas""")
def _(spark, d):
    return metrics.auc(v.scores_tall(spark, d), ["model"]).agg(
        F.max_by("model", "auc").alias("best"), F.min_by("model", "auc").alias("worst")
    )


@query("o05_fixed_sample", f"""WITH {v.LOAN} SELECT id FROM loan
  ORDER BY md5('42:' || id) LIMIT 5000""")
def _(spark, d):
    return sampling.fixed_sample(v.loan(spark, d), "id", 5000).select("id")


@query("o06_bernoulli_sample", f"""WITH {v.LOAN} SELECT id FROM loan
  WHERE {v.uniform_sql("42")} < 0.3::DOUBLE""")
def _(spark, d):
    return sampling.bernoulli_sample(v.loan(spark, d), "id", 0.3).select("id")


@query("o07_explicit_order", f"""WITH {v.SCORES} SELECT id, a_mix,
  CAST(rank() OVER (ORDER BY CAST(id AS BIGINT)) - 1 AS BIGINT) AS row_order FROM scores""",
       "a_mix")
def _(spark, d):
    numbered = v.stored_scores(spark, d).withColumn("k", F.col("id").cast("long"))
    points = ranks.cumulative_counts(
        numbered.withColumn("g", F.lit(0)), ["g"], "k", {"n": F.lit(1).cast("long")}
    )
    return numbered.join(
        points.select(F.col("k").cast("long").alias("k"), F.col("n_below").alias("row_order")), "k"
    ).select("id", "a_mix", "row_order")

"""Local explanations of misclassified rows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.modelling import refitted
from riskloom.catalog.registry import query
from riskloom.operators import explain, metrics, models
from riskloom.session import materialize, small_table

BACKGROUND_ROWS = 30000
VEC = """vec AS (SELECT CAST(vec_id AS VARCHAR) AS id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y,
  embedding FROM embeddings)"""
BACKGROUND = f"""{VEC}, ranked AS (SELECT *, row_number() OVER (PARTITION BY y
    ORDER BY md5('42:' || id)) AS pos, count(*) OVER (PARTITION BY y) AS n_class,
    count(*) OVER () AS n_all FROM vec),
  bg AS (SELECT id, y, embedding FROM ranked
    WHERE pos <= round_even(n_class * least(1.0::DOUBLE, 30000.0::DOUBLE / n_all), 0))"""


@query("x01_background_sample", f"WITH {BACKGROUND} SELECT id, y FROM bg")
def _(spark, d):
    return explain.background(v.vectors(spark, d), "id", "y", BACKGROUND_ROWS).select("id", "y")


def slots(spark, d, n=64):
    return small_table(
        spark, [(i, f"e{i}", "numeric") for i in range(n)], "idx int, name string, kind string"
    )


@query("x02_slot_statistics", f"""WITH {BACKGROUND}, tallv AS (SELECT
    CAST(unnest(range(len(embedding))) AS INTEGER) AS idx, CAST(unnest(embedding) AS DOUBLE)
    AS value FROM bg),
  qs AS (SELECT idx, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
    quantile_cont(value, 0.75) AS q3 FROM tallv GROUP BY idx),
  binned AS (SELECT *, CAST((value > q1)::INTEGER + (value > q2)::INTEGER + (value > q3)::INTEGER
    AS INTEGER) AS bin FROM tallv JOIN qs USING (idx))
  SELECT idx, 'e' || idx AS name, 'numeric' AS kind, q1, q2, q3, bin, count(*) AS n,
    avg(value) AS mean, stddev_pop(value) AS sd, min(value) AS low, max(value) AS high,
    count(*) / (SELECT count(*) FROM bg)::DOUBLE AS freq
  FROM binned GROUP BY idx, q1, q2, q3, bin""", "q1 q2 q3 mean sd low high freq")
def _(spark, d):
    sample = explain.background(v.vectors(spark, d), "id", "y", BACKGROUND_ROWS)
    return explain.slot_statistics(sample, slots(spark, d))


@query("x03_chosen_instances", f"""WITH {v.SCORES}, wrong AS (SELECT id, y, a_mix,
    CASE WHEN a_mix >= 420 THEN 1 ELSE 0 END AS pred FROM scores),
  c AS (SELECT *, CASE WHEN pred = 1 THEN 'FP' ELSE 'FN' END AS error_class FROM wrong
    WHERE pred <> y)
  SELECT id, y, a_mix, pred, error_class FROM c QUALIFY row_number() OVER (
    PARTITION BY error_class ORDER BY md5('7:' || id)) <= 5""", "a_mix")
def _(spark, d):
    wide = v.scores(spark, d).select("id", "y", "a_mix")
    return explain.choose_instances(wide, "id", "y", "a_mix", 420.0, per_class=5)


def explained(spark, d, samples=5000):
    """Model, statistics, instances and copies for one row of each kind that the boosted trees misclassify."""
    tuned, train, test = refitted(spark, d, ("GBT",))
    model = tuned["GBT"]
    sample = materialize(explain.background(train, "id", "y"))
    statistics = explain.slot_statistics(sample, slots(spark, d))
    scored = materialize(models.score_all(test, tuned, ["id", "y"]))
    cut = metrics.youden_thresholds(
        models.scores_long(scored, "id", "y", ["GBT"]), ["model"]
    ).select("threshold").first()[0]
    chosen = explain.choose_instances(scored, "id", "y", "score_GBT", cut)
    instances = materialize(
        chosen.join(test.select("id", vector_to_array("features").alias("values")), "id")
    )
    copies = explain.perturb(instances, statistics, "id", samples)
    return model, statistics, instances, copies


def fits_of(model, copies):
    scored = explain.score_copies(
        copies, model.model, models.score_of(model.family), ["id", "sample"]
    )
    return explain.local_fits(scored, "id")


@query("x04_perturbed_copies")
def _(spark, d):
    _, _, _, copies = explained(spark, d)
    return copies.select("id", "sample", F.size("values").alias("n_slots"),
                         F.aggregate("same", F.lit(0.0), lambda a, x: a + x).alias("n_same"))


@query("x05_scored_copies")
def _(spark, d):
    model, _, _, copies = explained(spark, d)
    return explain.score_copies(
        copies, model.model, models.score_of(model.family), ["id", "sample"]
    ).drop("same")


@query("x06_local_fits")
def _(spark, d):
    model, _, _, copies = explained(spark, d)
    return fits_of(model, copies).select("id", "intercept", "r2", F.size("slots").alias("n_slots"))


@query("x07_top_features")
def _(spark, d):
    model, statistics, instances, copies = explained(spark, d)
    return explain.top_features(fits_of(model, copies), instances, statistics, "id")


@query("x08_explanation_quality")
def _(spark, d):
    model, _, instances, copies = explained(spark, d)
    return explain.quality_by_class(fits_of(model, copies), instances, "id")


@query("s07_explanation_rows")
def _(spark, d):
    """Explanations as one record per row, the shape of the JSON result."""
    model, _, instances, copies = explained(spark, d)
    few = instances.select("id", "y", "pred", "error_class",
                           F.col("score_GBT").alias("score"))
    return few.join(fits_of(model, copies), "id").select(
        "id", "y", "pred", "error_class", "score", "intercept", "r2",
        F.to_json("slots").alias("explanation"),
    )

"""Feature preparation and classifier families."""

from __future__ import annotations

import json

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.columns import SPLIT
from riskloom.catalog.describing import COUNTS
from riskloom.catalog.ordering import AREAS
from riskloom.catalog.registry import query
from riskloom.operators import features, metrics, models, sampling, trees
from riskloom.session import materialize, small_table

TRAIN = f"""{SPLIT}, train AS (SELECT loan.* FROM loan JOIN split USING (id)
  WHERE split.split = 'train')"""


def split_loan(spark, d):
    df = v.loan(spark, d)
    return sampling.with_split(df, "id", "y")


def fitted(spark, d):
    rows = materialize(split_loan(spark, d))
    train = rows.where(F.col("split") == "train")
    return rows, features.feature_pipeline(v.LOAN_ROLES).fit(train)


@query("f02_median_imputer", f"""WITH {v.LINES}, m AS (SELECT
    quantile_cont(l_tax, 0.5) AS tax, quantile_cont(l_extendedprice, 0.5) AS price FROM lines)
  SELECT l_returnflag, count(*) AS n, sum(coalesce(l_tax, tax)) AS sum_tax,
    sum(coalesce(l_extendedprice, price)) / 1e6 AS sum_price FROM lines, m
  GROUP BY l_returnflag""", "sum_tax sum_price", 5)
def _(spark, d):
    lines = v.lines(spark, d)
    full = features.impute_exact(lines, lines, ["l_tax", "l_extendedprice"])
    return full.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum("l_tax").alias("sum_tax"),
        (F.sum("l_extendedprice") / 1e6).alias("sum_price"),
    )


INDEX = f"""{COUNTS}, ix AS (SELECT variable, value,
  CAST(row_number() OVER (PARTITION BY variable ORDER BY n DESC, value) - 1 AS INTEGER) AS idx
  FROM vc WHERE value IS NOT NULL AND variable IN ('status', 'segment', 'nation'))"""


@query("f03_category_index", f"WITH {INDEX} SELECT * FROM ix")
def _(spark, d):
    return features.category_index(v.loan(spark, d), list(v.LOAN_ROLES.categorical))


CATEGORICAL = list(v.LOAN_ROLES.categorical)


@query("f04_one_hot_slot", f"""WITH {INDEX} SELECT id, {", ".join(f"{c}_ix.idx AS {c}_slot" for c in CATEGORICAL)}
  FROM loan {" ".join(f"JOIN ix {c}_ix ON {c}_ix.variable = '{c}' AND {c}_ix.value = {c}" for c in CATEGORICAL)}""")
def _(spark, d):
    df = v.loan(spark, d)
    places, slots = [f"{c}_idx" for c in CATEGORICAL], [f"{c}_ohe" for c in CATEGORICAL]
    indexed = StringIndexer(inputCols=CATEGORICAL, outputCols=places, handleInvalid="keep").fit(df).transform(df)
    encoded = OneHotEncoder(inputCols=places, outputCols=slots).fit(indexed).transform(indexed)
    return encoded.select("id", *[
        (F.array_position(vector_to_array(s), 1.0) - 1).cast("int").alias(f"{n}_slot")
        for n, s in zip(CATEGORICAL, slots)
    ])


@query("f05_numeric_assembler", f"WITH {v.LOAN} SELECT id, price AS slot_0, bal AS slot_1 FROM loan",
       "slot_0 slot_1", 4)
def _(spark, d):
    vectors = VectorAssembler(inputCols=["price", "bal"], outputCol="v").transform(v.loan(spark, d))
    a = vector_to_array("v")
    return vectors.select("id", a[0].alias("slot_0"), a[1].alias("slot_1"))


@query("f06_scaler_statistics", f"""WITH {v.LOAN} SELECT 'price' AS variable, avg(price) AS mean,
  stddev_samp(price) AS sd FROM loan UNION ALL SELECT 'bal', avg(bal), stddev_samp(bal)
  FROM loan""", "mean sd", 4)
def _(spark, d):
    return features.scaler_statistics(v.loan(spark, d), ["price", "bal"])


@query("f07_final_vector", f"""WITH {INDEX} SELECT id,
  CAST(2 + (SELECT count(*) FROM ix) AS INTEGER) AS n_slots, CAST(3 AS BIGINT) AS n_hot
  FROM loan""")
def _(spark, d):
    rows, model = fitted(spark, d)
    a = vector_to_array("features")
    return features.prepared(model, rows, v.LOAN_ROLES).select(
        "id", F.size(a).alias("n_slots"),
        F.size(F.filter(F.slice(a, F.lit(3), F.size(a) - 2), lambda x: x == 1.0)).cast("long").alias("n_hot"),
    )


@query("f08_fitted_on_train", f"""WITH {TRAIN}, st AS (SELECT avg(price) AS mp,
    stddev_samp(price) AS sp, avg(bal) AS mb, stddev_samp(bal) AS sb FROM train)
  SELECT id, y, split.split, (price - mp) / sp AS slot_0, (bal - mb) / sb AS slot_1
  FROM loan JOIN split USING (id, y), st""", "slot_0 slot_1")
def _(spark, d):
    rows, model = fitted(spark, d)
    a = vector_to_array("features")
    return features.prepared(model, rows, v.LOAN_ROLES, ["split"]).select(
        "id", "y", "split", a[0].alias("slot_0"), a[1].alias("slot_1")
    )


SLOTS = f"""{TRAIN}, tc AS (SELECT variable, value, count(*) AS n FROM train
    UNPIVOT (value FOR variable IN (status, segment, nation)) GROUP BY variable, value),
  named AS (SELECT 'price' AS name, 'numeric' AS kind, 0 AS part, 0 AS place UNION ALL
    SELECT 'bal', 'numeric', 0, 1 UNION ALL
    SELECT variable || '_' || value, 'binary', list_position(['status', 'segment', 'nation'],
      variable), row_number() OVER (PARTITION BY variable ORDER BY n DESC, value) FROM tc)"""


@query("f09_slot_names", f"""WITH {SLOTS} SELECT CAST(row_number() OVER (ORDER BY part, place) - 1
  AS INTEGER) AS idx, name, kind FROM named""")
def _(spark, d):
    rows, model = fitted(spark, d)
    return features.slot_names(features.prepared(model, rows, v.LOAN_ROLES), v.LOAN_ROLES)


@query("q06_slots_named", f"""WITH {SLOTS} SELECT 'slots_named' AS check,
  count(*) FILTER (name IS NULL) AS n_bad, count(*) FILTER (name IS NULL) = 0 AS passed
  FROM named""")
def _(spark, d):
    from riskloom.operators.quality import slots_named

    rows, model = fitted(spark, d)
    prepared = features.prepared(model, rows, v.LOAN_ROLES)
    return slots_named(features.slot_names(prepared, v.LOAN_ROLES))


@query("f10_fitted_medians", f"""WITH {v.LINES_TALL} SELECT variable, quantile_cont(value, 0.5)
  AS median FROM lt WHERE value IS NOT NULL GROUP BY variable""", "median", 5)
def _(spark, d):
    return features.exact_medians(v.lines(spark, d), v.NUMERIC)


@query("e01_evaluator_auc", f"WITH {AREAS} SELECT model, auc FROM areas", "auc", 9)
def _(spark, d):
    wide = v.stored_scores(spark, d)
    rows = [
        (m, BinaryClassificationEvaluator(
            labelCol="y", rawPredictionCol=m, metricName="areaUnderROC", numBins=0
        ).evaluate(wide))
        for m in v.MODELS
    ]
    return small_table(spark, rows, "model string, auc double")


def vector_sets(spark, d):
    """Embeddings split into train and test, written to the checkpoint folder once."""
    df = v.vectors(spark, d)
    both = materialize(sampling.with_split(df, "id", "y"))
    train = both.where(F.col("split") == "train").drop("split")
    return train, both.where(F.col("split") == "test").drop("split")


def tuned_row(spark, d, name):
    train, test = vector_sets(spark, d)
    tuned = {name: models.tune(models.FAMILIES[name], train, "id", "y", parallelism=4)}
    scored = models.score_all(test, tuned, ["id", "y"])
    return models.evaluate(scored, "id", "y", tuned)


for number, family in enumerate(models.FAMILIES, start=1):
    query(f"m{number:02d}_{family.lower()}")(
        lambda spark, d, family=family: tuned_row(spark, d, family)
    )


VECTORS = """vec AS (SELECT CAST(vec_id AS VARCHAR) AS id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y, embedding
  FROM embeddings),
parted AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || id))
  <= ceil(count(*) OVER (PARTITION BY y) * 0.2::DOUBLE) AS test FROM vec)"""
#: Means and variances of every slot by class on the training rows; the larger posterior on the test rows.
BAYES = f"""{VECTORS}, slots AS (SELECT id, y, test, unnest(range(len(embedding))) AS slot,
  unnest(embedding)::DOUBLE AS x FROM parted),
smooth AS (SELECT 1e-9::DOUBLE * max(v) AS e FROM (SELECT var_pop(x) AS v FROM slots WHERE NOT test GROUP BY slot)),
shape AS (SELECT y, slot, avg(x) AS m, var_pop(x) + any_value(e) AS v FROM slots, smooth WHERE NOT test GROUP BY y, slot),
prior AS (SELECT y, ln(count(*)) - ln((SELECT count(*) FROM parted WHERE NOT test)) AS p FROM parted WHERE NOT test GROUP BY y),
raw AS (SELECT s.id, s.y, c.y AS class, any_value(p) + sum(-0.5::DOUBLE * ln(2 * pi() * v) - (x - m) * (x - m) / (2 * v)) AS r
  FROM slots s JOIN shape c USING (slot) JOIN prior ON prior.y = c.y WHERE test GROUP BY s.id, s.y, c.y),
bayes AS (SELECT id, y, exp(r1 - greatest(r0, r1)) / (exp(r0 - greatest(r0, r1)) + exp(r1 - greatest(r0, r1))) AS score
  FROM (SELECT id, y, max(r) FILTER (class = 0) AS r0, max(r) FILTER (class = 1) AS r1 FROM raw GROUP BY id, y))"""


@query("m06_gaussian_scores", f"WITH {BAYES} SELECT id, y, score FROM bayes", "score", 7)
def _(spark, d):
    train, test = vector_sets(spark, d)
    fitted = {"NaiveBayes": models.refit(models.FAMILIES["NaiveBayes"], train, "y", {})}
    return models.score_all(test, fitted, ["id", "y"]).withColumnRenamed("score_NaiveBayes", "score")


FOLDS = f"""{VECTORS}, folded AS (SELECT id, y, embedding, (pos > n // 3)::INTEGER + (pos > (2 * n) // 3)::INTEGER AS fold
  FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('fold42:' || id)) AS pos, count(*) OVER (PARTITION BY y) AS n
    FROM parted WHERE NOT test)),
rounds AS (SELECT unnest(range(3)) AS k),
slots AS (SELECT k, id, y, fold = k AS held, unnest(range(len(embedding))) AS slot, unnest(embedding)::DOUBLE AS x
  FROM folded, rounds),
smooth AS (SELECT k, 1e-9::DOUBLE * max(v) AS e FROM (
  SELECT k, var_pop(x) AS v FROM slots WHERE NOT held GROUP BY k, slot) GROUP BY k),
shape AS (SELECT k, y, slot, avg(x) AS m, var_pop(x) + any_value(e) AS v FROM slots JOIN smooth USING (k)
  WHERE NOT held GROUP BY k, y, slot),
prior AS (SELECT k, y, ln(count(*)) - ln(sum(count(*)) OVER (PARTITION BY k)) AS p FROM folded, rounds WHERE fold <> k GROUP BY k, y),
raw AS (SELECT s.k, s.id, s.y, c.y AS class, any_value(p) + sum(-0.5::DOUBLE * ln(2 * pi() * v) - (x - m) * (x - m) / (2 * v)) AS r
  FROM slots s JOIN shape c ON c.k = s.k AND c.slot = s.slot JOIN prior ON prior.k = s.k AND prior.y = c.y
  WHERE held GROUP BY s.k, s.id, s.y, c.y),
odds AS (SELECT k, id, y, max(r) FILTER (class = 1) - max(r) FILTER (class = 0) AS score FROM raw GROUP BY k, id, y),
areas AS (SELECT a.k, avg(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5::DOUBLE
  ELSE 0.0::DOUBLE END) AS auc FROM odds a JOIN odds b ON a.k = b.k AND a.y = 1 AND b.y = 0 GROUP BY a.k)"""


@query("m09_cross_validated_area", f"""WITH {FOLDS} SELECT 'NaiveBayes' AS model, '{{}}' AS best_params,
  avg(auc) AS cv_auc FROM areas""", "cv_auc", 6)
def _(spark, d):
    train, _ = vector_sets(spark, d)
    tuned = models.tune(models.FAMILIES["NaiveBayes"], train, "id", "y")
    return small_table(spark, [("NaiveBayes", json.dumps(tuned.params), tuned.cv_auc)],
                       "model string, best_params string, cv_auc double")


SLOPE = 1e-3
SIZES = "sizes AS (SELECT count(*) FILTER (NOT test) AS n, sum(y) FILTER (NOT test) AS p, count(*) FILTER (test) AS m FROM parted)"


@query("m01_logistic_optimum", f"""WITH {VECTORS}, {SIZES} SELECT unnest([1e-6, 1e-5, 1e-4]::DOUBLE[]) AS "regParam", n,
  true AS optimal FROM sizes""")
def _(spark, d):
    train, _ = vector_sets(spark, d)
    family, found = models.FAMILIES["LogisticRegression"], None
    for value in family.grid["regParam"]:
        fitted = models.refit(family, train, "y", {"regParam": value})
        row = models.logistic_slope(fitted, train, "y").select(
            F.lit(value).alias("regParam"), "n", (F.col("slope") < SLOPE).alias("optimal"))
        found = row if found is None else found.unionAll(row)
    return found


@query("m02_tree_leaves", f"""WITH {VECTORS}, {SIZES} SELECT unnest([5, 10, 15]) AS "maxDepth", n AS n_rows,
  CAST(p AS BIGINT) AS n_positive, CAST(0 AS BIGINT) AS n_bad FROM sizes""")
def _(spark, d):
    train, _ = vector_sets(spark, d)
    family, found = models.FAMILIES["DecisionTree"], None
    for depth in family.grid["maxDepth"]:
        fitted = models.refit(family, train, "y", {"maxDepth": depth})
        row = trees.wrong_leaves(train, trees.node_table(fitted, spark), "y", depth).select(
            F.lit(depth).alias("maxDepth"), "n_rows", "n_positive", "n_bad")
        found = row if found is None else found.unionAll(row)
    return found


def rescored(spark, d, name):
    """Test rows whose score from the table of nodes is not the model's."""
    tuned, _, test = refitted(spark, d, (name,))
    depth = KNOWN_PARAMS[name]["maxDepth"]
    again = trees.scores(test, trees.node_table(tuned[name], spark), ["id"], depth, name == "GBT")
    both = models.score_all(test, tuned, ["id"]).join(again, "id", "full")
    bad = ~F.coalesce(F.abs(F.col(f"score_{name}") - F.col("score")) < 1e-9, F.lit(False))
    return both.agg(F.count("*").alias("n"), F.count_if(bad).alias("n_bad"))


RESCORED = f"WITH {VECTORS}, {SIZES} SELECT m AS n, CAST(0 AS BIGINT) AS n_bad FROM sizes"
query("m02_tree_scores", RESCORED)(lambda spark, d: rescored(spark, d, "DecisionTree"))
query("m03_forest_scores", RESCORED)(lambda spark, d: rescored(spark, d, "RandomForest"))
query("m04_boosted_scores", RESCORED)(lambda spark, d: rescored(spark, d, "GBT"))


# One point of the grid of every family.
KNOWN_PARAMS = {
    "LogisticRegression": {"regParam": 1e-4}, "DecisionTree": {"maxDepth": 5},
    "RandomForest": {"numTrees": 10, "maxDepth": 5}, "GBT": {"maxIter": 50, "maxDepth": 3},
    "LinearSVC": {"regParam": 1e-4}, "NaiveBayes": {},
}


def refitted(spark, d, names=tuple(models.FAMILIES)):
    """All six families, or some, fitted once with known parameters."""
    train, test = vector_sets(spark, d)
    return {
        n: models.refit(models.FAMILIES[n], train, "y", KNOWN_PARAMS[n]) for n in names
    }, train, test


@query("m08_stratified_folds", f"""WITH {v.LOAN}, r AS (SELECT id, y,
    row_number() OVER (PARTITION BY y ORDER BY md5('fold42:' || id)) AS pos,
    count(*) OVER (PARTITION BY y) AS n FROM loan)
  SELECT id, CAST((pos > n // 3)::INTEGER + (pos > (2 * n) // 3)::INTEGER AS INTEGER) AS fold
  FROM r""")
def _(spark, d):
    return sampling.stratified_folds(v.loan(spark, d), "id", "y").select("id", "fold")


@query("m10_refit_once")
def _(spark, d):
    tuned, _, test = refitted(spark, d, ("LogisticRegression",))
    return models.evaluate(models.score_all(test, tuned, ["id", "y"]), "id", "y", tuned)


@query("m11_scores_of_all_models")
def _(spark, d):
    tuned, _, test = refitted(spark, d)
    return models.score_all(test, tuned, ["id", "y"])


@query("m12_champion")
def _(spark, d):
    tuned, _, test = refitted(spark, d)
    scored = models.score_all(test, tuned, ["id", "y"])
    return models.champion(models.evaluate(scored, "id", "y", tuned))


@query("m13_model_report")
def _(spark, d):
    tuned, _, test = refitted(spark, d)
    table = models.evaluate(models.score_all(test, tuned, ["id", "y"]), "id", "y", tuned)
    return table.join(models.predict_seconds(test, tuned), "model")


@query("m14_coefficients")
def _(spark, d):
    tuned, _, _ = refitted(spark, d, ("LogisticRegression",))
    return models.coefficient_report(tuned["LogisticRegression"], spark)


@query("m15_retuned_model_replaced")
def _(spark, d):
    from riskloom.operators.quality import replace_column

    tuned, train, test = refitted(spark, d)
    stored = models.score_all(test, tuned, ["id", "y"])
    new = {"DecisionTree": models.tune(models.FAMILIES["DecisionTree"], train, "id", "y", parallelism=4)}
    return replace_column(
        stored, models.score_all(test, new, ["id"]), "id", "score_DecisionTree"
    )


@query("m15_result_row_replaced", f"""WITH {AREAS} SELECT a.model, a.n_pos, a.n_neg, coalesce(b.auc, a.auc) AS auc
  FROM areas a LEFT JOIN areas b ON a.model = 'a_bal' AND b.model = 'b_bal'""", "auc", 9)
def _(spark, d):
    """The result row of a retuned model takes the place of the stored one, by key; all others stay."""
    from riskloom.operators.quality import replace_rows

    areas = materialize(metrics.auc(v.scores_tall(spark, d), ["model"]))
    new = areas.where("model = 'b_bal'").withColumn("model", F.lit("a_bal"))
    return replace_rows(areas, new, ["model"])


@query("a18_training_totals")
def _(spark, d):
    tuned, _, test = refitted(spark, d)
    table = models.evaluate(models.score_all(test, tuned, ["id", "y"]), "id", "y", tuned)
    return table.agg(F.sum("fit_seconds").alias("total_seconds"),
                     (F.max("fit_seconds") / F.min("fit_seconds")).alias("slowest_to_fastest"))


@query("r13_time_against_auc")
def _(spark, d):
    tuned, _, test = refitted(spark, d)
    table = models.evaluate(models.score_all(test, tuned, ["id", "y"]), "id", "y", tuned)
    return table.select("model", "fit_seconds", "test_auc").orderBy(F.desc("fit_seconds"))

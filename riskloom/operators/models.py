"""Six classifier families: grids, cross-validation, scoring and model reports.

Every family names the column its score comes from. The same column is used for tuning, for the
reported areas and for the stored scores, so that they can never disagree.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.metrics import auc, classification_metrics, confusion, long_scores
from riskloom.operators.sampling import stratified_folds
from riskloom.session import materialize, small_table

SEED = 42


@dataclass(frozen=True)
class Family:
    name: str
    build: Callable
    grid: Mapping[str, Sequence]
    score_source: str = "probability"
    cut: float = 0.5
    seeded: bool = False

    def estimator(self, target: str, features: str = "features", **params):
        if self.seeded:
            params.setdefault("seed", SEED)
        return self.build(labelCol=target, featuresCol=features, **params)


def _gaussian_bayes(**params):
    return NaiveBayes(modelType="gaussian", **params)


def _forest(**params):
    """Every row keeps its node in each tree, instead of walking down all trees again for each level; same trees."""
    return RandomForestClassifier(**({"cacheNodeIds": True} | params))


FAMILIES: dict[str, Family] = {
    f.name: f
    for f in (
        Family("LogisticRegression", LogisticRegression, {"regParam": [1e-6, 1e-5, 1e-4]}),
        Family("DecisionTree", DecisionTreeClassifier, {"maxDepth": [5, 10, 15]}, seeded=True),
        Family("RandomForest", _forest,
               {"numTrees": [10, 50, 100], "maxDepth": [5, 10, 15]}, seeded=True),
        Family("GBT", GBTClassifier, {"maxIter": [50, 100], "maxDepth": [3, 5]}, seeded=True),
        Family("LinearSVC", LinearSVC, {"regParam": [1e-6, 1e-5, 1e-4]},
               score_source="rawPrediction", cut=0.0),
        Family("NaiveBayes", _gaussian_bayes, {}),
    )
}


@dataclass
class Tuned:
    family: Family
    model: object
    params: dict
    cv_auc: float | None
    fit_seconds: float


def param_grid(estimator, grid: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def tune(family: Family, train: DataFrame, id_col: str, target: str,
         grid: Mapping[str, Sequence] | None = None, folds: int = 3, parallelism: int = 1,
         num_bins: int = 0, **params) -> Tuned:
    """Grid search by cross-validated AUC on the family's own score column, over all distinct scores unless
    ``num_bins`` says otherwise. Folds are stratified by hash and written once; ``parallelism`` fits run at once."""
    estimator = family.estimator(target, **params)
    evaluator = BinaryClassificationEvaluator(
        labelCol=target, rawPredictionCol=family.score_source, metricName="areaUnderROC",
        numBins=num_bins,
    )
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=param_grid(estimator, grid or family.grid),
        evaluator=evaluator, numFolds=folds, foldCol="fold", parallelism=parallelism, seed=SEED,
    )
    start = time.perf_counter()
    fitted = search.fit(materialize(stratified_folds(train, id_col, target, folds)))
    seconds = time.perf_counter() - start
    names = list(grid or family.grid)
    best = {p: fitted.bestModel.getOrDefault(fitted.bestModel.getParam(p)) for p in names}
    return Tuned(family, fitted.bestModel, best, float(max(fitted.avgMetrics)), seconds)


def refit(family: Family, train: DataFrame, target: str, params: Mapping) -> Tuned:
    """One fit with known parameters."""
    start = time.perf_counter()
    model = family.estimator(target, **params).fit(train)
    return Tuned(family, model, dict(params), None, time.perf_counter() - start)


def score_of(family: Family) -> Column:
    """Positive-class score: probability, or margin for a model without probabilities."""
    return vector_to_array(family.score_source)[1]


def score_all(df: DataFrame, tuned: Mapping[str, Tuned], keep: Sequence[str],
              features: str = "features") -> DataFrame:
    """``keep, score_<model>...``: all models applied in one chain, with no join and no shuffle."""
    out = df.select(*keep, features)
    names: list[str] = []
    for name, t in tuned.items():
        column = f"score_{name}"
        out = t.model.transform(out).select(
            *keep, features, *names, score_of(t.family).alias(column)
        )
        names.append(column)
    return out.drop(features)


def scores_long(scored: DataFrame, id_col: str, target: str, names: Sequence[str]) -> DataFrame:
    return long_scores(scored, id_col, target, {m: f"score_{m}" for m in names})


def evaluate(scored: DataFrame, id_col: str, target: str,
             tuned: Mapping[str, Tuned]) -> DataFrame:
    """One row per model: parameters, CV area, exact test area, confusion counts, metrics and fit
    time. All models are evaluated together."""
    spark = scored.sparkSession
    long = scores_long(scored, id_col, target, list(tuned))
    facts = small_table(
        spark,
        [(n, json.dumps(t.params, sort_keys=True), t.cv_auc, t.family.cut, t.fit_seconds)
         for n, t in tuned.items()],
        "model string, best_params string, cv_auc double, threshold double, fit_seconds double",
    )
    pred = long.join(F.broadcast(facts.select("model", "threshold")), "model").withColumn(
        "pred", F.when(F.col("score") >= F.col("threshold"), 1).otherwise(0)
    )
    metrics = classification_metrics(confusion(pred, ["model"]))
    areas = auc(long, ["model"]).select("model", F.col("auc").alias("test_auc"))
    return facts.drop("threshold").join(metrics, "model").join(areas, "model")


def champion(results: DataFrame) -> DataFrame:
    """Row of the model with the largest test area (ties by name)."""
    return results.orderBy(F.desc("test_auc"), "model").limit(1)


def save_model(tuned: Tuned, path: str) -> None:
    tuned.model.write().overwrite().save(path)


def load_model(kind, path: str):
    """``kind`` is the model class, for example ``GBTClassificationModel``."""
    return kind.load(path)


def coefficient_report(tuned: Tuned, spark: SparkSession) -> DataFrame:
    """Range, mean, spread and sign counts of a linear model's coefficients."""
    model = tuned.model
    values = [float(v) for v in model.coefficients.toArray()]
    summary = getattr(model, "summary", None) if getattr(model, "hasSummary", False) else None
    iterations = int(summary.totalIterations) if summary is not None else None
    table = small_table(spark, [(v,) for v in values], "coefficient double")
    c = F.col("coefficient")
    return table.agg(
        F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("sd"), F.count_if(c > 0).alias("n_positive"),
        F.count("*").alias("n_slots"),
    ).withColumns({
        "intercept": F.lit(float(model.intercept)), "iterations": F.lit(iterations).cast("int"),
    })


def named_coefficients(tuned: Tuned, slots: DataFrame) -> DataFrame:
    values = [(i, float(v)) for i, v in enumerate(tuned.model.coefficients.toArray())]
    table = small_table(slots.sparkSession, values, "idx int, coefficient double")
    return slots.join(table, "idx")


def logistic_slope(tuned: Tuned, train: DataFrame, target: str, features: str = "features") -> DataFrame:
    """``model, n, slope``: the largest slope of the penalised likelihood at the fitted coefficients of a logistic
    regression, every slot in units of its spread, from one pass over the rows. At the optimum it is 0."""
    model, k = tuned.model, len(tuned.model.coefficients)
    x = vector_to_array(F.col(features))
    w = F.array(*[F.lit(float(c)) for c in model.coefficients.toArray()])
    margin = F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(float(model.intercept)), lambda s, a: s + a)
    rows = train.select(x.alias("_x"), (1.0 / (1.0 + F.exp(-margin)) - F.col(target)).alias("_r"))
    sums = rows.agg(F.count("*").alias("n"), F.avg("_r").alias("_r0"), *[
        e for j in range(k) for e in (
            F.avg(F.col("_r") * F.col("_x")[j]).alias(f"_g{j}"), F.stddev_samp(F.col("_x")[j]).alias(f"_s{j}"))])
    penalty = float(model.getRegParam())
    slopes = [F.abs(F.col(f"_g{j}") / F.col(f"_s{j}") + penalty * F.col(f"_s{j}") * float(model.coefficients[j]))
              for j in range(k)]
    return sums.select(F.lit(tuned.family.name).alias("model"), "n", F.greatest(F.abs("_r0"), *slopes).alias("slope"))


def predict_seconds(df: DataFrame, tuned: Mapping[str, Tuned], features: str = "features") -> DataFrame:
    """``model, predict_seconds``: time to score all rows of ``df`` with each model alone; the rows are read by
    all of them, so they should be stored."""
    taken = []
    for name, t in tuned.items():
        start = time.perf_counter()
        t.model.transform(df.select(features)).select(score_of(t.family).alias("score")).write.format("noop").mode(
            "overwrite").save()
        taken.append((name, time.perf_counter() - start))
    return small_table(df.sparkSession, taken, "model string, predict_seconds double")

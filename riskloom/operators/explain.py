"""Local explanations for many rows in one job.

For every chosen row, perturbed copies are drawn in Spark from the statistics of a background
sample, scored by one ``transform``, and a weighted ridge line is fitted per row. A copy says, per
slot, whether it stayed in the row's own bin (quartile bin of a number, value of a 0/1 slot).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.functions.hashing import hash_key
from riskloom.operators.metrics import error_class
from riskloom.operators.sampling import pick_per_class, stratified_sample

QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def background(train: DataFrame, id_col: str, target: str, n: int = 30000,
               seed: int = 42) -> DataFrame:
    """Stratified training sample as arrays: ``id, target, values``."""
    return stratified_sample(train, id_col, target, n, seed).select(
        id_col, target, vector_to_array("features").alias("values")
    )


def slot_values(sample: DataFrame) -> DataFrame:
    return sample.select(F.posexplode("values").alias("idx", "value"))


def slot_statistics(sample: DataFrame, slots: DataFrame) -> DataFrame:
    """``idx, name, kind, q1, q2, q3, bin, n, freq, mean, sd, low, high``: one row per slot and bin.

    Bin of a number: how many quartiles lie strictly below it (0..3). Bin of a 0/1 slot: its value.
    """
    tall = slot_values(sample)
    # The sample has a fixed size, so the built-in exact percentile is bounded here.
    quart = tall.groupBy("idx").agg(*[
        F.percentile("value", p).alias(q) for q, p in QUARTILES.items()
    ])
    numeric = F.col("kind") == "numeric"
    by_quartile = sum(((F.col("value") > F.col(q)).cast("int") for q in QUARTILES), F.lit(0))
    binned = (
        tall.join(F.broadcast(slots), "idx").join(F.broadcast(quart), "idx")
        .withColumn("bin", F.when(numeric, by_quartile).otherwise(F.round("value").cast("int")))
    )
    per_bin = binned.groupBy("idx", "name", "kind", *QUARTILES, "bin").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"),
        F.coalesce(F.stddev_pop("value"), F.lit(0.0)).alias("sd"),
        F.min("value").alias("low"), F.max("value").alias("high"),
    )
    size = sample.agg(F.count("*")).scalar()
    return per_bin.withColumn("freq", F.col("n") / size)


def choose_instances(scored: DataFrame, id_col: str, target: str, score: str, cut: float = 0.5,
                     per_class: int = 1, seed: int = 7) -> DataFrame:
    """``id, target, score, pred, error_class``: random false positives and false negatives."""
    pred = F.when(F.col(score) >= F.lit(cut), 1).otherwise(0)
    wrong = scored.withColumn("pred", pred).withColumn(
        "error_class", error_class(F.col(target), F.col("pred"))
    ).where(F.col("error_class").isNotNull())
    return pick_per_class(wrong, id_col, "error_class", per_class, seed)


def perturb(instances: DataFrame, statistics: DataFrame, id_col: str, samples: int = 5000,
            seed: int = 42) -> DataFrame:
    """``id, sample, values, same``: perturbed copies; sample 0 is the row itself.

    The slot statistics (slots x at most four bins) are fitted state and go to the tasks once.
    """
    layout = _Layout(statistics.orderBy("idx", "bin").collect())
    draws = instances.select(
        id_col, "values", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("sample")
    )

    @pandas_udf("values array<double>, same array<double>")
    def draw(keys: pd.Series, rows: pd.Series, first: pd.Series) -> pd.DataFrame:
        drawn = [
            layout.draw(int(k[:16], 16), np.asarray(row, dtype=float), is_first)
            for k, row, is_first in zip(keys, rows, first)
        ]
        return pd.DataFrame({"values": [v for v, _ in drawn], "same": [s for _, s in drawn]})

    made = draws.select(
        id_col, "sample",
        draw(hash_key(seed, id_col, "sample"), F.col("values"), F.col("sample") == 0).alias("_d"),
    )
    return made.select(id_col, "sample", "_d.values", "_d.same")


class _Layout:
    """Slot statistics as arrays."""

    def __init__(self, rows):
        slots = sorted({r["idx"] for r in rows})
        at = {idx: i for i, idx in enumerate(slots)}
        k = len(slots)
        self.numeric = np.zeros(k, dtype=bool)
        self.quartiles = np.zeros((k, 3))
        self.freq, self.mean, self.sd = np.zeros((k, 4)), np.zeros((k, 4)), np.zeros((k, 4))
        self.low, self.high = np.zeros((k, 4)), np.zeros((k, 4))
        for r in rows:
            i, j = at[r["idx"]], min(max(int(r["bin"]), 0), 3)
            self.numeric[i] = r["kind"] == "numeric"
            self.quartiles[i] = r["q1"], r["q2"], r["q3"]
            self.freq[i, j] += r["freq"]
            self.mean[i, j], self.sd[i, j] = r["mean"], r["sd"]
            self.low[i, j], self.high[i, j] = r["low"], r["high"]
        self.cumulative = np.cumsum(self.freq, axis=1)
        self.cumulative /= self.cumulative[:, -1:]

    def bins_of(self, row):
        quart = (row[:, None] > self.quartiles).sum(axis=1)
        return np.where(self.numeric, quart, np.rint(row).astype(int))

    def draw(self, key: int, row, is_first: bool):
        if is_first:
            return row, np.ones(len(row))
        rng = np.random.default_rng(key)
        k = len(row)
        bins = (rng.random(k)[:, None] >= self.cumulative).sum(axis=1).clip(0, 3)
        at = (np.arange(k), bins)
        drawn = self.mean[at] + self.sd[at] * rng.standard_normal(k)
        inside = np.clip(drawn, self.low[at], self.high[at])
        values = np.where(self.numeric, inside, bins)
        return values, (bins == self.bins_of(row)).astype(float)


def score_copies(copies: DataFrame, model, score_column, keep: Sequence[str]) -> DataFrame:
    """Model score of every copy in one pass, with its keys."""
    vectors = copies.withColumn("features", array_to_vector("values"))
    return model.transform(vectors).select(*keep, "same", score_column.alias("score"))


def local_fits(scored: DataFrame, id_col: str, top: int = 10,
               kernel_width: float | None = None) -> DataFrame:
    """``id, intercept, r2, slots: array<struct<idx, weight>>``.

    One group per explained row, of exactly the number of copies asked for. Weights fall off with
    the distance to the row; the strongest slots of a first ridge fit are fitted again alone.
    """
    schema = (
        f"{id_col} string, intercept double, r2 double, "
        "slots array<struct<idx: int, weight: double>>"
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["same"].to_numpy())
        y = pdf["score"].to_numpy(dtype=float)
        width = kernel_width or 0.75 * math.sqrt(x.shape[1])
        distance2 = ((x - 1.0) ** 2).sum(axis=1)
        w = np.sqrt(np.exp(-distance2 / width**2))
        coefficients, _, _ = _ridge(x, y, w, 0.01)
        chosen = np.sort(np.argsort(-np.abs(coefficients), kind="stable")[:top])
        beta, intercept, r2 = _ridge(x[:, chosen], y, w, 1.0)
        order = np.argsort(-np.abs(beta), kind="stable")
        slots = [{"idx": int(chosen[i]), "weight": float(beta[i])} for i in order]
        return pd.DataFrame({
            id_col: [str(pdf[id_col].iloc[0])], "intercept": [intercept], "r2": [r2],
            "slots": [slots],
        })

    return scored.select(F.col(id_col).cast("string").alias(id_col), "same", "score").groupBy(
        id_col
    ).applyInPandas(fit, schema)


def _ridge(x, y, w, penalty):
    """Weighted ridge with a free intercept: coefficients, intercept and weighted R2."""
    total = w.sum()
    mx, my = (w[:, None] * x).sum(axis=0) / total, (w * y).sum() / total
    xc, yc = x - mx, y - my
    gram = (xc * w[:, None]).T @ xc + penalty * np.eye(x.shape[1])
    beta = np.linalg.solve(gram, (xc * w[:, None]).T @ yc)
    residual = (w * (yc - xc @ beta) ** 2).sum()
    spread = (w * yc**2).sum()
    r2 = 1.0 - residual / spread if spread > 0 else 0.0
    return beta, float(my - mx @ beta), float(r2)


def top_features(fits: DataFrame, instances: DataFrame, statistics: DataFrame,
                 id_col: str) -> DataFrame:
    """``id, rank, idx, name, weight, rule`` with the rule that the row itself satisfies."""
    flat = fits.select(id_col, F.posexplode("slots").alias("rank", "_s")).select(
        id_col, (F.col("rank") + 1).alias("rank"), F.col("_s.idx").alias("idx"),
        F.col("_s.weight").alias("weight"),
    )
    rows = instances.select(
        F.col(id_col).cast("string").alias(id_col), F.posexplode("values").alias("idx", "value")
    )
    names = statistics.select("idx", "name", "kind", *QUARTILES).distinct()

    def number(c: str):
        return F.format_string("%.2f", F.col(c))

    v, name = F.col("value"), F.col("name")
    rule = (
        F.when(F.col("kind") != "numeric",
               F.concat(name, F.lit("="), F.round(v).cast("int").cast("string")))
        .when(v <= F.col("q1"), F.concat(name, F.lit(" <= "), number("q1")))
        .when(v <= F.col("q2"), F.concat(number("q1"), F.lit(" < "), name, F.lit(" <= "),
                                         number("q2")))
        .when(v <= F.col("q3"), F.concat(number("q2"), F.lit(" < "), name, F.lit(" <= "),
                                         number("q3")))
        .otherwise(F.concat(name, F.lit(" > "), number("q3")))
    )
    return flat.join(rows, [id_col, "idx"]).join(F.broadcast(names), "idx").select(
        id_col, "rank", "idx", "name", "weight", rule.alias("rule")
    )


def quality_by_class(fits: DataFrame, instances: DataFrame, id_col: str) -> DataFrame:
    """Mean R2 of the local fits per error class."""
    classes = instances.select(F.col(id_col).cast("string").alias(id_col), "error_class")
    return fits.join(classes, id_col).groupBy("error_class").agg(
        F.count("*").alias("n"), F.avg("r2").alias("mean_r2")
    )


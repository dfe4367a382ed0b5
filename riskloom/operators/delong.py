"""Areas under correlated ROC curves with their covariance, and the paired tests on them.

Each positive row contributes the share of negatives ranked below it, each negative row the share
of positives ranked above it (ties half). The covariance of the areas is the sample covariance of
these contributions, class by class. The shares come from ordered counts, not from pairs of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.tails import normal_p
from riskloom.operators.multiple import holm
from riskloom.operators.ranks import attach_by_value, classes, counts_below, placed_points, point_sizes

Z95 = 1.96
PRACTICAL = 0.005


def components(long: DataFrame) -> DataFrame:
    """``id, y, model, score, v``: the contribution of every row to its model's area."""
    counters = classes()
    placed = placed_points(long, ["model"], "score", counters)
    points = counts_below(placed, ["model"], "score", list(counters))
    pos_above = F.col("n_pos_total") - F.col("n_pos_below") - F.col("n_pos")
    shares = points.select(
        "model", "score",
        ((F.col("n_neg_below") + F.col("n_neg") / 2.0) / F.col("n_neg_total")).alias("_v_pos"),
        ((pos_above + F.col("n_pos") / 2.0) / F.col("n_pos_total")).alias("_v_neg"),
        (F.col("n_pos") + F.col("n_neg")).alias("_size"),
        (F.col("n_pos_total") + F.col("n_neg_total")).alias("_total"),
    )
    rows = attach_by_value(long, shares, ["model"], "score", F.col("_size"), F.col("_total"), "id",
                           point_sizes(placed, ["model"], "score", list(counters)))
    return rows.select(
        "id", "y", "model", "score",
        F.when(F.col("y") == 1, F.col("_v_pos")).otherwise(F.col("_v_neg")).alias("v"),
    )


def _pivoted(long: DataFrame, models: Sequence[str]) -> DataFrame:
    return components(long).groupBy("id", "y").agg(*[
        F.max(F.when(F.col("model") == m, F.col("v"))).alias(f"v{i}")
        for i, m in enumerate(models)
    ])


def covariance(long: DataFrame, models: Sequence[str]) -> DataFrame:
    """``model_a, model_b, cov, var_a, var_b, auc_a, auc_b`` for all pairs a <= b, in the order of
    ``models``. One pass gives everything: the areas are class means of the same contributions."""
    pairs = list(combinations_with_replacement(range(len(models)), 2))
    per_class = _pivoted(long, models).groupBy("y").agg(
        F.count("*").alias("_n"),
        *[F.avg(f"v{i}").alias(f"_m{i}") for i in range(len(models))],
        *[F.covar_samp(f"v{i}", f"v{j}").alias(f"_c{i}_{j}") for i, j in pairs],
    )
    tall = per_class.select("y", "_n", F.inline(F.array(*[
        F.struct(F.lit(models[i]).alias("model_a"), F.lit(models[j]).alias("model_b"),
                 F.col(f"_c{i}_{j}").alias("_c"), F.col(f"_c{i}_{i}").alias("_va"),
                 F.col(f"_c{j}_{j}").alias("_vb"), F.col(f"_m{i}").alias("_ma"),
                 F.col(f"_m{j}").alias("_mb"))
        for i, j in pairs
    ])))
    positive = F.col("y") == 1
    # A class of one row has no variance, so neither has the area.
    total = lambda c: F.when(F.count(c) == 2, F.sum(F.col(c) / F.col("_n")))
    return tall.groupBy("model_a", "model_b").agg(
        total("_c").alias("cov"),
        total("_va").alias("var_a"),
        total("_vb").alias("var_b"),
        F.max(F.when(positive, F.col("_ma"))).alias("auc_a"),
        F.max(F.when(positive, F.col("_mb"))).alias("auc_b"),
    )


def auc_intervals(cov: DataFrame) -> DataFrame:
    """``model, auc, var, ci_low, ci_high`` from the diagonal."""
    half = Z95 * F.sqrt("cov")
    return cov.where(F.col("model_a") == F.col("model_b")).select(
        F.col("model_a").alias("model"), F.col("auc_a").alias("auc"), F.col("cov").alias("var"),
        (F.col("auc_a") - half).alias("ci_low"), (F.col("auc_a") + half).alias("ci_high"),
    )


def paired_tests(cov: DataFrame, comparisons: DataFrame) -> DataFrame:
    """Difference, interval, z and p for each row of ``comparisons (family, model_a, model_b)``,
    whichever way round a pair is asked for."""
    swap = {"model_a": "model_b", "model_b": "model_a", "cov": "cov", "var_a": "var_b",
            "var_b": "var_a", "auc_a": "auc_b", "auc_b": "auc_a"}
    both = cov.where(F.col("model_a") != F.col("model_b")).select(F.inline(F.array(
        F.struct(*swap), F.struct(*[F.col(c).alias(name) for name, c in swap.items()])
    )))
    variance = F.col("var_a") + F.col("var_b") - 2 * F.col("cov")
    tested = comparisons.join(both, ["model_a", "model_b"]).withColumns({
        "delta_auc": F.col("auc_a") - F.col("auc_b"),
        "se_delta": F.sqrt(F.greatest(variance, F.lit(0.0))),
        "_ha": Z95 * F.sqrt("var_a"), "_hb": Z95 * F.sqrt("var_b"),
    }).withColumn(
        "z", F.when(F.col("se_delta") > 0, F.col("delta_auc") / F.col("se_delta")).otherwise(0.0)
    )
    half = Z95 * F.col("se_delta")
    return tested.select(
        *comparisons.columns,
        "auc_a", (F.col("auc_a") - F.col("_ha")).alias("auc_a_ci_low"),
        (F.col("auc_a") + F.col("_ha")).alias("auc_a_ci_high"),
        "auc_b", (F.col("auc_b") - F.col("_hb")).alias("auc_b_ci_low"),
        (F.col("auc_b") + F.col("_hb")).alias("auc_b_ci_high"),
        "delta_auc", (F.col("delta_auc") - half).alias("delta_ci_low"),
        (F.col("delta_auc") + half).alias("delta_ci_high"),
        "se_delta", "z", normal_p("z").alias("p_value"),
    )


def compare_families(cov: DataFrame, comparisons: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``paired_tests`` with Holm adjustment inside each family and the practical flag."""
    adjusted = holm(paired_tests(cov, comparisons), ["family"], "p_value",
                    ["model_a", "model_b"], alpha)
    return adjusted.withColumn(
        "practical", F.abs(F.col("delta_auc")) >= F.lit(PRACTICAL)
    )


def comparison_table(models: DataFrame) -> DataFrame:
    """Families of comparisons from ``models (model, run, kind)``: all pairs inside each run, and
    the same kind across runs."""
    a = models.select(F.col("model").alias("model_a"), F.col("run").alias("run_a"),
                      F.col("kind").alias("kind_a"))
    b = models.select(F.col("model").alias("model_b"), F.col("run").alias("run_b"),
                      F.col("kind").alias("kind_b"))
    within = a.join(
        b, (F.col("run_a") == F.col("run_b")) & (F.col("model_a") < F.col("model_b"))
    ).select(F.concat(F.lit("within_"), "run_a").alias("family"), "model_a", "model_b")
    across = a.join(
        b, (F.col("kind_a") == F.col("kind_b")) & (F.col("run_a") < F.col("run_b"))
    ).select(F.lit("across").alias("family"), "model_a", "model_b")
    return within.unionByName(across)


def winners(tests: DataFrame) -> DataFrame:
    """Who wins each comparison, counting only practically relevant differences."""
    return tests.withColumn(
        "winner",
        F.when(~F.col("practical"), "tie")
        .when(F.col("delta_auc") > 0, F.col("model_a")).otherwise(F.col("model_b")),
    )

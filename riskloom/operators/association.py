"""Numeric variables against a 0/1 target and against each other."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.tails import normal_p
from riskloom.operators.profile import tall_numeric
from riskloom.operators.ranks import label_counts, pair_sum


def mann_whitney(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``variable, n_0, n_1, u, z``: U of class 0, asymptotic z with tie and continuity
    corrections (the two-sided statistic, so z belongs to the larger U)."""
    long = tall_numeric(df, columns, [target]).where(F.col(target).isNotNull())
    points = label_counts(long, ["variable"], "value", target)
    ties = (F.col("n_pos") + F.col("n_neg")).cast("double")
    twice = pair_sum(F.col("n_neg"), 2 * F.col("n_pos_below") + F.col("n_pos"))
    sums = points.groupBy("variable").agg(
        F.first("n_neg_total").alias("n_0"), F.first("n_pos_total").alias("n_1"),
        (twice / 2).alias("u"),
        F.sum(ties * ties * ties - ties).alias("_t"),
    )
    n0, n1 = F.col("n_0").cast("double"), F.col("n_1").cast("double")
    n = n0 + n1
    spread = F.sqrt(n0 * n1 / 12.0 * (n + 1.0 - F.col("_t") / (n * (n - 1.0))))
    larger = F.greatest(F.col("u"), n0 * n1 - F.col("u"))
    return sums.select(
        "variable", "n_0", "n_1", "u",
        F.when(spread > 0, (larger - n0 * n1 / 2.0 - 0.5) / spread).alias("z"),
    )


def with_normal_p(df: DataFrame, z: str = "z", p: str = "p_value") -> DataFrame:
    """Two-sided p-value; a statistic below zero (continuity correction) gives one."""
    return df.withColumn(p, normal_p(F.greatest(F.col(z), F.lit(0.0))))


def point_biserial(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``variable, r``: correlation of each variable with the target."""
    return (
        tall_numeric(df, columns, [target]).groupBy("variable")
        .agg(F.corr(F.col(target).cast("double"), F.col("value")).alias("r"))
    )


def pearson_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``var_a, var_b, r`` of all pairs in one pass; each pair uses the rows where both are known."""
    pairs = list(combinations(sorted(columns), 2))
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    row = values.agg(*[F.corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"_r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ])))


def mirrored(pairs: DataFrame, a: str, b: str, values: dict[str, int]) -> DataFrame:
    """Both triangles of a matrix given its upper one. ``values`` maps each value column to 1, or
    to -1 where the lower triangle has the other sign."""
    sides = F.array(
        F.struct(F.col(a).alias(a), F.col(b).alias(b), *values),
        F.struct(F.col(b).alias(a), F.col(a).alias(b),
                 *[(F.col(v) * sign).alias(v) for v, sign in values.items()]),
    )
    return pairs.select(F.inline(sides))


def nullity_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``var_a, var_b, r`` between missing indicators that vary. Rows are first reduced to their
    distinct patterns of missing columns, which combine before the shuffle."""
    names = sorted(columns)
    patterns = (
        df.select(F.array(*[F.col(c).isNull().cast("int") for c in names]).alias("_p"))
        .groupBy("_p").agg(F.count("*").cast("double").alias("_n"))
    )
    index = F.array(*[
        F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                 F.get("_p", F.lit(i)).alias("x"), F.get("_p", F.lit(j)).alias("y"))
        for (i, a), (j, b) in combinations(enumerate(names), 2)
    ])
    sums = (
        patterns.select("_n", F.explode(index).alias("_k")).select("_n", "_k.*")
        .groupBy("var_a", "var_b")
        .agg(F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("x")).alias("sx"),
             F.sum(F.col("_n") * F.col("y")).alias("sy"),
             F.sum(F.col("_n") * F.col("x") * F.col("y")).alias("sxy"))
    )
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread = sx * (n - sx) * sy * (n - sy)
    return sums.where(spread > 0).select(
        "var_a", "var_b", ((n * F.col("sxy") - sx * sy) / F.sqrt(spread)).alias("r")
    )

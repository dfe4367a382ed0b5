"""Chi-square independence, Cramer's V and missingness tests from long contingency tables.

The statistic needs no full row x column grid: expected counts over all cells add up to the
number of rows, so the empty cells contribute that number less the expected counts of the cells
that occur.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.tails import chi2_p
from riskloom.operators.profile import tall_text
from riskloom.operators.ranks import same_keys


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """``a, b, n`` of the rows where both are known."""
    return (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(a, b).agg(F.count("*").alias("n"))
    )


def chi2_independence(counts: DataFrame, by: Sequence[str], a: str = "a", b: str = "b",
                      n: str = "n") -> DataFrame:
    """``by, n, r, c, dof, chi2`` per table; continuity correction where there is one degree."""
    by = list(by)
    table = counts.select(*by, F.col(a).alias("_a"), F.col(b).alias("_b"), F.col(n).alias("_n"))
    # Marginals are combined before the shuffle, so a value with very many partners is no one task.
    per_a = table.groupBy(*by, "_a").agg(F.sum("_n").alias("_ra"), F.count("*").alias("_ka"))
    per_b = table.groupBy(*by, "_b").agg(F.sum("_n").alias("_cb"), F.count("*").alias("_kb"))
    totals = table.groupBy(*by).agg(F.sum("_n").alias("_total"))
    cells = (
        same_keys(same_keys(same_keys(table, per_a, [*by, "_a"]), per_b, [*by, "_b"]), totals, by)
        .withColumn("_e", F.col("_ra").cast("double") * F.col("_cb") / F.col("_total"))
    )
    stats = cells.groupBy(*by).agg(
        F.first("_total").alias("n"),
        F.round(F.sum(1.0 / F.col("_ka"))).cast("long").alias("r"),
        F.round(F.sum(1.0 / F.col("_kb"))).cast("long").alias("c"),
        F.sum((F.col("_n") - F.col("_e")) * (F.col("_n") - F.col("_e")) / F.col("_e"))
        .alias("_seen"),
        F.sum("_e").alias("_expected"),
        F.sum(1.0 / (F.col("_ra") * F.col("_ka"))).alias("_inv_a"),
        F.sum(1.0 / (F.col("_cb") * F.col("_kb"))).alias("_inv_b"),
    )
    plain = F.greatest(F.col("_seen") + F.col("n") - F.col("_expected"), F.lit(0.0))
    inverse = F.col("_inv_a") * F.col("_inv_b") * F.col("n")
    gap = F.sqrt(plain / inverse)
    corrected = F.pow(F.greatest(gap - 0.5, F.lit(0.0)), 2) * inverse
    return stats.withColumn("dof", (F.col("r") - 1) * (F.col("c") - 1)).select(
        *by, "n", "r", "c", "dof",
        F.when(F.col("dof") == 1, corrected).when(F.col("dof") == 0, 0.0)
        .otherwise(plain).alias("chi2"),
    )


def with_chi2_p(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "p_value", F.when(F.col("dof") > 0, chi2_p("chi2", F.col("dof").cast("double")))
        .otherwise(1.0)
    )


def category_vs_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Chi-square of every category column against the target."""
    counts = (
        tall_text(df, columns, [target])
        .where(F.col("value").isNotNull() & F.col(target).isNotNull())
        .groupBy("variable", "value", target).agg(F.count("*").alias("n"))
    )
    return chi2_independence(counts, ["variable"], "value", target)


def rate_extremes(rates: DataFrame) -> DataFrame:
    """Category with the highest and the lowest rate per variable; equal rates go by name."""
    return rates.groupBy("variable").agg(
        F.max(F.struct("rate", "value")).alias("_hi"), F.min(F.struct("rate", "value")).alias("_lo")
    ).select(
        "variable", F.col("_hi.value").alias("highest"), F.col("_hi.rate").alias("highest_rate"),
        F.col("_lo.value").alias("lowest"), F.col("_lo.rate").alias("lowest_rate"),
    )


def cramers_v(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``var_a, var_b, cramers_v`` of all column pairs, in one job: rows are first combined to the
    distinct combinations of all columns, and only those are taken apart into pairs."""
    names = sorted(columns)
    combined = df.groupBy(*[F.col(c).cast("string").alias(c) for c in names]).agg(F.count("*").alias("_rows"))
    pairs = F.array(*[
        F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                 F.col(a).alias("a"), F.col(b).alias("b"))
        for a, b in combinations(names, 2)
    ])
    counts = (
        combined.select("_rows", F.explode(pairs).alias("_p")).select("_rows", "_p.*")
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("var_a", "var_b", "a", "b").agg(F.sum("_rows").alias("n"))
    )
    table = chi2_independence(counts, ["var_a", "var_b"])
    smaller = F.least(F.col("r"), F.col("c")) - 1
    return table.select(
        "var_a", "var_b",
        F.when(smaller > 0, F.sqrt(F.col("chi2") / F.col("n") / smaller)).alias("cramers_v"),
    )


def missingness_vs_target(df: DataFrame, columns: Sequence[str], target: str,
                          low: float = 0.5, high: float = 99.0) -> DataFrame:
    """Does a value being missing go with the target? Variables with low < missing % < high;
    an indicator that never changes has no table and is left out."""
    flags = df.select(
        F.col(target).alias("_y"), *[F.col(c).isNull().cast("int").alias(c) for c in columns]
    ).unpivot(["_y"], list(columns), "variable", "is_missing")
    counts = flags.groupBy("variable", "is_missing", "_y").agg(F.count("*").alias("n"))
    missing = F.col("is_missing") == 1
    rates = counts.groupBy("variable").agg(
        (F.sum(F.when(missing, F.col("n")).otherwise(0)) / F.sum("n") * 100).alias("pct_missing"),
        (F.sum(F.when(missing, F.col("n") * F.col("_y")))
         / F.sum(F.when(missing, F.col("n"))) * 100).alias("rate_if_missing"),
        (F.sum(F.when(~missing, F.col("n") * F.col("_y")))
         / F.sum(F.when(~missing, F.col("n"))) * 100).alias("rate_if_present"),
        F.count_distinct("is_missing").alias("_levels"),
    ).where((F.col("pct_missing") > low) & (F.col("pct_missing") < high)
            & (F.col("_levels") > 1)).drop("_levels")
    tests = chi2_independence(
        counts.where(F.col("_y").isNotNull()), ["variable"], "is_missing", "_y"
    )
    return tests.join(rates, "variable").select(
        "variable", "pct_missing", "chi2", "dof", "rate_if_missing", "rate_if_present"
    )

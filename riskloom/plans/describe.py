"""All description tables of a data set, as DataFrames by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.clean import treatment_rule
from riskloom.operators import association, charts, contingency, normality, profile
from riskloom.roles import Roles
from riskloom.sources import write_result_csv


def describe(df: DataFrame, roles: Roles, profile_columns: list[str] | None = None,
             leakage_patterns: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Profile, summaries, tests against the target and correlations. Lazy apart from the fitted
    cut points; ``df`` should be a stored table, since each table here scans it."""
    y, numeric, categorical = roles.target, list(roles.numeric), list(roles.categorical)
    columns = profile.column_profile(df, profile_columns or df.columns)
    counts = profile.with_share(profile.value_counts(df, categorical), df)
    rates = profile.group_rate(df, categorical, y)
    pairs = association.pearson_pairs(df, numeric)
    tests = association.with_normal_p(association.mann_whitney(df, numeric, y))
    chi2 = contingency.with_chi2_p(contingency.category_vs_target(df, categorical, y))
    missing = contingency.with_chi2_p(
        contingency.missingness_vs_target(df, numeric + categorical, y)
    )
    return {
        "column_profile": columns.withColumn("plan", treatment_rule("pct_missing", "dtype")),
        "usable_columns": profile.select_columns(columns, leakage_patterns),
        "target": df.groupBy(y).agg(F.count("*").alias("n")),
        "numeric_summary": profile.numeric_summary(df, numeric),
        "shapiro": normality.shapiro_wilk(df, roles.id, numeric),
        "histograms": charts.histogram(df, numeric),
        "categorical_summary": profile.categorical_summary(df, categorical),
        "frequencies": counts,
        "numeric_vs_target": tests.join(profile.class_means(df, numeric, y), "variable")
        .join(association.point_biserial(df, numeric, y), "variable"),
        "categorical_vs_target": chi2.join(contingency.rate_extremes(rates), "variable"),
        "default_rates": profile.top_per_group(
            rates, ["variable"], [F.desc("rate"), F.asc("value")], 15),
        "correlation_matrix": association.mirrored(pairs, "var_a", "var_b", {"r": 1}),
        "strong_correlations": pairs.where(F.abs("r") > 0.7),
        "cramers_v": contingency.cramers_v(df, categorical).orderBy(F.desc("cramers_v")),
        "nullity_correlation": association.nullity_correlation(df, numeric + categorical),
        "missingness_vs_target": missing.orderBy("p_value"),
    }


def write_all(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        write_result_csv(table, f"{folder}/{name}")

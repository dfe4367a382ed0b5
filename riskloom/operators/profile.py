"""Profiles of wide tables: counts, shares, summaries. One job serves all columns of a call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.quantiles import fitted_quantiles, quantile_columns


def tall_text(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep, variable, value`` with every value as text; nulls are kept."""
    return df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        list(keep), list(columns), "variable", "value"
    )


def tall_numeric(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep, variable, value`` with every value as double; nulls are kept."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keep), list(columns), "variable", "value"
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``variable, value, n`` with null as a value of its own."""
    return tall_text(df, columns).groupBy("variable", "value").agg(F.count("*").alias("n"))


def with_share(counts: DataFrame, df: DataFrame, n: str = "n", share: str = "pct") -> DataFrame:
    """Adds ``n`` as a percentage of all rows of ``df``."""
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn(share, F.col(n) / total * 100)


def group_rate(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``variable, value, n, rate``: percentage of positives per category; null categories out."""
    return (
        tall_text(df, columns, [target]).where(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.count("*").alias("n"), (F.avg(target) * 100).alias("rate"))
    )


def column_profile(df: DataFrame, columns: Sequence[str] | None = None,
                   approximate: bool = False) -> DataFrame:
    """``variable, dtype, n_missing, pct_missing, n_unique`` for every column."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    dtype = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    if approximate:
        table = tall_text(df, columns).groupBy("variable").agg(
            F.count("*").alias("_n"),
            F.count_if(F.col("value").isNull()).alias("n_missing"),
            F.approx_count_distinct("value").alias("n_unique"),
        )
    else:
        # A long text is counted by its digest, so that its values need not be shuffled whole.
        short = tall_text(df, columns).withColumn("value", F.when(
            F.length("value") > 40, F.concat(F.lit("#"), F.md5("value"), F.length("value").cast("string")))
            .otherwise(F.col("value")))
        counted = short.groupBy("variable", "value").agg(F.count("*").alias("n"))
        table = counted.groupBy("variable").agg(
            F.sum("n").alias("_n"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
            .alias("n_missing"),
            F.count("value").alias("n_unique"),
        )
    # A table without rows has a profile row per column too.
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "variable string")
    table = every.join(F.broadcast(table), "variable", "left").na.fill(0, ["_n", "n_missing", "n_unique"])
    return table.select(
        "variable", F.element_at(dtype, F.col("variable")).alias("dtype"), "n_missing",
        F.round(F.when(F.col("_n") > 0, F.col("n_missing") / F.col("_n") * 100), 2).alias("pct_missing"),
        "n_unique",
    )


def completeness_counts(profile: DataFrame) -> DataFrame:
    """How many columns are complete, and how many miss more than 30 and 70 percent."""
    pct = F.col("pct_missing")
    return profile.agg(
        F.count_if(pct == 0).alias("n_complete"),
        F.count_if(pct > 30).alias("n_over_30"),
        F.count_if(pct > 70).alias("n_over_70"),
    )


def select_columns(profile: DataFrame, exclude_patterns: Sequence[str],
                   max_missing: float = 70.0) -> DataFrame:
    """Columns known at the origin of a row: not matching a leakage, text or id pattern and not
    mostly missing."""
    keep = F.col("pct_missing") <= max_missing
    for pattern in exclude_patterns:
        keep = keep & ~F.col("variable").rlike(pattern)
    return profile.where(keep)


def adjusted_skewness(column: str | Column) -> Column:
    """Bias-adjusted skewness; the built-in one is not adjusted."""
    n = F.count(column)
    return F.skewness(column) * F.sqrt(n * (n - 1.0)) / F.nullif(n - F.lit(2), F.lit(0))


def fences(long: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Quartiles and 1.5 IQR fences per group."""
    q = quantile_columns(long, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.select(
        *by, "q1", "median", "q3", iqr.alias("iqr"),
        (F.col("q1") - 1.5 * iqr).alias("low_fence"),
        (F.col("q3") + 1.5 * iqr).alias("high_fence"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments, quartiles, 1.5 IQR outliers, skewness and missing share of every variable."""
    long = tall_numeric(df, columns)
    fence = fences(long, ["variable"])
    value = F.col("value")
    outside = (value < F.col("low_fence")) | (value > F.col("high_fence"))
    return (
        # As many fences as columns; a variable without values has none but keeps its row.
        long.join(F.broadcast(fence), "variable", "left")
        .groupBy("variable")
        .agg(
            F.avg("value").alias("mean"), F.first("median").alias("median"),
            F.stddev_samp("value").alias("sd"), F.min("value").alias("min"),
            F.first("q1").alias("q1"), F.first("q3").alias("q3"), F.max("value").alias("max"),
            F.first("iqr").alias("iqr"), F.count_if(outside).alias("n_outliers"),
            (F.try_divide(F.count_if(outside), F.count("value")) * 100).alias("pct_outliers"),
            adjusted_skewness("value").alias("skewness"),
            (F.count_if(value.isNull()) / F.count("*") * 100).alias("pct_missing"),
        )
    )


def describe_all(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row per column: count; unique, top and freq for text; mean, sd, range and quartiles
    for numbers."""
    long = tall_numeric(df, numeric)
    quart = quantile_columns(long, ["variable"], "value",
                             {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    numbers = (
        long.groupBy("variable")
        .agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
             F.stddev_samp("value").alias("sd"), F.min("value").alias("min"),
             F.max("value").alias("max"))
        .join(F.broadcast(quart), "variable", "left")
    )
    known = F.col("value").isNotNull()
    texts = (
        value_counts(df, categorical).groupBy("variable")
        .agg(F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("count"), F.count_if(known).alias("unique"),
             F.max(F.when(known, F.struct(F.col("n"), F.col("value")))).alias("_top"))
        .select("variable", "count", "unique", F.col("_top.value").alias("top"),
                F.col("_top.n").alias("freq"))
    )
    return texts.unionByName(numbers, allowMissingColumns=True)


def categorical_summary(df: DataFrame, columns: Sequence[str],
                        rare_below: float = 1.0) -> DataFrame:
    """Categories, rare categories, missing share, and the most frequent value (null counts as
    a value, ties go to the larger text)."""
    counts = with_share(value_counts(df, columns), df)
    return (
        counts.groupBy("variable")
        .agg(
            F.count("value").alias("n_categories"),
            F.count_if(F.round("pct", 2) < rare_below).alias("n_rare"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("pct"))), F.lit(0.0))
            .alias("pct_missing"),
            F.max(F.struct("n", "value", "pct")).alias("_top"),
        )
        .select("variable", "n_categories", "n_rare", "pct_missing",
                F.col("_top.value").alias("top_value"), F.col("_top.pct").alias("pct_top"))
    )


def class_means(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``variable, mean_0, mean_1, diff``."""
    value, y = F.col("value"), F.col(target)
    return (
        tall_numeric(df, columns, [target]).groupBy("variable")
        .agg(F.avg(F.when(y == 0, value)).alias("mean_0"),
             F.avg(F.when(y == 1, value)).alias("mean_1"))
        .withColumn("diff", F.col("mean_1") - F.col("mean_0"))
    )


def frequent_values(train: DataFrame, columns: Sequence[str],
                    threshold: float = 0.01) -> DataFrame:
    """``variable, value, n, freq`` of the categories that reach the threshold in ``train``.
    Holds at most 1/threshold rows per column. Missing rows count in the denominator."""
    total = train.agg(F.count("*")).scalar()
    counts = value_counts(train, columns).where(F.col("value").isNotNull())
    return counts.withColumn("freq", F.col("n") / total).where(F.col("freq") >= threshold)


def group_rare(df: DataFrame, keep: DataFrame, columns: Sequence[str], other: str = "OTHER",
               suffix: str = "_grouped") -> DataFrame:
    """Adds ``<column><suffix>``: the category if it is in ``keep``, else ``other``."""
    out = df
    for c in columns:
        names = keep.where(F.col("variable") == c).select(F.col("value").alias(c + suffix))
        out = out.join(
            F.broadcast(names), F.col(c).cast("string") == F.col(c + suffix), "left"
        ).withColumn(c + suffix, F.coalesce(c + suffix, F.lit(other)))
    return out


def clip_at_quantile(df: DataFrame, columns: Sequence[str], prob: float = 0.99) -> DataFrame:
    """Every column cut off above at its own quantile."""
    caps = fitted_quantiles(df, columns, prob)
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.least(F.col(c), F.lit(cap))) for c, cap in caps.items()
    })


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group in the given order, with their ``rank``."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)

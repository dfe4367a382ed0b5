"""The tables behind the charts: bars, histograms, boxes, densities, matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.clean import missing_flag
from riskloom.operators.profile import fences, tall_numeric
from riskloom.operators.ranks import same_keys
from riskloom.operators.sampling import fixed_sample
from riskloom.session import checked


def _with_range(long: DataFrame, by: Sequence[str]) -> DataFrame:
    known = long.where(F.col("value").isNotNull())
    ranges = known.groupBy(*by).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    return same_keys(known, checked(ranges), list(by))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 60) -> DataFrame:
    """``variable, bin, n``: equal-width bins between minimum and maximum, the last one closed."""
    placed = F.least(
        F.floor((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins),
        F.lit(bins - 1),
    )
    return (
        _with_range(tall_numeric(df, columns), ["variable"])
        .withColumn("bin", F.when(F.col("_hi") > F.col("_lo"), placed).otherwise(0).cast("int"))
        .groupBy("variable", "bin").agg(F.count("*").alias("n"))
    )


def box_stats(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (furthest values inside 1.5 IQR) and number of points beyond them."""
    by = list(by)
    value = F.col("value")
    inside = (value >= F.col("low_fence")) & (value <= F.col("high_fence"))
    return (
        same_keys(long.where(value.isNotNull()), checked(fences(long, by)), by)
        .groupBy(*by)
        .agg(
            F.first("q1").alias("q1"), F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("n_fliers"),
        )
    )


def density(long: DataFrame, by: Sequence[str], points: int = 100, bins: int = 256) -> DataFrame:
    """Gaussian kernel density per group at ``points`` places, Scott's bandwidth.

    Rows are first counted in ``bins`` narrow bins, each represented by its middle, so the kernel
    sum runs over groups x points x bins terms whatever the number of rows.
    """
    by = list(by)
    known = long.where(F.col("value").isNotNull())
    shape = known.groupBy(*by).agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"),
        F.stddev_samp("value").alias("_sd"), F.count("*").alias("_n"),
    ).where((F.col("_hi") > F.col("_lo")) & (F.col("_sd") > 0))
    shape = checked(shape)
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.least(F.floor((F.col("value") - F.col("_lo")) / width), F.lit(bins - 1))
    counts = (
        same_keys(known, shape, by).withColumn("_bin", at)
        .groupBy(*by, "_bin").agg(F.count("*").alias("_c"))
    )
    counts = (
        same_keys(counts, shape, by)
        .withColumn("_mid", F.col("_lo") + (F.col("_bin") + 0.5) * width)
        .withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    )
    step = (F.col("_hi") - F.col("_lo")) / (points - 1)
    spread = counts.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("_lo") + F.col("point") * step
    scaled = (F.col("x") - F.col("_mid")) / F.col("_h")
    kernel = F.exp(-0.5 * scaled * scaled) / (F.col("_h") * 2.5066282746310002)
    return (
        spread.withColumn("x", x)
        .groupBy(*by, "point")
        .agg(F.first("x").alias("x"), F.sum(kernel * F.col("_c") / F.col("_n")).alias("density"))
    )


def nullity_sample(df: DataFrame, id_col: str, columns: Sequence[str], n: int = 5000,
                   seed: int = 42) -> DataFrame:
    """0/1 missing flags of a fixed-size sample of rows."""
    return fixed_sample(df, id_col, n, seed).select(
        id_col, *[missing_flag(c).alias(c) for c in columns]
    )

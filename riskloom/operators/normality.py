"""Shapiro-Wilk test on a fixed-size sample of every variable (Royston 1995, AS R94)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.tails import normal_p
from riskloom.operators.profile import tall_numeric
from riskloom.operators.sampling import fixed_sample

# The published polynomial coefficients, lowest power first.
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
SECOND_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SMALL_MEAN = (0.5440, -0.39978, 0.025054, -6.714e-4)
SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)
SMALL_GAMMA = (-2.273, 0.459)


# Wichura's rational approximation of the normal quantile (AS 241), lowest power first.
MIDDLE = ((3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
           45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
          (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867,
           39307.895800092710610, 28729.085735721942674, 5226.4952788528545610))
TAIL = ((1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
         1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4),
        (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550, 0.148103976427480074590,
         0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
FAR = ((6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
        0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
       (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525, 7.86869131145613259100e-4,
        1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))


def normal_quantile(p: Column) -> Column:
    """Value below which a standard normal variable lies with probability ``p``."""
    q = p - 0.5
    r = F.lit(0.180625) - q * q
    far = F.sqrt(-F.log(F.least(p, 1.0 - p)))
    part = lambda pair, x: _poly(pair[0], x) / _poly(pair[1], x)
    outer = F.when(far <= 5.0, part(TAIL, far - 1.6)).otherwise(part(FAR, far - 5.0))
    return F.when(F.abs(q) <= 0.425, q * part(MIDDLE, r)).otherwise(F.signum(q) * outer)


def _poly(coefficients: Sequence[float], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def shapiro_wilk(df: DataFrame, id_col: str, columns: Sequence[str], n: int = 5000,
                 seed: int = 42) -> DataFrame:
    """``variable, n, w, p_value`` from three known values on. Constant values have w = 1 and p = 1."""
    known = tall_numeric(df, columns, [id_col]).where(F.col("value").isNotNull())
    sample = fixed_sample(known, id_col, n, seed, by=["variable"])
    size = F.count("*").over(Window.partitionBy("variable"))
    rank = F.row_number().over(Window.partitionBy("variable").orderBy("value"))
    scored = (
        sample.select("variable", "value", size.alias("n"), rank.alias("i"))
        .where(F.col("n") >= 3)
        .withColumn("m", normal_quantile((F.col("i") - 0.375) / (F.col("n") + 0.25)))
    )
    first, second = F.col("i") == F.col("n"), F.col("i") == F.col("n") - 1
    sums = scored.groupBy("variable").agg(
        F.first("n").alias("n"), F.sum(F.col("m") * F.col("m")).alias("ssq"),
        F.max(F.when(first, F.col("m"))).alias("m1"),
        F.max(F.when(second, F.col("m"))).alias("m2"),
        # Sum of m * x without the two extremes on each side, and the extremes themselves.
        F.sum(F.when((F.col("i") > 2) & (F.col("i") < F.col("n") - 1),
                     F.col("m") * F.col("value")).otherwise(0.0)).alias("mx"),
        F.max(F.when(first, F.col("value"))).alias("x_last"),
        F.max(F.when(second, F.col("value"))).alias("x_second"),
        F.max(F.when(F.col("i") == 1, F.col("value"))).alias("x_first"),
        F.max(F.when(F.col("i") == 2, F.col("value"))).alias("x_next"),
        (F.var_pop("value") * F.count("*")).alias("ss"),
    )
    n_ = F.col("n").cast("double")
    u = 1.0 / F.sqrt(n_)
    # Three values have one weight, four and five one that is corrected, more have two.
    a1 = F.when(n_ == 3, F.lit(math.sqrt(0.5))).otherwise(F.col("m1") / F.sqrt("ssq") + _poly(LAST_WEIGHT, u))
    one = (F.col("ssq") - 2 * F.col("m1") ** 2) / (1 - 2 * F.col("a1") ** 2)
    both = (F.col("ssq") - 2 * F.col("m1") ** 2 - 2 * F.col("m2") ** 2) / (
        1 - 2 * F.col("a1") ** 2 - 2 * F.col("a2") ** 2)
    weights = sums.withColumn("a1", a1).withColumn(
        "a2", F.when(n_ == 3, 0.0).when(n_ <= 5, F.col("m2") / F.sqrt(one))
        .otherwise(F.col("m2") / F.sqrt("ssq") + _poly(SECOND_WEIGHT, u))
    ).withColumn("phi", F.when(n_ == 3, 1.0).when(n_ <= 5, one).otherwise(both))
    top = (
        F.col("mx") / F.sqrt("phi") + F.col("a1") * (F.col("x_last") - F.col("x_first"))
        + F.col("a2") * (F.col("x_second") - F.col("x_next"))
    )
    constant = F.col("x_last") == F.col("x_first")
    stat = weights.withColumn(
        "w", F.when(constant, 1.0).otherwise(F.least(F.lit(1.0), top * top / F.col("ss")))
    )
    gap = F.log(F.greatest(1.0 - F.col("w"), F.lit(1e-19)))
    ln = F.log(n_)
    large = (gap - _poly(LARGE_MEAN, ln)) / F.exp(_poly(LARGE_LOG_SD, ln))
    small = (
        -F.log(_poly(SMALL_GAMMA, n_) - gap) - _poly(SMALL_MEAN, n_)
    ) / F.exp(_poly(SMALL_LOG_SD, n_))
    z = F.when(n_ >= 12, large).otherwise(small)
    two_sided = normal_p("z")
    three = 6.0 / math.pi * (F.asin(F.sqrt("w")) - math.asin(math.sqrt(0.75)))
    return stat.withColumn("z", z).select(
        "variable", "n", "w",
        F.when(constant, 1.0).when(n_ == 3, F.greatest(three, F.lit(0.0)))
        .when(F.col("z") >= 0, two_sided / 2).otherwise(1 - two_sided / 2).alias("p_value"),
    )

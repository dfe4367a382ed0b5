"""Paired comparison of right and wrong predictions at fixed thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.tails import mcnemar_p

EXACT_BELOW = 25


def concordance(wide: DataFrame, label: str, thresholds: Mapping[str, float],
                comparisons: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``kind, model_a, model_b, n11, n10, n01, n00, error_a, error_b`` in one pass over the wide
    score table (a column per model). ``comparisons`` lists (kind, model a, model b)."""
    right = {
        m: (F.when(F.col(m) >= F.lit(t), 1).otherwise(0) == F.col(label))
        for m, t in thresholds.items()
    }
    counts = []
    for i, (_, a, b) in enumerate(comparisons):
        counts += [
            F.count_if(right[a] & right[b]).alias(f"n11_{i}"),
            F.count_if(right[a] & ~right[b]).alias(f"n10_{i}"),
            F.count_if(~right[a] & right[b]).alias(f"n01_{i}"),
            F.count_if(~right[a] & ~right[b]).alias(f"n00_{i}"),
        ]
    rows = wide.agg(*counts).select(F.inline(F.array(*[
        F.struct(
            F.lit(kind).alias("kind"), F.lit(a).alias("model_a"), F.lit(b).alias("model_b"),
            F.lit(float(thresholds[a])).alias("threshold_a"),
            F.lit(float(thresholds[b])).alias("threshold_b"),
            *[F.col(f"{n}_{i}").alias(n) for n in ("n11", "n10", "n01", "n00")],
        )
        for i, (kind, a, b) in enumerate(comparisons)
    ])))
    total = F.col("n11") + F.col("n10") + F.col("n01") + F.col("n00")
    return rows.withColumns({
        "error_a": (F.col("n01") + F.col("n00")) / total,
        "error_b": (F.col("n10") + F.col("n00")) / total,
    })


def mcnemar(table: DataFrame) -> DataFrame:
    """Adds ``discordant, exact, statistic``: exact binomial below 25 discordant rows, otherwise
    chi-square with continuity correction."""
    b, c = F.col("n10"), F.col("n01")
    exact = (b + c) < EXACT_BELOW
    corrected = F.pow(F.abs(b - c) - 1.0, 2) / (b + c)
    return table.withColumns({
        "discordant": b + c,
        "exact": exact,
        "statistic": F.when(exact, F.least(b, c).cast("double")).otherwise(corrected),
    })


def with_mcnemar_p(table: DataFrame) -> DataFrame:
    return table.withColumn("p_value", mcnemar_p("n10", "n01", "statistic", "exact"))

"""Adjustment for multiple comparisons on result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def holm(tests: DataFrame, family: Sequence[str], p: str, key: Sequence[str],
         alpha: float = 0.05) -> DataFrame:
    """Adds ``p_holm`` and ``reject``: step-down adjusted p-values inside each family."""
    order = Window.partitionBy(*family).orderBy(F.col(p), *key)
    size = F.count("*").over(Window.partitionBy(*family))
    stepped = (size - F.row_number().over(order) + 1) * F.col(p)
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    return (
        tests.withColumn("_step", stepped)
        .withColumn("p_holm", F.least(F.lit(1.0), F.max("_step").over(running)))
        .drop("_step")
        .withColumn("reject", F.col("p_holm") < F.lit(alpha))
    )

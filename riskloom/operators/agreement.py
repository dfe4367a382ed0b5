"""One table from the three paired tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.clean import as_interval_text


def oriented(tests: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``tests`` for the pairs of ``wanted``, whichever way round they were computed: a
    pair found as (b, a) gets its difference with the other sign."""
    low, high = F.least("model_a", "model_b"), F.greatest("model_a", "model_b")
    keyed = tests.select(
        low.alias("_low"), high.alias("_high"),
        F.when(F.col("model_a") <= F.col("model_b"), 1.0).otherwise(-1.0).alias("_sign"),
        *[F.col(c).alias(f"_t_{c}") for c in ("delta_auc", "p_holm", "reject")],
    )
    asked = wanted.withColumns({
        "_low": low, "_high": high,
        "_asked": F.when(F.col("model_a") <= F.col("model_b"), 1.0).otherwise(-1.0),
    })
    return asked.join(keyed, ["_low", "_high"]).select(
        *wanted.columns,
        (F.col("_t_delta_auc") * F.col("_sign") * F.col("_asked")).alias("delta_auc"),
        F.col("_t_p_holm").alias("p_holm"), F.col("_t_reject").alias("reject"),
    )


def three_test_table(delong: DataFrame, mcnemar: DataFrame, bootstrap: DataFrame,
                     practical: float = 0.005) -> DataFrame:
    """DeLong, McNemar and bootstrap side by side; ``all_agree`` where all three reject."""
    keys = ["kind", "model_a", "model_b"]
    pairs = mcnemar.select(*keys, F.col("reject").alias("mcnemar_reject"))
    boot = bootstrap.select(
        *keys, F.col("delta_auc").alias("bootstrap_delta_auc"),
        as_interval_text("auc_ci_low", "auc_ci_high").alias("bootstrap_ci"),
        F.col("auc_excludes_zero").alias("bootstrap_excludes_zero"),
    )
    return (
        oriented(delong, pairs).join(boot, keys)
        .select(
            *keys, F.col("delta_auc").alias("delong_delta_auc"),
            F.col("reject").alias("delong_reject"),
            (F.abs("delta_auc") >= practical).alias("delong_practical"),
            "mcnemar_reject", "bootstrap_delta_auc", "bootstrap_ci", "bootstrap_excludes_zero",
        )
        .withColumn("all_agree", F.col("delong_reject") & F.col("mcnemar_reject")
                    & F.col("bootstrap_excludes_zero"))
    )

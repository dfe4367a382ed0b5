"""Two stored runs to the paired comparison of all their models."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import (
    agreement, bootstrap, delong, mcnemar, metrics, multiple, profile, quality, sampling,
)
from riskloom.session import materialize, small_table


@dataclass(frozen=True)
class ScoreSet:
    """A stored run: wide score tables of both sets, and column name by model family."""

    name: str
    train: DataFrame
    test: DataFrame
    columns: Mapping[str, str]


def _aligned(runs: list[ScoreSet], part: str, id_col: str, label: str) -> DataFrame:
    """Both runs in one wide table, joined by id: ``id, y, <run>_<family>...``. An id that only one run has, or a
    label that differs, fails the job that reads the table."""
    tables = [
        getattr(r, part).select(
            F.col(id_col).cast("string").alias("id"), F.col(label).cast("int").alias(f"_y{i}"),
            *[F.col(c).cast("double").alias(f"{r.name}_{family}")
              for family, c in r.columns.items()],
        )
        for i, r in enumerate(runs)
    ]
    joined = tables[0].join(tables[1], "id", "full")
    # A run's row has a label, so a missing one means a missing row.
    good = F.coalesce(F.col("_y0") == F.col("_y1"), F.lit(False))
    return joined.where(F.when(good, F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit("the runs do not agree on id "), "id")).cast("boolean"))).withColumnRenamed("_y0", "y").drop("_y1")


def compare_runs(a: ScoreSet, b: ScoreSet, id_col: str, label: str, replicates: int = 2000,
                 bootstrap_rows: int | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """DeLong families, McNemar at training-set thresholds, paired bootstrap, and the table of all
    three. The bootstrap takes all rows; a caller may ask for a stratified sample of
    ``bootstrap_rows``.

    The aligned tables are written once: every test below reads them again.
    """
    runs = [a, b]
    spark = a.test.sparkSession
    names = [f"{r.name}_{family}" for r in runs for family in r.columns]
    families = small_table(
        spark, [(f"{r.name}_{family}", r.name, family) for r in runs for family in r.columns],
        "model string, run string, kind string",
    )
    checks = quality.join_kept_rows(a.test, b.test, id_col).unionByName(
        quality.labels_equal(a.test, b.test, id_col, label)
    )
    test = materialize(_aligned(runs, "test", id_col, label))
    train = _aligned(runs, "train", id_col, label)
    long = metrics.long_scores(test, "id", "y", {m: m for m in names})

    cuts = materialize(metrics.youden_thresholds(
        metrics.long_scores(train, "id", "y", {m: m for m in names}), ["model"]
    ))
    thresholds = metrics.as_dict(cuts, "model", "threshold")

    cov = materialize(delong.covariance(long, names))
    delong_tests = delong.compare_families(cov, delong.comparison_table(families))

    ranked = profile.top_per_group(
        delong.auc_intervals(cov).join(families, "model"), ["run"],
        [F.desc("auc"), F.asc("model")], 2,
    ).orderBy("run", "rank").collect()
    best = {r.name: [row["model"] for row in ranked if row["run"] == r.name] for r in runs}
    pairs = [("across", f"{a.name}_{f}", f"{b.name}_{f}") for f in a.columns if f in b.columns]
    pairs += [(f"top2_{run}", *two) for run, two in best.items() if len(two) == 2]

    counted = mcnemar.mcnemar(mcnemar.concordance(test, "y", thresholds, pairs))
    mcnemar_tests = multiple.holm(
        mcnemar.with_mcnemar_p(counted).withColumn("family", F.lit("all")),
        ["family"], "p_value", ["model_a", "model_b"],
    ).drop("family")

    sample = test
    if bootstrap_rows is not None:
        sample = materialize(sampling.stratified_sample(test, "id", "y", bootstrap_rows, seed))
    reps = bootstrap.replicate_metrics(sample, "id", "y", thresholds, replicates, seed)
    intervals = materialize(bootstrap.paired_intervals(reps, pairs))
    return {
        "checks": checks,
        "thresholds": cuts,
        "delong_covariance": cov,
        "delong_auc": delong.auc_intervals(cov),
        "delong": delong_tests,
        "mcnemar": mcnemar_tests,
        "bootstrap": intervals,
        "three_tests": agreement.three_test_table(delong_tests, mcnemar_tests, intervals),
        "practical": delong.winners(delong_tests.where(F.col("family") == "across")),
    }

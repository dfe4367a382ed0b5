"""Explanations of misclassified rows of a trained model."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from riskloom.operators import explain, models
from riskloom.session import materialize


def explain_errors(tuned: models.Tuned, train: DataFrame, test: DataFrame, scores: DataFrame,
                   slots: DataFrame, id_col: str, target: str, score: str, per_class: int = 1,
                   samples: int = 5000, background_rows: int = 30000) -> dict[str, DataFrame]:
    """Rows chosen per error class, their local fits, top rules and fit quality."""
    sample = materialize(explain.background(train, id_col, target, background_rows))
    statistics = materialize(explain.slot_statistics(sample, slots))
    chosen = explain.choose_instances(scores, id_col, target, score, tuned.family.cut, per_class)
    instances = materialize(chosen.join(
        test.select(id_col, vector_to_array("features").alias("values")), id_col
    ))
    copies = explain.perturb(instances, statistics, id_col, samples)
    scored = explain.score_copies(
        copies, tuned.model, models.score_of(tuned.family), [id_col, "sample"]
    )
    fits = materialize(explain.local_fits(scored, id_col))
    return {
        "instances": instances.drop("values"),
        "fits": fits,
        "rules": explain.top_features(fits, instances, statistics, id_col),
        "quality": explain.quality_by_class(fits, instances, id_col),
    }

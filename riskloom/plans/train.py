"""Prepared sets to tuned models, stored scores and a result table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskloom.operators import models
from riskloom.session import materialize
from riskloom.sources import write_result_csv, write_table


@dataclass
class Run:
    tuned: Mapping[str, models.Tuned]
    results: DataFrame
    train_scores: DataFrame
    test_scores: DataFrame
    champion: str


def train_run(train: DataFrame, test: DataFrame, id_col: str, target: str, folder: str,
              families: Sequence[str] = tuple(models.FAMILIES), grids: Mapping | None = None,
              parallelism: int = 1) -> Run:
    """Tune each family, score both sets right away with the chosen models (so no model is trained
    a second time), and store scores, results and the best model under ``folder``."""
    grids = grids or {}
    tuned = {
        name: models.tune(models.FAMILIES[name], train, id_col, target, grids.get(name),
                          parallelism=parallelism)
        for name in families
    }
    train_scores = write_table(
        models.score_all(train, tuned, [id_col, target]), f"{folder}/train_scores")
    test_scores = write_table(
        models.score_all(test, tuned, [id_col, target]), f"{folder}/test_scores")
    results = materialize(models.evaluate(test_scores, id_col, target, tuned))
    write_result_csv(results, f"{folder}/results")
    best = models.champion(results).first()["model"]
    models.save_model(tuned[best], f"{folder}/best_model")
    return Run(tuned, results, train_scores, test_scores, best)

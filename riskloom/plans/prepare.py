"""Cleaned table to prepared training and test sets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import features, profile, quality, sampling
from riskloom.roles import Roles
from riskloom.session import materialize
from riskloom.sources import write_table
from riskloom.sources.tables import save_pipeline


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    model: PipelineModel
    slots: DataFrame
    checks: DataFrame


def prepare(df: DataFrame, roles: Roles, folder: str, rare_columns: Sequence[str] = (),
            rare_threshold: float = 0.01, test_share: float = 0.2, seed: int = 42) -> Prepared:
    """Split, group rare categories, fit the feature pipeline on the training rows, and store the
    split, both prepared sets and the fitted pipeline under ``folder``.

    The joined rows are written once; every fit then reads that table and not the raw source.
    """
    keyed = df.withColumn(roles.id, F.col(roles.id).cast("string"))
    rows = sampling.with_split(keyed, roles.id, roles.target, test_share, seed)
    split = write_table(rows.select(F.col(roles.id).alias("id"), "split"), f"{folder}/split")
    keep = profile.frequent_values(
        rows.where(F.col("split") == "train"), list(rare_columns), rare_threshold
    ) if rare_columns else None
    if keep is not None:
        rows = profile.group_rare(rows, materialize(keep), list(rare_columns))
    rows = write_table(rows.select(*roles.all(), "split"), f"{folder}/rows", ["split"])
    train_rows = rows.where(F.col("split") == "train")
    if roles.categorical:
        features.check_labels(train_rows, roles.categorical)
    model = features.feature_pipeline(roles).fit(train_rows)
    save_pipeline(model, f"{folder}/pipeline")
    transformed = features.prepared(model, rows, roles, ["split"])
    slots = features.slot_names(transformed, roles)
    both = write_table(transformed, f"{folder}/prepared", ["split"])
    checks = quality.same_keys(
        keyed.select(F.col(roles.id).alias("id")), split, "id"
    ).unionByName(quality.slots_named(slots))
    return Prepared(
        both.where(F.col("split") == "train").drop("split"),
        both.where(F.col("split") == "test").drop("split"),
        model, slots, checks,
    )

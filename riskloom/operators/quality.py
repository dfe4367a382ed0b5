"""Data checks that return rows: ``check, n_bad, passed``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ranks import same_keys as by_keys


def _verdict(df: DataFrame, check: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), "n_bad", (F.col("n_bad") == 0).alias("passed"))


def _counted(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows per key on each side, in one shuffle: ``key, a, b``."""
    both = left.select(key, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        right.select(key, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    return both.groupBy(key).agg(F.sum("_a").alias("a"), F.sum("_b").alias("b"))


def join_kept_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every row of both sides has its partner, and keys are unique; counts the keys that fail."""
    bad = (F.col("a") != 1) | (F.col("b") != 1)
    row = _counted(left, right, key).agg(F.count_if(bad).alias("n_bad"))
    return _verdict(row, "join_kept_rows")


def labels_equal(left: DataFrame, right: DataFrame, key: str, label: str) -> DataFrame:
    pairs = left.select(key, F.col(label).alias("_a")).join(
        right.select(key, F.col(label).alias("_b")), key
    )
    return _verdict(
        pairs.agg(F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("n_bad")), "labels_equal"
    )


def same_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Both sides hold the same keys, each as often; counts the rows without a partner."""
    odd = F.coalesce(F.sum(F.abs(F.col("a") - F.col("b"))), F.lit(0))
    return _verdict(_counted(left, right, key).agg(odd.alias("n_bad")), "same_keys")


def scores_unchanged(old: DataFrame, new: DataFrame, key: str, score: str,
                     tolerance: float = 1e-9) -> DataFrame:
    """Recomputed scores against stored ones; adds the largest difference."""
    gap = F.abs(F.col("_new") - F.col("_old"))
    pairs = old.select(key, F.col(score).alias("_old")).join(
        new.select(key, F.col(score).alias("_new")), key
    )
    row = pairs.agg(F.count_if(gap >= tolerance).alias("n_bad"), F.max(gap).alias("max_gap"))
    return row.select(F.lit("scores_unchanged").alias("check"), "n_bad",
                      (F.col("n_bad") == 0).alias("passed"), "max_gap")


def split_rates(df: DataFrame, split: str, target: str) -> DataFrame:
    return df.groupBy(split).agg(
        F.count("*").alias("n"), (F.avg(target) * 100).alias("rate")
    )


def slots_named(names: DataFrame) -> DataFrame:
    return _verdict(names.agg(F.count_if(F.col("name").isNull()).alias("n_bad")), "slots_named")


def varying_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``variable, n_missing, varies``: does the missing indicator take both values?"""
    flags = df.select(*[F.col(c).isNull().cast("int").alias(c) for c in columns]).unpivot(
        [], list(columns), "variable", "is_missing"
    )
    return flags.groupBy("variable").agg(
        F.sum("is_missing").alias("n_missing"),
        (F.min("is_missing") < F.max("is_missing")).alias("varies"),
    )


def replace_column(stored: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """``stored`` with one column taken from ``new`` (left join by key; unmatched rows get null)."""
    return stored.drop(column).join(new.select(key, column), key, "left").select(*stored.columns)


def replace_rows(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``stored`` with the rows of ``new`` in place of those that have their keys (null equals null). Both need
    unique keys that are in ``stored``; otherwise the job that reads the result fails, and nothing is lost."""
    keys = list(keys)
    counted = new.groupBy(*keys).agg(F.count("*").alias("_times"))
    known = by_keys(counted, stored.groupBy(*keys).agg(F.count("*").alias("_held")), keys, "left")
    good = (F.col("_times") == 1) & (F.coalesce(F.col("_held"), F.lit(0)) == 1)
    checked_keys = known.where(F.when(good, F.lit(True)).otherwise(
        F.raise_error(F.lit("replace_rows: a key is new or not unique")).cast("boolean"))).select(*keys, F.lit(True).alias("_new"))
    rest = by_keys(stored, checked_keys, keys, "left").where("_new IS NULL").select(*stored.columns)
    return rest.unionByName(new.select(*stored.columns))

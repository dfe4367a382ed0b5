"""Exact, reproducible samples and splits.

A sample of ``q`` rows of a stratum is the ``q`` rows with the smallest hash keys. Counting keys
by their first hex digits finds the bin in which the q-th key lies; only that bin is ordered. The
result is one cut key per stratum, and choosing the rows is then a plain comparison per row: no
row is shuffled, and no stratum passes through one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.hashing import hash_key, hash_uniform
from riskloom.operators.ranks import same_keys
from riskloom.session import checked

BIN_DIGITS = 4


def cut_keys(df: DataFrame, strata: Sequence[str], key: Column,
             quota: Callable[[Column, Column], Column]) -> DataFrame:
    """Largest key inside the quota, per stratum: ``strata, cut_key, ties``, where ``ties`` is how
    many rows of that very key the quota takes. A null stratum is one like the others.

    ``quota(n, n_all)`` gives the wanted rows from the size of the stratum and of the table.
    """
    strata = list(strata)
    keyed = df.select(*strata, key.alias("_key"))
    counts = (
        keyed.groupBy(*strata, F.substring("_key", 1, BIN_DIGITS).alias("_bin"))
        .agg(F.count("*").alias("_n"))
    )
    n_all = counts.agg(F.sum("_n").alias("n_all")).scalar()
    running = Window.partitionBy(*strata).orderBy("_bin")
    boundary = (
        counts.withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_size", F.sum("_n").over(Window.partitionBy(*strata)))
        .withColumn("_quota", quota(F.col("_size"), n_all).cast("long"))
        .where((F.col("_quota") > F.col("_upto") - F.col("_n"))
               & (F.col("_quota") <= F.col("_upto")))
        .select(*strata, "_bin",
                (F.col("_quota") - (F.col("_upto") - F.col("_n"))).alias("_rank"))
    )
    order = Window.partitionBy(*strata).orderBy("_key")
    binned = keyed.withColumn("_bin", F.substring("_key", 1, BIN_DIGITS))
    return (
        same_keys(binned, checked(boundary), [*strata, "_bin"])
        .withColumns({"_at": F.row_number().over(order), "_first": F.rank().over(order)})
        .where(F.col("_at") == F.col("_rank"))
        .select(*strata, F.col("_key").alias("cut_key"), (F.col("_rank") - F.col("_first") + 1).alias("ties"))
    )


def with_split(df: DataFrame, id_col: str, target: str, test_share: float = 0.2, seed: int = 42,
               split: str = "split") -> DataFrame:
    """``df`` with a column ``split``: in every class, a null one included, exactly
    ceil(test_share * n) rows are ``test`` (ids being unique). Whether a row is in the test set is a
    comparison of its own key, so no row moves."""
    key = hash_key(seed, id_col)
    cuts = cut_keys(df, [target], key, lambda n, _: F.ceil(n * F.lit(test_share))).drop("ties")
    value = F.when(key <= F.col("cut_key"), "test").otherwise("train")
    return same_keys(df, checked(cuts), [target], "left").select(*df.columns, value.alias(split))


def stratified_split(df: DataFrame, id_col: str, target: str, test_share: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """``id, split``: in every class exactly ceil(test_share * n) rows are ``test``."""
    return with_split(df, id_col, target, test_share, seed, "_split").select(
        F.col(id_col).cast("string").alias("id"), F.col("_split").alias("split"))


def stratified_sample(df: DataFrame, id_col: str, target: str, n: int,
                      seed: int = 42) -> DataFrame:
    """About ``n`` rows, each class by its share (rounded half to even); all rows if fewer."""
    key = hash_key(seed, id_col)
    cuts = cut_keys(
        df, [target], key,
        lambda size, n_all: F.least(
            size, F.bround(size * F.least(F.lit(1.0), F.lit(float(n)) / n_all), 0)
        ),
    )
    return same_keys(df, checked(cuts), [target]).where(key <= F.col("cut_key")).select(*df.columns)


def fixed_sample(df: DataFrame, id_col: str, n: int, seed: int = 42,
                 by: Sequence[str] = ()) -> DataFrame:
    """Exactly ``n`` rows (per group of ``by`` if given, a null group included); all rows where
    there are fewer. Of rows that share the last id taken, as many as fit are kept."""
    key = hash_key(seed, id_col)
    strata = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    cuts = cut_keys(rows, strata, key, lambda size, _: F.least(size, F.lit(n)))
    near = same_keys(rows.withColumn("_key", key), checked(cuts), strata).where(F.col("_key") <= F.col("cut_key"))
    tied = near.where(F.col("_key") == F.col("cut_key")).withColumn(
        "_at", F.row_number().over(Window.partitionBy(*strata).orderBy("_key")))
    tied = tied.where(F.col("_at") <= F.col("ties"))
    return near.where(F.col("_key") < F.col("cut_key")).select(*df.columns).unionByName(tied.select(*df.columns))


def bernoulli_sample(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """Each row independently with probability ``fraction``, fixed by its id."""
    return df.where(hash_uniform(seed, id_col) < F.lit(fraction))


def pick_per_class(df: DataFrame, id_col: str, classes: str, k: int = 1,
                   seed: int = 7) -> DataFrame:
    """``k`` random rows of each class. The rank filter is pushed below the shuffle, so at most
    ``k`` rows per task and class move."""
    order = Window.partitionBy(classes).orderBy(hash_key(seed, id_col))
    return (
        df.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k).drop("_at")
    )


def stratified_folds(df: DataFrame, id_col: str, target: str, folds: int = 3,
                     seed: int = 42) -> DataFrame:
    """``df`` with a ``fold`` column 0..folds-1; class shares, the null class included, are equal
    across folds to one row. All cuts come from one count of the keys."""
    key = hash_key(f"fold{seed}", id_col)
    keyed = df.select(F.col(target), key.alias("_key"), F.substring(key, 1, BIN_DIGITS).alias("_bin"))
    counts = keyed.groupBy(target, "_bin").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(target).orderBy("_bin")
    bins = (
        counts.withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_size", F.sum("_n").over(Window.partitionBy(target)))
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(folds - 1))))
        .withColumn("_quota", F.floor(F.col("_size") * F.col("_i") / F.lit(folds)))
        .where((F.col("_quota") > F.col("_upto") - F.col("_n")) & (F.col("_quota") <= F.col("_upto")))
        .select(target, "_bin", "_i", (F.col("_quota") - (F.col("_upto") - F.col("_n"))).alias("_rank"))
    )
    if folds < 2:
        return df.withColumn("fold", F.lit(0))
    order = Window.partitionBy(target, "_i").orderBy("_key")
    cuts = (
        same_keys(keyed, checked(bins), [target, "_bin"]).withColumn("_at", F.row_number().over(order))
        .where(F.col("_at") == F.col("_rank"))
        .groupBy(target).agg(*[F.max(F.when(F.col("_i") == i, F.col("_key"))).alias(f"_cut{i}") for i in range(1, folds)])
    )
    fold = F.lit(0)
    for i in range(1, folds):  # a class too small for a cut has its rows after it
        fold = fold + F.coalesce((key > F.col(f"_cut{i}")).cast("int"), F.lit(1))
    return same_keys(df, checked(cuts), [target], "left").select(*df.columns, fold.alias("fold"))

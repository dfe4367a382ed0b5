"""Fitted trees as a table, and scoring by joins with it.

A stored tree model is a table of nodes. Reading it back gives a second way to every score: rows walk down one
level per join, all trees at once, and the leaf they end in holds their class counts or value. It also tells
whether the leaves of a tree hold the training rows that they claim.
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.models import Tuned
from riskloom.session import checked, ensure_checkpoint_dir


def node_table(tuned: Tuned, spark) -> DataFrame:
    """``tree, weight, node, feature, threshold, left, right, value, counts``: one row per node; a leaf has no
    children. Splits on numbers only."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    tuned.model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*").join(weights, "tree")
    else:
        nodes = nodes.withColumns({"tree": F.lit(0), "weight": F.lit(1.0)})
    return nodes.select(
        "tree", "weight", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.when(F.col("leftChild") >= 0, F.col("leftChild")).alias("left"),
        F.when(F.col("rightChild") >= 0, F.col("rightChild")).alias("right"),
        F.col("prediction").alias("value"), F.col("impurityStats").alias("counts"))


def leaves(df: DataFrame, nodes: DataFrame, keep: list[str], depth: int) -> DataFrame:
    """``keep, tree, node``: the leaf of every row in every tree of at most ``depth`` levels."""
    numbers = F.array(*[F.lit(r[0]) for r in nodes.select("tree").distinct().orderBy("tree").collect()])  # of trees, bounded
    walk = df.select(*keep, vector_to_array("features").alias("_x"), F.explode(numbers).alias("tree")).withColumn("node", F.lit(0))
    splits = checked(nodes.where("left IS NOT NULL").select("tree", "node", "feature", "threshold", "left", "right"))
    for _ in range(depth):
        step = F.when(F.col("left").isNull(), F.col("node")).when(
            F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        walk = walk.join(splits, ["tree", "node"], "left").select(*keep, "_x", "tree", step.alias("node"))
    return walk.drop("_x")


def scores(df: DataFrame, nodes: DataFrame, keep: list[str], depth: int, boosted: bool) -> DataFrame:
    """``keep, score``: the positive class's probability from the leaves. Of a tree or forest the mean share of
    positives in the leaves; of boosted trees the logistic curve of twice their weighted sum."""
    ends = leaves(df, nodes, keep, depth).join(
        checked(nodes.where("left IS NULL").select("tree", "node", "weight", "value", "counts")), ["tree", "node"])
    share = F.col("counts")[1] / (F.col("counts")[0] + F.col("counts")[1])
    total = F.sum(F.col("weight") * F.col("value"))
    score = 1.0 / (1.0 + F.exp(-2.0 * total)) if boosted else F.avg(share)
    return ends.groupBy(*keep).agg(score.alias("score"))


def wrong_leaves(train: DataFrame, nodes: DataFrame, target: str, depth: int) -> DataFrame:
    """``n_rows, n_positive, n_leaves, n_bad``: training rows in the leaves of a single tree, and leaves whose
    stored class counts are not those of the rows that end there."""
    ends = leaves(train, nodes, [target], depth).groupBy("node").agg(
        F.count("*").cast("double").alias("_n"), F.sum(F.col(target).cast("double")).alias("_p"))
    stored = nodes.where("left IS NULL").select("node", "counts")
    both = ends.join(stored, "node", "full").withColumn(
        "_bad", F.coalesce((F.col("counts")[0] != F.col("_n") - F.col("_p")) | (F.col("counts")[1] != F.col("_p")), F.lit(True)))
    return both.agg(F.sum("_n").cast("long").alias("n_rows"), F.sum("_p").cast("long").alias("n_positive"),
                    F.count("*").alias("n_leaves"), F.count_if("_bad").alias("n_bad"))

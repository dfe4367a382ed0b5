"""Intermediate tables in the shared checkpoint folder, dropped as soon as a later one replaces them."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskloom.session import ensure_checkpoint_dir


class Scratch:
    """Tables of one operator run. ``save`` cuts the lineage; ``drop`` removes what is used up."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


    def let_go(self) -> None:
        """Let the driver collect finished plans, so that the shuffle files they hold are removed now and not
        whenever the driver next runs short of memory."""
        gc.collect()    # plans that only a finished cycle of Python objects still names
        self.spark._jvm.System.gc()


def fresh(names: list[str], wanted: str) -> str:
    """``wanted`` with as many leading underscores as it takes to differ from all ``names``."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted

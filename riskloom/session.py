"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def local_session(app: str = "riskloom", cores: str = "*", shuffle_partitions: int = 8,
                  **conf: str) -> SparkSession:
    """Session for tests and benches. On a cluster the user's own session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="riskloom-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the checkpoint folder and read it back.

    Work that needs several passes then neither recomputes the lineage nor loses it with an
    executor, and each pass still reads only its own columns.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """Fitted numbers, thresholds, names: a handful of rows that become part of the plan itself
    (through Arrow), with no job to read them."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    names = schema.fieldNames()
    columns = [[r[i] for r in rows] for i in range(len(names))]
    return spark.createDataFrame(pa.table(columns, names=names), schema)


BROADCAST_ROWS = 10_000


def checked(df: DataFrame) -> DataFrame:
    """``df`` as a broadcast table if it has at most ``BROADCAST_ROWS`` rows, which is looked up;
    else as it is, for the planner to join."""
    rows = df.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) > BROADCAST_ROWS:
        return df
    return F.broadcast(small_table(df.sparkSession, rows, df.schema))


def shuffle_width(df: DataFrame) -> int:
    """Least number of buckets for range-split work: the session's shuffle width."""
    return max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

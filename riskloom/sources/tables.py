"""Tables on disk: CSV with free text in, Parquet between jobs, CSV and JSON for results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv_text(spark: SparkSession, path: str, schema: StructType | str | None = None,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """CSV whose quoted text may span lines and double its quotes. Without a schema every column
    is text, to be cast explicitly; the file is never scanned to guess types."""
    reader = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    )
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    return df.select(*columns) if columns else df


def ingest_csv(spark: SparkSession, path: str, out: str, schema: StructType | str | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """CSV to Parquet, once. A multi-line file is read by one task per file, so its rows are spread
    over the cluster before writing and every later job starts from Parquet."""
    rows = read_csv_text(spark, path, schema, columns)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(width).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Overwrite a Parquet table and read it back."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_result_csv(df: DataFrame, path: str) -> None:
    """CSV that ``read_csv_text`` reads back as it was: white space stays, an empty text is no null."""
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_params_table(spark: SparkSession, path: str, schema: str,
                      params: str = "best_params") -> DataFrame:
    """A result CSV whose ``params`` column holds a JSON object; it becomes a map of text."""
    df = spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)
    return df.withColumn(params, F.from_json(params, "map<string,string>"))


def export_arrays(df: DataFrame, vector: str = "features", name: str = "features_arr") -> DataFrame:
    return df.withColumn(name, vector_to_array(vector)).drop(vector)


def preview(df: DataFrame, key: str, n: int = 3, last: bool = False) -> DataFrame:
    """First or last rows by key."""
    return df.orderBy(F.desc(key) if last else F.asc(key)).limit(n)


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)

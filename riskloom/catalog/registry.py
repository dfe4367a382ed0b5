"""Registration of a query together with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _rounded(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    # Adding zero turns -0.0 into 0.0.
    return df.withColumns({c: F.round(c, digits) + 0.0 for c in columns})


def query(name: str, sql: str | None = None, doubles: str = "", digits: int = 6):
    """Register under ``name``. The columns listed in ``doubles`` are rounded on both sides."""
    names = doubles.split()

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return _rounded(df, names, digits) if names else df

        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            if names:
                changes = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in names)
                text = f"SELECT * REPLACE ({changes}) FROM ({text}) AS answer"
            ORACLE[name] = text
        return fn

    return register

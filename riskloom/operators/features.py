"""Feature preparation fitted on the training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.profile import tall_numeric
from riskloom.operators.quantiles import exact_quantiles, fitted_quantiles
from riskloom.roles import Roles
from riskloom.session import small_table

MEDIAN_ERROR = 1e-4


def feature_pipeline(roles: Roles) -> Pipeline:
    """Median imputation and scaling of the numbers, indexing and one-hot encoding of the
    categories, one vector column ``features``.

    Unseen and missing categories share an extra index whose one-hot slot is the dropped last one,
    so they encode as zeros and no real category is lost. All columns go through one imputer, one
    indexer and one encoder: one job each instead of one per column.
    """
    numeric, categorical = list(roles.numeric), list(roles.categorical)
    stages: list = []
    inputs: list[str] = []
    if numeric:
        filled = [f"{c}_imp" for c in numeric]
        stages += [
            Imputer(strategy="median", relativeError=MEDIAN_ERROR, inputCols=numeric,
                    outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="numeric_vec"),
            StandardScaler(inputCol="numeric_vec", outputCol="numeric_scaled",
                           withMean=True, withStd=True),
        ]
        inputs.append("numeric_scaled")
    if categorical:
        indexed = [f"{c}_idx" for c in categorical]
        encoded = [f"{c}_ohe" for c in categorical]
        stages += [
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
        ]
        inputs += encoded
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return Pipeline(stages=stages)


def prepared(model: PipelineModel, df: DataFrame, roles: Roles,
             keep: Sequence[str] = ()) -> DataFrame:
    """``id, target, keep..., features``."""
    return model.transform(df).select(roles.id, roles.target, *keep, "features")


def exact_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``variable, median`` with interpolation, for the report of fitted values."""
    return exact_quantiles(
        tall_numeric(train, columns), ["variable"], "value", [0.5]
    ).select("variable", F.col("quantile").alias("median"))


def impute_exact(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the missing numbers of ``columns`` replaced by the exact medians of ``train``."""
    medians = fitted_quantiles(train, columns, 0.5)
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()
    })


MAX_LABELS = 10_000


def check_labels(train: DataFrame, columns: Sequence[str]) -> None:
    """Labels of an indexed column are kept on the driver, so their number has a bound; columns with
    more go through ``profile.group_rare`` first."""
    found = train.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    wide = [c for c in columns if found[c] > MAX_LABELS]
    if wide:
        raise ValueError(f"more than {MAX_LABELS} labels in {', '.join(wide)}")


def category_index(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``variable, value, idx`` as fitted by the indexer: most frequent first, ties by name."""
    check_labels(train, columns)
    fitted = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"
    ).fit(train)
    rows = [
        (c, label, i)
        for c, labels in zip(columns, fitted.labelsArray) for i, label in enumerate(labels)
    ]
    return small_table(train.sparkSession, rows, "variable string, value string, idx int")


def scaler_statistics(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``variable, mean, sd`` of the fitted scaler (sample standard deviation)."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_v", handleInvalid="skip")
    fitted = StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True).fit(
        vectors.transform(train)
    )
    rows = [(c, float(m), float(s)) for c, m, s in zip(columns, fitted.mean, fitted.std)]
    return small_table(train.sparkSession, rows, "variable string, mean double, sd double")


def imputer_values(model: PipelineModel) -> DataFrame:
    """``variable, value`` that the fitted imputer fills in."""
    surrogate = next(s.surrogateDF for s in model.stages if hasattr(s, "surrogateDF"))
    return surrogate.unpivot([], surrogate.columns, "variable", "value")


def slot_names(df: DataFrame, roles: Roles, vector: str = "features") -> DataFrame:
    """``idx, name, kind`` of every vector slot, from the column metadata. Scaled numbers carry no
    names there, so they take the role's names in order."""
    attrs = df.schema[vector].metadata["ml_attr"]["attrs"]
    rows = []
    for kind, entries in attrs.items():
        for entry in entries:
            idx, name = entry["idx"], entry.get("name")
            if kind == "numeric" and idx < len(roles.numeric):
                name = roles.numeric[idx]
            elif name is not None:
                name = name.replace("_ohe_", "_")
            rows.append((idx, name, kind))
    return small_table(df.sparkSession, sorted(rows), "idx int, name string, kind string")

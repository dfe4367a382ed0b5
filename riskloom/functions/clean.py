"""Cleaning expressions. Each returns a Column, so a caller emits one ``select``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def target_flag(status: Column | str, positive: Sequence[str],
                excluded: Sequence[str] = ()) -> Column:
    """1 for the positive statuses, 0 for any other and for null; excluded statuses give null."""
    status = F.col(status) if isinstance(status, str) else status
    flag = F.when(status.isin(*positive), 1).otherwise(0)
    if excluded:
        flag = F.when(status.isin(*excluded), F.lit(None).cast("int")).otherwise(flag)
    return flag.cast("int")


def to_number(column: Column | str) -> Column:
    """Double, or null where the text is not a number."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("double")


def ordinal_text(column: Column | str, below: str = "<") -> Column:
    """The number in a text such as ``10+ years`` or ``3 years``; behind the sign ``below`` (``< 1 year``) the number
    before it. Null or no digits -> null."""
    column = F.col(column) if isinstance(column, str) else column
    number = F.regexp_extract(column, r"(\d+)", 1).try_cast("double")
    return F.when(column.rlike(rf"{below}\s*\d"), number - 1).otherwise(number)


def sentinel_to_null(column: Column | str, equals: Sequence[float] = (),
                     at_least: float | None = None) -> Column:
    """Null where the value is one of ``equals`` or reaches ``at_least``."""
    column = F.col(column) if isinstance(column, str) else column
    bad = F.lit(False)
    if equals:
        bad = bad | column.isin(*equals)
    if at_least is not None:
        bad = bad | (column >= F.lit(at_least))
    return F.when(bad, F.lit(None)).otherwise(column)


def log1p_floor0(column: Column | str) -> Column:
    """log(1 + max(x, 0)); a null stays null so that it can be imputed later."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column.isNotNull(), F.log1p(F.greatest(column, F.lit(0.0))))


def missing_flag(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.isNull().cast("int")


NUMERIC_TYPES = ("double", "float", "int", "bigint", "smallint", "tinyint")


def treatment_rule(pct_missing: Column | str, dtype: Column | str,
                   drop_above: float = 70.0) -> Column:
    """What to do with a column, from its share of missing values and its type."""
    pct = F.col(pct_missing) if isinstance(pct_missing, str) else pct_missing
    dtype = F.col(dtype) if isinstance(dtype, str) else dtype
    return (
        F.when(pct == 0, "none")
        .when(pct > drop_above, "drop")
        .when(dtype.isin(*NUMERIC_TYPES), "median+indicator")
        .otherwise("mode/unknown")
    )


def as_interval_text(low: Column | str, high: Column | str, digits: int = 4) -> Column:
    """``[low, high]`` with fixed decimals."""
    low = F.col(low) if isinstance(low, str) else low
    high = F.col(high) if isinstance(high, str) else high
    return F.format_string(f"[%.{digits}f, %.{digits}f]", low, high)

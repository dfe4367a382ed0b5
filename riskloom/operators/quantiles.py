"""Exact quantiles with linear interpolation, for data of any size.

The built-in exact ``percentile`` keeps every distinct value of a group in one task. Here a wanted position
is closed in on by counting: an interval of values is cut into ``SLOTS`` slots, the rows of each are counted,
and the slot that holds the position is the next interval, until it holds one value or few rows. Only the
rows of such last intervals are shuffled and ordered. Every step is one scan that combines before its shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from riskloom.operators.ranks import same_keys
from riskloom.session import checked, small_table

SLOTS = 1024     # slots of an interval
FEW = 20_000     # rows of an interval that are ordered
INF = float("inf")


@dataclass(frozen=True)
class _Interval:
    """Values of a group among which a wanted row is the ``at``-th; both ends are values of rows."""
    low: float
    high: float
    rows: int
    at: int

    @property
    def flat(self) -> bool:
        return not self.low < self.high


def _slot(value: Column, low: Column, high: Column, squeezed: Column) -> Column:
    """Number of a value's slot, never falling with the value: by its logarithm in the first step, which
    evens out long tails. Infinities and NaN have slots of their own."""
    log = lambda x: F.signum(x) * F.log1p(F.abs(x))
    part = F.when(squeezed, (log(value) - log(low)) / (log(high) - log(low))).otherwise((value - low) / (high - low))
    inside = F.greatest(F.lit(0), F.least(F.lit(SLOTS - 1), F.floor(F.coalesce(part, F.lit(0.0)) * SLOTS)))
    return (F.when(F.isnan(value), SLOTS + 1).when(value == INF, SLOTS).when(value == -INF, -1)
            .otherwise(inside).cast("int"))


def _intervals(rows: DataFrame, by: Sequence[str], wanted: dict, squeezed: bool) -> tuple[DataFrame, dict]:
    """Rows of the wanted intervals with the interval's number (``_at``), and the numbers."""
    number = {k: i for i, k in enumerate(dict.fromkeys((g, t.low, t.high) for (g, _, _), t in wanted.items()))}
    schema = StructType([rows.schema[c] for c in by] + [
        StructField("_at", IntegerType()), StructField("_low", DoubleType()), StructField("_high", DoubleType()),
        StructField("_first", BooleanType())])
    table = small_table(rows.sparkSession, [(*g, i, low, high, squeezed) for (g, low, high), i in number.items()], schema)
    inside = same_keys(rows, checked(table), by).where(
        F.col("_first") | ((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high"))))
    return inside, number


def _narrowed(rows: DataFrame, by: Sequence[str], wanted: dict, squeezed: bool) -> dict:
    """The slots that hold the wanted rows, as the next intervals."""
    inside, number = _intervals(rows, by, wanted, squeezed)
    slot = _slot(F.col("_v"), F.col("_low"), F.col("_high"), F.col("_first"))
    counts = inside.groupBy("_at", slot.alias("_slot")).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    upto = F.sum("_n").over(Window.partitionBy("_at").orderBy("_slot"))
    asked = sorted({(number[g, t.low, t.high], t.at) for (g, _, _), t in wanted.items()})
    table = small_table(rows.sparkSession, asked, "_at int, _row long")
    found = counts.withColumn("_upto", upto).join(checked(table), "_at").where(
        (F.col("_row") < F.col("_upto")) & (F.col("_row") >= F.col("_upto") - F.col("_n")))
    told = {(r["_at"], r["_row"]): r for r in found.collect()}
    out = {}
    for key, t in wanted.items():
        r = told[number[key[0], t.low, t.high], t.at]
        out[key] = _Interval(r["_least"], r["_most"], r["_n"], t.at - (r["_upto"] - r["_n"]))
    return out


def _ordered(rows: DataFrame, by: Sequence[str], wanted: dict) -> dict:
    """Values of the wanted rows of intervals of few rows."""
    inside, number = _intervals(rows, by, wanted, False)
    points = inside.groupBy("_at", "_v").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_at").orderBy("_v"))
    asked = sorted({(number[g, t.low, t.high], t.at) for (g, _, _), t in wanted.items()})
    table = small_table(rows.sparkSession, asked, "_at int, _row long")
    found = points.withColumn("_upto", upto).join(checked(table), "_at").where(
        (F.col("_row") < F.col("_upto")) & (F.col("_row") >= F.col("_upto") - F.col("_n")))
    told = {(r["_at"], r["_row"]): r["_v"] for r in found.collect()}
    return {key: told[number[key[0], t.low, t.high], t.at] for key, t in wanted.items()}


def exact_quantiles(long: DataFrame, by: Sequence[str], value: str, probs: Sequence[float],
                    few: int = FEW) -> DataFrame:
    """One row per group and probability: ``by, prob, quantile``.

    Groups are of a bounded number (variables, classes); what reaches the driver is a few numbers for each
    group and probability. Null values are left out, NaN is the largest value, and a null group is one like
    the others.
    """
    by = list(by)
    rows = long.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    finite = F.when(~F.isnan("_v") & (F.abs("_v") < INF), F.col("_v"))
    shape = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min(finite).alias("_low"), F.max(finite).alias("_high"))
    probs = sorted({float(p) for p in probs})
    wanted, parts = {}, {}
    for r in shape.collect():
        group = tuple(r[c] for c in by)
        for prob in probs:
            place = (r["_n"] - 1) * prob
            at = math.floor(place)
            parts[group, prob] = place - at
            for side in (0, 1):
                wanted[group, prob, side] = _Interval(
                    0.0 if r["_low"] is None else r["_low"], 0.0 if r["_high"] is None else r["_high"],
                    r["_n"], min(at + side, r["_n"] - 1))
    done, first = {}, True
    while wanted:
        before = wanted
        wanted = _narrowed(rows, by, wanted, first)
        stuck, first = not first and wanted == before, False   # values too far apart or too close to be cut
        done |= {k: t.low for k, t in wanted.items() if t.flat}
        wanted = {k: t for k, t in wanted.items() if not t.flat}
        # Intervals of few rows are narrowed along with the others until all have few.
        if wanted and (stuck or all(t.rows <= few for t in wanted.values())):
            done |= _ordered(rows, by, wanted)
            break
    schema = StructType([rows.schema[c] for c in by] + [StructField("prob", DoubleType()), StructField("quantile", DoubleType())])
    table = []
    for (group, prob), part in parts.items():
        low, high = done[group, prob, 0], done[group, prob, 1]
        table.append((*group, prob, low if low == high or part == 0 else low + (high - low) * part))
    return small_table(long.sparkSession, table, schema)


def quantile_columns(long: DataFrame, by: Sequence[str], value: str,
                     named: dict[str, float]) -> DataFrame:
    """Exact quantiles as one row per group with a column per name."""
    tall = exact_quantiles(long, by, value, list(named.values()))
    return tall.groupBy(*by).agg(*[
        F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(name)
        for name, p in named.items()
    ])


def fitted_quantiles(df: DataFrame, columns: Sequence[str], prob: float) -> dict[str, float]:
    """One exact quantile per column, as fitted numbers. Columns without values are absent."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "variable", "value"
    )
    rows = exact_quantiles(long, ["variable"], "value", [prob]).collect()
    return {r["variable"]: r["quantile"] for r in rows}

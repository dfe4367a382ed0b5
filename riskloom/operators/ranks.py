"""Ordered counts over any number of rows, without sorting a whole group in one task.

Every rank-based statistic here needs, for each distinct value of a group, how many rows lie
below it. The plan is:

1. rows reduced to distinct values with their counts (map-side combine, so a value held by a third of all
   rows costs nothing), in one scan of the rows;
2. these values dealt by range to as many partitions as the session shuffles to, which Spark balances, and
   written once with the number of their partition, so that it stays what it is;
3. a scan in three steps, all of them windows over a bounded number of rows: totals of partitions, totals of
   blocks of partitions, and back. What lies before a partition enters its window as a first row, so nothing
   is collected, broadcast or joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize, shuffle_width

SCAN_BLOCK = 1024      # partitions whose totals are summed in one window


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the keys of ``left`` stay."""
    names = {k: f"_right_{k}" for k in keys}
    other = right.withColumnsRenamed(names)
    condition = F.lit(True)
    for k, name in names.items():
        condition = condition & F.col(k).eqNullSafe(F.col(name))
    return left.join(other, condition, how).drop(*names.values())


def _from_heads(rows: DataFrame, heads: DataFrame, keys: Sequence[str], order: str,
                counters: Sequence[str]) -> DataFrame:
    """``rows`` with, for each counter, its sum over the rows before in order of ``order`` on top of the key's
    head (``c_below``), and the total that the head carries (``c_total``)."""
    kind = {f.name: f.dataType for f in rows.schema.fields}
    tall = rows.select(
        *keys, order, *counters, F.lit(1).alias("_row"),
        *[F.lit(None).cast(kind[c]).alias(f"{c}_total") for c in counters],
    ).unionByName(heads.select(
        *keys, F.lit(None).cast(kind[order]).alias(order),
        *[F.col(f"{c}_below").cast(kind[c]).alias(c) for c in counters], F.lit(0).alias("_row"),
        *[F.col(f"{c}_total").cast(kind[c]).alias(f"{c}_total") for c in counters],
    ))
    window = Window.partitionBy(*keys).orderBy("_row", order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return tall.select(
        *keys, order, *counters, "_row",
        *[F.sum(c).over(before).alias(f"{c}_below") for c in counters],
        *[F.first(f"{c}_total", ignorenulls=True).over(upto).alias(f"{c}_total") for c in counters],
    ).where("_row = 1").drop("_row")


def partition_heads(placed: DataFrame, by: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """Per group and ``_bucket``: each counter before the bucket (``c_below``) and in the group (``c_total``)."""
    by = list(by)
    totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(c) for c in counters]).withColumn(
        "_block", F.floor(F.col("_bucket") / SCAN_BLOCK).cast("int"))
    blocks = totals.groupBy(*by, "_block").agg(*[F.sum(c).alias(c) for c in counters])
    running = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    blocks = blocks.select(
        *by, "_block",
        *[F.coalesce(F.sum(c).over(running), F.lit(0)).alias(f"{c}_below") for c in counters],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in counters],
    )
    return _from_heads(totals, blocks, [*by, "_block"], "_bucket", counters).drop("_block", *counters)


def cumulative_counts(df: DataFrame, by: Sequence[str], value: str, counters: Mapping[str, Column],
                      n_buckets: int | None = None) -> DataFrame:
    """One row per group and distinct value, with for each counter its sum at the value
    (``c``), below the value (``c_below``) and over the group (``c_total``). Null values are
    left out; a null group is one like the others. ``n_buckets`` never changes a result.
    """
    return counts_below(placed_points(df, by, value, counters, n_buckets), by, value, list(counters))


def placed_points(df: DataFrame, by: Sequence[str], value: str, counters: Mapping[str, Column],
                  n_buckets: int | None = None) -> DataFrame:
    """The distinct values of each group with their counters, in order over numbered partitions, written once."""
    by = list(by)
    names = list(counters)
    rows = df.where(F.col(value).isNotNull()).select(
        *by, F.col(value).cast("double").alias(value), *[counters[c].alias(c) for c in names]
    )
    points = rows.groupBy(*by, value).agg(*[F.sum(c).alias(c) for c in names])
    return materialize(points.repartitionByRange(n_buckets or shuffle_width(df), *by, value)
                       .withColumn("_bucket", F.spark_partition_id()))


def counts_below(placed: DataFrame, by: Sequence[str], value: str, names: Sequence[str]) -> DataFrame:
    """``cumulative_counts`` of placed points."""
    by = list(by)
    heads = partition_heads(placed, by, names)
    return _from_heads(placed, heads, [*by, "_bucket"], value, names).select(
        *by, value, *names, *[f"{c}_below" for c in names], *[f"{c}_total" for c in names])


def label_counts(long: DataFrame, by: Sequence[str], score: str = "score", label: str = "y",
                 n_buckets: int | None = None) -> DataFrame:
    """Positives and negatives at, below and in total, per distinct score of each group."""
    return cumulative_counts(long, by, score, classes(label), n_buckets=n_buckets)


def classes(label: str = "y") -> dict[str, Column]:
    """Counters of the positives and negatives."""
    y = F.col(label).cast("long")
    return {"n_pos": y, "n_neg": 1 - y}


LOW_BITS = 20


def pair_sum(weight: Column, count: Column) -> Column:
    """Sum of ``weight * count`` as a double, from exact integer sums.

    Pair counts of large tables pass 64 bits, so the high and low bits of ``count`` are summed
    apart; both stay exact up to about 10^12 rows.
    """
    high = F.sum(weight * F.shiftright(count, LOW_BITS))
    low = F.sum(weight * count.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("long")))
    return high.cast("double") * float(1 << LOW_BITS) + low.cast("double")


HOT_SHARE = 256


def attach_by_value(rows: DataFrame, points: DataFrame, by: Sequence[str], value: str,
                    size: Column, total: Column, row_key: str, sizes: DataFrame | None = None) -> DataFrame:
    """Join per-value results back to rows.

    A value that holds more than 1/256 of its group is split: its rows get a salt from their id
    and its single result row is repeated once per salt. The list of such values has at most 256
    entries per group, so it is broadcast. ``size`` and ``total`` are exact counts; ``sizes`` is a stored table
    of ``by``, ``value``, ``_size`` and ``_total``, if there is one, so that ``points`` need not be computed twice.
    """
    keys = [*by, value]
    salts = lambda n, of: F.greatest(F.ceil(n * HOT_SHARE / of), F.lit(1)).cast("int")
    sized = points.withColumn("_salts", salts(size, total))
    listed = sized if sizes is None else sizes.withColumn("_salts", salts(F.col("_size"), F.col("_total")))
    hot = listed.where(F.col("_salts") > 1).select(*keys, "_salts")
    spread = sized.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    salted = (
        same_keys(rows.withColumn(value, F.col(value).cast("double")), F.broadcast(hot), keys, "left")
        .withColumn(
            "_salt",
            F.pmod(F.xxhash64(row_key), F.coalesce(F.col("_salts"), F.lit(1))).cast("int"),
        )
        .drop("_salts")
    )
    return same_keys(salted, spread.drop("_salts"), [*keys, "_salt"]).drop("_salt")


def point_sizes(placed: DataFrame, by: Sequence[str], value: str, counters: Sequence[str]) -> DataFrame:
    """``by, value, _size, _total`` of placed points: a scan and one row per group, with no order."""
    added = lambda names: sum((F.col(n) for n in names[1:]), F.col(names[0]))
    sums = [f"_sum_{c}" for c in counters]
    totals = placed.groupBy(*by).agg(*[F.sum(c).alias(s) for c, s in zip(counters, sums)])
    return same_keys(placed, F.broadcast(totals), by).select(
        *by, value, added(list(counters)).alias("_size"), added(sums).alias("_total"))


def midranks(rows: DataFrame, by: Sequence[str], value: str, row_key: str) -> DataFrame:
    """Every row with its 1-based rank inside the group; tied rows share their average rank."""
    placed = placed_points(rows, by, value, {"n": F.lit(1).cast("long")})
    ranked = attach_by_value(
        rows.where(F.col(value).isNotNull()), counts_below(placed, by, value, ["n"]), by, value,
        F.col("n"), F.col("n_total"), row_key, point_sizes(placed, by, value, ["n"]),
    )
    return ranked.withColumn(
        "midrank", F.col("n_below") + (F.col("n") + 1) / F.lit(2.0)
    ).drop("n", "n_below", "n_total")

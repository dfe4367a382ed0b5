"""A reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered in an order of their own values. A balanced Feistel network permutes the
numbers below the next power of four; a result beyond the last row is fed in again until it falls
below (cycle walking), which makes it a permutation of the rows. Shard and slot of any row, and the
row of any slot, follow from its number alone; nothing else is stored or looked up.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.store import Scratch, fresh

ROUNDS = 6
SEED = 20240803
# Odd multipliers of the round function.
_FIRST, _SECOND = np.uint64(0x7FEB352D), np.uint64(0x846CA68B)
_LOW = np.uint64(0xFFFFFFFF)


def _round(half: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    x = (half ^ np.uint64(key)) & _LOW
    x = ((x ^ (x >> np.uint64(16))) * _FIRST) & _LOW
    x = ((x ^ (x >> np.uint64(15))) * _SECOND) & _LOW
    return (x ^ (x >> np.uint64(16))) & mask


def _keys(seed: int) -> list[int]:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 32, ROUNDS).tolist()


def _network(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    """One pass; running the keys backwards over swapped halves undoes it."""
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    left, right = x >> shift, x & mask
    for key in keys:
        left, right = right, left ^ _round(right, key, mask)
    return (right << shift) | left


def _walk(x: np.ndarray, rows: int, keys: list[int]) -> np.ndarray:
    bits = max(1, -(-max(rows - 1, 1).bit_length() // 2))
    x = _network(np.asarray(x).astype(np.uint64), bits, keys)
    while len(out := np.flatnonzero(x >= rows)):
        x[out] = _network(x[out], bits, keys)
    return x.astype(np.int64)


def permuted(numbers: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """New place of each row number below ``rows`` (at most 2^62)."""
    return _walk(numbers, rows, _keys(seed))


def original(places: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """Row number at each place: the inverse of ``permuted``."""
    return _walk(places, rows, _keys(seed)[::-1])


def numbered(df: DataFrame, order: list[str], number: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """``df`` with global row numbers from 0 in the order of the columns ``order``, and the count.

    Rows equal in all of them are numbered in any order. One range shuffle; only one count per
    partition is gathered, to be summed up.
    """
    part, place, first = (fresh(df.columns + [number], n) for n in ("part", "place", "first"))
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The draw lets equal rows go to several partitions.
    ranged = df.repartitionByRange(width, *order, F.rand(7)).sortWithinPartitions(*order)
    placed = ranged.withColumn(part, F.spark_partition_id()).withColumn(
        place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed = scratch.save(placed)
    counts = placed.groupBy(part).agg(F.count("*").alias("n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(first))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # One row per partition of the range shuffle.
    out = placed.join(F.broadcast(starts), part).withColumn(number, F.col(first) + F.col(place))
    return out.drop(part, place, first), total


def shards(df: DataFrame, order: list[str], count: int, seed: int = SEED) -> DataFrame:
    """``df`` with its rows dealt at random into ``count`` shards whose sizes differ by one at most.

    Adds shard (int, from 0) and slot (long, gapless from 0 in each shard), replacing columns of
    these names. The result depends on the values in ``order``, the number of rows and the seed,
    never on partitioning; rows equal in ``order`` may swap places. Nulls sort first. Every row,
    repeated or not, gets a place of its own; an empty table gives an empty result.
    """
    if count < 1:
        raise ValueError("at least one shard")
    scratch = Scratch(df.sparkSession, "shards")
    df = df.drop(*[c for c in df.columns if c.lower() in ("shard", "slot") and c not in order])
    number = fresh(df.columns, "number")
    rows, total = numbered(df, order, number, scratch)

    @pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), total, seed))

    spot = fresh(df.columns, "spot")
    rows = rows.withColumn(spot, place(number))
    return rows.withColumns({
        "shard": (F.col(spot) % count).cast("int"), "slot": F.expr(f"`{spot}` div {count}")}).drop(number, spot)

"""Nearest neighbours by inner product from randomly rotated one-bit codes.

A vector is taken relative to a centre, scaled to length one, rotated by a random orthogonal matrix
and kept as the signs of its coordinates, with two correction scalars: its length and the inner
product f of the sign vector with the vector itself. For a query q the inner product with the
sign vector, from packed bits against bit planes of the rounded query, divided by f, estimates the
inner product with the vector; its error is at most about sqrt((1 - f^2) / f^2 / (D - 1)) for most
rotations. Every vector whose upper bound reaches the k-th best exact score so far is
reranked exactly. Vectors and queries are dealt into blocks by hash; a task takes one block of queries and a few
of vectors, so nothing grows with the data but the number of tasks.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch

BLOCK = 2048        # vectors of a block
QUERIES = 1024      # queries of a block
TOGETHER = 4        # vector blocks that one task compares with one block of queries
PLANES = 6          # bits of a rounded query coordinate
WIDTH = 1.5         # error bounds in units of the typical error
CENTRE = 4096       # vectors (of smallest hash) whose mean is the centre
PAIRS = 1 << 17     # exact products held at once
SEED = 20240802


@lru_cache(maxsize=2)
def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """Random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), np.uint8)
    wide[:, :bits.shape[1]] = bits
    return np.packbits(wide, axis=1).view(np.uint64)


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, lengths and sign products of the vectors."""
    rest = vectors.astype(np.float64) - centre
    length = np.sqrt((rest * rest).sum(axis=1))
    turned = rest @ rotation(vectors.shape[1]) / np.where(length > 0, length, 1)[:, None]
    near = np.abs(turned).sum(axis=1) / math.sqrt(vectors.shape[1])
    return _pack(turned > 0), length, np.where(length > 0, near, 1)


def estimate(codes, length, near, queries, centre) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (vectors x queries) and the typical size of their error."""
    size = queries.shape[1]
    turned = queries @ rotation(size)
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (2**PLANES - 1), 1e-300)
    rounded = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    total = np.zeros((len(codes), len(queries)), np.uint32)
    for plane in range(PLANES):
        bits = _pack((rounded >> plane) & 1)
        for word in range(codes.shape[1]):
            total += np.bitwise_count(codes[:, word, None] & bits[None, :, word]).astype(np.uint32) << plane
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    inside = low * ones[:, None] + step * total
    signs = (2 * inside - turned.sum(axis=1)) / math.sqrt(size)
    norm = np.sqrt((queries * queries).sum(axis=1))
    spread = np.sqrt(np.maximum(1 - near**2, 0)) / near / math.sqrt(max(size - 1, 1))
    error = length[:, None] * (spread[:, None] * norm + (step * math.sqrt(size / 12))[None, :] / near[:, None])
    return (queries @ centre) + (length / near)[:, None] * signs, error


def _products(vectors: np.ndarray, queries: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs, each summed in the same order."""
    out = np.empty(len(i))
    for at in range(0, len(i), PAIRS):
        a, b = i[at:at + PAIRS], j[at:at + PAIRS]
        out[at:at + PAIRS] = (vectors[a].astype(np.float64) * queries[b]).sum(axis=1)
    return out


class _Best:
    """The k best of every query of a block: larger score first, then smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query, self.id, self.score = (np.zeros(0, t) for t in (np.int64, np.int64, np.float64))
        self.least = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids, score = (np.concatenate(p) for p in ((self.query, query), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        first = np.searchsorted(query, np.arange(len(self.least)))
        place = np.arange(len(query)) - first[query]
        keep = place < self.k
        self.query, self.id, self.score = query[keep], ids[keep], score[keep]
        last = place[keep] == self.k - 1
        self.least[self.query[last]] = self.score[last]


def _search(k: int, size: int, centre: np.ndarray, width: float):
    def run(left, right):
        names = ["query_id", "query_row", "vec_id", "score"]
        best = None
        if left.num_rows and right.num_rows:
            ids = np.frombuffer(right["ids"][0].as_py(), np.int64)
            rows = np.frombuffer(right["rows"][0].as_py(), np.int64)
            queries = np.frombuffer(right["vectors"][0].as_py(), np.float64).reshape(-1, size)
            best = _Best(len(ids), k)
            for b in range(left.num_rows):
                own = np.frombuffer(left["ids"][b].as_py(), np.int64)
                vectors = np.frombuffer(left["vectors"][b].as_py(), np.float64).reshape(-1, size)
                codes = np.frombuffer(left["codes"][b].as_py(), np.uint64).reshape(len(own), -1)
                length, near = np.frombuffer(left["scalars"][b].as_py(), np.float64).reshape(2, -1)
                guess, error = estimate(codes, length, near, queries, centre)
                other = own[:, None] != ids[None, :]
                # The best guesses first: their exact scores are what the others have to reach.
                top = min(2 * k, len(own))
                i = np.argpartition(-np.where(other, guess, -np.inf), top - 1, axis=0)[:top].T.ravel()
                j = np.repeat(np.arange(len(ids)), top)
                fine = other[i, j]
                i, j = i[fine], j[fine]
                done = np.zeros(guess.shape, bool)
                done[i, j] = True
                best.add(j, own[i], _products(vectors, queries, i, j))
                j, i = np.nonzero((other & ~done & (guess + width * error >= best.least)).T)
                best.add(j, own[i], _products(vectors, queries, i, j))
        if best is None or not len(best.query):
            return pa.table({n: pa.array([], t) for n, t in zip(
                names, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))})
        return pa.table([ids[best.query], rows[best.query], best.id, best.score], names=names)
    return run


def _block(centre: np.ndarray | None, size: int):
    """One row per block: ids, vectors and, with a centre, codes."""
    def run(key, table):
        ids = table["vec_id"].to_numpy()
        vectors = table["v"].combine_chunks().values.to_numpy().astype(np.float64).reshape(-1, size)
        out = {"block": [key[0].as_py()], "ids": [ids.astype(np.int64).tobytes()], "vectors": [vectors.tobytes()]}
        if centre is None:
            out["rows"] = [table["row"].to_numpy().astype(np.int64).tobytes()]
        else:
            codes, length, near = encode(vectors, centre)
            out |= {"codes": [codes.tobytes()], "scalars": [np.stack([length, near]).tobytes()]}
        return pa.table(out)
    return run


def _valid(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
            vector_column: str = "embedding", width: float = WIDTH) -> DataFrame:
    """The ``k`` vectors of largest inner product for every query row.

    query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id and a query's own id is no
    candidate. Null ids, null or zero vectors and vectors with null or non-finite components take no
    part, neither do vectors whose length is not the most common one (the larger, if equally
    common). A row that repeats id and vector counts once; one id with several vectors stands for
    each of them. Other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                          F.col(vector_column).cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.where(F.col("vec_id").isNotNull() & _valid(F.col("v")))
    rows = kept = scratch.save(rows.groupBy("vec_id", "v").agg(F.max("q").alias("q")).withColumn(
        "row", F.xxhash64("vec_id", "v")))
    result = "query_id long, rank int, vec_id long, score double"
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.sum(F.col("q").cast("long")).alias("m"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if common is None or not common.m:
        return spark.createDataFrame([], result)
    size, count, asked = common.d, common.n, common.m
    rows = rows.where(F.size("v") == size)
    sample = rows.orderBy(F.xxhash64("row"), "vec_id").limit(CENTRE).select("v").toArrow()
    centre = sample["v"].combine_chunks().values.to_numpy().reshape(-1, size).mean(axis=0)

    blocks, parts = -(-count // BLOCK), -(-asked // QUERIES)
    salts = -(-blocks // TOGETHER)
    dealt = rows.select("vec_id", "v", F.pmod("row", F.lit(blocks)).alias("block"))
    coded = scratch.save(dealt.groupBy("block").applyInArrow(
        _block(centre, size), "block long, ids binary, vectors binary, codes binary, scalars binary"))
    queries = rows.where("q").select("vec_id", "v", "row", F.pmod(F.xxhash64("row"), F.lit(parts)).alias("block"))
    queries = scratch.save(queries.groupBy("block").applyInArrow(
        _block(None, size), "block long, ids binary, vectors binary, rows binary"))
    scratch.drop(kept)
    left = coded.withColumn("salt", F.pmod("block", F.lit(salts))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).drop("block")
    right = queries.withColumnRenamed("block", "part").withColumn("part", F.col("part").cast("int")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    found = left.groupBy("part", "salt").cogroup(right.groupBy("part", "salt")).applyInArrow(
        _search(k, size, centre, width), "query_id long, query_row long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

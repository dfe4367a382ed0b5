"""Hard negatives of anchors, with scores bounded along spanning trees of the anchors.

Near anchors score a row alike: |<a, x> - <b, x>| <= |a - b| * |x|. The anchors of one label are dealt
into groups of neighbours, and every group gets a minimum spanning tree. A block of rows is scored exactly
against a tree's root; going down the tree, what is known of a row's score at the parent, widened by the
length of the edge times the row's norm, bounds it at the child. Only rows whose bounds overlap the window that
a child still looks for are scored again, and then pass on an exact value. The window is first "among the
best of the own label", then, for every positive found, a band of scores below the positive's.

Blocks of rows meet blocks of anchors by a shuffle, each pair of blocks in a task of its own, and a task
sends back no more than the wanted number of rows for each anchor and positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch

BLOCK_BYTES = 32 << 20    # vectors of one block, of rows or of anchors
SMALLEST = 2048           # rows of a block are not split below this
PART = 2048               # rows of a block that are bounded at once
GROUP = 400               # anchors of one tree, about
PIVOTS = 64               # anchors that the others are dealt to, by distance


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    """Vectors of equal length as int64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.int64)


class Scorer:
    """Exact inner products: in doubles where every partial sum fits one, else in integers."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        most = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (rows, anchors)]
        kind = np.float64 if most[0] * most[1] * max(rows.shape[1], 1) < 2.0**53 else np.int64
        self.rows, self.anchors = rows.astype(kind), anchors.astype(kind)
        self.norm = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))

    def exact(self, some: np.ndarray, anchor: int) -> np.ndarray:
        return (self.rows[some] @ self.anchors[anchor]).astype(np.int64)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree from row 0: rows in the order they join, parent of each (by its number
    in that order, -1 for the root), and length of the edge to it."""
    n = len(x)
    x = x.astype(np.float64)
    left, near, via = np.ones(n, bool), np.full(n, np.inf), np.zeros(n, np.int64)
    order, parent, edge, place = [], [], [], np.zeros(n, np.int64)
    now = 0
    for step in range(n):
        order.append(now)
        parent.append(place[via[now]] if step else -1)
        edge.append(near[now] if step else 0.0)
        place[now], left[now] = step, False
        far = np.sqrt(((x - x[now]) ** 2).sum(axis=1))
        closer = left & (far < near)
        near[closer], via[closer] = far[closer], now
        now = int(np.where(left, near, np.inf).argmin())
    return np.array(order), np.array(parent), np.array(edge)


def _cells(pivots: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (pivots.astype(np.float64) ** 2).sum(axis=1)
        for batch in batches:
            x = _matrix(batch.column(2), batch.num_rows).astype(np.float64)
            cell = (size - 2 * x @ pivots.astype(np.float64).T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=names)
    return run


def _planted(table: pa.Table) -> pa.Table:
    """A group's anchors with their place in its tree."""
    table = table.sort_by("vec_id")
    order, parent, edge = spanning_tree(_matrix(table["vector"], table.num_rows))
    found = table.take(pa.array(order)).select(["vec_id", "label", "vector", "tree"])
    for name, values in (("place", np.arange(len(order))), ("parent", parent.astype(np.int64)), ("edge", edge)):
        found = found.append_column(name, pa.array(values))
    return found


def _trees(anchors: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray]]:
    anchors = anchors.sort_by([("tree", "ascending"), ("place", "ascending")])
    tree = anchors["tree"].to_numpy()
    cuts = np.append(np.flatnonzero(np.append(True, tree[1:] != tree[:-1])), len(tree))
    for a, b in zip(cuts, cuts[1:]):
        yield anchors.slice(a, b - a), np.arange(a, b)


def _walk(scorer: Scorer, at: np.ndarray, parent: np.ndarray, edge: np.ndarray, part: slice,
          wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray],
          taken: Callable[[int, np.ndarray, np.ndarray], None]) -> int:
    """Go down a tree with the rows of ``part``: ``wanted`` says which rows' bounds overlap what an anchor looks
    for, ``taken`` gets their exact scores. Returns how many scores were computed."""
    rows, norm = np.arange(part.start, part.stop), scorer.norm[part]
    low, high = [None] * len(at), [None] * len(at)
    last = np.zeros(len(at), np.int64)
    for k, p in enumerate(parent.tolist()):
        last[max(p, 0)] = k
    computed = 0
    for k in range(len(at)):
        p = int(parent[k])
        if p < 0:
            exact = scorer.exact(rows, at[k])
            lo, hi = _around(exact)
            computed += len(rows)
        else:
            # The last two terms are wider than any rounding of the first.
            wide = edge[k] * norm * (1 + 1e-9) + 1e-12 * np.maximum(np.abs(low[p]), np.abs(high[p])) + 1e-3
            lo, hi = low[p] - wide, high[p] + wide
        some = np.flatnonzero(wanted(k, lo, hi))
        if p < 0:
            exact = exact[some]
        else:
            exact = scorer.exact(rows[some], at[k])
            lo[some], hi[some] = _around(exact)
            computed += len(some)
        taken(k, rows[some], exact)
        low[k], high[k] = lo, hi
        if p >= 0 and last[p] <= k:
            low[p] = high[p] = None
        if last[k] <= k:
            low[k] = high[k] = None
    return computed


def _around(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Doubles that a whole number lies between."""
    value = score.astype(np.float64)
    wide = np.where(np.abs(value) < 2.0**53, 0.0, 1e-12 * np.abs(value))
    return value - wide, value + wide


class _Best:
    """The first few by score, ties by smaller id; fed in parts."""

    def __init__(self, size: int):
        self.size, self.score, self.ids = size, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(score):
            score, ids = np.append(self.score, score), np.append(self.ids, ids)
            order = np.lexsort((ids, -score))[:self.size]
            self.score, self.ids = score[order], ids[order]

    def least(self) -> float:
        """No row below this can still enter."""
        return self.score[-1] if len(self.score) == self.size else -np.inf


def _parts(n: int) -> Iterator[slice]:
    for at in range(0, n, PART):
        yield slice(at, min(at + PART, n))


def _positives(count: int):
    """Best rows of a block for every anchor of a block; all have one label."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, _Best]] = []
        if left.num_rows and right.num_rows:
            ids = left["vec_id"].to_numpy()
            scorer = Scorer(_matrix(left["vector"], left.num_rows), _matrix(_ordered(right)["vector"], right.num_rows))
            for tree, at in _trees(right):
                own = tree["vec_id"].to_numpy()
                best = [_Best(count) for _ in own]
                for part in _parts(len(ids)):
                    mine = ids[part]

                    def wanted(k, lo, hi):
                        other = mine != own[k]
                        floor, known = best[k].least(), lo[other]
                        if len(known) >= count:
                            floor = max(floor, np.partition(known, len(known) - count)[len(known) - count])
                        return other & (hi >= floor)

                    _walk(scorer, at, tree["parent"].to_numpy(), tree["edge"].to_numpy(), part, wanted,
                          lambda k, rows, score: best[k].add(score, ids[rows]))
                out += zip(own.tolist(), best)
        return pa.table({
            "anchor_id": pa.array(np.repeat([a for a, _ in out], [len(b.ids) for _, b in out]).astype(np.int64)),
            "positive_id": pa.array(np.concatenate([b.ids for _, b in out] or [np.zeros(0, np.int64)])),
            "positive_score": pa.array(np.concatenate([b.score for _, b in out] or [np.zeros(0, np.int64)]))})
    return run


def _ordered(anchors: pa.Table) -> pa.Table:
    return anchors.sort_by([("tree", "ascending"), ("place", "ascending")])


def _negatives(count: int, low_pct: int, high_pct: int):
    """Best rows of a block below every positive of every anchor of a block."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, _Best]] = []
        if left.num_rows and right.num_rows:
            ids, labels = left["vec_id"].to_numpy(), left["label"].to_numpy()
            scorer = Scorer(_matrix(left["vector"], left.num_rows), _matrix(_ordered(right)["vector"], right.num_rows))
            for tree, at in _trees(right):
                own, label = tree["vec_id"].to_numpy(), tree["label"].to_numpy()
                told = [[(p["positive_id"], p["positive_score"]) for p in ps] for ps in tree["positives"].to_pylist()]
                best = [[_Best(count) for _ in ps] for ps in told]
                # Least and largest score of each window, in whole numbers.
                band = [[(-((-low_pct * s) // 100), high_pct * s // 100) for _, s in ps] for ps in told]
                for part in _parts(len(ids)):
                    theirs = labels[part]

                    def wanted(k, lo, hi):
                        some = np.zeros(len(lo), bool)
                        for (least, most), b in zip(band[k], best[k]):
                            some |= (hi >= max(least, b.least())) & (lo <= most)
                        return some & (theirs != label[k])

                    def taken(k, rows, score):
                        for (least, most), b in zip(band[k], best[k]):
                            good = (score >= least) & (score <= most)
                            b.add(score[good], ids[rows[good]])

                    _walk(scorer, at, tree["parent"].to_numpy(), tree["edge"].to_numpy(), part, wanted, taken)
                out += [(a, p, s, b) for a, ps, bs in zip(own.tolist(), told, best) for (p, s), b in zip(ps, bs)]
        sizes = [len(b.ids) for *_, b in out]
        column = lambda i: pa.array(np.repeat([x[i] for x in out], sizes).astype(np.int64))
        return pa.table({
            "anchor_id": column(0), "positive_id": column(1), "positive_score": column(2),
            "negative_id": pa.array(np.concatenate([b.ids for *_, b in out] or [np.zeros(0, np.int64)])),
            "negative_score": pa.array(np.concatenate([b.score for *_, b in out] or [np.zeros(0, np.int64)]))})
    return run


def _first(found: DataFrame, by: list[str], score: str, row: str, count: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _spread(key: str, count: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), count).cast("int")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
         low_pct: int = 80, high_pct: int = 100) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label (whole numbers) and vector (array of whole numbers); other columns are ignored.
    ``is_anchor`` picks anchors by vec_id. Scores are inner products and have to fit a long. An anchor's positives are
    its best ``positives`` other rows of its label; for each the best ``negatives`` rows of other labels are returned
    whose score is at least ``low_pct`` and at most ``high_pct`` percent of the positive's. Ties go to the smaller
    vec_id. Rows with a null id, label, vector or component take no part. Of rows that share a vec_id the
    smallest (label, vector) counts. Shorter vectors are filled up with zeros. An anchor without another row of its
    label, and a positive without a row in its window, give no rows; nor does an empty table.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    rows = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("vector").cast("array<bigint>").alias("vector"))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector")
    rows = scratch.save(rows)
    n, least, most = rows.agg(F.count("*"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    dims = max(most or 0, 1)
    if (least or 0) < dims:
        filled = F.concat("vector", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("vector")))
        rows = rows.withColumn("vector", filled)
    block = min(max(BLOCK_BYTES // (8 * dims), 256), max(SMALLEST, -(-n // spark.sparkContext.defaultParallelism)))
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / block)).cast("int")

    # Anchors with their trees, in blocks of whole trees.
    chosen = rows.where(is_anchor)
    pivots = chosen.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(PIVOTS).select("vector").toArrow()
    pivots = _matrix(pivots["vector"], pivots.num_rows) if pivots.num_rows else np.zeros((1, dims), np.int64)
    cells = chosen.mapInArrow(_cells(pivots, ["vec_id", "label", "vector", "cell"]),
                              "vec_id long, label long, vector array<bigint>, cell int")
    crowd = cells.groupBy("label", "cell").agg(F.count("*").alias("n"))
    group = _spread("vec_id", F.ceil(F.col("n") / GROUP).cast("int"), 5)
    grouped = cells.join(crowd, ["label", "cell"]).withColumn("tree", F.xxhash64("label", "cell", group))
    trees = grouped.select("vec_id", "label", "vector", "tree").groupBy("tree").applyInArrow(
        _planted, "vec_id long, label long, vector array<bigint>, tree long, place long, parent long, edge double")
    trees = scratch.save(trees)

    # Positives, among the rows of one label.
    labels = rows.groupBy("label").agg(F.count("*").alias("n")).join(
        trees.groupBy("label").agg(F.count("*").alias("m")), "label")
    labels = labels.select("label", blocks("n").alias("row_blocks"), blocks("m").alias("anchor_blocks"))
    left = rows.join(labels, "label").select(
        "label", _spread("vec_id", F.col("row_blocks"), 7).alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("anchor_blocks") - 1)).alias("j"), "vec_id", "vector")
    right = trees.join(labels, "label").select(
        "label", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)).alias("i"),
        _spread("tree", F.col("anchor_blocks"), 9).alias("j"), "vec_id", "vector", "tree", "place", "parent", "edge")
    found = left.groupBy("label", "i", "j").cogroup(right.groupBy("label", "i", "j")).applyInArrow(
        _positives(positives), "anchor_id long, positive_id long, positive_score long")
    found = _first(found, ["anchor_id"], "positive_score", "positive_id", positives)
    told = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    trees_told = scratch.save(trees.join(told, "vec_id"))

    # Negatives, among all rows.
    row_blocks, anchor_blocks = -(-n // block) or 1, -(-trees_told.count() // block) or 1
    left = rows.select(
        _spread("vec_id", F.lit(row_blocks), 7).alias("i"),
        F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("j"), "vec_id", "label", "vector")
    right = trees_told.select(
        F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("i"),
        _spread("tree", F.lit(anchor_blocks), 9).alias("j"), "vec_id", "label", "vector", "tree", "place", "parent",
        "edge", "positives")
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(
        _negatives(negatives, low_pct, high_pct),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    found = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

"""Near-duplicate documents by a chosen-path set similarity join.

Every text becomes the set of its word shingles, and every distinct set a sketch of ``WIDTH``
minwise values. A tree starts with all sets in one node. A node picks each sketch coordinate with
probability 1 / (threshold * WIDTH), from a hash of the node itself, and sends every set to one
child per picked coordinate, named by the set's value there. Two sets above the threshold meet in
one child on average, others die out. Nodes that became small are compared exhaustively, larger ones
against one of their members, and branch again. Large nodes of the last level that hold one group of
linked sets are done; in the others each set outside the largest group is compared with all, in blocks. Before
two full sets are compared their sketches must agree to the threshold less ``SLACK``, which a pair at the threshold
fails with a probability of 2e-8. With that, and independent trees, the recall at the threshold is 1 - 1e-6 for
pairs that part from the crowd in the first level. Pairs are confirmed on the full sets; only groups are asked for,
so one pair of every set goes first, and a pair that then lies within one group adds nothing and is not confirmed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words as W
from riskloom.llm.components import components
from riskloom.llm.store import Scratch

WIDTH = 64          # minwise values of a sketch
TREES = 20          # independent trees
SMALL = 16          # a node of so many sets is compared exhaustively
LEVELS = 3          # levels of a tree; what is still large and mixed then is compared in blocks
BLOCK = 256         # sets of a block
SLACK = 0.3         # a pair whose sketches agree this much less than the threshold is dropped

_RNG = np.random.Generator(np.random.PCG64(20240801))
_MASK = _RNG.integers(0, 2**63, WIDTH, dtype=np.uint64)
_ODD = _RNG.integers(0, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sketch(members: np.ndarray) -> np.ndarray:
    low = np.full(WIDTH, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(members), 2048):
        part = (members[at:at + 2048, None] ^ _MASK) * _ODD
        low = np.minimum(low, part.min(axis=0) >> np.uint64(32))
    return low.astype(np.uint32)


def _sets(batch: pa.RecordBatch, length: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part, raw, offsets in W.chunks(batch, "text"):
        code, row = W.shingles(W.words(raw, offsets, W.NOT_SPACE), length)
        cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
        yield part, [np.unique(code[a:b]) for a, b in zip(cuts, cuts[1:])]


def _digest(members: np.ndarray) -> bytes | None:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None


def _signatures(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in _sets(batch, length):
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array([_sketch(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ], names=["doc_id", "n_shingles", "digest", "sketch"])
    return run


def _full_sets(length: int):
    def run(batches):
        for batch in batches:
            for _, sets in _sets(batch, length):
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ], names=["digest", "members"])
    return run


def _children(node: np.ndarray, sketch: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(index, child) of every set and picked coordinate."""
    at, child = [], []
    limit = np.uint64(int(2.0**64 / (threshold * WIDTH)))
    for i in range(WIDTH):
        draw = W.mix(node ^ W.mix(np.array([i + 1], np.uint64)))
        hit = np.flatnonzero(W.mix(draw) < limit)
        at.append(hit)
        child.append(W.mix(draw[hit] + W.mix(sketch[hit, i].astype(np.uint64) + np.uint64(i << 32))))
    return np.concatenate(at), np.concatenate(child)


def _branch(threshold: float, trees: int = 0):
    """Rows of the next level: from the roots of all trees, or from the column ``node``."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                cls = part.column(0)
                sketch = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, WIDTH)
                if trees:
                    starts = [np.full(len(sketch), W.mix(np.array([t + 77], np.uint64))[0])
                              for t in range(trees)]
                else:
                    starts = [part.column(2).to_numpy().view(np.uint64)]
                for node in starts:
                    index, child = _children(node, sketch, threshold)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(child.view(np.int64)), cls.take(pa.array(index))],
                        names=["node", "cls"])
    return run


def _alike(least: float):
    """Pairs whose sketches agree in a share of at least ``least``."""
    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, WIDTH)
                    for k in (2, 3))
            good = pa.array((x == y).mean(axis=1) >= least)
            yield batch.select([0, 1]).filter(good)
    return run


def _confirm(threshold_pct: int):
    def run(batches):
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = [_linked(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), threshold_pct)
                    for p, q in zip(x, y)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))
    return run


def _candidates(left, right, threshold_pct: int, least: float) -> list[tuple[int, int]]:
    """Places of the pairs of a block of minor groups and a block of all sets that sketches and sizes do not rule out.

    A pair that meets in several nodes is compared in the first of them only.
    """
    if left.empty or right.empty:
        return []
    x, y = (np.frombuffer(b"".join(s.sketch), np.uint32).reshape(-1, WIDTH) for s in (left, right))
    near = np.array([(y == v).mean(axis=1) >= least for v in x])
    near &= left.grp.to_numpy()[:, None] != right.grp.to_numpy()[None, :]
    n, m = left.n_shingles.to_numpy()[:, None], right.n_shingles.to_numpy()[None, :]
    near &= 100 * np.minimum(n, m) >= threshold_pct * np.maximum(n, m)
    node = left.node.iloc[0]
    ours, theirs = ([frozenset(v.tolist()) for v in s.nodes] for s in (left, right))
    return [(i, j) for i, j in zip(*(k.tolist() for k in np.nonzero(near))) if min(ours[i] & theirs[j]) == node]


def _wanted_in_blocks(threshold_pct: int, least: float):
    """The rows of a block that are in any candidate pair; only they need their full sets."""
    def run(pdf):
        import pandas as pd
        left, right = pdf[pdf.side == 0], pdf[pdf.side == 1]
        pairs = _candidates(left, right, threshold_pct, least)
        return pd.concat([left.iloc[sorted({i for i, _ in pairs})], right.iloc[sorted({j for _, j in pairs})]])
    return run


def _in_blocks(threshold_pct: int, least: float):
    """Confirmed links between one block of a node's minor groups and one block of all its sets."""
    def run(pdf):
        import pandas as pd
        left, right = pdf[pdf.side == 0], pdf[pdf.side == 1]
        p, q = ([np.frombuffer(m, np.uint64) for m in s.members] for s in (left, right))
        out = [(left.cls.iat[i], right.cls.iat[j]) for i, j in _candidates(left, right, threshold_pct, least)
               if _linked(p[i], q[j], threshold_pct)]
        return pd.DataFrame(out, columns=["a", "b"])
    return run


def _linked(p: np.ndarray, q: np.ndarray, threshold_pct: int) -> bool:
    if 100 * min(len(p), len(q)) < threshold_pct * max(len(p), len(q)):
        return False
    both = np.concatenate([p, q])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= threshold_pct * (len(both) - shared)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(documents: DataFrame, shingle: int = 5, threshold_pct: int = 80,
                    trees: int = TREES) -> DataFrame:
    """Group of every document: doc_id, n_shingles, component_id, kept.

    ``documents`` has doc_id and text; other columns are ignored. A text without words or null has
    an empty set and is linked with nothing. ``component_id`` is the smallest doc_id reachable over
    links, ``kept`` says whether it is the document's own. Equal sets form one class before any
    comparison; repeated rows give repeated result rows. A null doc_id takes the smallest id of its
    group; alone, its component is null and it is kept. An empty table gives an empty result.
    """
    spark, threshold = documents.sparkSession, threshold_pct / 100
    scratch = Scratch(spark, "near-dedup")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = scratch.save(docs.mapInArrow(
        _signatures(shingle), "doc_id long, n_shingles long, digest binary, sketch binary"))
    # Classes get numbers, which are short; the table is written once, so they are settled.
    classes = scratch.save(signed.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("low"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        .select(F.monotonically_increasing_id().alias("cls"), "digest", "low", "n_shingles", "sketch"))
    sketches = classes.select("cls", "sketch")
    # From here on only a class has a sketch.
    plain = scratch.save(signed.select("doc_id", "n_shingles", "digest"))
    scratch.drop(signed)
    signed = plain
    scratch.let_go()

    # The trees: every level's nodes of two sets or more, each with one member as its pivot.
    rows, pairs, nodes = sketches.mapInArrow(_branch(threshold, trees), "node long, cls long"), None, []
    for level in range(LEVELS):
        # Of four orders a node takes one, so that a group meets several of its members.
        order = F.struct(F.xxhash64("cls", F.pmod("node", F.lit(4))), "cls")
        sized = rows.groupBy("node").agg(F.count("*").alias("n"), F.min(order).alias("first"))
        live = rows.join(sized.where("n > 1"), "node").select("node", "cls", "n", F.col("first.cls").alias("pivot"))
        live = scratch.save(live)
        scratch.let_go()
        nodes.append(live)
        star = live.where("cls != pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b"))
        small = live.where(f"n between 3 and {SMALL}").select("node", "cls")
        near = star.unionAll(
            small.withColumnRenamed("cls", "a").join(small.withColumnRenamed("cls", "b"), "node")
            .where("a < b").select("a", "b"))
        pairs = near if pairs is None else pairs.unionAll(near)
        big = live.where(f"n > {SMALL}").select("node", "cls")
        rows = big.join(sketches, "cls").select("cls", "sketch", "node").mapInArrow(
            _branch(threshold), "node long, cls long")

    store, least = _Sets(docs, classes, shingle, scratch), threshold - SLACK
    sized = _with(_ordered(pairs), classes, "sketch", "n_shingles").where(
        F.least("a_n_shingles", "b_n_shingles") * 100 >= F.greatest("a_n_shingles", "b_n_shingles") * threshold_pct)
    close = scratch.save(sized.select("a", "b", "a_sketch", "b_sketch").mapInArrow(_alike(least), "a long, b long"))
    scratch.drop(*nodes[:-1])
    scratch.let_go()
    store.want(close.select(F.explode(F.array("a", "b")).alias("cls")))
    groups = None
    for late in (False, True):
        chosen = _across(close, groups) if late else close.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        chosen = scratch.save(chosen)
        scratch.let_go()
        links = scratch.save(_with(chosen, store.sets, "members").mapInArrow(_confirm(threshold_pct), "a long, b long"))
        scratch.drop(chosen)
        scratch.let_go()
        groups = _merged(groups, links, scratch)

    # Large nodes of the last level that hold several groups.
    packed = scratch.save(_mixed(nodes[-1].where(f"n > {SMALL}"), groups))
    scratch.drop(close, nodes[-1])
    scratch.let_go()
    blocks = scratch.save(_blocks(packed, classes).applyInPandas(_wanted_in_blocks(threshold_pct, least), _BLOCK_ROW))
    scratch.drop(packed)
    scratch.let_go()
    store.want(blocks.select("cls"))
    links = scratch.save(blocks.join(store.sets, "cls").groupBy("node", "i", "j").applyInPandas(
        _in_blocks(threshold_pct, least), "a long, b long"))
    scratch.drop(blocks)
    scratch.let_go()
    groups = _merged(groups, links, scratch)

    roots = groups.join(classes.select("cls", "low"), groups.vertex == classes.cls).select(
        "vertex", "root", "low")
    least = roots.groupBy("root").agg(F.min("low").alias("component"))
    found = classes.select("cls", "low").join(
        groups.join(least, "root").select(F.col("vertex").alias("cls"), "component"), "cls", "left")
    found = found.select("cls", F.coalesce("component", "low").alias("component"))
    found = found.join(classes.select("cls", "digest"), "cls").select("digest", "component")
    out = signed.join(found, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def _with(pairs: DataFrame, values: DataFrame, *names: str) -> DataFrame:
    """Pairs (a, b) with the values of both ends, as a_<name> and b_<name>."""
    for end in ("a", "b"):
        own = values.select(F.col("cls").alias(end), *[F.col(n).alias(f"{end}_{n}") for n in names])
        pairs = pairs.join(own, end)
    return pairs.select("a", "b", *[f"{end}_{n}" for n in names for end in ("a", "b")])


def _rooted(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs (a, b) with the roots of the groups of their ends; an end without a group is its own root."""
    for end in ("a", "b"):
        own = groups.select(F.col("vertex").alias(end), F.col("root").alias(f"{end}_root"))
        pairs = pairs.join(own, end, "left").withColumn(f"{end}_root", F.coalesce(f"{end}_root", end))
    return pairs


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one group."""
    return _rooted(pairs, groups).where("a_root != b_root").select("a", "b")


def _merged(groups: DataFrame | None, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Groups over all links so far. Later links are merged as links between roots, of which two groups have one at
    most, however many of their members are linked; members follow their root."""
    if groups is None:
        return scratch.save(components(links, "a", "b", scratch))
    found = scratch.save(components(_rooted(links, groups), "a_root", "b_root", scratch))
    moved = groups.join(found.select(F.col("vertex").alias("root"), F.col("root").alias("to")), "root", "left")
    alone = found.join(groups.select("vertex"), "vertex", "left_anti")
    return scratch.save(moved.select("vertex", F.coalesce("to", "root").alias("root")).unionAll(
        alone.select("vertex", "root")))


class _Sets:
    """Full sets of the classes that some comparison wanted, computed from the texts once."""

    def __init__(self, docs: DataFrame, classes: DataFrame, shingle: int, scratch: Scratch):
        self.docs, self.classes, self.shingle, self.scratch = docs, classes, shingle, scratch
        self.sets = None

    def want(self, keys: DataFrame) -> None:
        keys = keys.distinct()
        if self.sets is not None:
            keys = keys.join(self.sets.select("cls"), "cls", "left_anti")
        keys = self.scratch.save(keys.join(self.classes.select("cls", "digest", "low"), "cls"))
        ids = keys.select("low").distinct()
        texts = self.docs.join(ids, self.docs.doc_id.eqNullSafe(ids.low), "left_semi")
        found = texts.mapInArrow(_full_sets(self.shingle), "digest binary, members binary").join(
            keys.select("cls", "digest"), "digest").select("cls", "members")
        found = self.scratch.save(found)
        self.scratch.drop(keys)
        self.scratch.let_go()
        self.sets = found if self.sets is None else self.sets.unionAll(found)


def _mixed(big: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of the nodes that hold several groups, with their group and the node's largest one."""
    named = big.join(groups, big.cls == groups.vertex, "left").select(
        "node", "cls", F.coalesce("root", "cls").alias("grp"))
    sizes = named.groupBy("node", "grp").agg(F.count("*").alias("size")).groupBy("node").agg(
        F.count("*").alias("kinds"), F.max(F.struct("size", "grp")).alias("largest"))
    return named.join(sizes.where("kinds > 1").select("node", F.col("largest.grp").alias("major")), "node")


_BLOCK_ROW = ("node long, i int, j int, side int, cls long, grp long, nodes array<long>, n_shingles long, "
              "sketch binary")


def _blocks(packed: DataFrame, classes: DataFrame):
    """Blocks of the minor groups of every node against blocks of all its sets, with sketches but without full sets."""
    count = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK).cast("int"))
    sizes = packed.groupBy("node").agg(
        F.count("*").alias("n"), F.sum((F.col("grp") != F.col("major")).cast("int")).alias("m"))
    where = packed.groupBy("cls").agg(F.collect_set("node").alias("nodes"))
    full = packed.join(sizes, "node").join(where, "cls").join(classes.select("cls", "n_shingles", "sketch"), "cls")
    own = lambda c: F.pmod(F.xxhash64("cls"), count(c)).cast("int")
    keep = ["node", "i", "j", "side", "cls", "grp", "nodes", "n_shingles", "sketch"]
    left = full.where("grp != major").withColumn("side", F.lit(0)).withColumn("i", own("m")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), count("n") - 1))).select(*keep)
    right = full.withColumn("side", F.lit(1)).withColumn("j", own("n")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), count("m") - 1))).select(*keep)
    return left.unionAll(right).groupBy("node", "i", "j")

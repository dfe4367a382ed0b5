"""Paired bootstrap of AUC, average precision and F1 differences.

Row weights are Poisson(1) draws from a hash of (seed, id, replicate): the same row has the same weight for
every model, which is the pairing, and no replicate needs the whole table at once. This replaces drawing
exactly n rows with replacement; the two agree for large n. Replicate -1 is the data itself.

Rows are never multiplied by replicates in a shuffle. Every model's rows are dealt once to buckets of scores;
the weights of all replicates are computed where a row is, as a vector. One pass over pieces of the rows, whatever
their scores, draws a row's weights once and sums them per bucket for all models; a running sum of these few vectors
says what lies above each bucket, and a second pass takes every bucket's share of the areas. A bucket's smallest
score is kept apart: its rows only matter by their sums, so a score held by very many rows never meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from riskloom.functions.hashing import POISSON_STEPS, hash_key
from riskloom.operators.ranks import same_keys
from riskloom.session import materialize, shuffle_width, small_table

OBSERVED = -1
SLICE = 64             # replicates whose sums travel together
PIECE_ROWS = 100_000   # rows whose weights are summed in one task
WEIGHTS = 1 << 20      # weights held at once
DRAWS = 1 << 17        # of them, drawn at once
BLOCK = 64             # rows of a bucket compared at once
SAMPLE_PER_BUCKET = 64
ROWS_PER_BUCKET = 4_000_000
CUTS = 100_000         # cut points of all models together
LOG_RANGE = 1424.0
INF = float("inf")

# Multipliers of the 32-bit finisher, and the draws at which a Poisson(1) weight rises.
MIX = (0x7FEB352D, 0x846CA68B)
GOLDEN = 0x9E3779B9
STEPS = [int(np.ceil(s * 2.0**32)) for s in POISSON_STEPS if s * 2.0**32 < 2**32 - 1]


@dataclass(frozen=True)
class Buckets:
    """Cut points of all groups on one axis: group number plus a monotone squeeze of the value.

    The bucket of a row is the number of cut points at or below its place on the axis, so it costs
    one search whatever the number of groups. Buckets of different groups have different numbers.
    """

    by: tuple[str, ...]
    value: str
    groups: DataFrame | None
    cuts: tuple[float, ...]

    @staticmethod
    def fit(df: DataFrame, by: Sequence[str], value: str,
            n_buckets: int | None = None) -> Buckets:
        """Cut points from a sample of about ``SAMPLE_PER_BUCKET`` rows per bucket, whatever the
        number of rows; the number of buckets follows the rows of the largest group. Groups are of
        a bounded number; a null group counts as one of them."""
        spark = df.sparkSession
        by = list(by)
        rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(
            F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < INF))
        counts = rows.groupBy(*by).agg(F.count("*").alias("_n")).collect()
        if not counts:
            return Buckets(tuple(by), value, None, ())
        largest = max(r["_n"] for r in counts)
        n = n_buckets or max(shuffle_width(df), -(-largest // ROWS_PER_BUCKET))
        n = min(n, max(2, CUTS // len(counts)))
        numbered = [(*r[:-1], i, min(1.0, SAMPLE_PER_BUCKET * n / r["_n"])) for i, r in enumerate(
            sorted(counts, key=lambda r: str(r[:-1])))]
        schema = StructType([df.schema[c] for c in by] + [
            StructField("_group", IntegerType()), StructField("_share", DoubleType())])
        groups = small_table(spark, numbered, schema)
        probs = [i / n for i in range(1, n)]
        fitted = (
            same_keys(rows, F.broadcast(groups), by).where(F.rand(11) < F.col("_share"))
            .groupBy("_group").agg(F.percentile_approx("_v", probs, 10 * n + 1000).alias("_cuts"))
            .select("_group", F.explode("_cuts").alias("_v"))
            .select(_axis(F.col("_group"), F.col("_v")).alias("_at")).distinct().collect()
        )
        edges = {r["_at"] for r in fitted} | {float(i) for i in range(1, len(numbered))}
        return Buckets(tuple(by), value, groups.drop("_share"), tuple(sorted(edges)))

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` with an int column ``_bucket``; buckets rise with the value inside a group."""
        if not self.cuts:
            return df.withColumn("_bucket", F.lit(0))
        at = _axis(F.col("_group"), F.col(self.value).cast("double"))
        wide = same_keys(df, F.broadcast(self.groups), self.by, "left").withColumn("_at", at)
        placed = Bucketizer(
            inputCol="_at", outputCol="_place", handleInvalid="keep", splits=[-INF, *self.cuts, INF],
        ).transform(wide)
        return placed.select(*df.columns, F.coalesce("_place", F.lit(0.0)).cast("int").alias("_bucket"))


    def place_wide(self, df: DataFrame, columns: Mapping[str, str], out: Sequence[str]) -> DataFrame:
        """``df``, which has a column of values for each group (by its one name), with the int columns ``out``."""
        if not self.cuts:
            return df.withColumns({c: F.lit(0) for c in out})
        numbers = {r[self.by[0]]: r["_group"] for r in self.groups.collect()}
        at = [f"_at{i}" for i in range(len(out))]
        wide = df.withColumns({a: _axis(F.lit(numbers.get(g)), F.col(c)) for a, (g, c) in zip(at, columns.items())})
        place = [f"_place{i}" for i in range(len(out))]
        placed = Bucketizer(inputCols=at, outputCols=place, handleInvalid="keep",
                            splitsArray=[[-INF, *self.cuts, INF]] * len(out)).transform(wide)
        return placed.select(*df.columns, *[
            F.coalesce(p, F.lit(0.0)).cast("int").alias(o) for p, o in zip(place, out)])


def _bucket_count(rows: DataFrame, groups: int) -> int:
    """Buckets of a group: some tasks' worth of work for every slot of the shuffle, all groups together."""
    return max(4, -(-2 * shuffle_width(rows) // groups), -(-rows.count() // ROWS_PER_BUCKET))


def _axis(group: Column, value: Column) -> Column:
    """Place of a value inside [group, group + 1); -0.0 and 0.0 are one value, NaN is the largest.
    Equal values share a place and larger ones never come before, which is all a result needs."""
    squeezed = F.signum(value) * F.log1p(F.abs(value)) / LOG_RANGE
    inside = (F.when(value.isNull() | F.isnan(value), 0.9999)
              .when(value == INF, 0.9998).when(value == -INF, 0.0001).when(value == 0, 0.5)
              .otherwise(0.5 + squeezed * 0.999))
    return group + inside


def _mix(x: np.ndarray, spare: np.ndarray | None = None) -> np.ndarray:
    """Every bit of a 32-bit word moves every other."""
    spare = np.empty_like(x) if spare is None else spare
    for shift, odd in ((16, MIX[0]), (15, MIX[1])):
        x ^= np.right_shift(x, np.uint32(shift), out=spare)
        x *= np.uint32(odd)
    x ^= np.right_shift(x, np.uint32(16), out=spare)
    return x


def weights(first: np.ndarray, second: np.ndarray, replicates: int) -> np.ndarray:
    """Weights (rows x replicates + 1) of rows with these two hash words; the first column is the data itself."""
    reps = _mix((np.arange(replicates, dtype=np.uint64) * np.uint64(GOLDEN) + np.uint64(1)).astype(np.uint32))
    first, second = (v.astype(np.uint32)[:, None] for v in (first, second))
    out = np.ones((len(first), replicates + 1), np.uint8)
    # A few rows at a time, so that the words stay near the processor.
    step = max(1, DRAWS // max(1, replicates))
    words, spare = (np.empty((min(step, len(first)), replicates), np.uint32) for _ in range(2))
    over = np.empty(words.shape, bool)
    for at in range(0, len(first), step):
        n = min(step, len(first) - at)
        draw, own = words[:n], out[at:at + n, 1:]
        _mix(np.bitwise_xor(first[at:at + n], reps, out=draw), spare[:n])
        draw += second[at:at + n]
        _mix(draw, spare[:n])
        np.greater_equal(draw, np.uint32(STEPS[0]), out=own.view(bool))
        top = int(draw.max(initial=0))
        for step_at in STEPS[1:]:
            if step_at > top:
                break
            own += np.greater_equal(draw, np.uint32(step_at), out=over[:n]).view(np.uint8)
    return out


def _slices(vectors: Sequence[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    for k, at in enumerate(range(0, len(vectors[0]), SLICE)):
        yield k, [v[at:at + SLICE] for v in vectors]


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.append(0, np.cumsum([len(v) for v in values])).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.float64)))


def _sums(models: Sequence[str], cuts: Sequence[float], least: np.ndarray, replicates: int):
    """Summed weights of a piece of the rows, by model, bucket and part of the bucket: positives, negatives, and
    both at or above the cut. A row's weights are drawn once for all models."""
    buckets = least.shape[1]

    def run(table: pa.Table) -> pa.Table:
        width = replicates + 1
        first, second = table["first"].to_numpy(), table["second"].to_numpy()
        kinds = []
        y = table["y"].to_numpy() == 1
        for i, cut in enumerate(cuts):
            score, place = (table[f"{c}{i}"].to_numpy() for c in ("s", "b"))
            known = np.flatnonzero(~np.isnan(score))
            score, place = score[known], place[known].astype(np.int64)
            # Eight kinds of row to a bucket: inner or not, positive or not, at or above the cut or not.
            code = (place * 2 + (score > least[i, place])) * 4 + y[known] * 2 + (score >= cut)
            kinds.append((known, (code + i * 8 * buckets)))
        met = np.unique(np.concatenate([code for _, code in kinds]))
        totals, step = np.zeros((len(met), width)), max(1, WEIGHTS // width)
        kinds = [(known, np.searchsorted(met, code)) for known, code in kinds]
        for at in range(0, len(first), step):
            w = weights(first[at:at + step], second[at:at + step], replicates).astype(np.float32)
            for known, code in kinds:
                lo, hi = np.searchsorted(known, (at, at + step))
                if lo == hi:
                    continue
                order = np.argsort(code[lo:hi], kind="stable")
                here, row = code[lo:hi][order], known[lo:hi][order] - at
                start = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
                for a, b in zip(start, np.append(start[1:], len(here))):
                    totals[here[a]] += w[row[a:b]].sum(axis=0)
        out = []
        group = met // 4
        for g in np.unique(group):
            pos, neg, tp, fp = np.zeros((4, width))
            for k in np.flatnonzero(group == g):
                total = totals[k]
                if met[k] & 2:
                    pos, tp = pos + total, tp + total * (met[k] & 1)
                else:
                    neg, fp = neg + total, fp + total * (met[k] & 1)
            out += [(g, k, *x) for k, x in _slices((pos, neg, tp, fp))]
        group = np.array([x[0] for x in out], np.int64)
        return pa.table({
            "model": pa.array([models[g // (2 * buckets)] for g in group], pa.string()),
            "bucket": pa.array(group // 2 % buckets, pa.int32()), "inner": pa.array(group % 2 == 1),
            "slice": pa.array([x[1] for x in out], pa.int32()),
            **{name: _lists([x[2 + i] for x in out]) for i, name in enumerate(("pos", "neg", "tp", "fp"))}})
    return run


SUMS = "model string, bucket int, inner boolean, slice int, pos array<double>, neg array<double>, tp array<double>, fp array<double>"
ABOVE = "model string, bucket int, slice int, twice array<double>, area array<double>, pos array<double>, neg array<double>, tp array<double>, fp array<double>"


def _share(a: np.ndarray, n: np.ndarray, tp: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice the pairs in the right order, and the positives times precision, of scores with ``a``
    positives and ``n`` negatives, ``tp`` and ``fp`` being all at or above them."""
    called = tp + fp
    return n * (2 * tp - a), a * np.divide(tp, called, out=np.zeros_like(called), where=called > 0)


def _running(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """What lies above each bucket's inner rows, and a row without bucket: totals of the model with the
    share of all smallest scores."""
    size = len(table["pos"][0].as_py())
    bucket, inner = table["bucket"].to_numpy(), table["inner"].to_numpy(zero_copy_only=False)
    values = [table[c].combine_chunks().flatten().to_numpy().reshape(-1, size) for c in ("pos", "neg", "tp", "fp")]
    # From the highest down; within a bucket the smallest score comes last.
    order = np.lexsort((~inner, -bucket))
    bucket, inner, values = bucket[order], inner[order], [v[order] for v in values]
    start = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (inner[1:] != inner[:-1])))
    pos, neg, tp, fp = (np.add.reduceat(v, start, axis=0) for v in values)
    bucket, inner = bucket[start], inner[start]
    upto_pos, upto_neg = np.cumsum(pos, axis=0), np.cumsum(neg, axis=0)
    low = ~inner
    twice, area = _share(pos[low], neg[low], upto_pos[low], upto_neg[low])
    none = [np.zeros(0)] * int(inner.sum())
    column = lambda whole, rest: _lists([whole, *rest])
    n = 1 + len(none)
    return pa.table({
        "model": pa.array([key[0].as_py()] * n), "bucket": pa.array([None, *bucket[inner].tolist()], pa.int32()),
        "slice": pa.array([key[1].as_py()] * n, pa.int32()),
        "twice": column(twice.sum(axis=0), none), "area": column(area.sum(axis=0), none),
        "pos": column(pos.sum(axis=0), list(upto_pos[inner] - pos[inner])),
        "neg": column(neg.sum(axis=0), list(upto_neg[inner] - neg[inner])),
        "tp": column(tp.sum(axis=0), none), "fp": column(fp.sum(axis=0), none)})


def _inner(replicates: int):
    """A bucket's share of the areas, given what lies above it.

    Only scores that some positive has make a difference: blocks of rows are cut to these by products with 0/1
    matrices, which sum the weights of the rows at or above each.
    """
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, above: pa.Table) -> pa.Table:
        width = replicates + 1
        twice, area = np.zeros(width), np.zeros(width)
        if rows.num_rows and above.num_rows:
            above = above.sort_by("slice")
            over_tp, over_fp = (above[c].combine_chunks().flatten().to_numpy() for c in ("pos", "neg"))
            score = rows["score"].to_numpy()
            order = np.argsort(-score, kind="stable")
            score, y = score[order], rows["y"].to_numpy()[order] == 1
            first, second = rows["first"].to_numpy()[order], rows["second"].to_numpy()[order]
            start = np.flatnonzero(np.append(True, score[1:] != score[:-1]))
            end = np.append(start[1:], len(score))
            step, at = max(1, min(BLOCK, WEIGHTS // width)), 0
            tp, fp, wrong = over_tp.copy(), np.zeros(width), np.zeros(width)
            while at < len(start):
                to = max(int(np.searchsorted(end, start[at] + step, side="right")), at + 1)
                lo, hi = start[at], end[to - 1]
                if to == at + 1:
                    a, n = np.zeros((1, width)), np.zeros((1, width))
                    for k in range(lo, hi, step):
                        part = slice(k, min(k + step, hi))
                        w = weights(first[part], second[part], replicates).astype(np.float32)
                        a += np.stack([y[part]]).astype(np.float32) @ w
                        n += np.stack([~y[part]]).astype(np.float32) @ w
                    with_fp, tied, rest = n, n, n[0]
                else:
                    w = weights(first[lo:hi], second[lo:hi], replicates).astype(np.float32)
                    part, group = y[lo:hi], np.repeat(np.arange(to - at), end[at:to] - start[at:to])
                    held = np.unique(group[part])
                    same = held[:, None] == group
                    a = w[part] if len(held) == part.sum() else (same & part).astype(np.float32) @ w
                    upto = np.concatenate([(group <= held[:, None]) & ~part, ~part[None]]).astype(np.float32) @ w
                    with_fp, rest = upto[:-1], upto[-1]
                    mixed = same & ~part
                    tied = mixed.astype(np.float32) @ w if mixed.any() else None
                if len(a):
                    upto_tp = tp + (np.tri(len(a), dtype=np.float32) @ a.astype(np.float32) if len(a) > 1 else a)
                    wrong += 2 * fp * a.sum(axis=0) + (a * (2 * with_fp - (0 if tied is None else tied))).sum(axis=0, dtype=float)
                    called = upto_tp + with_fp
                    called += fp + over_fp
                    np.maximum(called, 1, out=called)
                    area += (a * np.divide(upto_tp, called, out=called)).sum(axis=0)
                    tp = upto_tp[-1]
                fp = fp + rest
                at = to
            # Pairs in the wrong order, and half of the ties, are what all pairs with the bucket's negatives lack.
            twice = 2 * fp * tp - wrong
        cut = [x for _, x in _slices([twice, area])]
        k = len(cut)
        return pa.table({"model": pa.array([key[0].as_py()] * k), "slice": pa.array(range(k), pa.int32()),
                         "twice": _lists([x[0] for x in cut]), "area": _lists([x[1] for x in cut])})
    return run


def _metrics(key: tuple[pa.Scalar, ...], parts: pa.Table, whole: pa.Table) -> pa.Table:
    matrix = lambda t, c: t[c].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
    twice, area, p, n, tp, fp = (matrix(whole, c)[0] for c in ("twice", "area", "pos", "neg", "tp", "fp"))
    if parts.num_rows:
        twice, area = twice + matrix(parts, "twice").sum(axis=0), area + matrix(parts, "area").sum(axis=0)
    both = (p > 0) & (n > 0)
    rep = key[1].as_py() * SLICE + np.arange(len(p)) - 1
    twice, area, p, n, tp, fp, rep = (v[both] for v in (twice, area, p, n, tp, fp, rep))
    called = tp + fp + p
    return pa.table({
        "rep": pa.array(rep, pa.int32()), "model": pa.array([key[0].as_py()] * len(rep), pa.string()),
        "auc": pa.array(twice / (2 * p * n)), "average_precision": pa.array(area / p),
        "f1": pa.array(np.divide(2 * tp, called, out=np.zeros_like(called), where=called > 0))})


def replicate_metrics(wide: DataFrame, id_col: str, label: str, thresholds: Mapping[str, float],
                      replicates: int = 2000, seed: int = 42) -> DataFrame:
    """``rep, model, auc, average_precision, f1``. ``thresholds`` has a cut per model column. Rows without a
    label or a score are left out, and so are replicates with one class only; NaN counts as infinity."""
    models = list(thresholds)
    key = hash_key(seed, id_col)
    word = lambda k: F.conv(F.substring(key, 8 * k + 1, 8), 16, 10).cast("long")
    known = wide.where(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("y"), word(0).alias("first"), word(1).alias("second"),
        *[F.nanvl(F.col(m).cast("double"), F.lit(INF)).alias(f"s{i}") for i, m in enumerate(models)])
    names = [F.struct(F.lit(m).alias("model"), F.col(f"s{i}").alias("score")) for i, m in enumerate(models)]
    tall = known.select(F.inline(F.array(*names))).where("score IS NOT NULL")
    buckets = Buckets.fit(tall, ["model"], "score", _bucket_count(known, len(models)))
    placed = materialize(buckets.place_wide(known, {m: f"s{i}" for i, m in enumerate(models)},
                                            [f"b{i}" for i in range(len(models))]))
    tall = placed.select("y", "first", "second", F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"s{i}").alias("score"), F.col(f"b{i}").alias("bucket"))
        for i, m in enumerate(models)]))).where("score IS NOT NULL")
    # The smallest score of each model and bucket; there are fewer of them than cut points.
    shape = materialize(tall.groupBy("model", "bucket").agg(F.min("score").alias("least")))
    least = np.full((len(models), len(buckets.cuts) + 2), np.inf)
    for r in shape.collect():
        least[models.index(r["model"]), r["bucket"]] = r["least"]
    pieces = -(-placed.count() // PIECE_ROWS)
    mark = F.xxhash64("first", *[f"s{i}" for i in range(len(models))])
    # Dealt by number here and below, since a few bytes are much work.
    pieced = placed.withColumn("piece", F.pmod(mark, F.lit(max(1, pieces)))).repartition(shuffle_width(wide), "piece")
    sums = pieced.groupBy("piece").applyInArrow(
        _sums(models, [float(t) for t in thresholds.values()], least, replicates), SUMS)
    above = materialize(sums.groupBy("model", "slice").applyInArrow(_running, ABOVE))
    inner = tall.join(F.broadcast(shape), ["model", "bucket"]).where("score > least").select(
        "model", "bucket", "score", "y", "first", "second").repartition(shuffle_width(wide), "model", "bucket")
    parts = inner.groupBy("model", "bucket").cogroup(
        above.where("bucket IS NOT NULL").select("model", "bucket", "slice", "pos", "neg").groupBy("model", "bucket")
    ).applyInArrow(_inner(replicates), "model string, slice int, twice array<double>, area array<double>")
    return parts.groupBy("model", "slice").cogroup(
        above.where("bucket IS NULL").groupBy("model", "slice")
    ).applyInArrow(_metrics, "rep int, model string, auc double, average_precision double, f1 double")


METRICS = ("auc", "average_precision", "f1")


def paired_intervals(metrics: DataFrame, comparisons: Sequence[tuple[str, str, str]],
                     level: float = 0.95) -> DataFrame:
    """Observed difference, percentile interval and excludes-zero flag of each metric, per
    comparison, with the number of replicates used. Percentiles run over replicates only."""
    models = sorted({m for _, a, b in comparisons for m in (a, b)})
    per_rep = metrics.groupBy("rep").agg(*[
        F.max(F.when(F.col("model") == m, F.col(k))).alias(f"{k}__{i}")
        for i, m in enumerate(models) for k in METRICS
    ])
    deltas = per_rep.select("rep", F.inline(F.array(*[
        F.struct(
            F.lit(kind).alias("kind"), F.lit(a).alias("model_a"), F.lit(b).alias("model_b"),
            *[(F.col(f"{k}__{models.index(a)}") - F.col(f"{k}__{models.index(b)}")).alias(k)
              for k in METRICS],
        )
        for kind, a, b in comparisons
    ])))
    drawn = F.col("rep") != OBSERVED
    tail = (1.0 - level) / 2.0
    table = deltas.groupBy("kind", "model_a", "model_b").agg(
        *[
            e for k in METRICS for e in (
                F.max(F.when(~drawn, F.col(k))).alias(f"delta_{k}"),
                F.percentile(F.when(drawn, F.col(k)), tail).alias(f"{k}_ci_low"),
                F.percentile(F.when(drawn, F.col(k)), 1.0 - tail).alias(f"{k}_ci_high"),
            )
        ],
        F.count_if(drawn & F.col("auc").isNotNull()).alias("n_replicates"),
    )
    return table.withColumns({
        f"{k}_excludes_zero": ~((F.col(f"{k}_ci_low") <= 0) & (F.col(f"{k}_ci_high") >= 0))
        for k in METRICS
    })


def variance_check(metrics: DataFrame, intervals: DataFrame) -> DataFrame:
    """Bootstrap variance of each area over its analytic variance (``model, var``)."""
    spread = (
        metrics.where(F.col("rep") != OBSERVED).groupBy("model")
        .agg(F.var_samp("auc").alias("var_bootstrap"))
    )
    return spread.join(intervals.select("model", F.col("var").alias("var_analytic")), "model"
                       ).withColumn("ratio", F.col("var_bootstrap") / F.col("var_analytic"))

"""Benchmark decontamination over a positional inverted index of the corpus.

The index is partitioned by documents: every row holds the postings of one block of whole
documents, sorted by term and position, for the terms of the test set (no other term can take part
in a match). Document frequencies come from the index itself. A search orders the terms of every
test window from the rarest up, takes the postings of the rarest, shifts them by its place in the
window and intersects them with the shifted postings of the next ones, within ``slop`` places for
proximity matches. The test set is taken in blocks of at most ``ITEM_WORDS`` words, so what is
broadcast has a fixed bound whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words as W
from riskloom.llm.store import Scratch, fresh

WINDOW = 13                # words of a window
BLOCK_WORDS = 1 << 19      # postings of one index row cover about so many words, or one document
ITEM_WORDS = 1 << 20       # words of the test set searched for in one pass
PAIRS = 1 << 20            # candidates that one step of a search holds
GAP = 64                   # places between documents, so that no match crosses; above any slop

INDEX = ("doc_ids array<long>, base array<int>, n_words array<int>, terms array<long>, "
         "ends array<int>, places binary, marks array<long>")


def _index(vocabulary: np.ndarray):
    """Rows of the index; ``vocabulary`` is the sorted term codes to keep."""
    def rows(ids, marks, counts, codes):
        counts = np.concatenate(counts)
        base = np.cumsum(counts + GAP) - counts - GAP
        code = np.concatenate(codes)
        place = np.arange(len(code)) + np.repeat(np.arange(len(counts)) * GAP, counts)
        at = np.minimum(np.searchsorted(vocabulary, code), max(len(vocabulary) - 1, 0))
        keep = vocabulary[at] == code if len(vocabulary) else np.zeros(len(code), bool)
        at, place = at[keep], place[keep]
        order = np.argsort(at, kind="stable")
        at, place = at[order], place[order]
        terms, first = np.unique(at, return_index=True)
        ends = np.append(first[1:], len(at)) if len(at) else first
        return pa.RecordBatch.from_arrays([
            pa.array([[i.as_py() for i in ids]], pa.list_(pa.int64())),
            pa.array([base], pa.list_(pa.int32())), pa.array([counts], pa.list_(pa.int32())),
            pa.array([vocabulary[terms].view(np.int64)], pa.list_(pa.int64())),
            pa.array([ends], pa.list_(pa.int32())),
            pa.array([place.astype(np.int32).tobytes()], pa.binary()),
            pa.array([[i.as_py() for i in marks]], pa.list_(pa.int64())),
        ], names=["doc_ids", "base", "n_words", "terms", "ends", "places", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, marks, counts, codes, held = [], [], [], [], 0
        for batch in batches:
            for part, raw, offsets in W.chunks(batch, "text"):
                found = W.words(raw, offsets, W.LETTER_DIGIT)
                ids.extend(part.column(0))
                marks.extend(part.column(2))
                counts.append(found.count)
                codes.append(found.code)
                held += len(found.code)
                if held >= BLOCK_WORDS:
                    yield rows(ids, marks, counts, codes)
                    ids, marks, counts, codes, held = [], [], [], [], 0
        if ids:
            yield rows(ids, marks, counts, codes)
    return run


def _item_windows(window: int):
    """(item_id, term codes) of every window of every test item, and its words."""
    def run(batches):
        for batch in batches:
            for part, raw, offsets in W.chunks(batch, "text"):
                found = W.words(raw, offsets, W.LETTER_DIGIT)
                out_id, out = [], []
                for r, (f, c) in enumerate(zip(found.first, found.count)):
                    code = found.code[f:f + c].view(np.int64)
                    for at in range(max(c - window, 0) + 1 if c else 0):
                        out_id.append(part.column(0)[r].as_py())
                        out.append(code[at:at + window])
                yield pa.RecordBatch.from_arrays([
                    pa.array(out_id, pa.string()), pa.array(out, pa.list_(pa.int64()))],
                    names=["item_id", "terms"])
    return run


def _ragged(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place of every element of the ranges start[i], start[i] + 1, ... of size[i]."""
    owner = np.repeat(np.arange(len(size)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + start[owner]


class _Plan:
    """Test windows as a matrix: terms and their places, rarest first; -1 beyond short windows."""

    def __init__(self, windows: list[np.ndarray], items: list[list[str]], frequency: dict[int, int]):
        width = max((len(w) for w in windows), default=0)
        self.terms = np.zeros((len(windows), width), np.int64)
        self.shift = np.full((len(windows), width), -1, np.int64)
        self.size = np.array([len(w) for w in windows], np.int64)
        self.items = items
        for k, w in enumerate(windows):
            order = np.argsort([frequency.get(int(t), 0) for t in w], kind="stable")
            self.terms[k, :len(w)], self.shift[k, :len(w)] = w[order], order

    def matches(self, terms: np.ndarray, ends: np.ndarray, places: np.ndarray,
                slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, start) of every match in one index row.

        With slop 0 all terms stand exactly at their places; else each within ``slop`` of it.
        """
        if not len(terms) or not len(self.terms):
            return
        begins = np.append(0, ends[:-1])
        step = int(places.max()) + 4 * GAP
        key = np.repeat(np.arange(len(terms)), ends - begins) * step + places + GAP
        sorter = np.argsort(terms)
        at = np.minimum(np.searchsorted(terms, self.terms, sorter=sorter), len(terms) - 1)
        term = sorter[at]
        known = (terms[term] == self.terms) | (self.shift < 0)
        alive = np.flatnonzero(known.all(axis=1))
        size = (ends - begins)[term[alive, 0]]
        # Whole windows are packed until PAIRS candidates; one very frequent term goes alone.
        group = np.cumsum(size) // PAIRS
        for g in np.unique(group):
            take = alive[group == g]
            owner, place = _ragged(begins[term[take, 0]], (ends - begins)[term[take, 0]])
            window, start = take[owner], places[place].astype(np.int64) - self.shift[take, 0][owner]
            for j in range(1, self.terms.shape[1]):
                used = self.shift[window, j] >= 0
                want = term[window, j] * step + start + self.shift[window, j] + GAP
                low = np.searchsorted(key, want - slop)
                found = key[np.minimum(low, len(key) - 1)]
                good = ~used | ((low < len(key)) & (found <= want + slop))
                window, start = window[good], start[good]
                if not len(window):
                    break
            if len(window):
                yield window, start


def _search(plan, slop: int):
    def run(batches):
        p = plan.value
        for batch in batches:
            for r in range(batch.num_rows):
                ids, base, count, terms, ends = (
                    batch.column(k)[r].values for k in range(5))
                base, count, ends = base.to_numpy().astype(np.int64), count.to_numpy(), ends.to_numpy()
                places = np.frombuffer(batch.column(5)[r].as_py(), np.int32)
                hit, items = [np.zeros(0, np.int64)], [set() for _ in range(len(base))]
                near = [set() for _ in range(len(base))]
                for window, start in p.matches(terms.to_numpy(), ends, places, 0):
                    doc = np.searchsorted(base, start, side="right") - 1
                    _, spot = _ragged(start, p.size[window])
                    hit.append(np.unique(spot))
                    for d, w in set(zip(doc.tolist(), window.tolist())):
                        items[d].update(p.items[w])
                if slop:
                    for window, start in p.matches(terms.to_numpy(), ends, places, slop):
                        doc = np.searchsorted(base, start + GAP // 2, side="right") - 1
                        for d, w in set(zip(doc.tolist(), window.tolist())):
                            near[d].update(p.items[w])
                spots = np.unique(np.concatenate(hit))
                hits = np.bincount(np.searchsorted(base, spots, side="right") - 1, minlength=len(base))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(count, pa.int64()), pa.array(hits, pa.int64()),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array([sorted(x) for x in near], pa.list_(pa.string())),
                    pa.array([spots[(spots >= b) & (spots < b + c)] - b if h else [] for b, c, h in
                              zip(base, count, hits)], pa.list_(pa.int64())),
                    batch.column(6)[r].values,
                ], names=["doc_id", "n_words", "n_hit", "items", "near_items", "hit_words", "mark"])
    return run


RESULT = ("doc_id long, n_words long, n_hit long, items array<string>, near_items array<string>, "
          "hit_words array<long>, mark long")


def contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 slop: int = 0) -> DataFrame:
    """Exact and near occurrences of test passages, one row per document.

    Words are runs of ASCII letters, digits and characters beyond ASCII, lower-cased. An item gives
    all its windows of ``window`` words, or itself if shorter; items without words give none.
    ``mark`` is the hash of the text, which tells rows of one doc_id apart, ``hit_words`` are the places of document words inside an exact occurrence, ``items`` the items
    that have one, ``near_items`` (with ``slop`` > 0, at most 16) those with a window whose terms all
    stand within ``slop`` of their places. Null or empty texts have no words; rows with a null or a
    repeated doc_id keep their own result rows; an item with a null item_id takes part under the
    name "". Empty tables give no hits or no rows. Other columns are ignored.
    """
    if not 0 <= slop <= 16:
        raise ValueError("slop must be 0 to 16")
    spark = documents.sparkSession
    scratch = Scratch(spark, "decontaminate")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    windows = scratch.save(items.mapInArrow(_item_windows(window), "item_id string, terms array<long>"))
    # Windows of one item block; the number of blocks follows the test set, their size does not.
    blocks = max(1, -(-windows.count() * window // ITEM_WORDS))
    windows = windows.groupBy("terms").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    windows = scratch.save(windows.withColumn("block", F.pmod(F.xxhash64("terms"), F.lit(blocks))))
    parts = []
    for block in range(blocks):
        found = windows.where(F.col("block") == block).select("terms", "items").toArrow()
        terms = [t.values.to_numpy() for t in found.column(0)]
        vocabulary = np.unique(np.concatenate(terms or [np.zeros(0, np.int64)])).view(np.uint64)
        vocabulary.sort()
        sent = spark.sparkContext.broadcast(vocabulary)
        index = scratch.save(docs.mapInArrow(lambda it, v=sent: _index(v.value)(it), INDEX))
        frequency = {}
        if len(vocabulary):
            counted = index.select(F.posexplode("terms").alias("k", "term"), "ends").select(
                "term", (F.col("ends")[F.col("k")] - F.when(F.col("k") > 0, F.col("ends")[F.col("k") - 1])
                         .otherwise(0)).alias("n")).groupBy("term").agg(F.sum("n").alias("n")).toArrow()
            frequency = dict(zip(counted.column(0).to_pylist(), counted.column(1).to_pylist()))
        plan = spark.sparkContext.broadcast(_Plan(terms, found.column(1).to_pylist(), frequency))
        parts.append(index.mapInArrow(_search(plan, slop), RESULT))
    if blocks == 1:
        return parts[0]
    return _merged(parts)


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Results of several item blocks. Rows of one doc_id and text (by ``mark``) are equal in all."""
    from functools import reduce
    rows = reduce(DataFrame.unionAll, [p.withColumn("part", F.lit(k)) for k, p in enumerate(parts)])
    return rows.groupBy("doc_id", "n_words", "mark").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.sum(F.when(F.col("part") == 0, 1).otherwise(0)).cast("int").alias("copies"),
    ).withColumn("k", F.explode(F.sequence(F.lit(1), "copies"))).select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), "items", "near_items", "hit_words",
        "mark")


def without(documents: DataFrame, found: DataFrame) -> DataFrame:
    """``documents`` without the rows of ``found``, by doc_id and text."""
    doc, mark = fresh(documents.columns, "doc"), fresh(documents.columns, "mark")
    gone = found.select(F.col("doc_id").alias(doc), F.col("mark").alias(mark))
    return documents.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (
        F.xxhash64("text") == F.col(mark)), "left_anti")



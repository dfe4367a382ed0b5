"""Passages that several documents share, by sparse suffix arrays.

Only suffixes at content-selected places are retained: the minimiser of every ``SPAN`` consecutive
runs of ``SEED`` words, so that every passage of ``least`` words holds one that the same passage has
elsewhere too. The retained suffixes are brought into order by their first ``SEED`` words and a
suffix lives on if a neighbour of another document starts alike. Around the survivors the text is
extended to the left and to the right, one word at a time up to ``least`` words, and the extended
suffixes are compared the same way; what has an equal neighbour in another document is repeated.
Comparison is by counts per key, which combine before the shuffle, so a passage that a third of all
documents hold needs no task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from riskloom.llm import words as W
from riskloom.llm.store import Scratch, fresh

LEAST = 50      # words of a passage
SEED = 16       # words that a retained suffix must share with a neighbour


def _minimisers(code: np.ndarray, span: int) -> np.ndarray:
    """Places that are the leftmost minimum of some ``span`` consecutive codes (all, if fewer)."""
    if len(code) <= span:
        return np.array([int(np.argmin(code))]) if len(code) else np.zeros(0, np.int64)
    low = np.stack([code, np.zeros_like(code)])[0].copy()
    place = np.arange(len(code))
    width = 1
    while width < span:  # minimum of windows of doubling width
        step = min(width, span - width)
        a, b = low[:-step], low[step:]
        right = b < a
        low = np.where(right, b, a)
        place = np.where(right, place[step:], place[:-step])
        width += step
    return np.unique(place)


def _anchors(seed: int, span: int):
    """(key, doc, mark, place) of the retained suffixes of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in W.chunks(batch, "text"):
                found = W.words(raw, offsets, W.NOT_SPACE, W.AS_IS)
                run_code = W.runs(found.code, seed)
                keys, places, rows = [], [], []
                for r in np.flatnonzero(found.count >= seed + span - 1):
                    a = found.first[r]
                    code = run_code[a:a + found.count[r] - seed + 1]
                    at = _minimisers(code, span)
                    keys.append(code[at])
                    places.append(at)
                    rows.append(np.full(len(at), r))
                if keys:
                    at = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(keys).view(np.int64)),
                        part.column(0).take(at), part.column(1).take(at),
                        pa.array(np.concatenate(places).astype(np.int32)),
                    ], names=["key", "doc", "mark", "place"])
    return run


def _extended(least: int, span: int):
    """Hashes of all passages of ``least`` words around the surviving suffixes."""
    def run(batches):
        for batch in batches:
            for part, raw, offsets in W.chunks(batch, "text"):
                found = W.words(raw, offsets, W.NOT_SPACE, W.AS_IS)
                full = W.runs(found.code, least)
                keys, starts, rows = [], [], []
                for r in range(part.num_rows):
                    last = found.count[r] - least
                    if last < 0:
                        continue
                    at = part.column(3)[r].values.to_numpy().astype(np.int64)
                    mark = np.zeros(last + 2, np.int64)
                    np.add.at(mark, np.clip(at - span + 1, 0, last + 1), 1)
                    np.add.at(mark, np.clip(at + 1, 0, last + 1), -1)
                    start = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
                    keys.append(full[found.first[r] + start])
                    starts.append(start)
                    rows.append(np.full(len(start), r))
                if keys:
                    at = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(keys).view(np.int64)),
                        part.column(0).take(at), part.column(1).take(at),
                        pa.array(np.concatenate(starts).astype(np.int32)),
                    ], names=["key", "doc", "mark", "start"])
    return run


def _spans(least: int):
    """Union of the repeated passages of each document, and of those that occur earlier."""
    def merged(start: np.ndarray) -> np.ndarray:
        start = np.unique(start)
        if not len(start):
            return np.zeros((0, 2), np.int64)
        cut = np.flatnonzero(np.diff(start) > least)
        return np.stack([start[np.append(0, cut + 1)], start[np.append(cut, len(start) - 1)] + least], 1)

    def run(batches):
        for batch in batches:
            every, later = [], []
            for k in range(batch.num_rows):
                x = batch.column(2)[k].values.to_numpy().astype(np.int64)
                every.append(merged(x >> 1).tolist())
                later.append(merged(x[(x & 1) == 1] >> 1).tolist())
            kind = pa.list_(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(every, kind), pa.array(later, kind)],
                names=["doc", "mark", "spans", "later"])
    return run


def _own_key() -> Column:
    """The doc_id; rows without one are told apart by their text."""
    return F.coalesce(F.col("doc_id").cast("long"), -F.shiftrightunsigned(F.xxhash64("text"), 1) - 1)


def repeated_passages(documents: DataFrame, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """Documents that share a passage of ``least`` or more words with another document.

    Result: doc (the doc_id), ``spans`` [from, to) in words of every repeated stretch, and ``later``,
    the part of them that occurs earlier: under a smaller doc_id, or further up in the document. Words
    are runs between white space, compared as they are. Null and empty texts, and texts of fewer
    than ``least`` words, have no passage. Rows that repeat a doc_id count as one document (a passage
    in both is not shared by two); rows with a null doc_id are documents of their own per text, under
    a negative id made from it. An empty table gives an empty result; other columns are ignored.
    """
    docs = documents.select(_own_key().alias("doc"), F.lit(0).cast("long").alias("mark"), "text")
    return _passages(docs, least, seed).select("doc", "spans", "later")


def _passages(docs: DataFrame, least: int, seed: int) -> DataFrame:
    """doc, mark, spans, later of ``docs`` (doc, mark, text): spans are places in the text of that mark.

    Passages are shared by two if their doc differs, and come first by doc, mark and place.
    """
    if not 1 <= seed <= least:
        raise ValueError("seed must be 1 to least words")
    span = least - seed + 1
    scratch = Scratch(docs.sparkSession, "repeats")
    longer = _around(docs, least, seed, span, scratch)
    # What the finished steps wrote for their shuffles is as large as the input and goes before the next one writes.
    scratch.let_go()
    first = scratch.save(longer.groupBy("key").agg(
        F.max("doc").alias("y"), F.min(F.struct("doc", "mark", "start")).alias("first")).where(
        "first.doc != y").select("key", "first"))
    scratch.let_go()
    is_first = F.struct("doc", "mark", "start") == F.col("first")
    seen = longer.join(first, "key").select("doc", "mark", (
        F.col("start").cast("long") * 2 + F.when(is_first, 0).otherwise(1)).alias("x"))
    found = seen.groupBy("doc", "mark").agg(F.collect_list("x").alias("x"))
    return found.mapInArrow(_spans(least), "doc long, mark long, spans array<array<long>>, later array<array<long>>")


def _around(docs: DataFrame, least: int, seed: int, span: int, scratch: Scratch) -> DataFrame:
    """key, doc, mark, start of the passages around suffixes that another document has too. Its plans end with it, so
    that nothing holds their shuffle files."""
    anchors = scratch.save(docs.mapInArrow(_anchors(seed, span), "key long, doc long, mark long, place int"))
    alike = anchors.groupBy("key").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x != y")
    alive = scratch.save(anchors.join(alike.select("key"), "key").groupBy("doc", "mark").agg(
        F.collect_set("place").alias("places")))
    scratch.drop(anchors)
    del anchors, alike
    scratch.let_go()
    around = docs.join(alive, ["doc", "mark"]).select("doc", "mark", "text", "places")
    longer = scratch.save(around.mapInArrow(_extended(least, span), "key long, doc long, mark long, start int"))
    scratch.drop(alive)
    return longer


def _cut(later: str):
    """Texts without the words in the column ``later``, which goes."""
    def run(batches):
        for batch in batches:
            where = batch.schema.get_field_index(later)
            column = batch.schema.get_field_index("text")
            texts = []
            for part, raw, offsets in W.chunks(batch, "text"):
                gone = part.column(where).to_pylist()
                found = None
                for r, (old, spans) in enumerate(zip(part.column(column).to_pylist(), gone)):
                    if not spans:
                        texts.append(old)
                        continue
                    found = W.words(raw, offsets, W.NOT_SPACE, W.AS_IS) if found is None else found
                    data, at, kept = raw[offsets[r]:offsets[r + 1]].tobytes(), 0, []
                    f, n = found.first[r], found.count[r]
                    for a, b in spans:
                        kept.append(data[at:found.start[f + a]])
                        at = found.start[f + b] if b < n else len(data)
                    texts.append(b"".join([*kept, data[at:]]).decode())
            arrays = list(batch.columns)
            arrays[column] = pa.array(texts, pa.string())
            names = batch.schema.names
            keep = [k for k in range(len(names)) if k != where]
            yield pa.RecordBatch.from_arrays([arrays[k] for k in keep], names=[names[k] for k in keep])
    return run


def without_repeats(documents: DataFrame, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """``documents`` with every repeated passage kept only where it occurs first.

    Documents that lose all their words go; all other rows and columns stay as they are. Rows of one
    doc_id with different texts are cut each by its own text.
    """
    names = documents.columns
    own, mark, later, changed = (fresh(names, n) for n in ("own", "mark", "later", "changed"))
    docs = documents.select(_own_key().alias("doc"), F.xxhash64("text").alias("mark"), "text")
    found = _passages(docs, least, seed).where("size(later) > 0").select(
        F.col("doc").alias(own), F.col("mark").alias(mark), F.col("later").alias(later))
    keyed = documents.withColumn(own, _own_key()).withColumn(mark, F.xxhash64("text"))
    rows = keyed.join(found, [own, mark], "left").select(
        *names, later, F.col(later).isNotNull().alias(changed))
    kinds = StructType([*documents.schema, StructField(changed, BooleanType())])
    cut = rows.mapInArrow(_cut(later), kinds)
    return cut.where(~F.col(changed) | (F.length(F.trim("text")) > 0)).select(*names)

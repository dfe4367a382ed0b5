"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of consecutive words that repeats its first q words at least ``EXPONENT`` times, q being
its smallest period. Re-Pair turns the word ids of a block of texts into a grammar: pairs of neighbouring
symbols that occur twice become a symbol of their own, most frequent pairs first, until no pair is left
that occurs twice. Every run crosses the inner boundary of some symbol that holds it, or a boundary of the
sequence that is left. A symbol's boundary is looked at once, whatever the number of its occurrences; what
is found there is carried to all places where the symbol stands, and pieces of one run are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words as W

EXPONENT = 4     # a run holds its period so many times
LEAST = 6        # and so many words

#: Where and with which period a text's words are made to repeat: (key, words of the text) -> (a, p).
Tail = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Grammar(NamedTuple):
    """Occurrences of all symbols that stand for a pair, and the sequence that is left."""
    symbol: np.ndarray   # of each occurrence
    start: np.ndarray    # its first place in the text
    left: np.ndarray     # words of the pair's first part
    width: np.ndarray    # words of both
    rest: np.ndarray     # first places of the symbols that are left


def _grouped(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the codes (stably), group of each in that order, and sizes of the groups."""
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    new = np.ones(len(code), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(new) - 1
    return order, group, np.bincount(group)


def grammar(ids: np.ndarray) -> Grammar:
    """Re-Pair of a sequence of ids. All pairs that are more frequent than the pairs they overlap
    are replaced in one round, so that rounds are few."""
    symbol, start = ids.astype(np.int64), np.arange(len(ids))
    width = np.ones(len(ids), np.int64)
    fresh = int(symbol.max(initial=-1)) + 1
    live = np.ones(len(ids), bool)        # pairs that may still occur twice
    live[-1:] = False
    found = []
    while True:
        at = np.flatnonzero(live)
        if not len(at):
            break
        order, group, size = _grouped((symbol[at] << 32) | symbol[at + 1])
        live[at[order[size[group] < 2]]] = False
        if size.max() < 2:
            break
        rank = np.empty(len(size), np.int64)
        rank[np.argsort(size, kind="stable")] = np.arange(1, len(size) + 1)
        prior = np.zeros(len(symbol), np.int64)
        prior[at[order]] = np.where(size[group] < 2, 0, rank[group])
        # Equal neighbours are overlapping pairs of one symbol: every second of them is taken.
        edge = np.flatnonzero(np.append(True, prior[1:] != prior[:-1]))
        value, length = prior[edge], np.diff(np.append(edge, len(prior)))
        top = (value > 0) & (value > np.append(0, value[:-1])) & (value > np.append(value[1:], 0))
        take = (length[top] + 1) // 2
        place = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
        chosen = np.repeat(edge[top], take) + 2 * place
        kinds, name = np.unique(prior[chosen], return_inverse=True)
        both = width[chosen] + width[chosen + 1]
        found.append((fresh + name, start[chosen], width[chosen], both))
        symbol[chosen], width[chosen] = fresh + name, both
        fresh += len(kinds)
        live[chosen] = True
        live[chosen[chosen > 0] - 1] = True
        keep = np.ones(len(symbol), bool)
        keep[chosen + 1] = False
        symbol, start, width, live = symbol[keep], start[keep], width[keep], live[keep]
        live[-1:] = False
    parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
    return Grammar(*parts, start)


class _Repeats:
    """Names of all stretches of 1, 2, 4, ... words that occur twice; -1 for the others."""

    def __init__(self, ids: np.ndarray):
        self.names: list[np.ndarray] = []
        self.next: list[tuple[np.ndarray, np.ndarray]] = []   # places and how far on the same stretch comes again
        at, code, size = np.arange(len(ids)), ids.astype(np.int64), len(ids)
        while len(at):
            order, group, counts = _grouped(code)
            again = counts[group] > 1
            ordered = at[order]
            name = np.full(size, -1, np.int64)
            name[ordered[again]] = group[again]
            if not again.any():
                break
            same = np.flatnonzero(group[1:] == group[:-1])
            self.names.append(name)
            self.next.append((ordered[same], ordered[same + 1] - ordered[same]))
            step = 1 << (len(self.names) - 1)
            at = np.flatnonzero(name[:max(size - step, 0)] >= 0)
            at = at[name[at + step] >= 0]
            code = (name[at] << 32) | name[at + step]

    def ahead(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on."""
        size, out = len(self.names[0]), np.zeros(len(x), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            name, i, j = self.names[level], x + out, y + out
            inside = np.maximum(i, j) < size
            a = name[np.where(inside, i, 0)]
            out += (inside & (a >= 0) & (a == name[np.where(inside, j, 0)])) << level
        return out

    def behind(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before x equal those before y."""
        out = np.zeros(len(x), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            name = self.names[level]
            i, j = x - out - (1 << level), y - out - (1 << level)
            inside = np.minimum(i, j) >= 0
            a = name[np.where(inside, i, 0)]
            out += (inside & (a >= 0) & (a == name[np.where(inside, j, 0)])) << level
        return out


def _crossing(repeats: _Repeats, lo: np.ndarray, middle: np.ndarray, hi: np.ndarray):
    """Runs that cross the boundary ``middle`` within [lo, hi): (boundary, start, end, period).

    A run of a period q with 2^(j-1) < q <= 2^j repeats stretches of 2^j words at a distance of
    exactly q, and one of the stretches that start 0 to 4 half-steps of 2^j before the boundary
    lies in it together with its next occurrence.
    """
    found = []
    for level, (at, gap) in enumerate(repeats.next):
        good = (gap <= 1 << level) & (2 * gap > 1 << level)
        if not good.any():
            continue
        period = np.zeros(len(repeats.names[0]) + 1, np.int64)
        period[at[good]] = gap[good]
        step = max(1 << level >> 1, 1)
        upto = np.append(0, np.cumsum(period > 0))
        wide = np.flatnonzero(hi - lo >= max(LEAST, EXPONENT * ((1 << level >> 1) + 1)))
        wide = wide[upto[middle[wide] + 1] > upto[np.maximum(middle[wide] - 4 * step, 0)]]
        for back in range(5):
            i = middle[wide] - back * step
            some = i >= lo[wide]
            which, i = wide[some], i[some]
            which, i = which[period[i] > 0], i[period[i] > 0]
            q = period[i]
            start = np.maximum(i - repeats.behind(i, i + q), lo[which])
            end = np.minimum(i + q + repeats.ahead(i, i + q), hi[which])
            good = (end - start >= np.maximum(LEAST, EXPONENT * q)) & (start < middle[which]) & (end > middle[which])
            found.append((which[good], start[good], end[good], q[good]))
    return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Pieces of one period that overlap by the period or more are pieces of one run."""
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    base = period * (int(end.max(initial=0)) + 1)        # keeps the running maximum within a period
    far = np.maximum.accumulate(end + base) - base
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > far[:-1] - period[1:])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return start[first], far[last] if len(first) else far, period[first]


def find(code: np.ndarray, row: np.ndarray, rows: int):
    """Runs of the texts whose words ``code`` stand in order of ``row``: (row, start, end, period)
    by row, start and period; starts count from the row's first word."""
    if not len(code):
        return [np.zeros(0, np.int64)] * 4
    # Every text is followed by an id that occurs once, so nothing repeats across texts.
    _, ids = np.unique(code, return_inverse=True)
    padded = np.empty(len(code) + rows, np.int64)
    place = np.arange(len(code)) + row
    stop = np.cumsum(np.bincount(row, minlength=rows)) + np.arange(rows)
    padded[place], padded[stop] = ids, len(code) + np.arange(rows)
    begin = np.append(0, stop[:-1] + 1)
    g, repeats = grammar(padded), _Repeats(padded)
    if not repeats.names:
        return [np.zeros(0, np.int64)] * 4
    # One occurrence of every symbol, then the boundaries of what is left, which reach over the text.
    order = np.argsort(g.symbol, kind="stable")
    once = order[np.flatnonzero(np.append(True, g.symbol[order][1:] != g.symbol[order][:-1]))] if len(order) else order
    rest = g.rest[1:]
    text = np.searchsorted(stop, rest)
    inner = (rest > begin[text]) & (rest < stop[text])
    rest, text = rest[inner], text[inner]
    lo = np.concatenate([g.start[once], begin[text]])
    middle = np.concatenate([g.start[once] + g.left[once], rest])
    hi = np.concatenate([g.start[once] + g.width[once], stop[text]])
    which, start, end, period = _crossing(repeats, lo, middle, hi)
    # To all places of the symbols.
    own = which < len(once)
    symbols = g.symbol[order]
    kind = g.symbol[once[which[own]]] if len(once) else np.zeros(0, np.int64)
    a, b = np.searchsorted(symbols, kind), np.searchsorted(symbols, kind, side="right")
    times = b - a
    nth = np.repeat(a, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    moved = g.start[order[nth]] - np.repeat(lo[which[own]], times)
    start = np.concatenate([np.repeat(start[own], times) + moved, start[~own]])
    end = np.concatenate([np.repeat(end[own], times) + moved, end[~own]])
    period = np.concatenate([np.repeat(period[own], times), period[~own]])
    start, end, period = _merged(start, end, period)
    text = np.searchsorted(stop, start)
    order = np.lexsort((period, start, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    return text, start - begin[text], end - begin[text], period


def _folded(first: np.ndarray, count: np.ndarray, row: np.ndarray, a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Index of the word that every word becomes when the words from ``a`` on repeat the ``p`` there."""
    at = np.arange(len(row)) - first[row]
    a, p = a[row], p[row]
    return first[row] + np.where(at >= a, a + (at - a) % np.maximum(p, 1), at)


def _blocks(tail: Tail | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in W.chunks(batch, "text"):
                found = W.words(raw, offsets, W.NOT_SPACE, W.AS_IS)
                code, told = found.code, part.num_rows
                source = np.arange(len(code))
                if tail is not None and len(code):
                    key = part.column(2).to_numpy(zero_copy_only=False)
                    a, p = tail(key, found.count)
                    source = _folded(found.first, found.count, found.row, a, p)
                    code = code[source]
                row, start, end, period = find(code, found.row, told)
                drop = np.zeros(len(code) + 1, np.int64)
                at = found.first[row]
                np.add.at(drop, at + start + period, 1)
                np.add.at(drop, at + end, -1)
                kept = np.cumsum(drop[:-1]) == 0
                data, texts = raw.tobytes(), []
                for k, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                    f, n = int(found.first[k]), int(found.count[k])
                    say = data[a:b].split()
                    mine = source[f:f + n][kept[f:f + n]] - f
                    texts.append(b" ".join(map(say.__getitem__, mine.tolist())))
                ends = np.append(0, np.cumsum(np.bincount(row, minlength=told))).astype(np.int32)
                spans = pa.StructArray.from_arrays(
                    [pa.array(start), pa.array(end - start), pa.array(period)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found.count.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), spans), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(documents: DataFrame, key: Column | None = None, tail: Tail | None = None) -> DataFrame:
    """Runs of every whole text: doc_id, n_words, runs (start, length, period), collapsed.

    ``documents`` has doc_id and text; other columns are ignored. Words are what white space parts,
    numbered from 0. ``runs`` are in order of start, then period. ``collapsed`` is the text without the
    repetitions: a word goes if some run holds it behind that run's first period; the others are joined
    by one space. With ``tail`` the words are changed before: given ``key`` and the number of words it
    says from which word on a text repeats how many words. A null or empty text has no words, no runs and
    an empty collapsed text. Every row, repeated or not, gives a row, whatever its doc_id; texts of
    equal words give equal results. An empty table gives an empty result. Memory is bounded by
    ``words.CHUNK_BYTES`` of text or the longest text; rows are independent, nothing is shuffled.
    """
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    columns += [] if tail is None else [key.alias("key")]
    return documents.select(*columns).mapInArrow(
        _blocks(tail), "doc_id long, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string")

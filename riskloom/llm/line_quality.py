"""Quality of texts by a linear-chain conditional random field over their lines.

Every line is good or bad. Its potential is a linear function of what the line and its two neighbours look
like (shares of letters, capitals and symbols, repeated words and lines, lengths), and neighbouring labels have
potentials of their own. Forward and backward messages are products of 2 x 2 matrices, taken for all lines
of a block of texts at once by doubling. A text's quality is the mean of its lines' marginals, weighted by
their lengths and mapped to the share of good labels by a logistic curve.

Only whole texts are labelled. A text labelled good has good lines. Of a text labelled bad those lines
are taken as good that a first model, of single lines without neighbours, finds good; its worst line stays bad.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words as W
from riskloom.llm.language import fold

SAMPLE = 2000           # labelled texts to learn from, half of them of each label where there are as many
SAMPLE_BYTES = 1 << 16  # longer texts are not learned from
STEPS, RATE, DECAY = 150, 0.1, 1e-3
CUT = 0.3               # texts of at least this score are predicted good

_IN = lambda chars: np.isin(W.BYTES, [ord(c) for c in chars])
_UPPER = (W.BYTES >= 65) & (W.BYTES <= 90)
_LETTER = _UPPER | ((W.BYTES >= 97) & (W.BYTES <= 122)) | (W.BYTES >= 128)
_DIGIT = (W.BYTES >= 48) & (W.BYTES <= 57)
_POINT = _IN(".,;:?!'\"()-")
_STOP = _IN(".?!")
_SYMBOL = ~_LETTER & ~_DIGIT & ~_POINT & W.NOT_SPACE


class Lines(NamedTuple):
    features: np.ndarray   # of each line
    row: np.ndarray        # text of each line
    start: np.ndarray      # first byte within the text
    end: np.ndarray        # byte after the last
    weight: np.ndarray     # bytes that are no white space


def lines_of(raw: np.ndarray, offsets: np.ndarray) -> Lines:
    """Lines with a visible character, in order, and what they look like."""
    inner = np.flatnonzero(raw == 10) + 1
    starts = np.union1d(inner[inner < len(raw)], offsets[:-1][offsets[:-1] < offsets[1:]])
    row = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.append(starts[1:], len(raw))
    count = lambda kind: np.add.reduceat(kind[raw].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    weight = count(W.NOT_SPACE)
    keep = weight > 0
    starts, ends, row, weight = starts[keep], ends[keep], row[keep], weight[keep]
    n = len(starts)
    if not n:
        return Lines(np.zeros((0, N_FEATURES), np.float32), row, starts, ends, weight)
    upper, letter, digit, point, symbol = (count(k) for k in (_UPPER, _LETTER, _DIGIT, _POINT, _SYMBOL))
    twice = np.append(0, np.cumsum(np.append(False, (raw[1:] == raw[:-1]) & (_SYMBOL | _POINT)[raw[1:]])))
    twice = twice[ends] - twice[starts]

    found = W.words(raw, offsets, W.NOT_SPACE, W.AS_IS)
    first, last = offsets[found.row] + found.start, offsets[found.row] + found.end - 1
    line = np.searchsorted(starts, first, side="right") - 1
    per = lambda values: np.bincount(line, values, n)
    size = np.bincount(line, minlength=n)
    letters = np.append(0, np.cumsum(_LETTER[raw]))
    capitals = np.append(0, np.cumsum(_UPPER[raw]))
    inside = letters[last + 1] - letters[first]
    big = capitals[last + 1] - capitals[first]
    near = np.append(False, (found.code[1:] == found.code[:-1]) & (line[1:] == line[:-1]))
    kinds = lambda group: np.unique(W.mix(found.code ^ W.mix(group.astype(np.uint64))), return_index=True)[1]
    distinct = np.bincount(line[kinds(line)], minlength=n)
    texts = len(offsets) - 1
    in_text, told = np.bincount(found.row[kinds(found.row)], minlength=texts), np.maximum(found.count, 1)
    place = np.arange(len(line)) - (np.cumsum(size) - size)[line]
    whole = np.add.reduceat(W.mix(found.code + place.astype(np.uint64)), np.cumsum(size) - size)
    whole ^= W.mix(row.astype(np.uint64))
    _, kind, times = np.unique(whole, return_inverse=True, return_counts=True)
    repeated = times[kind] > 1
    lines = np.bincount(row, minlength=texts)

    share = lambda part, of: part / np.maximum(of, 1)
    columns = [
        np.log1p(size), np.log1p(weight), share(letter, weight), share(digit, weight), share(upper, letter),
        share(symbol, weight), np.sqrt(share(symbol, weight)), share(point, weight), share(twice, weight),
        share(weight, size) / 10, share(distinct, size), share(distinct, np.sqrt(size + 0.0)), share(per(near), size),
        np.sqrt(share(per(near), size)), share(per(inside == 0), size), share(per((big > 1) & (big == inside)), size),
        share(per(_SYMBOL[raw[last]]), size), share(per(_STOP[raw[last]]), size), share(per(last - first >= 24), size),
        _STOP[raw[last[np.cumsum(size) - 1]]], _UPPER[raw[first[np.cumsum(size) - size]]], repeated,
        share(in_text, told)[row], np.log1p(lines)[row], share(np.bincount(row, repeated, texts), lines)[row],
    ]
    return Lines(np.stack(columns, axis=1).astype(np.float32), row, starts - offsets[row], ends - offsets[row], weight)


N_FEATURES = 25


def _with_neighbours(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Features of every line, of the one before and of the one behind, and where these are missing."""
    n = len(x)
    same = row[1:] == row[:-1]
    out = np.zeros((n, 3 * x.shape[1] + 3), np.float32)
    k = x.shape[1]
    out[:, :k] = x
    out[1:, k:2 * k] = np.where(same[:, None], x[:-1], 0)
    out[:-1, 2 * k:3 * k] = np.where(same[:, None], x[1:], 0)
    out[:, -3] = 1
    out[:, -2], out[:, -1] = np.append(True, ~same)[:n], np.append(~same, True)[:n]
    return out


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices (entries by row on the first axis), each scaled to a sum of 1."""
    c = np.stack([a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3],
                  a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3]])
    return c / c.sum(axis=0)


def forward_backward(potential: np.ndarray, row: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability that each line is good, probabilities of each line's pair of labels: before x own, 4 x lines).

    The pair of a text's first line is all 0. The matrix of a first line has equal rows, so that a product that
    reaches over it forgets what is before: products of as many matrices as the longest text has lines suffice.
    """
    n = len(potential)
    if not n:
        return np.zeros(0), np.zeros((4, 0))
    first = np.append(True, row[1:] != row[:-1])
    step = np.exp(np.where(first, 0.0, move.reshape(4, 1)))
    step[1::2] *= np.exp(np.clip(potential, -30, 30))
    ahead = step / step.sum(axis=0)
    behind = np.concatenate([ahead[:, 1:], np.full((4, 1), 0.25)], axis=1)
    begins = np.flatnonzero(first)
    longest = int(np.diff(np.append(begins, n)).max())
    reach = 1
    while reach < longest:
        ahead[:, reach:] = _times(ahead[:, :-reach], ahead[:, reach:])
        behind[:, :-reach] = _times(behind[:, :-reach], behind[:, reach:])
        reach *= 2
    alpha, beta = ahead[:2] + ahead[2:], behind[::2] + behind[1::2]
    both = alpha * beta
    pair = np.zeros((4, n))
    pair[:, 1:] = np.repeat(alpha[:, :-1], 2, axis=0) * step[:, 1:] * np.tile(beta[:, 1:], (2, 1))
    pair /= np.maximum(pair.sum(axis=0), 1e-300)
    pair[:, first] = 0
    return both[1] / both.sum(axis=0), pair


class Model:
    """Weights of the potentials, potentials of neighbouring labels, and the curve of the texts' score."""

    def __init__(self, features: np.ndarray, row: np.ndarray, weight: np.ndarray, label: np.ndarray, known: np.ndarray,
                 steps: int = STEPS):
        """``row`` numbers the texts, ``label`` has their labels, ``known`` how many texts there are of each."""
        self.mean = features.mean(axis=0) if len(features) else np.zeros(N_FEATURES)
        self.scale = np.maximum(features.std(axis=0), 1e-3) if len(features) else np.ones(N_FEATURES)
        self.prior = float((known[1] + 1) / (known.sum() + 2))
        self.move, self.w, self.curve = np.zeros((2, 2)), np.zeros(3 * N_FEATURES + 3), (0.0, 0.0)
        if not len(features) or len(set(label.tolist())) < 2:
            return
        x = self._inputs(features, row)
        texts = len(label)
        lines = np.bincount(row, minlength=texts)
        share = np.bincount(label[lines > 0], minlength=2)
        each = (1 / np.maximum(lines, 1) / np.maximum(share, 1)[label])[row] / 2
        own = label[row].astype(float)
        for full in (False, False, True):
            self._fit(x, row, own, each, full, steps)
            if not full:
                # Lines of bad texts that look good by themselves; the worst line of each stays bad.
                good = self._marginals(x, row)[0]
                worst = np.full(texts, np.inf)
                np.minimum.at(worst, row, good)
                own = np.where(label[row] == 1, 1.0, (good > 0.5) & (good > worst[row]))
        seen = lines > 0
        mean = self._means(x, row, weight, texts)
        factor = known / np.maximum(np.bincount(label[seen], minlength=2), 1)
        self.curve = self._curve(mean[seen], label[seen], factor[label[seen]])

    def _inputs(self, features: np.ndarray, row: np.ndarray) -> np.ndarray:
        return _with_neighbours(np.clip((features - self.mean) / self.scale, -6, 6).astype(np.float32), row)

    def _marginals(self, x, row):
        return forward_backward(x @ self.w, row, self.move)

    def _fit(self, x, row, own, each, full, steps):
        """Weighted conditional likelihood of the labels, by gradient steps with running moments; unless ``full``,
        neighbouring lines and labels are left out."""
        free = np.ones(len(self.w) + 4)
        free[N_FEATURES:-7] = free[-6:] = full
        pairs = np.zeros((4, len(x)))
        same = np.flatnonzero(row[1:] == row[:-1]) + 1
        pairs[(2 * own[same - 1] + own[same]).astype(int), same] = 1
        state = np.zeros((2, len(self.w) + 4))
        x64 = x.astype(np.float64)
        for step in range(1, steps + 1):
            good, pair = self._marginals(x64, row)
            slope = free * np.append(x64.T @ ((own - good) * each) - DECAY * self.w,
                                     (pairs - pair) @ each - DECAY * self.move.ravel())
            state[0] = 0.9 * state[0] + 0.1 * slope
            state[1] = 0.99 * state[1] + 0.01 * slope ** 2
            go = RATE * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8)
            self.w, self.move = self.w + go[:-4], self.move + go[-4:].reshape(2, 2)

    def _means(self, x, row, weight, texts):
        good = self._marginals(x, row)[0]
        total = np.bincount(row, weight, texts)
        return np.bincount(row, weight * good, texts) / np.maximum(total, 1)

    def _curve(self, mean, label, factor):
        """Slope (0 at least) and height of the logistic curve, by damped Newton steps with a small penalty."""
        z, p = np.stack([mean, np.ones(len(mean))], axis=1), np.zeros(2)
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(z @ p, -30, 30)))
            slope = z.T @ ((label - q) * factor) - 0.02 * p
            bend = (z * (q * (1 - q) * factor)[:, None]).T @ z + 0.02 * np.eye(2)
            p = p + np.clip(np.linalg.solve(bend, slope), -2, 2)
        return max(float(p[0]), 0.0), float(p[1])

    def read(self, found: Lines, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """(marginal of each line, score of each text)."""
        x = self._inputs(found.features, found.row)
        good = self._marginals(x, found.row)[0]
        total = np.bincount(found.row, found.weight, texts)
        mean = np.bincount(found.row, found.weight * good, texts) / np.maximum(total, 1)
        score = 1 / (1 + np.exp(-np.clip(self.curve[0] * mean + self.curve[1], -30, 30)))
        learned = bool(np.any(self.w))
        return good, np.where((total > 0) & learned, score, self.prior)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, raw, offsets in W.chunks(batch, "text"):
            found = lines_of(raw, offsets)
            cuts = np.searchsorted(found.row, np.arange(part.num_rows + 1))
            packed = [found.features[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            sizes = [found.weight[a:b].astype(np.int64).tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(packed, pa.binary()), pa.array(sizes, pa.binary())],
                names=["doc_id", "quality", "features", "weights"])


def fit(documents: DataFrame, labels: DataFrame, may_learn: Column, sample: int = SAMPLE, steps: int = STEPS) -> Model:
    """Learn from the documents that ``labels`` (doc_id, quality 0 or 1) has and that ``may_learn`` (of doc_id) admits.

    The ``sample`` / 2 labelled ids of smallest hash of each label are looked up; a document labelled twice has the
    smaller label, of documents that share an id the text that sorts first is used, and texts of more than
    ``SAMPLE_BYTES`` are not. Labels other than 0 and 1 and null ids are passed over. With texts of one label only, or
    none, the model gives every text the share of label 1 among the labels.
    """
    told = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(may_learn).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("lines"))
    sides = [told.where(f"quality = {q}").orderBy(order, "doc_id").limit(sample // 2) for q in (0, 1)]
    few = F.broadcast(sides[0].unionAll(sides[1]).withColumnRenamed("doc_id", "id"))   # ``sample`` rows at most
    counts = dict(told.groupBy("quality").count().collect())
    known = np.array([counts.get(q, 0) for q in (0, 1)], np.int64)
    texts = documents.where(f"octet_length(text) <= {SAMPLE_BYTES}").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(few, F.col("doc_id") == F.col("id")).groupBy("doc_id").agg(
        F.first("quality").alias("quality"), F.min("text").alias("text")).select("doc_id", "quality", "text").mapInArrow(
        _features, "doc_id long, quality int, features binary, weights binary").toArrow().to_pandas().sort_values("doc_id")
    if found.empty:
        return Model(np.zeros((0, N_FEATURES)), np.zeros(0, int), np.zeros(0), np.zeros(0, int), known)
    features = np.frombuffer(b"".join(found.features), np.float32).reshape(-1, N_FEATURES).astype(np.float64)
    row = np.repeat(np.arange(len(found)), [len(w) // 8 for w in found.weights])
    weight = np.frombuffer(b"".join(found.weights), np.int64)
    return Model(features, row, weight, found.quality.to_numpy().astype(int), known, steps)


def score(documents: DataFrame, model: Model, lines: bool = False) -> DataFrame:
    """Quality of every whole text: doc_id, score (0 to 1), and with ``lines`` what was found of each line.

    ``documents`` has doc_id and text; other columns are ignored. ``lines`` holds first byte, byte after the
    last and the probability that the line is good, for lines with a visible character. Texts that are null,
    empty or without such a line get the share of label 1 among the labels. Every row, repeated or not, gives a row,
    whatever its doc_id, and equal texts have equal scores; an empty table gives an empty result. Rows are
    independent; memory is bounded by ``words.CHUNK_BYTES`` of text or the longest text.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    kinds = "doc_id long, score double" + ", lines array<struct<start: long, end: long, good: double>>" * lines

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in W.chunks(batch, "text"):
                found = lines_of(raw, offsets)
                good, value = sent.value.read(found, part.num_rows)
                columns = [part.column(0), pa.array(value)]
                if lines:
                    ends = np.searchsorted(found.row, np.arange(part.num_rows + 1)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                        [pa.array(found.start), pa.array(found.end), pa.array(good)], names=["start", "end", "good"])))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "lines"][:len(columns)])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text")).mapInArrow(run, kinds)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out (false for a null doc_id), score, predicted; learned outside the held-out fold."""
    found = score(documents, fit(documents, labels, fold() != 0))
    return found.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= CUT).cast("int").alias("predicted"))

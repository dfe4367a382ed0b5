"""Language of whole texts by a string kernel.

Two texts are as near as the sets of byte n-grams they hold (n = 1 to ``ORDERS``, blended):
k(x, y) = common n-grams / sqrt(n-grams of x * n-grams of y). Kernel ridge regression, one against
the rest, is fitted on a bounded sample through Nyström landmarks. As the kernel is a product of
presence vectors, landmarks and regression weights fold into one matrix, and a batch of texts is
scored by one product of its presence matrix with it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import words as W
from riskloom.llm.store import fresh

ORDERS = 3            # longest n-gram, in bytes
SLOTS = 1 << 16       # presence slots that n-grams are hashed to
ROWS = 64             # texts of one presence matrix
PART = 1 << 13        # slots whose weights are computed at once
SAMPLE = 1600         # labelled rows to learn from, all languages together
LANDMARKS = 256       # of these, landmarks
RIDGE = 1e-3
UNKNOWN = "und"
# A text is refused if its best language leads by less than MARGIN (of about 2) and its n-grams are less
# than FAMILIAR (about 1 for texts like the learned ones). Short texts show less: of CHECKED labelled texts of each
# language that are not learned from, the first LENGTHS bytes are looked at, and both cuts are lowered for texts of
# that length until all but REFUSED of these would pass. Texts of under SHORT bytes cannot be judged.
MARGIN, FAMILIAR, SHORT = 0.45, 0.85, 8
LENGTHS, CHECKED, REFUSED = (8, 12, 16, 24, 36, 54, 80, 120), 60, 0.01

# ASCII letters in lower case, bytes of other characters as they are, all else one space.
FOLD = np.where(((W.LOWER >= 97) & (W.LOWER <= 122)) | (W.BYTES >= 128), W.LOWER, 32).astype(np.uint8)


def _presence(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Presence of every slot in every row's text (bool)."""
    rows = len(offsets) - 1
    out = np.zeros(rows * SLOTS, bool)
    data = FOLD[raw].astype(np.uint32)
    size = np.diff(offsets)
    base = np.repeat(np.arange(rows, dtype=np.int64) * SLOTS, size)
    end = np.repeat(offsets[1:], size)
    code = np.zeros(len(data), np.uint32)
    for n in range(1, ORDERS + 1):
        m = len(data) - n + 1
        if m <= 0:
            break
        code = code[:m] * np.uint32(257) + data[n - 1:]
        slot = ((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(16)
        inside = np.arange(n, m + n) <= end[:m] if n > 1 else slice(None)
        out[(base[:m] + slot)[inside]] = True
    return out.reshape(rows, SLOTS)


def _rows(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for part, raw, offsets in W.chunks(batch, column, 1 << 20):
        for at in range(0, part.num_rows, ROWS):
            to = min(at + ROWS, part.num_rows)
            yield part.slice(at, to - at), _presence(
                raw[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])


def _packed(present: np.ndarray) -> bytes:
    """A row's presence as slot numbers or as a bitmap, whichever is shorter: a short text has few slots."""
    slots = np.flatnonzero(present).astype("<u2")
    return slots.tobytes() if slots.nbytes < SLOTS // 8 else np.packbits(present).tobytes()


class Packed:
    """Presence of every slot in rows that are held packed. Only the rows asked for are spread out, to ``SLOTS`` bytes each."""

    def __init__(self, rows: Sequence[bytes]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, at: slice | np.ndarray) -> np.ndarray:
        rows = self.rows[at] if isinstance(at, slice) else [self.rows[i] for i in at]
        out = np.zeros((len(rows), SLOTS), bool)
        for line, row in zip(out, rows):
            if len(row) == SLOTS // 8:
                line[:] = np.unpackbits(np.frombuffer(row, np.uint8))
            else:
                line[np.frombuffer(row, "<u2")] = True
        return out


def _sent(batches):
    for batch in batches:
        for part, present in _rows(batch):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pc.binary_length(part.column(2)).cast(pa.int64()),
                 pa.array([_packed(x) for x in present], pa.binary())],
                names=["lang", "rank", "size", "slots"])


class Classifier:
    """Folded weights: slots that count, their weight per language, and the languages in order.

    A last column is fitted to the constant 1: near 1 for texts like the learned ones, near 0 for others.
    """

    def __init__(self, present: np.ndarray | Packed, labels: list[str], landmarks: int, ridge: float):
        self.languages = sorted(set(labels))
        n = len(present)
        used = np.zeros(SLOTS, bool)
        for at in range(0, n, ROWS):
            used |= present[at:at + ROWS].any(axis=0)
        self.slots = np.flatnonzero(used)

        def rows(at):
            """Normed presence of some rows: as numbers, a row takes four times the bytes of its spread out presence."""
            block = present[at]
            size = np.sqrt(np.maximum(np.count_nonzero(block, axis=1), 1)).astype(np.float32)
            block = block[:, self.slots].astype(np.float32)
            block /= size[:, None]
            return block

        chosen = np.unique(np.linspace(0, n - 1, min(landmarks, n)).astype(int))
        z = np.empty((len(chosen), len(self.slots)), np.float32)
        for at in range(0, len(chosen), ROWS):
            z[at:at + ROWS] = rows(chosen[at:at + ROWS])
        # What is left over goes with the last block: a product with few rows is summed in another order.
        cuts = [*range(0, n - ROWS, ROWS)] or [0]
        if n - cuts[-1] > 2 * ROWS - 1:
            cuts.append(cuts[-1] + ROWS)
        cross = np.concatenate([rows(slice(a, b)) @ z.T for a, b in zip(cuts, [*cuts[1:], n])]).astype(np.float64)
        own = (z @ z.T).astype(np.float64)
        y = np.where(np.array(labels)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        y = np.hstack([y, np.ones((n, 1))])
        system = cross.T @ cross + ridge * n * own + 1e-8 * np.eye(len(own))
        shares = np.linalg.lstsq(system, cross.T @ y, rcond=None)[0]
        # The product takes its part of z as doubles.
        self.weights = np.concatenate([
            (z[:, at:at + PART].T @ shares).astype(np.float32) for at in range(0, len(self.slots), PART)] or [
            np.zeros((0, y.shape[1]), np.float32)])
        self.lengths, self.cuts = np.array([SHORT, SHORT + 1]), np.array([0.0, 1.0])

    def calibrate(self, lengths: np.ndarray, present: np.ndarray | Packed) -> None:
        """Lower the cuts for short texts, given labelled ones of known lengths. Without any, texts shorter than
        the longest of ``LENGTHS`` are all kept."""
        # A few rows at a time: spread out, a row takes ``SLOTS`` bytes, and four times as many to be scored.
        told = np.concatenate([np.zeros(0)] + [
            self.clearness(*self.scores(present[at:at + ROWS])) for at in range(0, len(present), ROWS)])
        least = [min(1.0, float(np.quantile(told[lengths == n], REFUSED, method="lower"))) if (lengths == n).any() else 0.0
                 for n in LENGTHS]
        # A longer text is never judged more mildly.
        self.lengths, self.cuts = np.array([*LENGTHS, 2 * LENGTHS[-1]]), np.maximum.accumulate([*least, 1.0])

    def clearness(self, scores: np.ndarray, familiar: np.ndarray) -> np.ndarray:
        """How far a text reaches the better of its two cuts; 1 is just enough for a long one."""
        second = np.sort(scores, axis=1)[:, -2] if scores.shape[1] > 1 else 0.0
        return np.maximum((scores.max(axis=1) - second) / MARGIN, familiar / FAMILIAR)

    def refuses(self, scores: np.ndarray, familiar: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Texts (of ``size`` bytes without white space around) that are in no learned language."""
        cut = np.interp(size, self.lengths, self.cuts)
        return (size >= SHORT) & (self.clearness(scores, familiar) < cut)

    def scores(self, present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw value of every language, and how familiar the text is."""
        size = np.sqrt(np.maximum(np.count_nonzero(present, axis=1), 1)).astype(np.float32)
        raw = (present[:, self.slots].astype(np.float32) @ self.weights) / size[:, None]
        return raw[:, :-1], raw[:, -1]


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS,
        ridge: float = RIDGE, checked: int = 0) -> Classifier | None:
    """Learn from ``labelled`` (doc_id, text, lang): the rows of smallest hash of every language,
    ``sample`` rows in all. Rows without a language or a letter are not used; None if none is left. The
    ``checked`` next rows of every language (a tenth of its rows at most) set the cuts by which short texts are refused.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = dict(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample + 1).toArrow()
                  .to_pandas().itertuples(index=False))
    if len(counts) > sample:
        raise ValueError("more languages than sampled rows")
    if not counts:
        return None
    each = sample // len(counts)
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4.0 * each / n))])
    learn = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(each, n - min(checked, n // 10)))])[F.col("lang")]
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    near = rows.withColumn("order", order).where(
        F.pmod("order", F.lit(1 << 20)) < shares[F.col("lang")] * (1 << 20)).where(has_letter())
    ranked = near.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy("order", "doc_id", "text"))).where(F.col("rank") <= learn + checked)
    heads = F.array(*[F.substring("text", 1, n) for n in LENGTHS])
    # Heads of the checked rows have a rank below 0; a language of few rows is checked by some that it also learns.
    whole = F.when(F.col("rank") <= each, F.array(F.struct("rank", "text"))).otherwise(F.array().cast("array<struct<rank: int, text: string>>"))
    parts = F.when(F.col("rank") > learn, F.transform(heads, lambda h: F.struct((-F.col("rank")).alias("rank"), h.alias("text"))))
    sent = ranked.select("lang", F.inline(F.concat(whole, F.coalesce(parts, F.array().cast("array<struct<rank: int, text: string>>")))))
    found = sent.mapInArrow(
        _sent, "lang string, rank int, size long, slots binary").toArrow().to_pandas()
    if found.empty:
        return None
    present = lambda rows: Packed(rows.slots.tolist())
    texts = found[found["rank"] > 0].sort_values(["rank", "lang"], kind="stable")
    model = Classifier(present(texts), texts.lang.tolist(), landmarks, ridge)
    if checked:
        heads = found[found["rank"] < 0]
        met = set(zip(heads.lang, -heads["rank"]))
        others = texts[[k not in met for k in zip(texts.lang, texts["rank"])]]
        judge = model if len(others) == len(texts) else Classifier(present(others), others.lang.tolist(), landmarks, ridge)
        # Characters may have several bytes: a head counts for the largest of LENGTHS that it reaches.
        reach = np.searchsorted(LENGTHS, heads["size"].to_numpy(), side="right") - 1
        judge.calibrate(np.where(reach < 0, 0, np.array(LENGTHS)[reach]), present(heads))
        model.lengths, model.cuts = judge.lengths, judge.cuts
    return model


def annotate(documents: DataFrame, classifier: Classifier | None, lang: str, score: str,
             keep: list[str] | None = None, refused: str | None = None) -> DataFrame:
    """``documents`` (or its columns ``keep``) with the predicted language and its score, 0 to 1.

    With ``refused`` a boolean column of that name says that the text is in no learned language: it is
    ``und``, or neither its language is clear nor its n-grams are familiar. The score cannot tell, as
    the values of all machines have a fixed sum on familiar texts.

    Only the text is looked at. A text that is null or has no letter is ``und`` with score 0, and so
    is every text if nothing could be learned. Of equal scores the first language in order wins.
    Every row stays, repeated or not; an empty table gives an empty result.
    """
    sent = documents.sparkSession.sparkContext.broadcast(classifier)
    keep = documents.columns if keep is None else keep
    known, size = (fresh(keep, n) for n in ("known", "size"))
    own = "text" if "text" in keep else fresh(keep, "text")

    def run(batches):
        model = sent.value
        for batch in batches:
            for part, present in _rows(batch, own):
                letter = part.column(len(keep)).to_numpy(zero_copy_only=False)
                if model is None:
                    best, name = np.zeros(part.num_rows), np.full(part.num_rows, UNKNOWN, object)
                    alien = np.ones(part.num_rows, bool)
                else:
                    scores, familiar = model.scores(present)
                    top = scores.argmax(axis=1)
                    best = np.clip((scores[np.arange(len(top)), top].astype(np.float64) + 1) / 2, 0, 1)
                    alien = ~letter | model.refuses(scores, familiar, part.column(len(keep) + 1).to_numpy())
                    best, name = np.where(letter, best, 0.0), np.array(model.languages, object)[top]
                    name = np.where(letter, name, UNKNOWN)
                columns = [*part.columns[:len(keep)], pa.array(name, pa.string()), pa.array(best)]
                columns += [pa.array(alien, pa.bool_())] if refused else []
                yield pa.RecordBatch.from_arrays(columns, names=kinds.names)

    # The text is sent once, under its own name where it is kept.
    rows = documents.select(*keep, has_letter().alias(known),
                            F.coalesce(F.octet_length(F.trim("text")), F.lit(0)).alias(size),
                            *([] if own in keep else [F.col("text").alias(own)]))
    kinds = documents.select(*keep).schema.add(lang, "string").add(score, "double")
    if refused:
        kinds = kinds.add(refused, "boolean")
    return rows.mapInArrow(run, kinds)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text modulo 5; 0 is held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5))


def identify(documents: DataFrame) -> DataFrame:
    """Predictions for all ``documents``, learned from those outside the held-out fold.

    doc_id, held_out (false for a null doc_id), lang_pred, score.
    """
    model = fit(documents.select("doc_id", "text", "lang").where(fold() != 0))
    found = annotate(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model,
                     "lang_pred", "score", keep=["doc_id"])
    return found.select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")

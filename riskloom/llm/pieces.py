"""SentencePiece encoding and decoding with shared prefixes.

The distinct marked words of a batch are sorted, which lines them up as a depth-first walk over
their trie: a word takes over the forward states of the prefix it shares with the one before and
computes only the rest. For a unigram model the forward state of a prefix is the best score of its
segmentations. For a BPE model scores only order the merges, so the best sum is not what the model
means; there every prefix has exactly one segmentation that merging leaves alone, and its last
piece is the one that merging keeps apart from the last piece of what stands before it. Both are
the same walk with another step, and both give what the SentencePiece library gives.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from riskloom.llm.store import fresh

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_BYTES = 64 << 20    # largest model file that is sent to the executors
KNOWN_WORDS = 150_000     # words whose pieces a task keeps between batches
KNOWN_PAIRS = 300_000     # pairs of pieces whose verdict a task keeps, some 50 MB
KNOWN_ENDINGS = 100_000   # endings of words whose pieces a task keeps
REACH = 4                 # characters of an ending
LONG = 64                 # words of more characters keep back pointers instead of ids
TEXT_PIECES = 3 << 20     # characters of text encoded at once, or one document

# Fixed values of the model file format: field numbers and piece types.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of one message in wire format."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at:at + size]
            at += size


class Model:
    """Pieces, scores and rules of a model file."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.types = [], [], []
        self.kind, self.prefix, self.squeeze, self.normal = UNIGRAM, True, True, b""
        for field, value in _fields(data):
            if field == PIECES:
                piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0])
                self.types.append(piece[3])
            elif field == TRAINER:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == NORMALIZER:
                rule = dict(_fields(value))
                self.prefix, self.squeeze = bool(rule.get(3, 1)), bool(rule.get(4, 1))
                self.normal = rule.get(2, b"")
        if self.kind not in (UNIGRAM, BPE) or self.normal:
            raise ValueError("only unigram and BPE models without character rewriting are read")
        usable = [i for i, t in enumerate(self.types) if t in (NORMAL, USER_DEFINED)]
        self.ids = {self.pieces[i]: i for i in usable}
        self.score = {self.pieces[i]: self.scores[i] for i in usable}
        self.longest = max(map(len, self.ids), default=1)
        self.byte = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        self.unknown = self.types.index(UNKNOWN) if UNKNOWN in self.types else 0
        self.penalty = min(self.score.values(), default=0.0) - 10.0
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces that reach over a word's start are not supported")
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        self.alone = {c for c in map(chr, range(33)) if c not in joined}
        single = re.escape("".join(sorted(self.alone)))
        self.unit = re.compile(f"[{single}]|{MARK}*[^{MARK}{single}]+|{MARK}+")
        self.bytes = [self._bytes(i) for i in range(len(self.pieces))]

    def _bytes(self, i: int) -> bytes:
        if self.types[i] == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if self.types[i] in (CONTROL, UNUSED):
            return b""
        return self.pieces[i].replace(MARK, " ").encode() if i != self.unknown else " ⁇ ".encode()

    def codes(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        if self.byte:
            return [self.byte[b] for b in piece.encode()]
        return [self.unknown]

    def merged(self, text: str) -> list[str]:
        """Merge by score, the left one first among equals, until nothing merges."""
        if len(text) > LONG:
            return self._merged_long(text)
        parts, find, none = list(text), self.score.get, -math.inf
        scores = [find(x + y, none) for x, y in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == none:
                break
            k = scores.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k < len(scores):
                scores[k] = find(parts[k] + parts[k + 1], none)
            if k:
                scores[k - 1] = find(parts[k - 1] + parts[k], none)
        return parts

    def _merged_long(self, text: str) -> list[str]:
        """The same with a heap over linked parts, in time near the length."""
        n, find = len(text), self.score.get
        parts: list[str | None] = list(text)
        behind, ahead = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(-s, k, x + y) for k, (x, y) in enumerate(zip(text, text[1:])) if (s := find(x + y)) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, whole = heapq.heappop(heap)
            to = ahead[k] if parts[k] is not None else n
            if to >= n or len(parts[k]) + len(parts[to]) != len(whole) or parts[k] + parts[to] != whole:
                continue                      # one of the two has been merged since
            parts[k], parts[to], ahead[k] = whole, None, ahead[to]
            if ahead[k] < n:
                behind[ahead[k]] = k
            for i in (behind[k], k):
                if i >= 0 and ahead[i] < n and (s := find(parts[i] + parts[ahead[i]])) is not None:
                    heapq.heappush(heap, (-s, i, parts[i] + parts[ahead[i]]))
        return [p for p in parts if p is not None]


class Endings(dict):
    """Lengths of the pieces that a text can end with, longest first, by its last ``REACH`` characters (or all, if
    fewer). Lengths up to ``REACH`` are sure; longer pieces are to be looked up. Filled as asked, up to a bound."""

    def __init__(self, pieces):
        super().__init__()
        self.pieces, self.longer = pieces, {}
        for p in pieces:
            if len(p) > REACH:
                self.longer.setdefault(p[-REACH:], set()).add(len(p))

    def __missing__(self, end: str) -> tuple[int, ...]:
        if len(self) >= KNOWN_ENDINGS:
            self.clear()
        sure = (n for n in range(len(end), 1, -1) if end[-n:] in self.pieces)
        found = self[end] = (*sorted(self.longer.get(end, ()), reverse=True), *sure, 1)
        return found


class Encoder:
    """Forward states over sorted words; what is kept between words has a fixed bound.

    The state of a prefix is its last piece and what reads its ids: for words of up to ``LONG`` characters
    the packed ids themselves, for longer ones (where these would take quadratic space) where the last piece starts.
    """

    def __init__(self, model: Model):
        self.model = model
        whole = [p for p in model.ids if model.merged(p) == [p]] if model.kind == BPE else model.ids
        self.packed = {p: struct.pack("<i", model.ids[p]) for p in whole}
        self.sizes = Endings(self.packed)
        self.forget()

    def forget(self) -> None:
        """Let go all that was met in texts; what is left is the model's, and was there before."""
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._near: dict[str, dict[str, bool]] = {}
        self._n_near = 0
        self.sizes.clear()

    def _verdicts(self, left: str) -> dict[str, bool]:
        """What is known of the pieces behind ``left``."""
        found = self._near.get(left)
        if found is None:
            found = self._near[left] = {}
        return found

    def _apart(self, left: str, known: dict[str, bool], right: str) -> bool:
        """Whether merging leaves the two pieces as they are; kept in ``known``."""
        if self._n_near >= KNOWN_PAIRS:
            for verdicts in self._near.values():
                verdicts.clear()
            self._n_near = 0
        self._n_near += 1
        found = known[right] = self.model.merged(left + right) == [left, right]
        return found

    def _code(self, piece: str) -> bytes:
        """Packed ids; a character without a piece of its own is spelt in bytes."""
        found = self.packed.get(piece)
        return np.array(self.model.codes(piece), np.int32).tobytes() if found is None else found

    def learn(self, words: set[str]) -> None:
        """Pieces of all the words."""
        walk = self._walk_bpe if self.model.kind == BPE else self._walk_unigram
        spaces = [w for w in words if w.startswith(MARK * 2)] if self.model.kind == BPE else []
        for word in spaces:
            # Runs of spaces merge with equal scores, where the order of merging decides.
            self.known[word] = b"".join(map(self._code, self.model.merged(word)))
        for some, long in (([w for w in words if len(w) <= LONG], False), ([w for w in words if len(w) > LONG], True)):
            walk(sorted(set(some).difference(spaces)), long)

    def _read_back(self, last: list, start: list, at: int) -> bytes:
        found = []
        while at > 0:
            found.append(self._code(last[at]))
            at = start[at]
        return b"".join(reversed(found))

    def _walk_bpe(self, words: list[str], long: bool) -> None:
        """The last piece of a prefix is the longest that merging keeps apart from the last before it."""
        packed, sizes, known, near = self.packed, self.sizes, self.known, self._near
        before, last, state, after = "", [None], [0 if long else b""], [None]
        for word in words:
            shared = _shared(before, word)
            del last[shared + 1:], state[shared + 1:], after[shared + 1:]
            before = word
            for to in range(shared + 1, len(word) + 1):
                for size in sizes[word[to - REACH:to] if to > REACH else word[:to]]:
                    at = to - size
                    if at > 0:
                        piece = word[at:to]
                        if size > REACH and piece not in packed:
                            continue
                        # Whether merging leaves it and the piece before as they are.
                        apart = after[at].get(piece)
                        if apart is None:
                            apart = self._apart(last[at], after[at], piece)
                        if apart:
                            break
                    elif at == 0:
                        piece = word[:to]
                        if size <= REACH or piece in packed:
                            break
                last.append(piece)
                after.append(near.get(piece) or self._verdicts(piece))
                state.append(at if long else state[at] + (packed.get(piece) or self._code(piece)))
            known[word] = self._read_back(last, state, len(word)) if long else state[-1]

    def _walk_unigram(self, words: list[str], long: bool) -> None:
        """The best sum of scores of a prefix's segmentations."""
        before, last, state, total = "", [None], [0 if long else b""], [0.0]
        for word in words:
            shared = _shared(before, word)
            del last[shared + 1:], state[shared + 1:], total[shared + 1:]
            before = word
            for to in range(shared + 1, len(word) + 1):
                best = None
                for size in range(1, min(self.model.longest, to) + 1):
                    piece = word[to - size:to]
                    score = self.model.score.get(piece, self.model.penalty if size == 1 else None)
                    if score is not None and (best is None or score + total[to - size] > best[1]):
                        best = piece, score + total[to - size], to - size
                piece, score, at = best
                last.append(piece)
                total.append(score)
                state.append(at if long else state[at] + self._code(piece))
            self.known[word] = self._read_back(last, state, len(word)) if long else state[-1]

    def units(self, text: str) -> list[str]:
        if self.model.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return []
        return self.model.unit.findall((MARK if self.model.prefix else "") + text.replace(" ", MARK))

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        split = [None if t is None else self.units(t) for t in texts]
        if len(self.known) >= KNOWN_WORDS:  # words that were not met since the last turn go
            self.known, self.older = {}, self.known
        new = {u for units in split if units for u in units}.difference(self.known)
        kept = {u: self.older[u] for u in new.intersection(self.older)}
        self.known |= kept
        self.learn(new.difference(kept))
        known = self.known.__getitem__
        return [None if units is None else b"".join(map(known, units)) for units in split]


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


_ENCODERS: dict[bytes, Encoder] = {}


def _encoder(data: bytes) -> Encoder:
    """The worker's encoder of a model. What it knows of the model serves the next task too; words are a task's own."""
    key = hashlib.sha256(data).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Model(data))
    _ENCODERS[key].forget()
    return _ENCODERS[key]


def decoded(model: Model, ids: np.ndarray) -> str:
    """Text of a sequence of ids; ids outside the vocabulary are passed over."""
    table = model.bytes
    ids = ids[(ids >= 0) & (ids < len(table))]
    text = b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if model.prefix and text.startswith(" ") else text


def _load(df: DataFrame, path: str):
    with open(path, "rb") as file:
        data = file.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError("the model file is larger than MODEL_BYTES")
    return df.sparkSession.sparkContext.broadcast(data)


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    at, where = 0, batch.schema.get_field_index(column)
    texts = batch.column(where).to_pylist()
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held < TEXT_PIECES):
            held += len(texts[to] or "")
            to += 1
        yield batch.slice(at, to - at), texts[at:to]
        at = to


def encode(df: DataFrame, column: str = "text", ids: str = "ids", model: str = MODEL,
           round_trip: str | None = None) -> DataFrame:
    """``df`` with the piece ids of ``column`` (array<int>) under the name ``ids``.

    A null text gives null, an empty one an empty array. With ``round_trip`` a boolean column of
    that name says whether decoding gives the text back; it is true for a null text, and the mark
    U+2581 counts as the space it is read as. All other columns stay; a column that already has one
    of the new names is replaced. An empty table gives an empty table.
    """
    sent = _load(df, model)
    new = [ids] + ([round_trip] if round_trip else [])
    old = [c for c in df.columns if c not in new]
    # The text travels under a name of its own in case ``column`` itself is replaced.
    source = fresh(df.columns, "source")
    rows = df.select(*old, df[column].alias(source))
    kinds = StructType([*df.select(*old).schema, StructField(ids, ArrayType(IntegerType()))])
    if round_trip:
        kinds = kinds.add(round_trip, "boolean")

    def run(batches):
        encoder = _encoder(sent.value)
        m = encoder.model
        for batch in batches:
            for part, texts in _slices(batch, source):
                packed = encoder.encode(texts)
                flat = np.frombuffer(b"".join(p for p in packed if p), np.int32)
                sizes = np.array([len(p) // 4 if p else 0 for p in packed], np.int64)
                ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
                missing = pa.array([p is None for p in packed] + [False])
                offsets = pa.array(ends, mask=missing.to_numpy(zero_copy_only=False))
                columns = [*part.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))]
                if round_trip:
                    columns.append(pa.array([
                        t is None or decoded(m, flat[a:b]) == t.replace(MARK, " ")
                        for t, a, b in zip(texts, ends, ends[1:])], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[*old, *new])
        encoder.forget()
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, kinds)


def decode(df: DataFrame, ids: str = "ids", text: str = "text", model: str = MODEL) -> DataFrame:
    """``df`` with the text of the piece ids in ``ids`` under the name ``text``; null stays null."""
    sent = _load(df, model)
    old = [c for c in df.columns if c != text]
    source = fresh(df.columns, "source")
    rows = df.select(*old, df[ids].alias(source))

    def run(batches):
        m = Model(sent.value)
        for batch in batches:
            texts = [None if x is None else decoded(m, np.array([i for i in x if i is not None], np.int64))
                     for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], names=[*old, text])

    return rows.mapInArrow(run, StructType([*df.select(*old).schema, StructField(text, StringType())]))

"""Words of a text column as numpy arrays: one pass over an Arrow buffer, no Python per word.

A word is a maximal run of word bytes; its code is a 64-bit hash of its (lower-cased) bytes. All
sizes are bounded by ``CHUNK_BYTES`` of text or one document, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

BYTES = np.arange(256)
AS_IS = BYTES.astype(np.uint8)
LOWER = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype(np.uint8)
#: Everything but the space and the controls from tab to carriage return.
NOT_SPACE = ~((BYTES == 32) | ((BYTES >= 9) & (BYTES <= 13)))
#: Digits, lower-case letters and every byte of a character beyond ASCII.
LETTER_DIGIT = ((BYTES >= 48) & (BYTES <= 57)) | ((BYTES >= 97) & (BYTES <= 122)) | (BYTES >= 128)


class Words(NamedTuple):
    code: np.ndarray    # uint64, hash of the word
    row: np.ndarray     # int64, row of the word
    start: np.ndarray   # int64, first byte within the row's text
    end: np.ndarray     # int64, byte after the last
    count: np.ndarray   # int64, words of each row
    first: np.ndarray   # int64, index of each row's first word


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def chunks(batch: pa.RecordBatch, column: str,
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the text bytes (uint8) and row offsets (int64) of each slice.

    A null text counts as an empty one.
    """
    text = batch.column(batch.schema.get_field_index(column))
    text = pc.fill_null(text.cast(pa.large_binary()), b"")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(text):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(text))
        yield (batch.slice(at, to - at), raw[offsets[at]:offsets[to]],
               offsets[at:to + 1] - offsets[at])
        at = to


def words(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray,
          fold: np.ndarray = LOWER) -> Words:
    """Words of the rows whose bytes are ``raw[offsets[r]:offsets[r + 1]]``."""
    rows = len(offsets) - 1
    data = fold[raw]
    inside = is_word[data]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[edge] = False
    if len(edge):
        after[np.append(edge[1:], len(inside)) - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    size = end - start
    row = np.searchsorted(offsets, start, side="right") - 1
    count = np.bincount(row, minlength=rows)
    if len(start):
        power = np.cumprod(np.full(int(size.max()), _BASE))
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        value = (data[inside].astype(np.uint64) + np.uint64(1)) * power[place]
        code = mix(np.add.reduceat(value, np.cumsum(size) - size))
    else:
        code = np.zeros(0, np.uint64)
    base = offsets[row] if len(row) else np.zeros(0, np.int64)
    return Words(code, row, start - base, end - base, count, np.cumsum(count) - count)


def runs(code: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` consecutive codes from each place (the last places are cut off)."""
    n = max(len(code) - length + 1, 0)
    out = np.full(n, np.uint64(length))
    for k in range(length):
        out = mix(out * _BASE + code[k:k + n])
    return out


def shingles(found: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``length`` words; a shorter text that has words gives one run."""
    full = runs(found.code, length)
    same = found.row[:len(full)] == found.row[length - 1:] if len(full) else np.zeros(0, bool)
    code, row = [full[same]], [found.row[:len(full)][same]]
    short = np.flatnonzero((found.count > 0) & (found.count < length))
    if len(short):
        whole = np.array([whole_run(found.code[f:f + c]) for f, c in
                          zip(found.first[short], found.count[short])], np.uint64)
        code.append(whole)
        row.append(short)
        code, row = np.concatenate(code), np.concatenate(row)
        order = np.argsort(row, kind="stable")
        return code[order], row[order]
    return code[0], row[0]


def whole_run(code: np.ndarray) -> np.uint64:
    return runs(code, len(code))[0]

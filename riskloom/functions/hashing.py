"""Reproducible randomness: every draw is a function of a seed and the row id.

The same row gets the same number whatever the partitioning, after a lost executor, and in any
engine that has MD5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = float(2**32)


def hash_key(seed: int | str, *parts: Column | str) -> Column:
    """Hex MD5 of ``seed:part:part``; its text order is a random order of the ids."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def uniform_from_key(key: Column, slot: int | Column = 0) -> Column:
    """Uniform number in [0, 1) from one of the four 32-bit words of an MD5 hex text."""
    start = slot * 8 + 1 if isinstance(slot, Column) else F.lit(slot * 8 + 1)
    word = F.substr(key, start, F.lit(8))
    return F.conv(word, 16, 10).cast("double") / F.lit(UNIT)


def hash_uniform(seed: int | str, *parts: Column | str) -> Column:
    return uniform_from_key(hash_key(seed, *parts))


# P(X <= k) for X ~ Poisson(1), k = 0, 1, ... (inverse-CDF steps).
def _poisson_steps(count: int = 12) -> list[float]:
    steps, term, total = [], 0.36787944117144233, 0.0
    for k in range(count):
        total += term
        steps.append(total)
        term /= k + 1
    return steps


POISSON_STEPS = _poisson_steps()


def poisson_one(u: Column) -> Column:
    """Poisson(1) draw by inverse CDF; the draw is the number of steps at or below ``u``."""
    weight = F.lit(len(POISSON_STEPS))
    for k in reversed(range(len(POISSON_STEPS))):
        weight = F.when(u < F.lit(POISSON_STEPS[k]), F.lit(k)).otherwise(weight)
    return weight

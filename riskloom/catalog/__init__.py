"""Registered queries: every operator on the given tables, with the same question in SQL."""

from __future__ import annotations

from riskloom.catalog.registry import ORACLE, QUERIES
from riskloom.catalog import (  # noqa: F401
    columns, comparisons, describing, evaluation, explaining, modelling, ordering, storing, testing,
)

__all__ = ["ORACLE", "QUERIES"]

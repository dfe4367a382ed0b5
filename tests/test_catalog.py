"""Every registered query runs on the smallest tables and equals its SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import KINDS, rows_of

SF = "/root/testdata/sf0.001"
SLOW = ("m0", "m15", "x0", "s07")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF)):
        connection.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    answer = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(columns)
    types = {c[0]: KINDS.get(str(c[1]), str(c[1])) for c in answer.description}
    got = [tuple(r) for r in df.collect()]
    assert rows_of(df.columns, got) == rows_of(columns, answer.fetchall())
    assert dict(df.dtypes) == types


@pytest.mark.parametrize(
    "name", sorted(q for q in set(entry.queries()) - set(entry.oracle_sql())
                   if not q.startswith(SLOW)))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 9

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from riskloom.llm import periodic
from riskloom.llm.queries import QUERIES, every_tenth_repeats

SCHEMA = "doc_id long, text string"


def brute_runs(w):
    """(start, end, period) of all runs, by comparing every word with the one q words on."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, q, b) for (a, b), q in found.items())


def brute_collapsed(w, runs):
    gone = {i for a, q, b in runs for i in range(a + q, b)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def found_runs(texts):
    code = np.concatenate([np.asarray(t, np.uint64) for t in texts])
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    which, start, end, period = periodic.find(code, row, len(texts))
    return [[(int(a), int(q), int(b)) for a, q, b in zip(start[which == k], period[which == k], end[which == k])]
            for k in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.lists(st.integers(0, 1), max_size=60),
    st.builds(lambda p, u, t, s: p + u * t + s, st.lists(st.integers(0, 3), max_size=8),
              st.lists(st.integers(0, 2), min_size=1, max_size=15), st.integers(3, 9), st.lists(st.integers(0, 3), max_size=8)),
    st.builds(lambda a, b, t: (a * 5 + b) * t, st.lists(st.integers(0, 1), min_size=1, max_size=3),
              st.lists(st.integers(0, 2), max_size=4), st.integers(4, 6))), min_size=1, max_size=5))
def test_runs_of_texts_with_many_repetitions(texts):
    if any(texts):
        assert found_runs(texts) == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("n", [5, 6, 7, 1000, 100_000])
def test_one_word_repeated(n):
    assert found_runs([[7] * n]) == [[(0, 1, n)] if n >= 6 else []]


def test_a_run_within_a_run_and_neighbours_of_equal_text():
    inner = [1, 1, 1, 1, 1, 1, 2]
    text = inner * 5
    assert found_runs([text, text, [2] * 3, [2] * 3]) == [brute_runs(text)] * 2 + [[], []]
    assert len(brute_runs(text)) == 6


def test_grammar_gives_the_text_back():
    ids = np.random.default_rng(3).integers(0, 4, 500)
    g = periodic.grammar(ids)
    rest = np.diff(np.append(g.rest, len(ids)))
    assert g.rest[0] == 0 and rest.sum() == len(ids)
    for s in np.unique(g.symbol):
        places, width = g.start[g.symbol == s], g.width[g.symbol == s]
        assert len(set(width.tolist())) == 1
        assert len({tuple(ids[p:p + width[0]]) for p in places}) == 1


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a a"), (4, "a a a a a a"), (None, "x y " * 4),
            (5, "a b " * 6), (6, "A a " * 3)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("runs", F.lit(1)).withColumn("key", F.lit("k"))
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in
                  periodic.periodic_runs(docs).collect()), key=repr)
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"),
        (None, 8, [(0, 8, 2)], "x y"), (5, 6, [(0, 6, 1)], "a b"), (6, 6, [], "A a A a A a")], key=repr)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    words = [f"w{i}" for i in range(300_000)] + [f"v{i}" for i in range(50_000)] * 4
    row = periodic.periodic_runs(spark.createDataFrame([(1, " ".join(words))], SCHEMA)).first()
    assert [tuple(r) for r in row.runs] == [(300_000, 200_000, 50_000)]
    assert row.collapsed == " ".join(words[:350_000])


def test_query_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(map(str, rng.integers(0, 2 + i % 40, int(rng.integers(0, 80)))))) for i in range(300)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == 300
    changed = 0
    for doc_id, text in rows:
        w = text.split()
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            a, p = h // 10 % len(w), 0
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
            changed += 1
        runs, r = brute_runs(w), got[doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b - a},{q}\n" for a, q, b in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()
        if runs:
            a, q, b = min(runs, key=lambda x: (x[0] - x[2], x[0], x[1]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (a, b - a, q, 1000 * (b - a) // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert changed > 10
    assert every_tenth_repeats(np.array([10]), np.array([0]))[0].tolist() == [0]

import itertools
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F
from riskloom.llm import line_quality as Q
from riskloom.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def brute_marginals(potential, row, move):
    """By summing over all labellings of every text."""
    good, pairs = np.zeros(len(row)), np.zeros((4, len(row)))
    for r in np.unique(row):
        at = np.flatnonzero(row == r)
        total = 0.0
        for ys in itertools.product((0, 1), repeat=len(at)):
            p = np.exp(sum(potential[i] * y for i, y in zip(at, ys)) + sum(move[a, b] for a, b in zip(ys, ys[1:])))
            total += p
            for k, (i, y) in enumerate(zip(at, ys)):
                good[i] += p * y
                if k:
                    pairs[2 * ys[k - 1] + y, i] += p
        good[at] /= total
        pairs[:, at] /= total
    return good, pairs


def test_messages_equal_the_sum_over_all_labellings():
    rng = np.random.default_rng(2)
    for _ in range(20):
        row = np.repeat(np.arange(5), rng.integers(1, 8, 5))
        potential, move = rng.normal(0, 2, len(row)), rng.normal(0, 1.5, (2, 2))
        good, pairs = Q.forward_backward(potential, row, move)
        want = brute_marginals(potential, row, move)
        assert np.allclose(good, want[0]) and np.allclose(pairs, want[1])


def test_a_long_chain_is_stable():
    good, pairs = Q.forward_backward(np.full(50_000, 40.0), np.zeros(50_000, int), np.array([[9.0, -9], [-9, 9]]))
    assert np.isfinite(good).all() and good.min() > 0.99 and np.isfinite(pairs).all()


def test_the_slope_of_the_likelihood():
    """Observed less expected counts are the derivative of the log-likelihood."""
    row, own = np.array([0, 0, 0, 1, 1]), np.array([1, 0, 1, 1, 1])
    potential, move = np.array([0.3, -1, 2, 0.1, -0.4]), np.array([[0.2, -0.5], [0.1, 0.7]])

    def likelihood(u, t):
        out = 0.0
        for r in (0, 1):
            at = np.flatnonzero(row == r)
            say = lambda ys: sum(u[i] * y for i, y in zip(at, ys)) + sum(t[a, b] for a, b in zip(ys, ys[1:]))  # noqa: E731, B023
            out += say(own[at]) - np.log(sum(np.exp(say(y)) for y in itertools.product((0, 1), repeat=len(at))))
        return out

    good, pairs = Q.forward_backward(potential, row, move)
    for i in range(5):
        e = np.eye(5)[i] * 1e-6
        assert np.isclose((likelihood(potential + e, move) - likelihood(potential - e, move)) / 2e-6, own[i] - good[i], atol=1e-5)
    seen = np.zeros(4)
    for i in (1, 2, 4):
        seen[2 * own[i - 1] + own[i]] += 1
    for k in range(4):
        e = (np.eye(4)[k] * 1e-6).reshape(2, 2)
        slope = (likelihood(potential, move + e) - likelihood(potential, move - e)) / 2e-6
        assert np.isclose(slope, seen[k] - pairs[k].sum(), atol=1e-5)


def batch(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(t) for t in raw])).astype(np.int64)


def test_lines_and_what_they_look_like():
    found = Q.lines_of(*batch(["ab cd.\n\n  \nAB 1$$", "", "\n", "ab cd.\nab cd."]))
    assert found.row.tolist() == [0, 0, 3, 3]
    assert found.start.tolist() == [0, 11, 0, 7] and found.end.tolist() == [7, 17, 7, 13]
    assert found.weight.tolist() == [5, 5, 5, 5]
    repeated, symbols = found.features[:, 21], found.features[:, 5]
    assert repeated.tolist() == [0, 0, 1, 1]
    assert np.allclose(symbols, [0, 0.4, 0, 0])
    assert found.features.shape[1] == Q.N_FEATURES


def test_features_do_not_depend_on_the_block():
    texts = ["a b c\nD E F!!\nx $$ y", "one\n\ntwo two two", "z", "é ü\nß"]
    together = Q.lines_of(*batch(texts))
    for k, t in enumerate(texts):
        assert np.array_equal(Q.lines_of(*batch([t])).features, together.features[together.row == k])


def planted(spark, n=400, seed=0):
    """Good texts of words; bad ones with some or all lines of symbols. With labels of most."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 8)))
    line = lambda bad: " ".join(word() + ("$$%" if bad else "") for _ in range(rng.integers(3, 12)))
    rows, labels = [], []
    for i in range(n):
        good, size = bool(rng.random() < 0.7), int(rng.integers(1, 9))
        bads = [False] * size if good else [k >= rng.integers(0, size) for k in range(size - 1)] + [True]
        rows.append((i, "\n".join(line(b) for b in bads)))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_held_out_texts(spark):
    docs, labels, told = planted(spark)
    got = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i in got)
    right = [got[i].predicted == told[i][1] for i in held]
    assert len(held) > 50 and np.mean(right) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_lines_of_mixed_texts_are_told_apart(spark):
    docs, labels, _ = planted(spark)
    model = Q.fit(docs, labels, F.lit(True))
    text = "abc de fgh ab cd\nfed hgba abcd eh\nab$$% cd$$% ef$$% gh$$%\nfe$$% abd$$% cfe$$%"
    row = Q.score(spark.createDataFrame([(1, text)], DOCS), model, lines=True).first()
    assert [x.good > 0.5 for x in row.lines] == [True, True, False, False]
    assert [text.encode()[x.start:x.end].strip() for x in row.lines] == text.encode().split(b"\n")


def test_held_out_labels_do_not_matter(spark):
    docs, labels, told = planted(spark, 200)
    other = spark.createDataFrame(
        [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in told], labels.schema)
    same = [sorted(map(tuple, Q.classify(docs, x).collect())) for x in (labels, other)]
    assert same[0] == same[1]


def test_edge_rows(spark):
    docs, labels, _ = planted(spark, 200)
    odd = spark.createDataFrame(
        [(None, "abc def"), (1000, None), (1001, ""), (1002, " \n\n"), (1003, "ab " * 200_000 + "\n" + "x\n" * 50_000),
         (1, "abc def"), (1, "abc def")], DOCS)
    table = docs.unionByName(odd).withColumn("score", F.lit("x")).withColumn("quality", F.lit("y")).withColumn("id", F.lit(0))
    more = labels.unionByName(spark.createDataFrame(
        [(None, 1, 0), (3, None, 0), (4, 7, 0), (1001, 0, 0), (5, 0, 0), (99999, 1, 0)], labels.schema))
    got = Q.classify(table, more).collect()
    assert len(got) == 207
    assert all(r.score is not None and 0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert len({r.score for r in got if r.doc_id in (1000, 1001, 1002)}) == 1
    assert Q.classify(docs.limit(0), labels).count() == 0
    none = Q.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert {round(r.score, 3) for r in Q.classify(docs, labels.where("quality = 1")).collect()} <= {
        round(x / 1000, 3) for x in range(980, 1000)}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_on_given_tables(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op11_line_quality"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.97

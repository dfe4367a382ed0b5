"""What the text operators hold at once: memory of the driver, files of finished steps."""

from __future__ import annotations

import tracemalloc

import numpy as np

from riskloom.llm import components, language, near_dedup, repeats
from riskloom.llm.store import Scratch


def test_language_fit_never_holds_all_rows_as_numbers():
    rng = np.random.default_rng(0)
    present = rng.random((640, language.SLOTS)) < 0.02
    tracemalloc.start()
    language.Classifier(present, [f"l{i % 4}" for i in range(640)], 32, 1e-3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * present.nbytes


def test_finished_steps_go_before_passages_are_written(spark, monkeypatch):
    calls = []
    for name in ("save", "drop", "let_go"):
        real = getattr(Scratch, name)
        monkeypatch.setattr(Scratch, name, lambda self, *a, name=name, real=real: (calls.append(name), real(self, *a))[1])
    shared = " ".join(f"w{i}" for i in range(60))
    rows = [(1, shared + " a b c"), (2, "x y " + shared), (3, "alone " * 70)]
    found = repeats.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc"]: r["spans"] for r in found} == {1: [[0, 60]], 2: [[2, 62]]}
    # Suffixes, survivors, passages, first places: before the next is written, what it replaces has gone.
    assert calls == ["save", "save", "drop", "let_go", "save", "drop", "let_go", "save", "let_go"]


def test_a_group_of_copies_has_few_links_and_only_candidates_need_full_sets(spark, monkeypatch):
    links, wanted = [], []
    find, want = near_dedup.components, near_dedup._Sets.want
    monkeypatch.setattr(near_dedup, "components", lambda t, *a: (links.append(t.count()), find(t, *a))[1])
    monkeypatch.setattr(near_dedup._Sets, "want", lambda self, keys: (
        wanted.append(keys.distinct().count()), want(self, keys))[1])
    words = lambda p, n: [f"{p}{i}" for i in range(n)]
    rows = []
    for k in range(120):  # copies with a word of their own
        copy = words("w", 200)
        copy[k + 20] = f"own{k}"
        rows.append((k, " ".join(copy)))
    # Texts that share a fifth, so that they meet in nodes, but are never alike.
    rows += [(1000 + k, " ".join(words("c", 40) + words(f"t{k}x", 160))) for k in range(120)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: 0 if i < 1000 else i for i, _ in rows}
    assert max(links) < 3 * 120
    assert wanted[-1] < 20


def test_links_between_two_groups_are_merged_as_one(spark, monkeypatch):
    seen, stars = [], components._stars
    monkeypatch.setattr(components, "_stars", lambda edges, large: (seen.append(edges.count()), stars(edges, large))[1])
    groups = spark.createDataFrame([(i, i // 20 * 20) for i in range(60)], "vertex long, root long")
    # All pairs of the first two groups, and a set that is in no group yet.
    links = spark.createDataFrame([(i, j) for i in range(20) for j in range(20, 40)] + [(99, 45)], "a long, b long")
    found = near_dedup._merged(groups, links, Scratch(spark, "t")).collect()
    assert sorted(map(tuple, found)) == [(i, 0 if i < 40 else 40) for i in [*range(60), 99]]
    assert max(seen) < 10


def test_language_fit_spreads_out_a_few_rows_at_a_time():
    rng = np.random.default_rng(0)
    present = rng.random((640, language.SLOTS)) < 0.02
    present[:5] = rng.random((5, language.SLOTS)) < 0.5  # bitmaps
    labels, rows = [f"l{i % 4}" for i in range(640)], [language._packed(x) for x in present]
    assert max(map(len, rows)) <= language.SLOTS // 8
    whole = language.Classifier(present, labels, 32, 1e-3)
    tracemalloc.start()
    model = language.Classifier(language.Packed(rows), labels, 32, 1e-3)
    model.calibrate(np.resize(language.LENGTHS, 640), language.Packed(rows))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.2 * present.nbytes
    assert np.array_equal(model.slots, whole.slots) and np.array_equal(model.weights, whole.weights)
    assert np.array_equal(language.Packed(rows)[np.array([0, 639])], present[[0, 639]])

"""The flows from raw loan text to compared and explained models, on a small made-up table."""

from __future__ import annotations

import numpy as np
import pytest

from riskloom import sources
from riskloom.operators import models
from riskloom.plans import loan
from riskloom.plans.compare import ScoreSet, compare_runs
from riskloom.plans.describe import describe, write_all
from riskloom.plans.explain_errors import explain_errors
from riskloom.plans.prepare import prepare
from riskloom.plans.train import train_run

FAMILIES = ("LogisticRegression", "DecisionTree")


@pytest.fixture(scope="module")
def raw_csv(tmp_path_factory):
    rng = np.random.default_rng(21)
    lines = [",".join(loan.RAW_COLUMNS)]
    for i in range(600):
        risk = rng.normal()
        bad = risk + rng.normal() > 1.2
        cells = {c: f"{rng.normal(10, 3) + risk:.2f}" for c in (*loan.NUMBERS, *loan.LOGGED)}
        cells["dti"] = ["-1", "999", "", f"{rng.random() * 30:.1f}"][min(i % 9, 3)]
        cells |= {
            "id": str(i), "loan_status": "Charged Off" if bad else ("" if i % 50 == 0 else "Current"),
            "emp_length": ["10+ years", "< 1 year", "3 years", ""][i % 4],
            "annual_inc": "" if i % 20 == 0 else f"{rng.lognormal(10, 1):.0f}",
        }
        for j, c in enumerate(loan.TEXT):
            cells[c] = f"v{(i * (j + 3)) % (j + 2)}"
        cells["addr_state"] = "RARE" if i == 7 else f"S{i % 5}"
        lines.append(",".join(cells[c] for c in loan.RAW_COLUMNS))
    path = tmp_path_factory.mktemp("raw") / "loans.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def cleaned(spark, raw_csv, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("ingest") / "parquet")
    raw = sources.ingest_csv(spark, raw_csv, out, columns=loan.RAW_COLUMNS)
    return loan.clean(raw)


def test_clean_rules(cleaned):
    rows = {r["id"]: r for r in cleaned.collect()}
    assert len(rows) == 600
    assert rows["9"]["dti"] is None and rows["10"]["dti"] is None and rows["2"]["dti"] is None
    assert rows["3"]["emp_length_num"] is None and rows["0"]["emp_length_num"] == 10.0
    assert rows["1"]["emp_length_num"] == 0.0 and rows["2"]["emp_length_num"] == 3.0
    assert rows["20"]["annual_inc_log"] is None
    assert {r["default"] for r in rows.values()} == {0, 1}


def test_flow(spark, cleaned, tmp_path):
    ready = prepare(
        cleaned, loan.ROLES, str(tmp_path / "data"), loan.RARE_COLUMNS, loan.RARE_THRESHOLD
    )
    assert all(r["passed"] for r in ready.checks.collect())
    assert ready.train.count() + ready.test.count() == 600
    names = [r["name"] for r in ready.slots.orderBy("idx").collect()]
    assert names[:14] == list(loan.ROLES.numeric)
    assert "addr_state_grouped_OTHER" in names and "addr_state_grouped_RARE" not in names

    grids = {"LogisticRegression": {"regParam": [1e-2]}, "DecisionTree": {"maxDepth": [3]}}
    runs = {}
    for name, grid in (("a", grids), ("b", {**grids, "DecisionTree": {"maxDepth": [4]}})):
        runs[name] = train_run(ready.train, ready.test, "id", "default",
                               str(tmp_path / name), FAMILIES, grid)
    assert runs["a"].champion in FAMILIES
    assert runs["a"].results.count() == 2

    columns = {f: f"score_{f}" for f in FAMILIES}
    tables = compare_runs(
        *[ScoreSet(n, r.train_scores, r.test_scores, columns) for n, r in runs.items()],
        "id", "default", replicates=12,
    )
    assert all(r["passed"] for r in tables["checks"].collect())
    assert tables["delong"].count() == 4
    assert tables["mcnemar"].count() == 4
    same = tables["delong"].where("model_a = 'a_LogisticRegression' and family = 'across'").first()
    assert same["delta_auc"] == 0.0 and same["p_value"] == 1.0
    agreed = {(r["kind"], r["model_a"]): r for r in tables["three_tests"].collect()}
    assert len(agreed) == 4
    assert not agreed["across", "a_LogisticRegression"]["all_agree"]

    tuned = runs["a"].tuned["LogisticRegression"]
    explained = explain_errors(
        tuned, ready.train, ready.test, runs["a"].test_scores, ready.slots, "id", "default",
        "score_LogisticRegression", samples=400,
    )
    rules = explained["rules"].collect()
    per_row = explained["instances"].count()
    assert per_row >= 1 and len(rules) == 10 * per_row
    assert all(0.0 <= r["r2"] <= 1.0 for r in explained["fits"].collect())
    reloaded = models.load_model(type(runs["a"].tuned[runs["a"].champion].model),
                                 str(tmp_path / "a" / "best_model"))
    assert reloaded.numFeatures == len(names)


def test_describe(spark, cleaned, tmp_path):
    stored = sources.write_table(
        cleaned.withColumnRenamed("addr_state", "addr_state_grouped"), str(tmp_path / "rows")
    )
    tables = describe(stored, loan.ROLES, leakage_patterns=("_pymnt",))
    chosen = {k: tables[k] for k in (
        "column_profile", "numeric_summary", "categorical_vs_target", "numeric_vs_target",
        "cramers_v", "missingness_vs_target")}
    write_all(chosen, str(tmp_path / "tables"))
    back = spark.read.option("header", True).csv(str(tmp_path / "tables" / "numeric_vs_target"))
    assert back.count() == len(loan.ROLES.numeric)
    profile = {r["variable"]: r["plan"] for r in chosen["column_profile"].collect()}
    assert profile["annual_inc_log"] == "median+indicator" and profile["id"] == "none"


def test_registered_families_take_the_full_grids(monkeypatch):
    from riskloom.catalog import modelling
    from riskloom.operators import models

    taken = {}

    def tune(family, train, id_col, target, grid=None, **params):
        taken[family.name] = (grid or family.grid, set(params) - {"parallelism"})
    monkeypatch.setattr(modelling, "vector_sets", lambda spark, d: (None, None))
    monkeypatch.setattr(models, "tune", tune)
    monkeypatch.setattr(models, "score_all", lambda *a: None)
    monkeypatch.setattr(models, "evaluate", lambda *a: None)
    for name, family in models.FAMILIES.items():
        modelling.tuned_row(None, None, name)
        assert taken[name] == (family.grid, set())
        known = modelling.KNOWN_PARAMS[name]
        assert set(known) == set(family.grid) and all(x in family.grid[p] for p, x in known.items())


def test_forest_keeps_node_ids_and_its_trees(spark):
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(3)
    rows = [(*map(float, x), int(x[0] + rng.normal() > 0)) for x in rng.normal(size=(300, 4))]
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, c double, d double, y int")).cache()
    own = models.FAMILIES["RandomForest"].estimator("y", numTrees=4, maxDepth=8)
    walked = own.copy({own.cacheNodeIds: False})
    assert own.getCacheNodeIds() and not walked.getCacheNodeIds()
    a, b = ([t.toDebugString.split("\n", 1)[1] for t in e.fit(df).trees] for e in (own, walked))
    assert a == b

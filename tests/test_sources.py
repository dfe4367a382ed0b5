"""Reading and storing: text CSV, result tables, JSON, models and pipelines."""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from riskloom import sources
from riskloom.operators import features, models
from riskloom.roles import Roles
from riskloom.sources.tables import load_pipeline, save_pipeline

RAW = 'id,desc,amount\n1,"line one\nline ""two"", more",10\n2,plain,n/a\n3,,7.5\n'


def test_multiline_csv_is_read_once_into_parquet(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(RAW)
    df = sources.ingest_csv(spark, str(path), str(tmp_path / "raw_parquet"))
    rows = {r["id"]: r for r in df.collect()}
    assert len(rows) == 3
    assert rows["1"]["desc"] == 'line one\nline "two", more'
    assert rows["3"]["desc"] is None
    assert dict(df.dtypes)["amount"] == "string"
    numbers = df.select(F.col("amount").try_cast("double").alias("a")).where("a is not null")
    assert numbers.count() == 2
    typed = sources.read_csv_text(spark, str(path), "id int, desc string, amount string",
                                  ["id", "amount"])
    assert typed.columns == ["id", "amount"]


def test_result_tables_round_trip(spark, tmp_path):
    table = spark.createDataFrame(
        [("LogisticRegression", '{"regParam": 1e-06}', 0.5), ("GBT", '{"maxIter": 50}', 0.7)],
        "model string, best_params string, auc double")
    path = str(tmp_path / "results")
    sources.write_result_csv(table, path)
    back = {r["model"]: r for r in sources.read_params_table(
        spark, path, "model string, best_params string, auc double").collect()}
    assert back["GBT"]["best_params"] == {"maxIter": "50"}
    assert float(back["LogisticRegression"]["best_params"]["regParam"]) == 1e-6
    sources.write_json(table.limit(1), str(tmp_path / "json"))
    text = "".join(p.read_text() for p in (tmp_path / "json").glob("*.json"))
    assert set(json.loads(text)) == {"model", "best_params", "auc"}


def test_parquet_overwrite_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_table(spark.range(10).withColumn("x", F.col("id") * 2), path)
    df = sources.write_table(spark.range(4).withColumn("x", F.col("id") * 3), path)
    assert df.count() == 4
    pruned = sources.read_table(spark, path, ["x"])
    assert "struct<x:bigint>" in pruned._jdf.queryExecution().toString()


def test_pipeline_and_model_store(spark, tmp_path):
    rows = [(str(i), i % 2, float(i % 7) if i % 5 else None, "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, y int, x double, c string")
    roles = Roles("id", "y", ("x",), ("c",))
    pipeline = features.feature_pipeline(roles).fit(df)
    save_pipeline(pipeline, str(tmp_path / "p"))
    again = load_pipeline(str(tmp_path / "p"))
    one = features.prepared(pipeline, df, roles).collect()
    two = features.prepared(again, df, roles).collect()
    assert [r["features"] for r in one] == [r["features"] for r in two]
    unseen = spark.createDataFrame([("u", 0, 1.0, "zzz"), ("v", 0, 1.0, None)], df.schema)
    for r in features.prepared(pipeline, unseen, roles).collect():
        assert list(r["features"].toArray()[1:]) == [0.0, 0.0, 0.0]
    train = features.prepared(pipeline, df, roles)
    tuned = models.refit(models.FAMILIES["LogisticRegression"], train, "y", {"regParam": 0.1})
    models.save_model(tuned, str(tmp_path / "m"))
    loaded = models.load_model(LogisticRegressionModel, str(tmp_path / "m"))
    assert loaded.coefficients == tuned.model.coefficients
    slots = features.slot_names(train, roles)
    named = [r["name"] for r in models.named_coefficients(tuned, slots).orderBy("idx").collect()]
    assert named == ["x", "c_a", "c_b", "c_c"]
    fitted = features.imputer_values(pipeline).first()
    assert fitted["variable"] == "x"


def test_score_column_rules(spark):
    rows = [(str(i), int(i % 3 == 0), float(i % 10), float((i * 7) % 11)) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, y int, a double, b double")
    roles = Roles("id", "y", ("a", "b"), ())
    train = features.prepared(features.feature_pipeline(roles).fit(df), df, roles)
    tuned = {
        "DecisionTree": models.tune(models.FAMILIES["DecisionTree"], train, "id", "y",
                                    {"maxDepth": [3]}),
        "LinearSVC": models.refit(models.FAMILIES["LinearSVC"], train, "y", {"maxIter": 5}),
    }
    scored = models.score_all(train, tuned, ["id", "y"])
    assert scored.columns == ["id", "y", "score_DecisionTree", "score_LinearSVC"]
    tree = scored.agg(F.min("score_DecisionTree"), F.max("score_DecisionTree")).first()
    assert 0.0 <= tree[0] <= tree[1] <= 1.0
    table = {r["model"]: r for r in models.evaluate(scored, "id", "y", tuned).collect()}
    assert table["LinearSVC"]["tn"] + table["LinearSVC"]["fp"] == 200
    assert json.loads(table["DecisionTree"]["best_params"]) == {"maxDepth": 3}

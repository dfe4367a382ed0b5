"""Sources and sinks: what is written to the shared folder comes back as it was."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom import sources
from riskloom.catalog import views as v
from riskloom.catalog.columns import SPLIT
from riskloom.catalog.modelling import fitted, vector_sets
from riskloom.catalog.registry import query
from riskloom.operators import features, models
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources.tables import load_pipeline, save_pipeline


def folder(spark) -> str:
    """A new place below the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"


@query("s01_csv_text_scan", "SELECT doc_id, lang, text FROM documents")
def _(spark, d):
    path = folder(spark)
    sources.write_result_csv(v.table(spark, d, "documents").select("doc_id", "lang", "text"), path)
    return sources.read_csv_text(spark, path, "doc_id long, lang string, text string")


@query("s04_parquet_overwrite", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def _(spark, d):
    path = folder(spark)
    rows = v.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sources.write_table(rows.limit(10), path)
    return sources.write_table(rows, path, ["o_orderstatus"])


@query("s05_result_csv", """SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS price
  FROM orders GROUP BY 1""", "price", 4)
def _(spark, d):
    path = folder(spark)
    table = v.table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.avg("o_totalprice").alias("price"))
    sources.write_result_csv(table, path)
    return sources.read_csv_text(spark, path, "o_orderpriority string, n long, price double")


@query("s06_json_params", """SELECT event_id, event_type,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""")
def _(spark, d):
    path = folder(spark)
    sources.write_result_csv(v.table(spark, d, "events").select("event_id", "event_type", "props"), path)
    stored = sources.read_params_table(spark, path, "event_id long, event_type string, props string", "props")
    return stored.select(
        "event_id", "event_type", F.element_at("props", F.lit("k")).try_cast("double").alias("k"))


@query("s07_json_sink", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def _(spark, d):
    path = folder(spark)
    rows = v.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    sources.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("s08_pipeline_store", f"""{"WITH " + SPLIT}, train AS (SELECT loan.* FROM loan JOIN split USING (id)
    WHERE split.split = 'train'), st AS (SELECT avg(price) AS mp, stddev_samp(price) AS sp,
    avg(bal) AS mb, stddev_samp(bal) AS sb FROM train)
  SELECT id, y, (price - mp) / sp AS slot_0, (bal - mb) / sb AS slot_1 FROM loan, st""",
       "slot_0 slot_1")
def _(spark, d):
    rows, model = fitted(spark, d)
    path = folder(spark)
    save_pipeline(model, path)
    a = vector_to_array("features")
    return features.prepared(load_pipeline(path), rows, v.LOAN_ROLES).select(
        "id", "y", a[0].alias("slot_0"), a[1].alias("slot_1"))


@query("s09_model_store", """WITH e AS (SELECT CAST(vec_id AS VARCHAR) AS id,
    CASE WHEN label = 0 THEN 1 ELSE 0 END AS y FROM embeddings)
  SELECT id, true AS same FROM e QUALIFY row_number() OVER (PARTITION BY y ORDER BY md5('42:' || id))
    <= ceil(count(*) OVER (PARTITION BY y) * 0.2::DOUBLE)""")
def _(spark, d):
    train, test = vector_sets(spark, d)
    family = models.FAMILIES["NaiveBayes"]
    kept = models.refit(family, train, "y", {})
    path = folder(spark)
    models.save_model(kept, path)
    back = models.load_model(type(kept.model), path)
    score = models.score_of(family)
    scored = kept.model.transform(test).select("id", "features", score.alias("before"))
    return back.transform(scored).select("id", (score == F.col("before")).alias("same"))

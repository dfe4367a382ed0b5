"""Views over the given tables that play the parts of a loan study, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.clean import sentinel_to_null, target_flag
from riskloom.functions.hashing import hash_uniform
from riskloom.operators.metrics import long_scores
from riskloom.operators.sampling import with_split
from riskloom.roles import Roles
from riskloom.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "y", target_flag("o_orderpriority", ["1-URGENT"])
    )


ORDERS = """o AS (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y
  FROM orders)"""


def loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as loans: a unique id, a target, two numbers, four categories."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("id"),
            target_flag("o_orderpriority", ["1-URGENT"]).alias("y"),
            F.col("o_totalprice").alias("price"), F.col("c_acctbal").alias("bal"),
            F.col("o_orderstatus").alias("status"), F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("nation"), F.col("o_orderpriority").alias("priority"),
        )
    )


LOAN = """loan AS (SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y,
  o_totalprice AS price, c_acctbal AS bal, o_orderstatus AS status, c_mktsegment AS segment,
  n_name AS nation, o_orderpriority AS priority
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

LOAN_ROLES = Roles("id", "y", ("price", "bal"), ("status", "segment", "nation"))


def uniform_sql(seed: str, key: str = "id", block: str | None = None, slot: str = "0") -> str:
    text = f"'{seed}:' || {block} || ':' || {key}" if block else f"'{seed}:' || {key}"
    word = f"substr(md5({text}), CAST({slot} AS BIGINT) * 8 + 1, 8)"
    return f"(CAST(CAST('0x' || {word} AS UBIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE))"


MODELS = ("a_price", "a_bal", "a_mix", "b_price", "b_bal", "b_mix")


def stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score table written once, for questions that read it several times."""
    return materialize(scores(spark, sf_dir))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide score table: three kinds of score in two runs, one of them heavily tied and one that
    carries signal. Run b is run a with hashed noise."""
    df = loan(spark, sf_dir)
    price, bal, y = F.col("price"), F.col("bal"), F.col("y")
    u = {k: hash_uniform(k, "id") for k in ("u1", "u2", "u3", "u4")}
    return df.select(
        "id", "y",
        price.alias("a_price"),
        F.floor(bal / 500).cast("double").alias("a_bal"),
        (price / 1000 + u["u1"] * 300 + y * 60).alias("a_mix"),
        (price + u["u2"] * 40000).alias("b_price"),
        F.floor((bal + u["u3"] * 1500) / 500).cast("double").alias("b_bal"),
        (price / 1000 + u["u4"] * 300 + y * 45).alias("b_mix"),
    )


SCORES = f"""{LOAN}, scores AS (SELECT id, y,
  price AS a_price,
  CAST(floor(bal / 500) AS DOUBLE) AS a_bal,
  price / 1000 + {uniform_sql("u1")} * 300 + y * 60 AS a_mix,
  price + {uniform_sql("u2")} * 40000 AS b_price,
  CAST(floor((bal + {uniform_sql("u3")} * 1500) / 500) AS DOUBLE) AS b_bal,
  price / 1000 + {uniform_sql("u4")} * 300 + y * 45 AS b_mix
  FROM loan)"""


def scores_tall(spark: SparkSession, sf_dir: str, passes: int = 2) -> DataFrame:
    """All scores in long form; a table that is read once is not written first."""
    wide = stored_scores(spark, sf_dir) if passes > 1 else scores(spark, sf_dir)
    return long_scores(wide, "id", "y", {m: m for m in MODELS})


TALL = f"""{SCORES}, tall AS (UNPIVOT scores ON {", ".join(MODELS)} INTO NAME model VALUE score)"""

# Per distinct score: rows at the score and below it, and class totals.
POINTS_BODY = """points AS (
  SELECT model, score, n_pos, n_neg,
    CAST(sum(n_pos) OVER w - n_pos AS BIGINT) AS pos_below,
    CAST(sum(n_neg) OVER w - n_neg AS BIGINT) AS neg_below,
    CAST(sum(n_pos) OVER (PARTITION BY model) AS BIGINT) AS p,
    CAST(sum(n_neg) OVER (PARTITION BY model) AS BIGINT) AS n
  FROM (SELECT model, score, count(*) FILTER (y = 1) AS n_pos, count(*) FILTER (y = 0) AS n_neg
        FROM tall GROUP BY model, score)
  WINDOW w AS (PARTITION BY model ORDER BY score))"""
POINTS = f"{TALL}, {POINTS_BODY}"

# Contribution of every row to the area of its model, and the covariance of the areas.
DELONG_BODY = """comp AS (
  SELECT t.id, t.y, t.model, CASE WHEN t.y = 1 THEN (neg_below + n_neg / 2.0::DOUBLE) / n
    ELSE (p - pos_below - n_pos + n_pos / 2.0::DOUBLE) / p END AS v
  FROM tall t JOIN points USING (model, score)),
per_class AS (
  SELECT a.model AS model_a, b.model AS model_b, a.y, covar_samp(a.v, b.v) / count(*) AS part,
    avg(a.v) AS mean_a, avg(b.v) AS mean_b
  FROM comp a JOIN comp b ON a.id = b.id GROUP BY a.model, b.model, a.y),
cov AS (
  SELECT model_a, model_b, sum(part) AS cov, max(mean_a) FILTER (y = 1) AS auc_a,
    max(mean_b) FILTER (y = 1) AS auc_b
  FROM per_class GROUP BY model_a, model_b)"""
DELONG = f"{POINTS}, {DELONG_BODY}"

STUDY_KINDS = ("price", "bal", "mix", "size", "net", "rank")
STUDY_MODELS = tuple(f"{run}_{kind}" for run in "ab" for kind in STUDY_KINDS)


def study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of six kinds of score each, with the set (``part``) that a row belongs to: a fifth of each
    class is ``test``. Written once."""
    rows = with_split(loan(spark, sf_dir), "id", "y", split="part")
    price, bal, y = F.col("price"), F.col("bal"), F.col("y")
    u = {k: hash_uniform(f"u{k}", "id") for k in range(1, 10)}
    return materialize(rows.select(
        "id", "y", "part",
        price.alias("a_price"),
        F.floor(bal / 500).cast("double").alias("a_bal"),
        (price / 1000 + u[1] * 300 + y * 60).alias("a_mix"),
        F.floor(price / 20000).cast("double").alias("a_size"),
        (bal + u[5] * 4000 + y * 900).alias("a_net"),
        (u[6] + y * 0.12).alias("a_rank"),
        (price + u[2] * 40000).alias("b_price"),
        F.floor((bal + u[3] * 1500) / 500).cast("double").alias("b_bal"),
        (price / 1000 + u[4] * 300 + y * 45).alias("b_mix"),
        F.floor((price + u[7] * 60000) / 20000).cast("double").alias("b_size"),
        (bal + u[8] * 4000 + y * 700).alias("b_net"),
        (u[9] + y * 0.11).alias("b_rank"),
    ))


STUDY = f"""{LOAN}, study AS (SELECT id, y, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY md5('42:' || id))
    <= ceil(count(*) OVER (PARTITION BY y) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part,
  price AS a_price,
  CAST(floor(bal / 500) AS DOUBLE) AS a_bal,
  price / 1000 + {uniform_sql("u1")} * 300 + y * 60 AS a_mix,
  CAST(floor(price / 20000) AS DOUBLE) AS a_size,
  bal + {uniform_sql("u5")} * 4000 + y * 900 AS a_net,
  {uniform_sql("u6")} + y * 0.12::DOUBLE AS a_rank,
  price + {uniform_sql("u2")} * 40000 AS b_price,
  CAST(floor((bal + {uniform_sql("u3")} * 1500) / 500) AS DOUBLE) AS b_bal,
  price / 1000 + {uniform_sql("u4")} * 300 + y * 45 AS b_mix,
  CAST(floor((price + {uniform_sql("u7")} * 60000) / 20000) AS DOUBLE) AS b_size,
  bal + {uniform_sql("u8")} * 4000 + y * 700 AS b_net,
  {uniform_sql("u9")} + y * 0.11::DOUBLE AS b_rank
  FROM loan),
study_tall AS (UNPIVOT study ON {", ".join(STUDY_MODELS)} INTO NAME model VALUE score),
tall AS (SELECT id, y, model, score FROM study_tall WHERE part = 'test'), {POINTS_BODY},
train_points AS (
  SELECT model, score AS threshold, sum(n_pos) OVER w AS tp, sum(n_neg) OVER w AS fp,
    sum(n_pos) OVER (PARTITION BY model) AS p, sum(n_neg) OVER (PARTITION BY model) AS n
  FROM (SELECT model, score, count(*) FILTER (y = 1) AS n_pos, count(*) FILTER (y = 0) AS n_neg
        FROM study_tall WHERE part = 'train' GROUP BY model, score)
  WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
cuts AS (SELECT model, threshold FROM train_points QUALIFY row_number() OVER (
  PARTITION BY model ORDER BY tp::HUGEINT * n::HUGEINT - fp::HUGEINT * p::HUGEINT DESC, threshold DESC) = 1),
test_areas AS (SELECT model, sum(n_pos::HUGEINT * (2 * neg_below + n_neg)) / (2.0::DOUBLE * any_value(p) * any_value(n)) AS auc
  FROM points GROUP BY model),
pairs AS (SELECT 'across' AS kind, 'a_' || k AS model_a, 'b_' || k AS model_b FROM (SELECT unnest({list(STUDY_KINDS)}) AS k)
  UNION ALL SELECT 'top2_' || run, max(model) FILTER (pos = 1), max(model) FILTER (pos = 2) FROM (
    SELECT model[1] AS run, model, row_number() OVER (PARTITION BY model[1] ORDER BY auc DESC, model) AS pos
    FROM test_areas) GROUP BY run)"""


def missing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels where they have any: real missing values."""
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select(
            F.col("doc_id").cast("string").alias("id"),
            F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("y"),
            "quality", "toxic", "lang", "source", "n_chars",
        )
    )


MISSING = """missing AS (SELECT CAST(d.doc_id AS VARCHAR) AS id,
  CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS y, quality, toxic, lang, source, n_chars
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their zero tax read as not recorded."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
        "l_quantity", "l_extendedprice", "l_discount",
        sentinel_to_null("l_tax", equals=[0.0]).alias("l_tax"),
        "l_returnflag", "l_linestatus",
    )


LINES = """lines AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  l_quantity, l_extendedprice, l_discount,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS l_tax, l_returnflag, l_linestatus
  FROM lineitem)"""

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINES_TALL = f"""{LINES}, lt AS (
  SELECT y, variable, value FROM lines UNPIVOT INCLUDE NULLS
  (value FOR variable IN ({", ".join(NUMERIC)})))"""

CATEGORIES = ["status", "segment", "nation", "priority"]
LOAN_TALL = f"""{LOAN}, ct AS (
  SELECT y, variable, value FROM loan UNPIVOT INCLUDE NULLS
  (value FOR variable IN ({", ".join(CATEGORIES)})))"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as ready feature vectors; the target is the first label."""
    from pyspark.ml.functions import array_to_vector

    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.when(F.col("label") == 0, 1).otherwise(0).alias("y"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )

"""Scans, projections, filters, joins, set operations and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from riskloom import sources
from riskloom.catalog import views as v
from riskloom.catalog.registry import query
from riskloom.functions import clean
from riskloom.functions.hashing import hash_uniform
from riskloom.operators import metrics, profile, quality, sampling


@query("s02_column_pruned_read", """SELECT o_orderkey, o_totalprice FROM orders""")
def _(spark, d):
    return sources.read_table(spark, f"{d}/orders.parquet", ["o_orderkey", "o_totalprice"])


@query("s03_parquet_scan", "SELECT * FROM customer")
def _(spark, d):
    return sources.read_table(spark, f"{d}/customer.parquet")


@query("s10_small_lookup_table", """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' WHEN 'P' THEN 'pending' END
  AS state FROM orders""")
def _(spark, d):
    names = sources.small_table(
        spark, [("F", "filled"), ("O", "open"), ("P", "pending")],
        "o_orderstatus string, state string",
    )
    return v.table(spark, d, "orders").join(
        F.broadcast(names), "o_orderstatus", "left"
    ).select("o_orderkey", "state")


@query("s11_vector_to_array", """SELECT CAST(vec_id AS VARCHAR) AS id,
  CAST(len(embedding) AS INTEGER) AS n_slots,
  CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[-1] AS DOUBLE) AS last
  FROM embeddings""", "first last")
def _(spark, d):
    arrays = sources.export_arrays(v.vectors(spark, d))
    return arrays.select(
        "id", F.size("features_arr").alias("n_slots"),
        F.element_at("features_arr", 1).alias("first"),
        F.element_at("features_arr", -1).alias("last"),
    )


@query("s12_preview", """(SELECT * FROM nation ORDER BY n_nationkey LIMIT 3)
  UNION ALL (SELECT * FROM nation ORDER BY n_nationkey DESC LIMIT 3)""")
def _(spark, d):
    nation = v.table(spark, d, "nation")
    return sources.preview(nation, "n_nationkey").unionByName(
        sources.preview(nation, "n_nationkey", last=True)
    )


@query("p01_target_flag", """SELECT o_orderkey,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y,
  CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y_closed
  FROM orders""")
def _(spark, d):
    return v.orders(spark, d).select(
        "o_orderkey", "y",
        clean.target_flag("o_orderstatus", ["F"], excluded=["P"]).alias("y_closed"),
    )


@query("p02_numeric_coercion", """SELECT c_custkey,
  TRY_CAST(substr(c_name, 10) AS DOUBLE) AS from_name,
  TRY_CAST(c_mktsegment AS DOUBLE) AS from_text,
  TRY_CAST(CAST(c_nationkey AS VARCHAR) AS DOUBLE) AS from_int FROM customer""")
def _(spark, d):
    return v.table(spark, d, "customer").select(
        "c_custkey", clean.to_number(F.expr("substr(c_name, 10)")).alias("from_name"),
        clean.to_number("c_mktsegment").alias("from_text"),
        clean.to_number(F.col("c_nationkey").cast("string")).alias("from_int"),
    )


@query("p03_ordinal_parse", """SELECT o_orderkey,
  TRY_CAST(regexp_extract(o_orderpriority, '([0-9]+)', 1) AS DOUBLE) AS level,
  CASE WHEN years LIKE '%10+%' THEN 10.0::DOUBLE WHEN years LIKE '%< 1%' THEN 0.0::DOUBLE
    ELSE TRY_CAST(regexp_extract(years, '([0-9]+)', 1) AS DOUBLE) END AS years
  FROM (SELECT *, CASE WHEN o_custkey % 13 = 0 THEN '< 1 year' WHEN o_custkey % 13 > 9
    THEN '10+ years' WHEN o_custkey % 13 = 5 THEN NULL
    ELSE CAST(o_custkey % 13 AS VARCHAR) || ' years' END AS years FROM orders)""")
def _(spark, d):
    k = F.col("o_custkey") % 13
    years = (
        F.when(k == 0, "< 1 year").when(k > 9, "10+ years").when(k == 5, None)
        .otherwise(F.concat(k.cast("string"), F.lit(" years")))
    )
    return v.table(spark, d, "orders").withColumn("years", years).select(
        "o_orderkey", clean.ordinal_text("o_orderpriority").alias("level"),
        clean.ordinal_text("years").alias("years"),
    )


@query("p04_sentinel_to_null", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS l_tax,
  CASE WHEN l_quantity = 1 OR l_quantity >= 45 THEN NULL ELSE l_quantity END AS l_quantity
  FROM lineitem""")
def _(spark, d):
    return v.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        clean.sentinel_to_null("l_tax", equals=[0.0]).alias("l_tax"),
        clean.sentinel_to_null("l_quantity", equals=[1.0], at_least=45.0).alias("l_quantity"),
    )


@query("p05_log1p_floor0", """SELECT c_custkey, ln(1 + greatest(c_acctbal, 0)) AS log_bal,
  ln(1 + CASE WHEN c_acctbal < 1000 THEN NULL ELSE greatest(c_acctbal, 0) END) AS log_big
  FROM customer""", "log_bal log_big")
def _(spark, d):
    big = F.when(F.col("c_acctbal") >= 1000, F.col("c_acctbal"))
    return v.table(spark, d, "customer").select(
        "c_custkey", clean.log1p_floor0("c_acctbal").alias("log_bal"),
        clean.log1p_floor0(big).alias("log_big"),
    )


@query("p06_clip_at_p99", """SELECT o_orderkey,
  least(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.99) FROM orders)) AS o_totalprice
  FROM orders""", "o_totalprice", 4)
def _(spark, d):
    df = v.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return profile.clip_at_quantile(df, ["o_totalprice"])


@query("p07_missing_flag", f"""WITH {v.MISSING} SELECT id,
  CAST(quality IS NULL AS INTEGER) AS quality_missing,
  CAST(lang IS NULL AS INTEGER) AS lang_missing FROM missing""")
def _(spark, d):
    return v.missing_view(spark, d).select(
        "id", clean.missing_flag("quality").alias("quality_missing"),
        clean.missing_flag("lang").alias("lang_missing"),
    )


@query("p08_rare_categories", f"""WITH {v.LOAN},
  keep AS (SELECT nation FROM loan GROUP BY nation
           HAVING count(*) / (SELECT count(*) FROM loan)::DOUBLE >= 0.04)
  SELECT id, CASE WHEN nation IN (SELECT nation FROM keep) THEN nation ELSE 'OTHER' END
    AS nation_grouped FROM loan""")
def _(spark, d):
    df = v.loan(spark, d)
    keep = profile.frequent_values(df, ["nation"], 0.04)
    return profile.group_rare(df, keep, ["nation"]).select("id", "nation_grouped")


SPLIT = f"""{v.LOAN}, split AS (SELECT id, y, CASE WHEN row_number() OVER (
    PARTITION BY y ORDER BY md5('42:' || id)) <= ceil(count(*) OVER (PARTITION BY y) * 0.2::DOUBLE)
  THEN 'test' ELSE 'train' END AS split FROM loan)"""


@query("p09_partition_filter", f"WITH {SPLIT} SELECT id FROM split WHERE split = 'train'")
def _(spark, d):
    split = sampling.stratified_split(v.loan(spark, d), "id", "y")
    return split.where(F.col("split") == "train").select("id")


PROFILE = f"""{v.MISSING}, long AS (
  SELECT variable, value FROM (SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, text,
    CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic, lang, source,
    CAST(n_chars AS VARCHAR) AS n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
  UNPIVOT INCLUDE NULLS
  (value FOR variable IN (doc_id, text, quality, toxic, lang, source, n_chars))),
profile AS (SELECT variable,
  CASE variable WHEN 'quality' THEN 'int' WHEN 'toxic' THEN 'int' WHEN 'n_chars' THEN 'bigint'
    WHEN 'doc_id' THEN 'bigint' ELSE 'string' END AS dtype,
  count(*) - count(value) AS n_missing,
  round((count(*) - count(value)) / count(*)::DOUBLE * 100, 2) AS pct_missing,
  count(DISTINCT value) AS n_unique FROM long GROUP BY variable)"""


def profiled(spark, d):
    """Every column of the documents and of their labels."""
    return profile.column_profile(
        v.table(spark, d, "documents").join(v.table(spark, d, "labels"), "doc_id", "left"))


@query("p10_profile_range_filter", f"""WITH {PROFILE} SELECT variable, pct_missing FROM profile
  WHERE pct_missing > 0.5 AND pct_missing < 99""", "pct_missing", 2)
def _(spark, d):
    return profiled(spark, d).where(
        (F.col("pct_missing") > 0.5) & (F.col("pct_missing") < 99)
    ).select("variable", "pct_missing")


PLAN = f"""{PROFILE}, planned AS (SELECT variable, CASE WHEN pct_missing = 0 THEN 'none'
  WHEN pct_missing > 70 THEN 'drop' WHEN dtype IN ('int', 'bigint') THEN 'median+indicator'
  ELSE 'mode/unknown' END AS plan FROM profile)"""


@query("p11_treatment_rule", f"WITH {PLAN} SELECT variable, plan FROM planned")
def _(spark, d):
    return profiled(spark, d).select(
        "variable", clean.treatment_rule("pct_missing", "dtype").alias("plan")
    )


@query("a21_treatment_counts", f"""WITH {PLAN} SELECT plan, count(*) AS n FROM planned
  GROUP BY plan""")
def _(spark, d):
    plan = clean.treatment_rule("pct_missing", "dtype").alias("plan")
    return profiled(spark, d).select(plan).groupBy("plan").agg(F.count("*").alias("n"))


@query("p13_threshold_label", f"""WITH {v.TALL} SELECT id, model, CASE WHEN score >= CASE WHEN model LIKE '%bal' THEN 8.0
    WHEN model LIKE '%mix' THEN 420.0 ELSE 250000.0 END THEN 1 ELSE 0 END AS pred FROM tall""")
def _(spark, d):
    cuts = sources.small_table(
        spark, [("a_bal", 8.0), ("b_bal", 8.0), ("a_price", 250000.0), ("b_price", 250000.0),
                ("a_mix", 420.0), ("b_mix", 420.0)],
        "model string, threshold double",
    )
    return metrics.apply_thresholds(v.scores_tall(spark, d, passes=1), cuts, ["model"]).select(
        "id", "model", "pred"
    )


@query("p14_error_class", f"""WITH {v.SCORES} SELECT id,
  CASE WHEN p = 1 AND y = 0 THEN 'FP' ELSE 'FN' END AS error_class
  FROM (SELECT id, y, CASE WHEN a_mix >= 420 THEN 1 ELSE 0 END AS p FROM scores)
  WHERE p <> y""")
def _(spark, d):
    pred = F.when(F.col("a_mix") >= 420, 1).otherwise(0)
    return v.scores(spark, d).select(
        "id", metrics.error_class(F.col("y"), pred).alias("error_class")
    ).where(F.col("error_class").isNotNull())


@query("p15_membership_filter", """SELECT o_orderkey, o_custkey FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def _(spark, d):
    owing = v.table(spark, d, "customer").where(F.col("c_acctbal") < 0)
    return v.table(spark, d, "orders").join(
        owing.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi"
    ).select("o_orderkey", "o_custkey")


@query("p16_key_normalisation", """SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders""")
def _(spark, d):
    return v.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"))


@query("p17_run_column", f"""WITH {v.TALL} SELECT id, substr(model, 1, 1) AS run,
  substr(model, 3) AS kind, score FROM tall""", "score")
def _(spark, d):
    parts = F.split("model", "_", 2)
    return v.scores_tall(spark, d, passes=1).select(
        "id", F.get(parts, F.lit(0)).alias("run"), F.get(parts, F.lit(1)).alias("kind"), "score"
    )


@query("p18_model_family_map", f"""WITH {v.TALL} SELECT model, CASE
  WHEN model LIKE '%price' THEN 'linear' WHEN model LIKE '%bal' THEN 'tied' ELSE 'mixed' END
  AS family, count(*) AS n FROM tall GROUP BY 1, 2""")
def _(spark, d):
    families = sources.small_table(
        spark, [("price", "linear"), ("bal", "tied"), ("mix", "mixed")],
        "kind string, family string",
    )
    kind = F.regexp_replace("model", "^(a|b)_", "")
    counts = v.scores_tall(spark, d, passes=1).groupBy("model").agg(F.count("*").alias("n"))
    return counts.withColumn("kind", kind).join(F.broadcast(families), "kind").select(
        "model", "family", "n"
    )


@query("p19_replace_column", f"""WITH {v.SCORES} SELECT id, y, a_price,
  CASE WHEN y = 1 THEN b_bal END AS a_bal FROM scores""", "a_price a_bal")
def _(spark, d):
    wide = v.scores(spark, d)
    new = wide.where(F.col("y") == 1).select("id", F.col("b_bal").alias("a_bal"))
    return quality.replace_column(wide.select("id", "y", "a_price", "a_bal"), new, "id", "a_bal")


@query("p22_origin_columns", f"""WITH {PROFILE} SELECT variable FROM profile
  WHERE pct_missing <= 70 AND NOT regexp_matches(variable, '^toxic|_id$')""")
def _(spark, d):
    return profile.select_columns(profiled(spark, d), ["^toxic", "_id$"]).select("variable")


@query("j01_join_to_split", f"""WITH {SPLIT} SELECT split, y, count(*) AS n FROM split
  GROUP BY split, y""")
def _(spark, d):
    df = v.loan(spark, d)
    return sampling.with_split(df, "id", "y").groupBy("split", "y").agg(F.count("*").alias("n"))


@query("j02_aligned_scores", f"""WITH {v.SCORES} SELECT id, y, a_mix, b_mix FROM scores""",
       "a_mix b_mix")
def _(spark, d):
    wide = v.scores(spark, d)
    return wide.select("id", "y", "a_mix").join(wide.select("id", "b_mix"), "id")


@query("j03_widened_scores", f"""WITH {v.TALL} SELECT id,
  max(score) FILTER (model = 'a_price') AS a_price, max(score) FILTER (model = 'a_bal') AS a_bal,
  max(score) FILTER (model = 'a_mix') AS a_mix FROM tall GROUP BY id""", "a_price a_bal a_mix")
def _(spark, d):
    long = v.scores_tall(spark, d, passes=1)
    return long.groupBy("id").agg(*[
        F.max(F.when(F.col("model") == m, F.col("score"))).alias(m)
        for m in ("a_price", "a_bal", "a_mix")
    ])


@query("j04_left_join_patch", f"""WITH {v.MISSING} SELECT id, quality, toxic, lang FROM missing""")
def _(spark, d):
    return v.missing_view(spark, d).select("id", "quality", "toxic", "lang")


@query("j05_mapped_key_join", """SELECT s_name, n_name, r_name FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(spark, d):
    return (
        v.table(spark, d, "supplier")
        .join(v.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(v.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_name", "n_name", "r_name")
    )


@query("j10_score_gap", f"""WITH {v.SCORES} SELECT count(*) AS n, max(abs(a_price - b_price))
  AS max_gap FROM scores""", "max_gap")
def _(spark, d):
    wide = v.scores(spark, d)
    old = wide.select("id", F.col("a_price").alias("old"))
    new = wide.select("id", F.col("b_price").alias("new"))
    return old.join(new, "id").agg(
        F.count("*").alias("n"), F.max(F.abs(F.col("old") - F.col("new"))).alias("max_gap")
    )


@query("u01_append_rows", """SELECT c_name AS name, c_acctbal AS acctbal FROM customer
  UNION ALL SELECT s_name, s_acctbal FROM supplier""")
def _(spark, d):
    a = v.table(spark, d, "customer").select(F.col("c_name").alias("name"),
                                             F.col("c_acctbal").alias("acctbal"))
    b = v.table(spark, d, "supplier").select(F.col("s_name").alias("name"),
                                             F.col("s_acctbal").alias("acctbal"))
    return a.unionByName(b)


@query("u02_same_keys", """SELECT 'same_keys' AS check, n_bad, n_bad = 0 AS passed FROM (
  SELECT (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey
    FROM customer)) + (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT ALL
    SELECT o_custkey FROM orders)) AS n_bad)""")
def _(spark, d):
    a = v.table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    b = v.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return quality.same_keys(a, b, "k")


@query("q01_join_kept_rows", """SELECT 'join_kept_rows' AS check, n_bad, n_bad = 0 AS passed
  FROM (SELECT count(*) AS n_bad FROM
    (SELECT doc_id, count(*) AS a FROM documents GROUP BY doc_id) x FULL JOIN
    (SELECT doc_id, count(*) AS b FROM labels GROUP BY doc_id) y USING (doc_id)
    WHERE coalesce(a, 0) <> 1 OR coalesce(b, 0) <> 1)""")
def _(spark, d):
    return quality.join_kept_rows(
        v.table(spark, d, "documents").select("doc_id"), v.table(spark, d, "labels"), "doc_id"
    )


@query("q02_labels_equal", f"""WITH {v.SCORES} SELECT 'labels_equal' AS check, n_bad,
  n_bad = 0 AS passed FROM (SELECT count(*) FILTER (y <> CASE WHEN a_mix >= 420 THEN 1 ELSE 0
  END) AS n_bad FROM scores)""")
def _(spark, d):
    wide = v.scores(spark, d)
    other = wide.select("id", F.when(F.col("a_mix") >= 420, 1).otherwise(0).alias("y"))
    return quality.labels_equal(wide, other, "id", "y")


@query("q03_same_ids", f"""WITH {v.SCORES}, ids AS (SELECT CAST(o_orderkey AS VARCHAR) AS id
    FROM orders), odd AS ((SELECT id FROM scores EXCEPT ALL SELECT id FROM ids) UNION ALL
    (SELECT id FROM ids EXCEPT ALL SELECT id FROM scores))
  SELECT 'same_keys' AS check, count(*) AS n_bad, count(*) = 0 AS passed FROM odd""")
def _(spark, d):
    wide = v.scores(spark, d)
    loan = v.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    return quality.same_keys(wide, loan, "id")


@query("q04_scores_unchanged", f"""WITH {v.SCORES} SELECT 'scores_unchanged' AS check, n_bad,
  n_bad = 0 AS passed, max_gap FROM (SELECT count(*) FILTER (abs(b_bal - a_bal) >= 1e-9) AS n_bad,
  max(abs(b_bal - a_bal)) AS max_gap FROM scores)""", "max_gap")
def _(spark, d):
    wide = v.scores(spark, d)
    return quality.scores_unchanged(
        wide.select("id", F.col("a_bal").alias("s")), wide.select("id", F.col("b_bal").alias("s")),
        "id", "s",
    )


@query("q05_split_rates", f"""WITH {SPLIT} SELECT split, count(*) AS n, avg(y) * 100 AS rate
  FROM split GROUP BY split""", "rate")
def _(spark, d):
    df = v.loan(spark, d)
    return quality.split_rates(sampling.with_split(df, "id", "y"), "split", "y")


@query("q07_varying_indicators", f"""WITH {v.MISSING}, f AS (SELECT variable, m FROM (
    SELECT CAST(quality IS NULL AS INTEGER) AS quality, CAST(lang IS NULL AS INTEGER) AS lang,
    CAST(toxic IS NULL AS INTEGER) AS toxic FROM missing)
    UNPIVOT (m FOR variable IN (quality, lang, toxic)))
  SELECT variable, CAST(sum(m) AS BIGINT) AS n_missing, min(m) < max(m) AS varies FROM f
  GROUP BY variable""")
def _(spark, d):
    return quality.varying_columns(v.missing_view(spark, d), ["quality", "lang", "toxic"])


@query("c01_text_functions", f"""WITH {v.SCORES} SELECT id,
  printf('[%.4f, %.4f]', a_mix, b_mix) AS interval_text,
  regexp_replace(id || '_spark', '_(sklearn|spark)$', '') AS stripped,
  split_part('sk_' || id, '_', 2) AS tail, replace('nation_ohe_' || id, '_ohe_', '_') AS slot
  FROM scores""")
def _(spark, d):
    i = F.col("id")
    return v.scores(spark, d).select(
        "id", clean.as_interval_text("a_mix", "b_mix").alias("interval_text"),
        F.regexp_replace(F.concat(i, F.lit("_spark")), "_(sklearn|spark)$", "").alias("stripped"),
        F.substring_index(F.concat(F.lit("sk_"), i), "_", -1).alias("tail"),
        F.replace(F.concat(F.lit("nation_ohe_"), i), F.lit("_ohe_"), F.lit("_")).alias("slot"),
    )


@query("p12_positive_class_score", """SELECT CAST(vec_id AS VARCHAR) AS id,
  CAST(embedding[2] AS DOUBLE) AS score FROM embeddings""", "score")
def _(spark, d):
    return v.vectors(spark, d).select("id", vector_to_array("features")[1].alias("score"))


@query("c02_hash_uniform", f"""WITH {v.LOAN} SELECT id, {v.uniform_sql("9")} AS u FROM loan""",
       "u", 9)
def _(spark, d):
    return v.loan(spark, d).select("id", hash_uniform(9, "id").alias("u"))

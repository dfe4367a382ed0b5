"""Counts, summaries, profiles and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.columns import PROFILE, profiled
from riskloom.catalog.registry import query
from riskloom.operators import charts, contingency, metrics, profile, quantiles


@query("a01_row_counts", """SELECT count(*) AS n, CAST(sum(CASE WHEN o_orderpriority = '1-URGENT'
  THEN 1 ELSE 0 END) AS BIGINT) AS n_pos FROM orders""")
def _(spark, d):
    return v.orders(spark, d).agg(F.count("*").alias("n"), F.sum("y").alias("n_pos"))


COUNTS = f"""{v.LOAN_TALL}, vc AS (
  SELECT variable, value, count(*) AS n,
    count(*) / (SELECT count(*) FROM loan)::DOUBLE * 100 AS pct
  FROM ct GROUP BY variable, value)"""


@query("a02_value_counts", f"""WITH {v.MISSING} SELECT 'quality' AS variable,
  CAST(quality AS VARCHAR) AS value, count(*) AS n FROM missing GROUP BY quality
  UNION ALL SELECT 'lang', lang, count(*) FROM missing GROUP BY lang""")
def _(spark, d):
    return profile.value_counts(v.missing_view(spark, d), ["quality", "lang"])


@query("a03_share_of_total", f"WITH {COUNTS} SELECT * FROM vc", "pct")
def _(spark, d):
    df = v.loan(spark, d)
    return profile.with_share(profile.value_counts(df, v.CATEGORIES), df)


RATES = f"""{v.LOAN_TALL}, rates AS (SELECT variable, value, count(*) AS n, avg(y) * 100 AS rate
  FROM ct WHERE value IS NOT NULL GROUP BY variable, value)"""


@query("a04_group_rate", f"WITH {RATES} SELECT * FROM rates", "rate")
def _(spark, d):
    return profile.group_rate(v.loan(spark, d), v.CATEGORIES, "y")


@query("a05_column_profile", f"WITH {PROFILE} SELECT * FROM profile", "pct_missing", 2)
def _(spark, d):
    return profiled(spark, d)


FENCES = f"""{v.LINES_TALL}, q AS (SELECT variable, quantile_cont(value, 0.25) AS q1,
    quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
    FROM lt WHERE value IS NOT NULL GROUP BY variable),
  fen AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
    FROM q)"""


@query("a06_numeric_summary", f"""WITH {FENCES} SELECT variable, avg(value) AS mean,
  any_value(median) AS median, stddev_samp(value) AS sd, min(value) AS min, any_value(q1) AS q1,
  any_value(q3) AS q3, max(value) AS max, any_value(iqr) AS iqr,
  count(*) FILTER (value < lo OR value > hi) AS n_outliers,
  count(*) FILTER (value < lo OR value > hi) / count(value)::DOUBLE * 100 AS pct_outliers,
  skewness(value) AS skewness, count(*) FILTER (value IS NULL) / count(*)::DOUBLE * 100
  AS pct_missing FROM lt JOIN fen USING (variable) GROUP BY variable""",
       "mean median sd q1 q3 iqr pct_outliers skewness pct_missing", 5)
def _(spark, d):
    return profile.numeric_summary(v.lines(spark, d), v.NUMERIC)


@query("a07_describe_all", f"""WITH {FENCES}
  SELECT variable, count(*) AS count, CAST(NULL AS BIGINT) AS unique, NULL::VARCHAR AS top,
    CAST(NULL AS BIGINT) AS freq, avg(value) AS mean, stddev_samp(value) AS sd,
    min(value) AS min, max(value) AS max, any_value(q1) AS p25, any_value(median) AS p50,
    any_value(q3) AS p75 FROM lt JOIN fen USING (variable) WHERE value IS NOT NULL GROUP BY variable
  UNION ALL SELECT variable, CAST(sum(n) AS BIGINT), count(*), max(ROW(n, value))[2], max(n),
    NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM (SELECT 'l_returnflag' AS variable, l_returnflag AS value, count(*) AS n FROM lines
        GROUP BY l_returnflag UNION ALL SELECT 'l_linestatus', l_linestatus, count(*)
        FROM lines GROUP BY l_linestatus) GROUP BY variable""", "mean sd p25 p50 p75", 5)
def _(spark, d):
    return profile.describe_all(
        v.lines(spark, d), v.NUMERIC, ["l_returnflag", "l_linestatus"]
    ).select("variable", "count", "unique", "top", "freq", "mean", "sd", "min", "max",
             "p25", "p50", "p75")


@query("a08_exact_percentiles", f"""WITH {v.LINES_TALL}, p AS (SELECT unnest([0.01, 0.5, 0.99])
    ::DOUBLE AS prob)
  SELECT variable, prob, CASE prob WHEN 0.01 THEN quantile_cont(value, 0.01)
    WHEN 0.5 THEN quantile_cont(value, 0.5) ELSE quantile_cont(value, 0.99) END AS quantile
  FROM lt, p WHERE value IS NOT NULL GROUP BY variable, prob""", "quantile", 5)
def _(spark, d):
    long = profile.tall_numeric(v.lines(spark, d), v.NUMERIC)
    return quantiles.exact_quantiles(long, ["variable"], "value", [0.01, 0.5, 0.99])


@query("a09_categorical_summary", f"""WITH {COUNTS} SELECT variable, count(value) AS n_categories,
  count(*) FILTER (round(pct, 2) < 4.0) AS n_rare,
  coalesce(sum(pct) FILTER (value IS NULL), 0) AS pct_missing,
  max(ROW(n, value))[2] AS top_value, max(pct) AS pct_top FROM vc GROUP BY variable""",
       "pct_missing pct_top")
def _(spark, d):
    return profile.categorical_summary(v.loan(spark, d), v.CATEGORIES, rare_below=4.0)


@query("a10_frequency_table", f"""WITH {COUNTS} SELECT value, n, pct FROM vc
  WHERE variable = 'nation'""", "pct", 3)
def _(spark, d):
    df = v.loan(spark, d)
    return profile.with_share(profile.value_counts(df, ["nation"]), df).select("value", "n", "pct")


@query("a11_rare_count", f"""WITH {COUNTS} SELECT variable, count(*) FILTER (pct < 4.0) AS n_rare
  FROM vc GROUP BY variable""")
def _(spark, d):
    df = v.loan(spark, d)
    shares = profile.with_share(profile.value_counts(df, v.CATEGORIES), df)
    return shares.groupBy("variable").agg(F.count_if(F.col("pct") < 4.0).alias("n_rare"))


@query("a12_crosstab", f"""WITH {v.MISSING} SELECT source, quality, count(*) AS n FROM missing
  WHERE source IS NOT NULL AND quality IS NOT NULL GROUP BY source, quality""")
def _(spark, d):
    return contingency.crosstab(v.missing_view(spark, d), "source", "quality")


@query("a13_class_means", f"""WITH {v.LINES_TALL} SELECT variable, avg(value) FILTER (y = 0)
  AS mean_0, avg(value) FILTER (y = 1) AS mean_1, avg(value) FILTER (y = 1)
  - avg(value) FILTER (y = 0) AS diff FROM lt GROUP BY variable""", "mean_0 mean_1 diff", 5)
def _(spark, d):
    return profile.class_means(v.lines(spark, d), v.NUMERIC, "y")


@query("a14_frequent_values", f"""WITH {COUNTS} SELECT variable, value, n, pct / 100 AS freq
  FROM vc WHERE pct / 100 >= 0.04 AND value IS NOT NULL""", "freq")
def _(spark, d):
    return profile.frequent_values(v.loan(spark, d), v.CATEGORIES, 0.04)


@query("a19_completeness_counts", f"""WITH {PROFILE} SELECT count(*) FILTER (pct_missing = 0)
  AS n_complete, count(*) FILTER (pct_missing > 30) AS n_over_30,
  count(*) FILTER (pct_missing > 70) AS n_over_70 FROM profile""")
def _(spark, d):
    return profile.completeness_counts(profiled(spark, d))


@query("a20_columns_per_type", f"WITH {PROFILE} SELECT dtype, count(*) AS n FROM profile GROUP BY 1")
def _(spark, d):
    return profiled(spark, d).groupBy("dtype").agg(F.count("*").alias("n"))


@query("a23_max_abs_gap", f"""WITH {v.SCORES} SELECT max(abs(a_mix - b_mix)) AS gap
  FROM scores""", "gap")
def _(spark, d):
    return v.scores(spark, d).agg(F.max(F.abs(F.col("a_mix") - F.col("b_mix"))).alias("gap"))


@query("r01_target_bars", """SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y,
  count(*) AS n FROM orders GROUP BY 1""")
def _(spark, d):
    return v.orders(spark, d).groupBy("y").agg(F.count("*").alias("n"))


@query("r02_histogram", f"""WITH {v.LINES_TALL}, r AS (SELECT variable, min(value) AS lo,
    max(value) AS hi FROM lt GROUP BY variable)
  SELECT variable, CAST(CASE WHEN hi > lo THEN least(floor((value - lo) / (hi - lo) * 60), 59)
    ELSE 0 END AS INTEGER) AS bin, count(*) AS n FROM lt JOIN r USING (variable)
  WHERE value IS NOT NULL GROUP BY 1, 2""")
def _(spark, d):
    return charts.histogram(v.lines(spark, d), v.NUMERIC)


@query("r03_box_stats", f"""WITH {FENCES} SELECT variable, any_value(q1) AS q1,
  any_value(median) AS median, any_value(q3) AS q3,
  min(value) FILTER (value BETWEEN lo AND hi) AS whisker_low,
  max(value) FILTER (value BETWEEN lo AND hi) AS whisker_high,
  count(*) FILTER (value < lo OR value > hi) AS n_fliers
  FROM lt JOIN fen USING (variable) WHERE value IS NOT NULL GROUP BY variable""",
       "q1 median q3 whisker_low whisker_high", 5)
def _(spark, d):
    return charts.box_stats(profile.tall_numeric(v.lines(spark, d), v.NUMERIC), ["variable"])


CLIPPED = f"""{v.LOAN}, cl AS (SELECT y, variable, value FROM (SELECT y,
    least(price, (SELECT quantile_cont(price, 0.99) FROM loan)) AS price,
    least(bal, (SELECT quantile_cont(bal, 0.99) FROM loan)) AS bal FROM loan)
    UNPIVOT (value FOR variable IN (price, bal)))"""


def clipped(spark, d):
    df = profile.clip_at_quantile(v.loan(spark, d), ["price", "bal"])
    return profile.tall_numeric(df, ["price", "bal"], ["y"])


@query("r04_box_stats_by_class", f"""WITH {CLIPPED}, q AS (SELECT variable, y,
    quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.75) AS q3 FROM cl GROUP BY variable, y),
  fen AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
  SELECT variable, y, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
    min(value) FILTER (value BETWEEN lo AND hi) AS whisker_low,
    max(value) FILTER (value BETWEEN lo AND hi) AS whisker_high,
    count(*) FILTER (value < lo OR value > hi) AS n_fliers
  FROM cl JOIN fen USING (variable, y) GROUP BY variable, y""",
       "q1 median q3 whisker_low whisker_high", 4)
def _(spark, d):
    return charts.box_stats(clipped(spark, d), ["variable", "y"])


@query("r05_density_by_class", f"""WITH {CLIPPED}, s AS (SELECT variable, y, min(value) AS lo,
    max(value) AS hi, stddev_samp(value) * pow(count(*)::DOUBLE, -0.2) AS h, count(*) AS n
    FROM cl GROUP BY variable, y),
  b AS (SELECT variable, y, least(floor((value - lo) / ((hi - lo) / 256)), 255) AS bin,
    count(*) AS c FROM cl JOIN s USING (variable, y) GROUP BY 1, 2, 3),
  g AS (SELECT CAST(unnest(range(100)) AS INTEGER) AS point)
  SELECT variable, y, point, any_value(lo + point * ((hi - lo) / 99)) AS x,
    sum(exp(-0.5 * pow((lo + point * ((hi - lo) / 99) - (lo + (bin + 0.5) * ((hi - lo) / 256)))
      / h, 2)) / (h * 2.5066282746310002::DOUBLE) * c / n) AS density
  FROM b JOIN s USING (variable, y), g GROUP BY variable, y, point""", "x density", 5)
def _(spark, d):
    return charts.density(clipped(spark, d), ["variable", "y"])


@query("r06_top_shares", f"""WITH {COUNTS} SELECT variable, value, n, pct,
  CAST(row_number() OVER (PARTITION BY variable ORDER BY n DESC, value) AS INTEGER) AS rank FROM vc
  QUALIFY rank <= 15""", "pct")
def _(spark, d):
    df = v.loan(spark, d)
    shares = profile.with_share(profile.value_counts(df, v.CATEGORIES), df)
    return profile.top_per_group(shares, ["variable"], [F.desc("n"), F.asc("value")], 15)


@query("r07_top_rates", f"""WITH {RATES} SELECT variable, value, n, rate,
  CAST(row_number() OVER (PARTITION BY variable ORDER BY rate DESC, value) AS INTEGER) AS rank
  FROM rates QUALIFY rank <= 15""", "rate")
def _(spark, d):
    rates = profile.group_rate(v.loan(spark, d), v.CATEGORIES, "y")
    return profile.top_per_group(rates, ["variable"], [F.desc("rate"), F.asc("value")], 15)


@query("r09_nullity_sample", f"""WITH {v.MISSING} SELECT id,
  CAST(quality IS NULL AS INTEGER) AS quality, CAST(toxic IS NULL AS INTEGER) AS toxic,
  CAST(lang IS NULL AS INTEGER) AS lang FROM missing
  QUALIFY row_number() OVER (ORDER BY md5('42:' || id)) <= 5000""")
def _(spark, d):
    return charts.nullity_sample(v.missing_view(spark, d), "id", ["quality", "toxic", "lang"])


@query("a17_score_diagnostics", f"""WITH {v.TALL}, s AS (SELECT model, score, count(*) AS n
    FROM tall GROUP BY model, score),
  t AS (SELECT model, avg(score) AS mean, stddev_samp(score) AS sd FROM tall GROUP BY model)
  SELECT model, min(score) AS min, max(score) AS max, count(*) AS n_distinct,
    arg_max(n, score) / sum(n)::DOUBLE * 100 AS pct_at_max, any_value(mean) AS mean,
    any_value(sd) AS sd, count(*) = 1 AS constant_score
  FROM s JOIN t USING (model) GROUP BY model""", "min max mean sd pct_at_max", 5)
def _(spark, d):
    return metrics.score_diagnostics(v.scores_tall(spark, d), ["model"])

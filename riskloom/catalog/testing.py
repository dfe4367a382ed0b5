"""Tests of association between variables, target and missingness."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.describing import RATES
from riskloom.catalog.registry import query
from riskloom.operators import association, contingency, normality, profile


def normal_p_sql(z: str) -> str:
    """Two-sided normal tail: 1 - erf(z / sqrt 2) from the series with positive terms."""
    x = f"(({z}) / sqrt(2.0::DOUBLE))"
    terms = (
        f"list_sum(list_transform(range(0, 150), lambda k: "
        f"exp((2 * k + 1) * ln({x}) - lgamma(k + 1.5::DOUBLE) - {x} * {x})))"
    )
    return (f"CASE WHEN ({z}) <= 0 THEN 1.0::DOUBLE WHEN ({z}) > 8 THEN 0.0::DOUBLE "
            f"ELSE 1 - {terms} END")


def chi2_p_sql(x: str, dof: str) -> str:
    """Upper chi-square tail: 1 - P(dof / 2, x / 2) from the series with positive terms."""
    a, h = f"(({dof}) / 2.0::DOUBLE)", f"(({x}) / 2.0::DOUBLE)"
    terms = (
        f"list_sum(list_transform(range(0, 900), lambda k: "
        f"exp(({a} + k) * ln({h}) - {h} - lgamma({a} + k + 1.0::DOUBLE))))"
    )
    return (f"CASE WHEN ({x}) <= 0 THEN 1.0::DOUBLE WHEN ({x}) > 600 THEN 0.0::DOUBLE "
            f"ELSE 1 - {terms} END")


def chi2_sql(counts: str, by: str, a: str, b: str) -> str:
    """CTEs ending in ``chi``: the textbook statistic over the full grid of observed categories."""
    keys = [k.strip() for k in by.split(",")]
    on_a = " AND ".join(f"ra.{k} = cb.{k}" for k in keys)
    on_c = " AND ".join(f"k.{c} = g.{c}" for c in keys)
    return f"""ra AS (SELECT {by}, {a}, sum(n) AS r FROM {counts} GROUP BY {by}, {a}),
cb AS (SELECT {by}, {b}, sum(n) AS c FROM {counts} GROUP BY {by}, {b}),
tot AS (SELECT {by}, sum(n) AS total FROM {counts} GROUP BY {by}),
dims AS (SELECT {by}, (SELECT count(*) FROM ra WHERE {" AND ".join(f"ra.{k} = tot.{k}" for k in keys)}) AS nr,
  (SELECT count(*) FROM cb WHERE {" AND ".join(f"cb.{k} = tot.{k}" for k in keys)}) AS nc, total FROM tot),
grid AS (SELECT {", ".join("ra." + k for k in keys)}, {a}, {b},
  r::DOUBLE * c AS rc FROM ra JOIN cb ON {on_a}),
cell AS (SELECT {", ".join("g." + k for k in keys)}, coalesce(k.n, 0) AS o, rc / total AS e, nr, nc, total
  FROM grid g JOIN dims USING ({by}) LEFT JOIN {counts} k ON {on_c}
    AND k.{a} = g.{a} AND k.{b} = g.{b}),
chi AS (SELECT {by}, CAST(any_value(total) AS BIGINT) AS n, any_value(nr) AS r,
  any_value(nc) AS c, (any_value(nr) - 1) * (any_value(nc) - 1) AS dof,
  sum(CASE WHEN (nr - 1) * (nc - 1) = 1 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e
    ELSE pow(o - e, 2) / e END) AS chi2 FROM cell GROUP BY {by})"""


LOAN_NUM = f"""{v.LOAN}, ln_ AS (SELECT y, variable, value FROM loan
  UNPIVOT (value FOR variable IN (price, bal)))"""
NUMS = ["price", "bal"]

MWU = f"""{v.LINES_TALL}, pts AS (SELECT variable, value, count(*) FILTER (y = 1) AS n1,
    count(*) FILTER (y = 0) AS n0 FROM lt WHERE value IS NOT NULL GROUP BY variable, value),
  below AS (SELECT *, coalesce(sum(n1) OVER (PARTITION BY variable ORDER BY value
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below1 FROM pts),
  s AS (SELECT variable, CAST(sum(n0) AS BIGINT) AS n_0, CAST(sum(n1) AS BIGINT) AS n_1,
    CAST(sum(n0::HUGEINT * (2 * below1 + n1)) AS DOUBLE) / 2 AS u,
    sum(pow((n0 + n1)::DOUBLE, 3) - (n0 + n1)) AS t FROM below GROUP BY variable),
  mw AS (SELECT variable, n_0, n_1, u, (greatest(u, n_0::DOUBLE * n_1 - u)
    - n_0::DOUBLE * n_1 / 2 - 0.5) / sqrt(n_0::DOUBLE * n_1 / 12 * (n_0 + n_1 + 1 - t /
    ((n_0 + n_1)::DOUBLE * (n_0 + n_1 - 1)))) AS z FROM s)"""


@query("t02_mann_whitney", f"""WITH {MWU} SELECT variable, n_0, n_1, u, z,
  {normal_p_sql("z")} AS p_value FROM mw""", "u z p_value")
def _(spark, d):
    return association.with_normal_p(association.mann_whitney(v.lines(spark, d), v.NUMERIC, "y"))


@query("t03_point_biserial", f"""WITH {v.LINES_TALL} SELECT variable, corr(y, value) AS r FROM lt
  GROUP BY variable""", "r")
def _(spark, d):
    return association.point_biserial(v.lines(spark, d), v.NUMERIC, "y")


CHI = f"""{v.LOAN_TALL}, cc AS (SELECT variable, value, y, count(*) AS n FROM ct
  WHERE value IS NOT NULL AND variable <> 'priority' GROUP BY variable, value, y),
{chi2_sql("cc", "variable", "value", "y")}"""


@query("t04_chi_square", f"""WITH {CHI} SELECT variable, n, r, c, dof, chi2,
  {chi2_p_sql("chi2", "dof")} AS p_value FROM chi""", "chi2 p_value")
def _(spark, d):
    return contingency.with_chi2_p(contingency.category_vs_target(
        v.loan(spark, d), ["status", "segment", "nation"], "y"
    ))


@query("t05_rate_extremes", f"""WITH {RATES} SELECT variable, max(ROW(rate, value))[2] AS highest,
  max(rate) AS highest_rate, min(ROW(rate, value))[2] AS lowest, min(rate) AS lowest_rate
  FROM rates GROUP BY variable""", "highest_rate lowest_rate")
def _(spark, d):
    return contingency.rate_extremes(profile.group_rate(v.loan(spark, d), v.CATEGORIES, "y"))


PAIRED = f"""{v.LINES}, fl AS (SELECT l_returnflag AS flag, l_linestatus AS line,
    CASE WHEN l_tax IS NULL THEN 'no' ELSE 'yes' END AS taxed,
    CAST(l_quantity AS VARCHAR) AS qty FROM lines),
  pc AS ({" UNION ALL ".join(
      f"SELECT '{a}' AS var_a, '{b}' AS var_b, {a} AS a, {b} AS b, count(*) AS n FROM fl "
      f"GROUP BY {a}, {b}"
      for a, b in (("flag", "line"), ("flag", "qty"), ("flag", "taxed"), ("line", "qty"),
                   ("line", "taxed"), ("qty", "taxed")))}),
{chi2_sql("pc", "var_a, var_b", "a", "b")}"""


@query("t06_cramers_v", f"""WITH {PAIRED} SELECT var_a, var_b,
  sqrt(chi2 / n / (least(r, c) - 1)) AS cramers_v FROM chi""", "cramers_v")
def _(spark, d):
    flags = v.lines(spark, d).select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line"),
        F.when(F.col("l_tax").isNull(), "no").otherwise("yes").alias("taxed"),
        F.col("l_quantity").cast("string").alias("qty"),
    )
    return contingency.cramers_v(flags, ["flag", "line", "taxed", "qty"])


PEARSON = f"""{v.LINES}, pr AS (SELECT unnest([
  {", ".join(f"ROW('{a}', '{b}', corr({a}, {b}))" for a, b in (
      ("l_discount", "l_extendedprice"), ("l_discount", "l_quantity"), ("l_discount", "l_tax"),
      ("l_extendedprice", "l_quantity"), ("l_extendedprice", "l_tax"), ("l_quantity", "l_tax")))}
  ]) AS p FROM lines), pairs AS (SELECT p[1] AS var_a, p[2] AS var_b, p[3] AS r FROM pr)"""


def pearson(spark, d):
    return association.pearson_pairs(v.lines(spark, d), v.NUMERIC)


@query("t07_pearson_pairs", f"WITH {PEARSON} SELECT * FROM pairs", "r")
def _(spark, d):
    return pearson(spark, d)


STRONG = " UNION ALL ".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, corr({a}, {b}) AS r FROM scores"
    for a, b in combinations(sorted(v.MODELS), 2)
)


@query("t08_strong_pairs", f"""WITH {v.SCORES}, sp AS ({STRONG})
  SELECT * FROM sp WHERE abs(r) > 0.7""", "r")
def _(spark, d):
    pairs = association.pearson_pairs(v.scores(spark, d), v.MODELS)
    return pairs.where(F.abs("r") > 0.7)


@query("r08_correlation_matrix", f"""WITH {PEARSON} SELECT * FROM pairs
  UNION ALL SELECT var_b, var_a, r FROM pairs""", "r")
def _(spark, d):
    return association.mirrored(pearson(spark, d), "var_a", "var_b", {"r": 1})


def gappy(spark, d):
    return v.missing_view(spark, d).withColumn(
        "long_quality", F.when(F.col("n_chars") % 3 > 0, F.col("quality"))
    )


GAPPY = f"""{v.MISSING}, gappy AS (SELECT *, CASE WHEN n_chars % 3 > 0 THEN quality END
  AS long_quality FROM missing)"""


@query("t09_nullity_correlation", f"""WITH {GAPPY}, g AS (SELECT
    CAST(long_quality IS NULL AS INTEGER) AS l, CAST(quality IS NULL AS INTEGER) AS q,
    CAST(toxic IS NULL AS INTEGER) AS t FROM gappy)
  SELECT 'long_quality' AS var_a, 'quality' AS var_b, corr(l, q) AS r FROM g UNION ALL
  SELECT 'long_quality', 'toxic', corr(l, t) FROM g UNION ALL
  SELECT 'quality', 'toxic', corr(q, t) FROM g""", "r")
def _(spark, d):
    return association.nullity_correlation(
        gappy(spark, d), ["quality", "toxic", "long_quality", "lang"]
    )


MISS_TARGET = f"""{GAPPY}, fl AS (SELECT y, variable, m FROM (SELECT y,
    CAST(quality IS NULL AS INTEGER) AS quality, CAST(lang IS NULL AS INTEGER) AS lang,
    CAST(long_quality IS NULL AS INTEGER) AS long_quality FROM gappy)
    UNPIVOT (m FOR variable IN (quality, lang, long_quality))),
  mc AS (SELECT variable, m, y, count(*) AS n FROM fl WHERE variable <> 'lang'
    GROUP BY variable, m, y),
{chi2_sql("mc", "variable", "m", "y")},
  rates AS (SELECT variable, avg(m) * 100 AS pct_missing, avg(y) FILTER (m = 1) * 100
    AS rate_if_missing, avg(y) FILTER (m = 0) * 100 AS rate_if_present FROM fl GROUP BY variable)"""


@query("t10_missingness_vs_target", f"""WITH {MISS_TARGET} SELECT variable, pct_missing, chi2, dof,
  rate_if_missing, rate_if_present FROM chi JOIN rates USING (variable)
  WHERE pct_missing > 0.5 AND pct_missing < 99""",
       "pct_missing chi2 rate_if_missing rate_if_present")
def _(spark, d):
    return contingency.missingness_vs_target(
        gappy(spark, d), ["quality", "lang", "long_quality"], "y"
    )


def poly_sql(coefficients, x: str) -> str:
    out = f"{coefficients[-1]!r}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        out = f"({out} * ({x}) + ({c!r}::DOUBLE))"
    return out


def normal_quantile_sql(p: str) -> str:
    """The same rational approximation from the same fixed values."""
    q, far = f"(({p}) - 0.5::DOUBLE)", f"sqrt(-ln(least({p}, 1.0::DOUBLE - ({p}))))"
    part = lambda pair, x: f"{poly_sql(pair[0], x)} / {poly_sql(pair[1], x)}"
    return (f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {part(normality.MIDDLE, f'(0.180625::DOUBLE - {q} * {q})')} "
            f"ELSE sign({q}) * CASE WHEN {far} <= 5.0 THEN {part(normality.TAIL, f'({far} - 1.6::DOUBLE)')} "
            f"ELSE {part(normality.FAR, f'({far} - 5.0::DOUBLE)')} END END")


SHAPIRO = f"""{v.LOAN}, picked AS (SELECT variable, value FROM (SELECT id, price, bal FROM loan)
    UNPIVOT (value FOR variable IN (price, bal)) WHERE value IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY variable ORDER BY md5('42:' || id)) <= 5000),
placed AS (SELECT variable, value, count(*) OVER (PARTITION BY variable) AS n,
    row_number() OVER (PARTITION BY variable ORDER BY value) AS i FROM picked),
quants AS (SELECT *, {normal_quantile_sql("(i - 0.375::DOUBLE) / (n + 0.25::DOUBLE)")} AS m FROM placed),
sums AS (SELECT variable, any_value(n) AS n, 1.0::DOUBLE / sqrt(any_value(n)) AS u, sum(m * m) AS ssq,
    max(m) AS m1, max(m) FILTER (i = n - 1) AS m2,
    sum(m * value) FILTER (i > 2 AND i < n - 1) AS mx, max(value) - min(value) AS span,
    max(value) FILTER (i = n - 1) - max(value) FILTER (i = 2) AS inner_span, var_pop(value) * count(*) AS ss
  FROM quants GROUP BY variable),
ends AS (SELECT *, m1 / sqrt(ssq) + {poly_sql(normality.LAST_WEIGHT, "u")} AS a1,
    m2 / sqrt(ssq) + {poly_sql(normality.SECOND_WEIGHT, "u")} AS a2 FROM sums),
stat AS (SELECT variable, n, ln(n) AS ln_n, least(1.0::DOUBLE, pow(mx / sqrt((ssq - 2 * m1 * m1 - 2 * m2 * m2)
    / (1 - 2 * a1 * a1 - 2 * a2 * a2)) + a1 * span + a2 * inner_span, 2) / ss) AS w FROM ends),
zs AS (SELECT variable, n, w, (ln(greatest(1 - w, 1e-19)) - {poly_sql(normality.LARGE_MEAN, "ln_n")})
    / exp({poly_sql(normality.LARGE_LOG_SD, "ln_n")}) AS z FROM stat)"""


@query("t01_shapiro_wilk", f"""WITH {SHAPIRO} SELECT variable, n, w, CASE WHEN z >= 0
    THEN {normal_p_sql("abs(z)")} / 2 ELSE 1 - {normal_p_sql("abs(z)")} / 2 END AS p_value FROM zs""", "w p_value", 7)
def _(spark, d):
    return normality.shapiro_wilk(v.loan(spark, d), "id", ["price", "bal"])

"""Paired comparison of models: DeLong, McNemar, bootstrap, Holm."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import sources
from riskloom.catalog import views as v
from riskloom.catalog.registry import query
from riskloom.catalog.testing import CHI, chi2_p_sql, normal_p_sql
from riskloom.operators import (
    agreement, association, bootstrap, contingency, delong, mcnemar, metrics, multiple,
)
from riskloom.session import materialize

MODELS = list(v.MODELS)


def model_table(spark, models=MODELS):
    return sources.small_table(
        spark, [(m, m[0], m[2:]) for m in models], "model string, run string, kind string"
    )


def covariance(spark, d):
    return delong.covariance(v.scores_tall(spark, d), MODELS)


def families(spark, d):
    return delong.compare_families(covariance(spark, d), delong.comparison_table(model_table(spark)))


def comparisons_sql(models) -> str:
    return f"""names AS (SELECT unnest({list(models)}) AS model), comparisons AS (
  SELECT CASE WHEN a.model[1] = b.model[1] THEN 'within_' || a.model[1] ELSE 'across' END AS family,
    a.model AS model_a, b.model AS model_b FROM names a JOIN names b ON a.model < b.model
  WHERE a.model[1] = b.model[1] OR substr(a.model, 3) = substr(b.model, 3))"""


COMPARISONS = comparisons_sql(MODELS)
CATEGORY_PAIRS = """kinds AS (SELECT DISTINCT o_orderstatus || '/' || o_orderpriority AS model,
    o_orderstatus AS run, o_orderpriority AS kind FROM orders),
  pairs AS (SELECT a.model AS model_a, b.model AS model_b, a.run = b.run AS within,
    a.kind = b.kind AND a.run < b.run AS across FROM kinds a JOIN kinds b ON a.model < b.model
    OR a.kind = b.kind AND a.run < b.run)"""


def found_kinds(spark, d):
    """Which status and priority classes of orders there are, as runs and kinds to be compared."""
    rows = v.table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()
    return rows.select(F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("model"),
                       F.col("o_orderstatus").alias("run"), F.col("o_orderpriority").alias("kind"))


@query("j06_unordered_pairs", f"""WITH {CATEGORY_PAIRS} SELECT model_a, model_b FROM pairs
  WHERE within AND model_a < model_b""")
def _(spark, d):
    table = delong.comparison_table(found_kinds(spark, d))
    return table.where(F.col("family") != "across").select("model_a", "model_b")


@query("j07_cross_run_pairs", f"""WITH {CATEGORY_PAIRS} SELECT model_a, model_b FROM pairs
  WHERE across""")
def _(spark, d):
    table = delong.comparison_table(found_kinds(spark, d))
    return table.where(F.col("family") == "across").select("model_a", "model_b")


@query("j08_pairwise_kernel", f"""WITH {v.SCORES} SELECT a.id, a.y, avg(CASE
    WHEN a.y = 1 AND a.a_bal > b.a_bal THEN 1.0::DOUBLE
    WHEN a.y = 0 AND a.a_bal < b.a_bal THEN 1.0::DOUBLE
    WHEN a.a_bal = b.a_bal THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) AS v
  FROM scores a JOIN scores b ON a.y <> b.y GROUP BY a.id, a.y""", "v", 8)
def _(spark, d):
    long = metrics.long_scores(v.stored_scores(spark, d), "id", "y", {"a_bal": "a_bal"})
    return delong.components(long).select("id", "y", "v")


@query("t11_delong_covariance", f"""WITH {v.DELONG} SELECT model_a, model_b, cov * 1e6 AS cov,
  auc_a, auc_b FROM cov WHERE list_position({MODELS}, model_a) <= list_position({MODELS}, model_b)""",
       "cov auc_a auc_b", 8)
def _(spark, d):
    return covariance(spark, d).select(
        "model_a", "model_b", (F.col("cov") * 1e6).alias("cov"), "auc_a", "auc_b"
    )


@query("t12_single_auc_variance", f"""WITH {v.DELONG} SELECT model_a AS model, auc_a AS auc,
  cov AS var, auc_a - 1.96::DOUBLE * sqrt(cov) AS ci_low,
  auc_a + 1.96::DOUBLE * sqrt(cov) AS ci_high FROM cov
  WHERE model_a = model_b AND model_a = 'a_mix'""", "auc var ci_low ci_high", 9)
def _(spark, d):
    one = metrics.long_scores(v.stored_scores(spark, d), "id", "y", {"a_mix": "a_mix"})
    return delong.auc_intervals(delong.covariance(one, ["a_mix"]))


TESTS_BODY = f"""t0 AS (SELECT family, c.model_a, c.model_b,
    va.auc_a AS auc_a, vb.auc_a AS auc_b, va.cov AS var_a, vb.cov AS var_b,
    va.auc_a - vb.auc_a AS delta_auc, sqrt(greatest(va.cov + vb.cov - 2 * ab.cov, 0)) AS se_delta
  FROM comparisons c JOIN cov ab ON ab.model_a = c.model_a AND ab.model_b = c.model_b
  JOIN cov va ON va.model_a = c.model_a AND va.model_b = c.model_a
  JOIN cov vb ON vb.model_a = c.model_b AND vb.model_b = c.model_b),
t1 AS (SELECT *, CASE WHEN se_delta > 0 THEN delta_auc / se_delta ELSE 0 END AS z FROM t0),
t2 AS (SELECT *, {normal_p_sql("abs(z)")} AS p_value FROM t1),
t3 AS (SELECT *, (count(*) OVER (PARTITION BY family) - row_number() OVER (PARTITION BY family
    ORDER BY p_value, abs(z) DESC) + 1) * p_value AS step, row_number() OVER (PARTITION BY family
    ORDER BY p_value, abs(z) DESC) AS pos FROM t2),
t4 AS (SELECT *, least(1.0::DOUBLE, max(step) OVER (PARTITION BY family ORDER BY pos)) AS p_holm
  FROM t3)"""
TESTS = f"{v.DELONG}, {COMPARISONS}, {TESTS_BODY}"
TEST_COLUMNS = """family, model_a, model_b, auc_a, auc_a - 1.96::DOUBLE * sqrt(var_a)
  AS auc_a_ci_low, auc_a + 1.96::DOUBLE * sqrt(var_a) AS auc_a_ci_high, auc_b,
  auc_b - 1.96::DOUBLE * sqrt(var_b) AS auc_b_ci_low,
  auc_b + 1.96::DOUBLE * sqrt(var_b) AS auc_b_ci_high, delta_auc,
  delta_auc - 1.96::DOUBLE * se_delta AS delta_ci_low,
  delta_auc + 1.96::DOUBLE * se_delta AS delta_ci_high, se_delta, z, p_value"""
TEST_DOUBLES = ("auc_a auc_a_ci_low auc_a_ci_high auc_b auc_b_ci_low auc_b_ci_high delta_auc "
                "delta_ci_low delta_ci_high se_delta z p_value")


@query("t13_delong_paired_test", f"WITH {TESTS} SELECT {TEST_COLUMNS} FROM t4", TEST_DOUBLES)
def _(spark, d):
    return delong.paired_tests(covariance(spark, d), delong.comparison_table(model_table(spark)))


@query("t14_comparison_families", f"""WITH {TESTS} SELECT {TEST_COLUMNS}, p_holm,
  p_holm < 0.05 AS reject, abs(delta_auc) >= 0.005 AS practical FROM t4""",
       TEST_DOUBLES + " p_holm")
def _(spark, d):
    return families(spark, d)


@query("p20_practical_flag", f"""WITH {TESTS} SELECT family, model_a, model_b,
  abs(delta_auc) >= 0.005 AS practical FROM t4""")
def _(spark, d):
    return families(spark, d).select("family", "model_a", "model_b", "practical")


@query("t21_practical_winner", f"""WITH {TESTS} SELECT model_a, model_b, delta_auc, CASE
  WHEN abs(delta_auc) < 0.005 THEN 'tie' WHEN delta_auc > 0 THEN model_a ELSE model_b END AS winner
  FROM t4 WHERE family = 'across'""", "delta_auc")
def _(spark, d):
    across = families(spark, d).where(F.col("family") == "across")
    return delong.winners(across).select("model_a", "model_b", "delta_auc", "winner")


@query("r11_delta_matrix", f"""WITH {TESTS}, m AS (SELECT model_a, model_b, delta_auc, p_holm FROM t4
    WHERE family = 'within_a')
  SELECT * FROM m UNION ALL SELECT model_b, model_a, -delta_auc, p_holm FROM m""",
       "delta_auc p_holm")
def _(spark, d):
    m = families(spark, d).where(F.col("family") == "within_a")
    return association.mirrored(m, "model_a", "model_b", {"delta_auc": -1, "p_holm": 1})


@query("r12_delta_intervals", f"""WITH {TESTS} SELECT substr(model_a, 3) AS kind, delta_auc,
  delta_auc - 1.96::DOUBLE * se_delta AS delta_ci_low,
  delta_auc + 1.96::DOUBLE * se_delta AS delta_ci_high, abs(delta_auc) >= 0.005 AS practical
  FROM t4 WHERE family = 'across'""", "delta_auc delta_ci_low delta_ci_high")
def _(spark, d):
    return families(spark, d).where(F.col("family") == "across").select(
        F.expr("substr(model_a, 3)").alias("kind"), "delta_auc", "delta_ci_low",
        "delta_ci_high", "practical",
    )


@query("j09_oriented_lookup", f"""WITH {TESTS} SELECT model_b AS model_a, model_a AS model_b,
  -delta_auc AS delta_auc, p_holm, p_holm < 0.05 AS reject FROM t4""", "delta_auc p_holm")
def _(spark, d):
    # The tests are read twice here: a few rows, but all contributions to the areas behind them.
    tests = materialize(families(spark, d))
    asked = tests.select(F.col("model_b").alias("model_a"), F.col("model_a").alias("model_b"))
    return agreement.oriented(tests, asked)


HOLM = f"""{CHI}, hp AS (SELECT variable, {chi2_p_sql("chi2", "dof")} AS p_value FROM chi),
h1 AS (SELECT *, row_number() OVER (ORDER BY p_value, variable) AS pos, count(*) OVER () AS m
  FROM hp), h2 AS (SELECT *, least(1.0::DOUBLE, max((m - pos + 1) * p_value) OVER (ORDER BY pos))
  AS p_holm FROM h1)"""


@query("t15_holm", f"""WITH {HOLM} SELECT variable, p_value, p_holm, p_holm < 0.05 AS reject
  FROM h2""", "p_value p_holm")
def _(spark, d):
    tests = contingency.with_chi2_p(contingency.category_vs_target(
        v.loan(spark, d), ["status", "segment", "nation"], "y"
    )).withColumn("family", F.lit("category"))
    return multiple.holm(tests, ["family"], "p_value", ["variable"]).select(
        "variable", "p_value", "p_holm", "reject"
    )


@query("w03_running_maximum", f"WITH {HOLM} SELECT variable, p_holm FROM h2", "p_holm")
def _(spark, d):
    tests = contingency.with_chi2_p(contingency.category_vs_target(
        v.loan(spark, d), ["status", "segment", "nation"], "y"
    )).withColumn("family", F.lit("category"))
    return multiple.holm(tests, ["family"], "p_value", ["variable"]).select("variable", "p_holm")


class Study:
    """The test set, the cuts fitted on the training set, and the comparisons: every kind across the runs,
    and the two models of largest test area in each run."""

    def __init__(self, spark, d):
        rows, models = v.study(spark, d), list(v.STUDY_MODELS)
        by_part = {p: rows.where(F.col("part") == p) for p in ("train", "test")}
        tall = {p: metrics.long_scores(t, "id", "y", {m: m for m in models}) for p, t in by_part.items()}
        self.test, self.tall = by_part["test"], tall["test"]
        self.cuts = metrics.as_dict(metrics.youden_thresholds(tall["train"], ["model"]), "model", "threshold")
        areas = metrics.as_dict(metrics.auc(self.tall, ["model"]), "model", "auc")
        self.pairs = [("across", f"a_{k}", f"b_{k}") for k in v.STUDY_KINDS]
        for run in "ab":
            best = sorted((m for m in models if m[0] == run), key=lambda m: (-areas[m], m))
            self.pairs.append((f"top2_{run}", *best[:2]))

    def concordance(self):
        return mcnemar.concordance(self.test, "y", self.cuts, self.pairs)

    def mcnemar(self):
        return mcnemar.with_mcnemar_p(mcnemar.mcnemar(self.concordance()))

    def mcnemar_family(self):
        tests = self.mcnemar().withColumn("family", F.lit("all"))
        return multiple.holm(tests, ["family"], "p_value", ["model_a", "model_b"])

    def replicates(self):
        return bootstrap.replicate_metrics(self.test, "id", "y", self.cuts, REPLICATES)

    def covariance(self):
        return delong.covariance(self.tall, list(v.STUDY_MODELS))


EXACT_P = """least(1.0::DOUBLE, 2 * list_sum(list_transform(range(0, CAST(statistic AS BIGINT) + 1), lambda i:
  exp(lgamma(discordant + 1.0::DOUBLE) - lgamma(i + 1.0::DOUBLE) - lgamma(discordant - i + 1.0::DOUBLE) - discordant * ln(2.0::DOUBLE)))))"""
MCN = f"""{v.STUDY}, verdicts AS (SELECT id, model, threshold, (score >= threshold)::INTEGER = y AS ok
  FROM tall JOIN cuts USING (model)),
t AS (SELECT kind, model_a, model_b, any_value(a.threshold) AS threshold_a, any_value(b.threshold) AS threshold_b,
    count(*) FILTER (a.ok AND b.ok) AS n11, count(*) FILTER (a.ok AND NOT b.ok) AS n10,
    count(*) FILTER (NOT a.ok AND b.ok) AS n01, count(*) FILTER (NOT a.ok AND NOT b.ok) AS n00
  FROM pairs JOIN verdicts a ON a.model = model_a JOIN verdicts b ON b.model = model_b AND b.id = a.id
  GROUP BY kind, model_a, model_b),
mcn AS (SELECT *,
  (n01 + n00) / (n11 + n10 + n01 + n00)::DOUBLE AS error_a,
  (n10 + n00) / (n11 + n10 + n01 + n00)::DOUBLE AS error_b,
  n10 + n01 AS discordant, n10 + n01 < 25 AS exact,
  CASE WHEN n10 + n01 < 25 THEN least(n10, n01)::DOUBLE
    ELSE pow(abs(n10 - n01) - 1, 2) / (n10 + n01)::DOUBLE END AS statistic FROM t),
m1 AS (SELECT *, CASE WHEN exact THEN {EXACT_P} ELSE {chi2_p_sql("statistic", "1")} END AS p_value FROM mcn),
m2 AS (SELECT *, row_number() OVER (ORDER BY p_value, model_a, model_b) AS pos, count(*) OVER () AS m FROM m1),
m3 AS (SELECT *, least(1.0::DOUBLE, max((m - pos + 1) * p_value) OVER (ORDER BY pos)) AS p_holm FROM m2)"""


@query("a22_concordance_table", f"""WITH {MCN} SELECT kind, model_a, model_b, threshold_a,
  threshold_b, n11, n10, n01, n00, error_a, error_b FROM mcn""",
       "threshold_a threshold_b error_a error_b")
def _(spark, d):
    return Study(spark, d).concordance()


@query("t16_mcnemar", f"""WITH {MCN} SELECT * FROM m1""",
       "threshold_a threshold_b error_a error_b statistic p_value")
def _(spark, d):
    return Study(spark, d).mcnemar()


@query("t17_mcnemar_family", f"""WITH {MCN} SELECT kind, model_a, model_b, discordant, exact,
  statistic, p_value, p_holm, p_holm < 0.05 AS reject FROM m3""", "statistic p_value p_holm")
def _(spark, d):
    return Study(spark, d).mcnemar_family().select(
        "kind", "model_a", "model_b", "discordant", "exact", "statistic", "p_value", "p_holm",
        "reject",
    )


REPLICATES = 2000


def mix_sql(value: str, name: str) -> str:
    """Columns ``name1`` to ``name5``: the steps of the finisher of 32-bit words; the last is its value."""
    one, two = bootstrap.MIX
    word = "4294967295::UBIGINT"
    return (f"xor({value}, ({value}) // 65536) AS {name}1, ({name}1 * {one}::UBIGINT) & {word} AS {name}2, "
            f"xor({name}2, {name}2 // 32768) AS {name}3, ({name}3 * {two}::UBIGINT) & {word} AS {name}4, "
            f"xor({name}4, {name}4 // 65536) AS {name}5")


#: CTEs from the test set to ``bm``: the metrics of every replicate and model.
BOOT = f"""{v.STUDY},
reps AS (SELECT r AS rep, {mix_sql(f"((r * {bootstrap.GOLDEN} + 1) % 4294967296)::UBIGINT", "x")}
  FROM (SELECT unnest(range({REPLICATES})) AS r)),
words AS (SELECT id, y, CAST('0x' || substr(h, 1, 8) AS UBIGINT) AS a, CAST('0x' || substr(h, 9, 8) AS UBIGINT) AS b
  FROM (SELECT id, y, md5('42:' || id) AS h FROM study WHERE part = 'test')),
first AS (SELECT rep, id, b, {mix_sql("xor(a, x5)", "f")} FROM words, reps),
draws AS (SELECT rep, id, {mix_sql("((f5 + b) & 4294967295::UBIGINT)", "g")} FROM first),
weights AS (SELECT rep, id, CAST({" + ".join(f"(g5 >= {s})::INTEGER" for s in bootstrap.STEPS)} AS INTEGER) AS w FROM draws
  UNION ALL SELECT -1, id, 1 FROM words),
bt AS (SELECT rep, model, score, sum(w * y) AS n_pos, sum(w * (1 - y)) AS n_neg
  FROM tall JOIN weights USING (id) WHERE w > 0 GROUP BY rep, model, score),
bp AS (SELECT *, sum(n_pos) OVER (PARTITION BY rep, model) AS p, sum(n_neg) OVER (PARTITION BY rep, model) AS n,
    sum(n_pos) OVER w - n_pos AS pos_below, sum(n_neg) OVER w - n_neg AS neg_below
  FROM bt WINDOW w AS (PARTITION BY rep, model ORDER BY score)),
bm AS (SELECT rep, model, CAST(sum(n_pos * (2 * neg_below + n_neg)) AS DOUBLE)
    / (2.0::DOUBLE * any_value(p) * any_value(n)) AS auc,
  sum(n_pos / p::DOUBLE * (p - pos_below)::DOUBLE / (p - pos_below + n - neg_below)::DOUBLE)
    AS average_precision,
  2.0::DOUBLE * sum(CASE WHEN score >= threshold THEN n_pos ELSE 0 END) / (any_value(p)
    + sum(CASE WHEN score >= threshold THEN n_pos + n_neg ELSE 0 END))::DOUBLE AS f1
  FROM bp JOIN cuts USING (model) WHERE p > 0 AND n > 0 GROUP BY rep, model)"""


def intervals_sql() -> str:
    parts = []
    for k in bootstrap.METRICS:
        gap = f"(x.{k} - z.{k})"
        parts.append(
            f"max({gap}) FILTER (x.rep = -1) AS delta_{k}, "
            f"quantile_cont({gap}, 0.025) FILTER (x.rep >= 0) AS {k}_ci_low, "
            f"quantile_cont({gap}, 0.975) FILTER (x.rep >= 0) AS {k}_ci_high"
        )
    return (f"bi AS (SELECT kind, model_a, model_b, {', '.join(parts)}, count(*) FILTER (x.rep >= 0) AS n_replicates "
            f"FROM pairs JOIN bm x ON x.model = model_a JOIN bm z ON z.model = model_b AND z.rep = x.rep "
            f"GROUP BY kind, model_a, model_b)")


@query("t18_bootstrap_replicates", f"""WITH {BOOT} SELECT CAST(rep AS INTEGER) AS rep, model, auc,
  average_precision, f1 FROM bm""", "auc average_precision f1", 8)
def _(spark, d):
    return Study(spark, d).replicates()


@query("t18_paired_bootstrap", f"""WITH {BOOT}, {intervals_sql()} SELECT *, {", ".join(
    f"NOT ({k}_ci_low <= 0 AND {k}_ci_high >= 0) AS {k}_excludes_zero" for k in bootstrap.METRICS)}
  FROM bi""", " ".join(f"delta_{k} {k}_ci_low {k}_ci_high" for k in bootstrap.METRICS))
def _(spark, d):
    study = Study(spark, d)
    return bootstrap.paired_intervals(study.replicates(), study.pairs)


@query("t19_variance_ratio", f"""WITH {BOOT}, {v.DELONG_BODY}
  SELECT b.model, var_samp(b.auc) * 1e6 AS var_bootstrap, any_value(cov) * 1e6 AS var_analytic,
    var_samp(b.auc) / any_value(cov) AS ratio
  FROM bm b JOIN cov ON cov.model_a = b.model AND cov.model_b = b.model WHERE b.rep >= 0
  GROUP BY b.model""", "var_bootstrap var_analytic ratio")
def _(spark, d):
    study = Study(spark, d)
    intervals = delong.auc_intervals(study.covariance())
    return bootstrap.variance_check(study.replicates(), intervals).select(
        "model", (F.col("var_bootstrap") * 1e6).alias("var_bootstrap"),
        (F.col("var_analytic") * 1e6).alias("var_analytic"), "ratio",
    )


THREE = f"""{BOOT}, {intervals_sql()}, {v.DELONG_BODY}, {comparisons_sql(v.STUDY_MODELS)}, {TESTS_BODY},
{MCN[len(v.STUDY) + 2:]}"""


@query("t20_three_tests", f"""WITH {THREE}
  SELECT m.kind, m.model_a, m.model_b,
    CASE WHEN t4.model_a = m.model_a THEN t4.delta_auc ELSE -t4.delta_auc END AS delong_delta_auc,
    t4.p_holm < 0.05 AS delong_reject, abs(t4.delta_auc) >= 0.005 AS delong_practical,
    m.p_holm < 0.05 AS mcnemar_reject, bi.delta_auc AS bootstrap_delta_auc,
    printf('[%.4f, %.4f]', bi.auc_ci_low, bi.auc_ci_high) AS bootstrap_ci,
    NOT (bi.auc_ci_low <= 0 AND bi.auc_ci_high >= 0) AS bootstrap_excludes_zero,
    t4.p_holm < 0.05 AND m.p_holm < 0.05 AND NOT (bi.auc_ci_low <= 0 AND bi.auc_ci_high >= 0)
      AS all_agree
  FROM m3 m JOIN bi ON bi.model_a = m.model_a AND bi.model_b = m.model_b
  JOIN t4 ON least(t4.model_a, t4.model_b) = least(m.model_a, m.model_b)
    AND greatest(t4.model_a, t4.model_b) = greatest(m.model_a, m.model_b)""",
       "delong_delta_auc bootstrap_delta_auc")
def _(spark, d):
    study = Study(spark, d)
    tests = delong.compare_families(
        study.covariance(), delong.comparison_table(model_table(spark, v.STUDY_MODELS))
    )
    intervals = bootstrap.paired_intervals(study.replicates(), study.pairs)
    return agreement.three_test_table(tests, study.mcnemar_family(), intervals)

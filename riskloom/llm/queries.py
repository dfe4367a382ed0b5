"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    chat, decontaminate, hard_negatives, language, licenses, line_quality, near_dedup, neighbours, pages, periodic,
    pieces, repeats, sharding,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, "text", "ids", round_trip="round_trip")
    return found.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                        "ids", "round_trip")


@_query
def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_passages(_table(spark, sf_dir, "documents"))
    covered = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + x[1] - x[0])
    return found.select(
        F.col("doc").alias("doc_id"), F.size("spans").cast("long").alias("n_spans"),
        covered("spans").alias("n_repeated"), covered("later").alias("n_later"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x[0].cast("string"), x[1].cast("string"))),
                     ",").alias("spans"))


ORACLE["op2_repeated_passages"] = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
r AS (
  SELECT doc_id, p - 1 AS p, md5(array_to_string(w[p:p + 49], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)),
f AS (
  SELECT s, min({'d': doc_id, 'p': p}) AS first FROM r GROUP BY s HAVING count(DISTINCT doc_id) > 1),
x AS (SELECT doc_id, p, {'d': doc_id, 'p': p} <> first AS later FROM r JOIN f USING (s)),
e AS (
  SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q,
    lag(p) OVER (PARTITION BY doc_id, later ORDER BY p) AS ql FROM x),
g AS (
  SELECT *, sum(CASE WHEN p - q <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS k,
    CASE WHEN ql IS NULL THEN 50 ELSE least(50, p - ql) END AS more FROM e),
spans AS (
  SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM g GROUP BY doc_id, k),
total AS (
  SELECT doc_id, CAST(sum(CASE WHEN later THEN more ELSE 0 END) AS BIGINT) AS n_later FROM g GROUP BY doc_id)
SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_repeated, any_value(n_later) AS n_later,
  string_agg(a || '-' || b, ',' ORDER BY a) AS spans
FROM spans JOIN total USING (doc_id) GROUP BY doc_id
"""


@_query
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.pmod("vec_id", F.lit(20)) == 0)


@_query
def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    found = sharding.shards(docs, ["doc_id", "size", "text_crc32"], 8)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@_query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


@_query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    own = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, '{own}' AS text "
                     f"UNION ALL SELECT -1L, 1L, 'assistant', '{own}'")
    found = chat.conversations(chat.turns(rows.unionAll(more)))
    read = found.select(F.col("tree").alias("conv_id"), chat.read_turns(F.col("formatted")).alias("turns"),
                        chat.read_loss(F.col("formatted"), F.col("loss")).alias("said"), "formatted")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("said").cast("long").alias("loss_chars"), F.sha2("said", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE["op6_chat"] = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '[', '&#91;'), '<', '&lt;')) AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(n + length(role) + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@_query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


ORACLE["op8_near_dedup"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4
    THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2),
      lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w WHERE w IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s
    AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS v, doc_id AS r FROM documents
  UNION SELECT reach.v, link.b FROM reach JOIN link ON link.a = reach.r),
root AS (SELECT v, min(r) AS r FROM reach GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, root.r AS component_id, d.doc_id = root.r AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN root ON root.v = d.doc_id
"""


@_query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find(_table(spark, sf_dir, "documents"))


ORACLE["op9_licenses"] = """
WITH t AS (
  SELECT template, list_filter(string_split_regex(lower(text), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
    lambda x: x <> '') AS w FROM (VALUES """ + ", ".join(
    "('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.TEMPLATES.items()) + """) AS v(template, text)),
ts AS (
  SELECT template, len(w) - 4 AS n, list_distinct(list_transform(range(1, len(w) - 3),
    lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM t),
tp AS (SELECT *, n + (n + 5) // 2 AS width, (n + 5) // 2 + 1 AS stride, len(s) AS size FROM ts),
d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
    lambda x: x <> '') AS w FROM (SELECT DISTINCT doc_id, text FROM documents)),
r AS (
  SELECT doc_id, p - 1 AS p, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d)),
h AS (SELECT doc_id, p, r.s, template, width, stride, size FROM r JOIN (
  SELECT template, width, stride, size, unnest(s) AS s FROM tp) x ON r.s = x.s),
k AS (
  SELECT doc_id, template, stride, size, k, count(DISTINCT s) AS c FROM (
    SELECT *, unnest(range(greatest(0, CAST(floor((p - width) / stride) AS BIGINT) + 1), p // stride + 1)) AS k FROM h)
  GROUP BY doc_id, template, stride, size, k)
SELECT doc_id, template, max(c / size) AS containment, min(k * stride) AS first_word, count(*) AS n_windows
FROM k WHERE c / size >= 0.8 GROUP BY doc_id, template
"""


@_query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


def is_contaminated() -> Column:
    return F.expr("n_hit > 0 AND 20 * n_hit >= n_words")


ORACLE["op10_decontaminate"] = """
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS p FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
run AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d CROSS JOIN size)),
m AS (SELECT DISTINCT doc_id, item_id, run.n, p FROM run JOIN win ON run.n = win.n AND run.s = win.s),
hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""


@_query
def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def every_tenth_repeats(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts whose hash ends in 0 the words from some word on repeat a stretch 3 to 10 times."""
    g = h // 10
    a = np.where((h % 10 == 0) & (n > 0), g % np.maximum(n, 1), n)
    return a, 1 + (n - a) // (3 + g % 8)


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(1))
    found = periodic.periodic_runs(_table(spark, sf_dir, "documents"), h, every_tenth_repeats)
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS less, r.start AS start, r.period AS period)))")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("most"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("most.start").alias("start"), (-F.col("most.less")).alias("length"),
        F.col("most.period").alias("period"),
        F.expr("-1000 * most.less div most.period").cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


#: A run of period q repeats its stretches of 5 words q words on, at 3 q places or more.
ORACLE["op12_periodic_runs"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
crc AS (
  SELECT v::UBIGINT AS v, 0 AS k, v::UBIGINT AS c FROM range(256) t(v)
  UNION ALL SELECT v, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END FROM crc WHERE k < 8),
tab AS (SELECT list(c ORDER BY v) AS t FROM crc WHERE k = 8),
h AS (
  SELECT doc_id, w, len(w) AS n, CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda c, x: xor(c // 256, t[CAST(xor(c, x) % 256 + 1 AS BIGINT)])), 4294967295::UBIGINT) AS BIGINT) AS h
  FROM d, tab),
s AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM h),
e AS (
  SELECT doc_id, n, list_transform(range(0, n), lambda i:
    w[CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) ELSE i END + 1]) AS w FROM s),
g AS (
  SELECT doc_id, n, p, hash(w[p + 1], w[p + 2], w[p + 3], w[p + 4], w[p + 5]) AS s
  FROM (SELECT doc_id, n, w, unnest(range(0, n - 4)) AS p FROM e)),
m AS (
  SELECT x.doc_id, x.p, y.p - x.p AS q, x.p - row_number() OVER (PARTITION BY x.doc_id, y.p - x.p ORDER BY x.p) AS isle
  FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.s = y.s AND y.p > x.p AND 4 * (y.p - x.p) <= x.n),
r AS (
  SELECT doc_id, q, min(p) AS a, max(p) - min(p) + 5 + q AS l FROM m GROUP BY doc_id, q, isle
  HAVING max(p) - min(p) + 5 + q >= greatest(6, 4 * q)),
u AS (SELECT doc_id, a, l, min(q) AS q FROM r GROUP BY doc_id, a, l),
told AS (
  SELECT doc_id, count(*) AS n_runs, arg_min({'s': a, 'l': l, 'q': q}, {'x': -l, 'y': a, 'z': q}) AS most,
    string_agg(a || ',' || l || ',' || q || chr(10), '' ORDER BY a, q) AS listed FROM u GROUP BY doc_id),
gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (
  SELECT doc_id, unnest(range(a + q, a + l)) AS i FROM u) GROUP BY doc_id),
kept AS (
  SELECT v.doc_id, string_agg(v.w[v.j + 1], ' ' ORDER BY v.j) AS text FROM (
    SELECT doc_id, w, unnest(range(0, n)) AS j FROM e) v
  LEFT JOIN (SELECT doc_id, unnest(gone) AS k FROM gone) x ON x.doc_id = v.doc_id AND x.k = v.j
  WHERE x.k IS NULL GROUP BY v.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, most.s AS start, most.l AS length, most.q AS period,
  1000 * most.l // most.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").where(
        "NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    rows = rows.select(
        "vec_id", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END").alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vector"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS own, list_dot_product(a.v, b.v)::BIGINT AS s
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT a, b, s FROM s WHERE own QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS INTEGER) AS rank,
  s.b AS negative_id, p.s AS positive_score, s.s AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.own AND 80 * p.s <= 100 * s.s AND 100 * s.s <= 100 * p.s
QUALIFY rank <= 5
"""

"""License notices in texts, with DataFrame functions only.

A text becomes its runs of five words. For every template length it is cut into overlapping windows
of one and a half times that length, dealt so that any passage of the template's length lies whole
in one of them. A window's MinHash signature is its smallest run hash in each of ``BANDS`` bins, one
value per band; a template is retrieved if one band agrees. A run that window and template share
fails to be the smallest of its bin only if another run of the window falls into the same bin, so a
band agrees with a probability of at least 1 - w / (2 * BANDS) for w runs in the window, more than
0.999 up to w = 131. Retrieved templates are then verified by exact containment of their runs.

A band can only agree in a window that holds a run of the template, so windows without any are not
built; their number, not the result, is what this changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.store import Scratch

SHINGLE = 5
BANDS = 1 << 16
LEAST = 0.8             # share of a template's runs that a window must hold
TEMPLATE_RUNS = 50_000  # runs of all templates together, at most: they are broadcast

# Notices that are looked for by default.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies."),
}

# Everything in ASCII but digits and lower-case letters parts words.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def runs(text: Column) -> Column:
    """Hashes of all runs of five words (lower-cased, parted by what is no letter or digit)."""
    words = F.array_remove(F.split(F.lower(text), _BETWEEN), "")
    at = lambda w, i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])
    # A one-element transform binds the words once for all runs.
    return F.flatten(F.transform(F.array(words), lambda w: F.when(
        F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: at(w, i)))
        .otherwise(F.array().cast("array<bigint>"))))


def find(documents: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Templates found in each document: doc_id, template, containment, first_word, n_windows.

    ``containment`` is the largest share of the template's distinct runs in one window (at least
    ``LEAST``), ``first_word`` the first word (from 0) of the first such window and ``n_windows``
    their number. Null texts and texts of fewer than five words hold none. Rows that repeat doc_id
    and text count once; a null doc_id is kept. Templates need five words; other columns are
    ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "licenses")
    given = TEMPLATES if templates is None else templates
    known = spark.createDataFrame(list(given.items()) or [("", "")], "template string, text string").where("template != ''")
    known = known.select("template", F.array_distinct(runs(F.col("text"))).alias("t"),
                         F.size(runs(F.col("text"))).alias("n"))
    rows = known.collect()  # as many as templates were given
    if any(r.n < 1 for r in rows):
        raise ValueError("a template needs five words")
    if sum(len(r.t) for r in rows) > TEMPLATE_RUNS:
        raise ValueError("the templates have more runs than TEMPLATE_RUNS")
    own = [(r.template, r.n, r.n + (r.n + SHINGLE) // 2, (r.n + SHINGLE) // 2 + 1, len(r.t), r.t) for r in rows]
    shape = "template string, n int, width int, stride int, size int, t array<long>"
    book = F.broadcast(spark.createDataFrame(own, shape))

    every = sorted({x for r in rows for x in r.t})
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"),
                             runs(F.col("text")).alias("s"))
    held = texts.where(F.arrays_overlap("s", F.array(*[F.lit(x) for x in every]) if every else F.array().cast("array<bigint>")))
    held = scratch.save(held)

    # The windows around runs that some template has.
    terms = F.broadcast(spark.createDataFrame(
        sorted({(x, r[2], r[3]) for r in own for x in r[5]}), "run long, width int, stride int"))
    hits = held.select("doc_id", "mark", F.posexplode("s").alias("place", "run")).join(terms, "run")
    low = F.greatest(F.lit(0), F.floor((F.col("place") - F.col("width")) / F.col("stride")) + 1)
    high = F.floor(F.col("place") / F.col("stride"))
    windows = hits.withColumn("k", F.explode(F.sequence(low, high))).select(
        "doc_id", "mark", "width", "stride", "k").distinct()
    windows = windows.join(held.dropDuplicates(["doc_id", "mark"]).select(
        F.col("doc_id").alias("d"), F.col("mark").alias("m"), "s"),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")))
    windows = scratch.save(windows.select("doc_id", "mark", "width", "stride", "k", F.slice(
        "s", (F.col("k") * F.col("stride") + 1).cast("int"), F.col("width")).alias("w")))

    # Bands: the smallest run of each bin.
    band = F.pmod(F.xxhash64("run"), F.lit(BANDS)).alias("band")
    signed = windows.select("doc_id", "mark", "width", "stride", "k", F.explode("w").alias("run")).groupBy(
        "doc_id", "mark", "width", "stride", "k", band).agg(F.min("run").alias("least"))
    marks = book.select("template", "width", "stride", F.explode("t").alias("run")).groupBy(
        "template", "width", "stride", band).agg(F.min("run").alias("least"))
    found = signed.join(F.broadcast(marks), ["width", "stride", "band", "least"]).select(
        "doc_id", "mark", "width", "stride", "k", "template").distinct()

    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")) & (
        F.col("width") == F.col("wd")) & (F.col("stride") == F.col("st")) & (F.col("k") == F.col("kk"))
    text = windows.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), F.col("width").alias("wd"),
                          F.col("stride").alias("st"), F.col("k").alias("kk"), "w")
    share = F.size(F.array_intersect("w", "t")) / F.col("size")
    checked = found.join(text, same).join(book.select("template", "size", "t"), "template").withColumn("share", share)
    return checked.where(F.col("share") >= LEAST).groupBy("doc_id", "mark", "template").agg(
        F.max("share").alias("containment"), F.min(F.col("k") * F.col("stride")).alias("first_word"),
        F.count("*").alias("n_windows")).drop("mark")

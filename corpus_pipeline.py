"""A corpus cleaned and encoded in five stages; every stage reads what its predecessor wrote.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
``documents``. No stage drops a row for more than its own finding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, language, near_dedup, pieces, repeats
from riskloom.llm.queries import is_contaminated
from riskloom.llm.store import Scratch, fresh


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts in no language that the labelled ones are in."""
    names = docs.columns
    model = language.fit(docs.select("doc_id", "text", "lang").where(language.fold() != 0), checked=language.CHECKED)
    pred, score, refused = (fresh(names, n) for n in ("lang_pred", "score", "refused"))
    return language.annotate(docs, model, pred, score, refused=refused).where(~F.col(refused)).select(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one of smallest doc_id. Repeated rows stay once.

    Near are documents that share four fifths of their runs of five words.
    """
    names = docs.columns
    doc, mark = fresh(names, "doc"), fresh(names, "mark")
    found = near_dedup.near_duplicates(docs)
    keep = found.where("kept").select(F.col("doc_id").alias(doc)).distinct()
    kept = docs.join(keep, docs.doc_id.eqNullSafe(F.col(doc)), "left_semi")
    return kept.withColumn(mark, F.xxhash64("text")).dropDuplicates(["doc_id", mark]).select(*names)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 or more words stay where they occur first; documents left empty go."""
    return repeats.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in passages of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(docs, benchmark)
    return decontaminate.without(docs, found.where(is_contaminated()))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding them gives the text back."""
    return pieces.encode(docs.select("doc_id", "lang", "source", "text"), "text", "ids",
                         round_trip="round_trip").drop("text").withColumn("n_tokens", F.size("ids"))


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: Language scores and piece ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES[:-1]:
        after = scratch.save(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        docs = before = after
    return STAGES[-1][1](spark, docs, sf_dir)

"""Documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, as a table of the columns of
``documents``, and its decisions take effect; the last one returns the packed
pieces. ``run`` writes every stage's result as Parquet under the shared folder
that ``spark.checkpoint.dir`` names and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import line_dedup, ngram_join, packing, pii, quality
from vigil.llm.queries import PII_KEY
from vigil.llm.storage import stored

NEAR_DUPLICATES = ngram_join.Jaccard(words=5, over=80, under=100)


def _columns(result: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the stage's input, n_chars measured on the new text."""
    return result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF, fitted on the table's labels, accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.where("predicted = 1").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; so do documents that lose four fifths
    of them or more: near copies, whose few other lines would resemble nothing."""
    kept = line_dedup.dedup_lines(docs).where("n_lines = 0 OR 5 * n_removed < 4 * n_lines")
    return _columns(kept, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at Jaccard 0.8 stays."""
    return ngram_join.keep_one(docs, NEAR_DUPLICATES)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms of the same format, by the key that
    the session's ``spark.vigil.pii.key`` holds (invented data need none)."""
    key = spark.conf.get("spark.vigil.pii.key", None)
    return _columns(pii.pseudonymise(docs, key=key.encode() if key else PII_KEY).drop("pii"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", near_duplicates),
    ("pii", pseudonyms),
    ("best_fit_packing", pack),
]

#: a trained classifier and BPE ids can't be expressed in SQL; the tests hold
#: the stages against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

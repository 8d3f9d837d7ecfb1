"""The corpus pipeline: ``documents`` through five stages, each written as Parquet and read again.

Each function takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, ngram_join, packing, quality_model, repetition, scratch, tokens

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCORE_LIMIT = 0.3
SEQUENCE_LENGTH = 4096


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at the limit or above; it learns from ``labels``. Null and empty texts score by the bias alone."""
    weights = quality_model.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.select(*COLUMNS, quality_model.score(spark, F.col("text"), weights).alias("score")).where(F.col("score") >= SCORE_LIMIT).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules; null and empty texts fail, repeated rows are judged one by one."""
    return repetition.keep(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id.

    Rows that share an id are told apart by their texts' shingle sets; of copies that
    share one, the first by column values stays. Documents without words all stay.
    """
    return ngram_join.representatives(docs.select(*COLUMNS)).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its sources' quotas take it, twice at most.

    A null source is a source of its own; a text without words has size 0 and is never
    taken. Repeated rows count one by one; ties in the seeded order fall to the id.
    """
    mixed = mixing.mix(docs, F.array("source"), carry=["text", "lang", "source", "n_chars"])
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return mixed.where("copies > 0").withColumn("copy", copies).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: every piece of every document with its place; a null or empty text is one piece, the end id. Copies are packed one by one."""
    return packing.pack(docs, tokens.default_file(), SEQUENCE_LENGTH)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: The classifier, the n-gram join and the packing are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two stages is a table in the shared folder."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), len(STAGES) - 1
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < last:
            docs = scratch.cut(docs, f"pipeline-{i}")
    return docs

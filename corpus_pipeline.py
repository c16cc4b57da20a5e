"""From raw documents to packed token sequences: five stages over the ``documents`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracel.llm.common import read_table, stage
from terracel.llm.language_id import UNKNOWN, predict, train_on_documents
from terracel.llm.line_dedup import dedup_lines
from terracel.llm.mixing import mix
from terracel.llm.near_dedup import drop_near_duplicates
from terracel.llm.packing import pack_documents

#: SQL has no n-gram classifier, schedule or packing; tests compare the stages with brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose nearest codeword is not ambiguous; lang becomes the predicted language."""
    found = predict(docs, train_on_documents(docs))
    return found.filter((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")).withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat over at least three of them."""
    found = dedup_lines(docs)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a similarity of at least 0.8."""
    return drop_near_duplicates(docs, k=5, per_cent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document taken more than once has more rows."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and places."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each reading what the one before has written."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

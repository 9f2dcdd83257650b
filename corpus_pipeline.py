"""A cleaning pipeline over ``documents``: each stage keeps or rewrites rows and hands them on as a table.

Every stage works on all rows its predecessor kept.  The first four return the columns of
``documents``; the last returns each document's token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import decontamination, language, line_dedup, near_duplicates, pieces
from loanloom.llm.frames import read_table, stored

#: Text bytes that a task segments at once: here executors still hold what the stages before have grown to.
PIECE_CHUNK = 1 << 18


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from the rows that name one."""
    return language.accepted_rows(docs, language.fit(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat in others; ``n_chars`` follows the text."""
    kept, added = line_dedup.without_repeated_lines(docs)
    kept = kept.drop(*added.values())
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each near-duplicate class."""
    return near_duplicates.one_of_each_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontamination.clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of each document, and whether they all decode to its text."""
    return pieces.encode(docs, read_back="restored", chunk=PIECE_CHUNK).drop("text")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", sentencepiece),
]
#: The stages train models and draw samples; SQL cannot express them, so tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

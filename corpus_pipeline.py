"""From raw documents to a training mix: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of ``documents``; other columns, whatever their names, are handed on. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontaminate, language_id, line_dedup, minhash, mixing
from stratalake.llm.common import table, written


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough probability.

    Null, empty and blank texts and those without a letter go. A null lang or source is no evidence. Rows that repeat
    each other are judged alike, ids play no part.
    """
    return language_id.identify_documents(docs).where("__kept").select(docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the later occurrences of repeated three-line windows; documents that lose every line go.

    Earlier is a smaller doc_id, null last, then an earlier line. Rows with the same doc_id and text are one document, so
    neither loses lines to the other. Texts of fewer than three lines stay as they are. n_chars follows the text.
    """
    found = line_dedup.drop_repeated_lines(docs)
    return _sized(found.where("__removed = 0 or __removed < __lines").select(docs.columns))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id.

    Rows that share an id are judged each by its own text; those with the smallest id of their group all stay. Of a group
    without any id one row stays. Texts without a word are in no group.
    """
    return minhash.drop_near_duplicates(docs, width=5, percent=80, permutations=72, rows=4)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without benchmark passages; documents that are benchmark text for the greater part go.

    Items without id count. Documents without a hit, null and empty texts among them, stay as they are; repeated rows are
    cut alike. n_chars follows the text.
    """
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), unnamed=True)
    return _sized(decontaminate.remove_leaks(found).select(docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: how many words of each document are taken, and where in training.

    A null source is a source of its own, the last one. Documents without words take nothing. Null and repeated ids are
    ordered by the size of the text; rows alike in that are interchangeable.
    """
    return mixing.mix(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("minhash", one_of_each),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
]

#: SQL has no trigram models; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

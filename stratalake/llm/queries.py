"""Registered queries over the text tables; each takes (spark, folder of the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import (
    conversation_repair,
    decontaminate,
    html_text,
    language_id,
    line_dedup,
    merkle,
    minhash,
    mixing,
    quality_rules,
    quality_trees,
    suffix_dedup,
    toxicity,
    url_filter,
)
from stratalake.llm.common import table
from stratalake.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

#: The rules of the url query.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.round("__severity", 6).alias("expected_severity"),
        F.col("__grade").alias("grade"),
        F.round("__p_toxic", 6).alias("p_toxic"),
        F.col("__toxic").alias("toxic"),
    )


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), "text"
    )


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, folder, "benchmark"), unnamed=True)
    hit = F.aggregate("__hits", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    items = F.array_sort(F.transform("__items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The second policy over the stored ledger, with the rule that alone drops a document and how many it drops."""
    entries = quality_rules.sole_rule(quality_rules.stored(table(spark, folder, "documents")), "v2")
    return quality_rules.apply_policy(entries, "v2").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed", "base_failed", "kept",
        "only_rule", "n_only_rule",
    )


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.train(pages))
    return found.select(
        "page_id", "url", F.col("__text").alias("text"), F.length("__text").cast("bigint").alias("n_chars")
    )


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of documents (page_id is null) and of pages (doc_id is null)."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    model = language_id.train(docs, "lang")
    none = F.lit(None).cast("bigint")
    judged = language_id.identify_documents(docs, model).withColumnRenamed("lang", "declared").withColumn("page_id", none)
    shown = language_id.identify_pages(pages, model).withColumn("doc_id", none)
    names = ["doc_id", "page_id", "declared", "__language", "__probability", "__kept"]
    return judged.select(names).union(shown.select(names)).select(
        "doc_id",
        "page_id",
        "declared",
        F.col("__language").alias("language"),
        F.round("__probability", 6).alias("probability"),
        F.col("__kept").alias("kept"),
    )


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of documents, checked against rows of which about one in seven was tampered with."""
    docs = table(spark, folder, "documents")
    longer = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, longer).otherwise(F.col("n_chars"))
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    found = merkle.manifest(docs, fields, tree="lang", order="doc_id", shown={"n_chars": tampered})
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(), 256).alias("proof_sha256"), "folded_root", "verified"
    )


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all conversations after planted damage."""
    turns, there = conversation_repair.damaged(table(spark, folder, "conversations"))
    return conversation_repair.repair(turns, there)[0]


def op13_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality, by trees that never saw the held-out quarter of the labels."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(~quality_trees.held_out())
    found = quality_trees.score(docs, quality_trees.train(docs, labels))
    return found.select(
        "doc_id",
        quality_trees.held_out().alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.7).cast("int").alias("predicted"),
    )


QUERIES = {
    "op2_suffix_dedup": op2_suffix_dedup,
    "op1_toxicity": op1_toxicity,
    "op9_html_text": op9_html_text,
    "op10_language_id": op10_language_id,
    "op4_minhash": op4_minhash,
    "op7_decontamination": op7_decontamination,
    "op8_quality_rules": op8_quality_rules,
    "op3_mixing": op3_mixing,
    "op5_url_filter": op5_url_filter,
    "op6_line_dedup": op6_line_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_quality_trees": op13_quality_trees,
}

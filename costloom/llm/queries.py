"""The registered queries of the training-data operators, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.llm import decontam, html, jaccard, language, licenses, lines, pieces, quality, rules, secrets, toxicity, variants, whitening
from costloom.llm.sql import ORACLE
from costloom.llm.storage import table


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_documents(docs)


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source, then hundreds of ids; the first of a hundred is its licence file."""
    docs = table(spark, sf_dir, "documents")
    hundred = F.floor(F.col("doc_id") / 100)
    name = F.when(F.col("doc_id") % 100 == 0, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(hundred / 10).cast("string"), hundred.cast("string"))
    parent = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(hundred / 10).cast("string"))
    place = F.when(F.col("doc_id") % 1000 == 0, parent).otherwise(path)
    files = docs.select(F.col("doc_id").alias("file_id"), F.concat_ws("/", place, name).alias("path"), "text")
    return licenses.scan_licenses(files).withColumnRenamed("file_id", "doc_id")


def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_report(table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": line_dedup,
    "op2_quality_rules": quality_rules,
    "op3_secret_scan": secret_scan,
    "op4_decontamination": decontamination,
    "op5_sentencepiece": sentencepiece,
    "op6_html_text": html_text,
    "op7_toxicity": toxic,
    "op8_license_scan": license_scan,
    "op9_quality_classifier": quality_score,
    "op10_jaccard_join": jaccard_join,
    "op11_spelling_variants": spelling_variants,
    "op12_language_id": language_id,
    "op13_embedding_whitening": embedding_whitening,
}

__all__ = ["ORACLE", "QUERIES"]

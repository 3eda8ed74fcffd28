"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandweave.llm import alignment, compression_quality, embedding_dedup, lexical_search, license_scan, line_dedup, mixing, oracles, packing, pii, quality_rules, sentencepiece, simhash, url_filter
from strandweave.llm.common import table


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(quality_rules.stored_ledger(table(spark, sf_dir, "documents")))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy rejects, and what it alone rejects, from the stored bits."""
    return quality_rules.ablations(quality_rules.stored_ledger(table(spark, sf_dir, "documents")), "v2")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=4, shingle=4)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "source", "lang", "topic", "tokens", F.round("probability", 6).alias("probability"), F.round("residual", 4).alias("residual"), "kept")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether decoding them gives the text again."""
    coded = sentencepiece.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), same_col="same")
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "same", "ids")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"), min_tokens=1).select("doc_id", "n_lines", "n_dropped", "text")


def op10_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_embedding_dedup, op2_url_filter, op3_quality_rules, op4_simhash, op5_mixing, op6_pii, op7_license_scan, op8_sentencepiece, op9_line_dedup, op10_compression_quality, op11_lexical_search, op12_packing, op13_alignment, quality_ablations)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)

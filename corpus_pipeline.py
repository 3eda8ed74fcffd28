"""Five corpus stages, each one operator over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from strandweave.llm import line_dedup, mixing, near_copies as near_copies_by_sets, quality_rules, sentencepiece
from strandweave.llm.common import NOT_SPACE
from strandweave.plans.cut import cut, release


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy rejects go; the others stay as they are."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template an earlier document holds go; so do documents left without a word by that."""
    thinned = line_dedup.line_dedup(docs, min_tokens=1)
    left = thinned.where((F.col("n_dropped") == 0) | F.col("text").rlike(NOT_SPACE))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays: sets of five-word shingles at a
    Jaccard similarity of 0.8 or more, decided on the whole sets. Coverings of words of wide SimHash fingerprints
    propose the pairs."""
    return near_copies_by_sets.one_of_each(docs, threshold=0.8, shingle=5)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw at the probabilities raked to the target shares of sources, languages and topics."""
    return mixing.mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its ids and their number."""
    coded = sentencepiece.encode(docs)
    return coded.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


STAGES = [("quality_rules", rules), ("line_dedup", lines), ("simhash", near_copies), ("mixing", mixed), ("sentencepiece", pieces)]

#: Covering hashes, XXH64 and a tokeniser's model are not expressible in SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = cut(stage(spark, docs, sf_dir), name)
        release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)

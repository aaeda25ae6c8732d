"""From raw documents to packed training sequences: five stages, each a table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm import mixing, ngramjoin, packing, pii, quality
from cohortix.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that fail the full policy."""
    return quality.filter_documents(docs, "full-1")


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return ngramjoin.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by the name of its kind."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the documents of the mixture; a document taken several times gives as many rows."""
    return mixing.mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mixture's documents into sequences: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_join),
    ("personal data", personal_data),
    ("mixing sources", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage-" + name.replace(" ", "-").lower())
    return docs

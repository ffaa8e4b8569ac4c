"""The corpus pipeline: quality rules, near-duplicate removal, benchmark
decontamination, personal-data masking and sequence packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between two
stages the result is written as Parquet into the shared checkpoint folder and
read again, so a lost executor never costs more than the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionlens.llm import decontaminate, ngram_join, packing, pii, quality_rules
from sessionlens.llm.tables import DOCUMENT_COLUMNS, table, text_batches
from sessionlens.session import scratch_path


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    text_batches(spark)
    return quality_rules.keep_good(docs.select(*DOCUMENT_COLUMNS))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % of their 5-grams."""
    return ngram_join.keep_first(docs.select(*DOCUMENT_COLUMNS))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    return decontaminate.keep_clean(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.mask(docs.select(*DOCUMENT_COLUMNS))


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in training sequences."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality_rules", stage_quality),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontaminate),
    ("pii", stage_pii),
    ("packing", stage_pack),
]

#: packing ids and near-duplicate groups are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

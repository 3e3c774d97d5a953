"""Five stages that turn raw documents into a weighted training mix.

Each stage gets all that its predecessor kept, written as Parquet and read again.
"""

from pyspark.sql import DataFrame, SparkSession

from pixwave.llm import decontaminate, mixture, quality_crf, simhash_dedup, substring_dedup
from pixwave.session import shared_dir

STAGES = [
    ("quality_crf", quality_crf.pipeline_stage),  # documents that the classifier rejects go
    ("simhash_dedup", simhash_dedup.pipeline_stage),  # one document of each group of near copies stays
    ("substring_dedup", substring_dedup.pipeline_stage),  # repeated passages are cut out of their documents
    ("decontaminate", decontaminate.pipeline_stage),  # documents with benchmark passages go
    ("mix_sources", mixture.pipeline_stage),  # what the mix takes of each document
]
# A trained classifier and hashes that SQL has not: the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

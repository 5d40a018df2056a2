"""Corpus pipeline: quality, near-duplicates, decontamination, mixing, records.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framecurate.llm.common import prepare, staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranker learnt from `labels` rejects go."""
    from framecurate.llm.catalog import quality_model
    from framecurate.llm.quality import keep_good
    prepare(spark)
    return keep_good(docs, quality_model(spark, docs, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one of the least id."""
    from framecurate.llm.simhash import keep_one_per_component
    prepare(spark)
    return keep_one_per_component(docs, shingle=3, radius=3, pieces=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edits included, go."""
    from framecurate.llm.decontam import drop_contaminated
    prepare(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), rate=0.1)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn for the target mix; the budget is 70 % of the tokens."""
    from framecurate.llm.catalog import mixed_sample
    prepare(spark)
    return mixed_sample(docs, keep=0.7)


def records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id record files; returns what is read back from them."""
    from framecurate.llm.catalog import token_records
    prepare(spark)
    return token_records(spark, docs)


STAGES = [
    ("quality_ranking", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mixing),
    ("token_records", records),
]

#: The stages' models and file formats have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

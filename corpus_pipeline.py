"""A training-data pipeline over the table of documents: each stage applies one operator of dwellmart.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dwellmart.llm import stages
from dwellmart.session import written

STAGES = [
    ("quality classifier", stages.quality),
    ("n-gram Jaccard join", stages.near_duplicates),
    ("benchmark decontamination", stages.decontamination),
    ("mixing sources to target weights", stages.mixing_stage),
    ("sharding", stages.sharding),
]

# Trained models and bin packing have no SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that pass all stages, with their shards. Every stage's result is stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

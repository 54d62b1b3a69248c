"""The stages of the corpus pipeline: each applies one operator to all documents its predecessor kept.

All but the last return the columns of documents. Rows that repeat an id are documents of their own. Columns
beside doc_id and text are passed on whatever their names: while a stage runs they bear others, so that they
can't meet its own. Texts are taken whole, however long; an empty table passes as an empty one.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmart.llm import classifier, contamination, mixing, ngram_join, shards
from dwellmart.llm.quality import quality_model
from dwellmart.llm.shipping import ship
from dwellmart.session import written

LEAST_QUALITY = 0.3
TOXIC = mixing.DOMAINS.index("toxic")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def any_columns(stage):
    """A stage whose own columns can't clash with those of the documents."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        neutral = [name if name in ("doc_id", "text") else f"kept_{i}" for i, name in enumerate(names)]
        return stage(spark, docs.toDF(*neutral), sf_dir).toDF(*names)

    return run


@any_columns
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score 0.3 or more)."""
    model = quality_model(docs, _table(spark, sf_dir, "labels"))
    scored = classifier.score(docs, model, name="__quality")
    return scored.where(F.element_at("__quality", 1) >= LEAST_QUALITY).drop("__quality")


def _text_key(column: str = "text"):
    return F.unhex(F.md5(F.coalesce(column, F.lit("")).cast("binary")))


@any_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a Jaccard similarity of 0.8: the one
    with the least id (and, of rows that repeat that id with several texts of the group, the least text
    key). Of rows that repeat an id and text one stays; rows with a null id, or with an empty text,
    are in no group and all stay."""
    ship(spark)
    lost = ngram_join.superseded(docs, size=5, num=8, den=10)
    lost = lost.select("doc_id", F.col("text_key").alias("__key"))
    named = docs.where("doc_id IS NOT NULL").withColumn("__key", _text_key())
    left = named.join(lost, ["doc_id", "__key"], "left_anti").dropDuplicates(["doc_id", "__key"])
    return left.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


@any_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of a benchmark item occurs."""
    found = contamination.contamination(docs, _table(spark, sf_dir, "benchmark"))
    # Keyed by the text: equal texts are hit alike, and ids may be null or repeated.
    hit = found.where(F.size("hits") > 0).select(F.col("text_key").alias("__key")).distinct()
    return docs.withColumn("__key", _text_key()).join(hit, "__key", "left_anti").select(docs.columns)


def _without_toxic(table: DataFrame) -> np.ndarray:
    """Tokens of each domain in the documents that are more likely of another domain than toxic."""
    p = F.col("mix_domains")
    kept = table.where(p[TOXIC] < F.array_max("mix_domains"))
    sums = [F.coalesce(F.sum(p[i] * F.col("mix_tokens")), F.lit(0.0)) for i in range(len(mixing.DOMAINS))]
    return np.array(kept.agg(*sums).first())


@any_columns
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate, rounded to the nearest whole number, says. The target of each
    domain is what it has in documents that are likelier of another domain than toxic: clean ones
    have rates near 1 and stay, toxic ones have rates near 0 and go."""
    columns = docs.columns
    table = mixing.posteriors(docs, _table(spark, sf_dir, "labels"), columns)
    table = written(table, "posteriors")
    aim = _without_toxic(table)
    rated = mixing.rated(table, mixing.fit(table, lambda start: aim))
    copies = F.floor(F.col("mix_rate") + 0.5).cast("int")
    return rated.where(copies > 0).select(*columns, F.explode(F.sequence(F.lit(1), copies)).alias("__copy")).select(columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and the place in it of every document left, 16 shards of near equal bytes."""
    return shards.assign(docs, shards=16)

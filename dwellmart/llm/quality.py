"""Quality scores of documents, learned from the labels that are not held out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.llm import classifier


def held_out(id_column: str = "doc_id"):
    """Ids whose crc32, as text, divides by 5. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def quality_model(docs: DataFrame, labels: DataFrame) -> classifier.Model:
    known = labels.where(~held_out()).select("doc_id", "quality")
    return classifier.train(docs.select("doc_id", "text"), known, ["quality"])


def quality_scores(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``least`` on) of every document."""
    scored = classifier.score(docs.select("doc_id", "text"), quality_model(docs, labels), ["doc_id"])
    score = F.element_at("score", 1)
    return scored.select(
        "doc_id", held_out().alias("held_out"), score.alias("score"), (score >= least).cast("int").alias("predicted")
    )

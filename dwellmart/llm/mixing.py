"""Mixing documents so that the expected tokens of each domain meet target weights.

Domains are soft: a classifier learned from the table of labels gives each document a probability
for each domain, and its tokens count for all domains in that proportion. The classifier learns from the
labels that are not held out; on the others (a fifth, on a bounded sample) the sharpness of its
probabilities is fitted: the power that makes the held-out labels likeliest. Probabilities that are too
soft would give each domain tokens of all documents, and few targets could then be met.

Document rates (how often a document is to be seen, 0 or more) are fitted by projected gradient least
squares. Of all rates that meet the targets, those nearest to 1 are wanted (squared distances
weighted by tokens), so that no document is lost without need: they have the form max(0, 1 - p v), for
one vector v over the domains. Every step adds a multiple of the gradient of the squared errors of the
domain totals to v; the rates are 1 less all gradient steps so far, projected onto 0 or more. The gradient
is scaled by the inverse of the least-squares matrix of the documents whose rate is above 0 (one row a
domain), so that a step would meet the targets if it cut off nothing more. A step that comes no closer
is taken back and tried again at a quarter of its length.

A step needs the domain totals and that matrix only, sums over all documents, made in the tasks and
added up by Spark; the rates themselves are never stored, since every rate follows from the document's own
probabilities and v. Totals cover all documents.

Domains: "toxic" (labelled toxic), "poor" (not toxic, quality 0), "good" (not toxic, quality 1).

Nulls and ties: a null or empty text has no tokens and the probabilities of no evidence; it gets a
rate like any other. Repeated rows get equal rates. Targets of a domain without tokens can't be met
and are left out. An empty table gives an empty result. Without held-out labels the sharpness is 1. Very long
texts count whole. Columns kept must not be named mix_domains, mix_tokens, mix_rate or mix_text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellmart.llm import classifier
from dwellmart.llm.quality import held_out
from dwellmart.llm.text import SPACE, text_bytes, tokenise
from dwellmart.session import written

DOMAINS = ["good", "poor", "toxic"]
TARGETS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}
STEPS, TOLERANCE, SHORTEST = 60, 1e-3, 1e-4
POWERS = [0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0]


def domain_labels(labels: DataFrame) -> DataFrame:
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    return labels.select(
        "doc_id",
        (~toxic & good).cast("int").alias("good"),
        (~toxic & ~good).cast("int").alias("poor"),
        toxic.cast("int").alias("toxic"),
    )


def sharpness(docs: DataFrame, labels: DataFrame, model: classifier.Model) -> float:
    """The power of POWERS under which the probabilities make the given labels likeliest, the mildest of equals."""
    rows = classifier.labelled(docs.select("doc_id", "text"), labels, DOMAINS)
    scored = classifier.score(rows, model, ["truth"], "mix_domains")
    floor = F.lit(1e-12)
    powers = {power: F.transform("mix_domains", lambda x: F.pow(F.greatest(x, floor), F.lit(power))) for power in POWERS}
    likely = [
        F.sum(F.log(F.greatest(F.element_at(p, F.array_position("truth", 1.0).cast("int"))
                               / F.aggregate(p, F.lit(0.0), lambda a, x: a + x), floor))).alias(f"of_{i}")
        for i, p in enumerate(powers.values())
    ]
    found = scored.where(F.array_contains("truth", 1.0)).agg(*likely).first()
    if found[0] is None:
        return 1.0
    return max(zip(found, POWERS), key=lambda pair: (round(pair[0], 9), -abs(np.log(pair[1]))))[1]


def posteriors(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep``, mix_tokens (words) and mix_domains (a probability for each of DOMAINS)."""
    known, aside = (domain_labels(labels.where(rows)) for rows in (~held_out(), held_out()))
    model = classifier.train(docs.select("doc_id", "text"), known, DOMAINS, recipe=classifier.PRESENCE)
    power = sharpness(docs, aside, model)
    counted = docs.withColumn("mix_text", F.col("text")).select(*keep, "mix_text", "text")
    scored = classifier.score(counted, model, [*keep, "mix_text"], "mix_domains")
    fields = [T.StructField("mix_domains", T.ArrayType(T.DoubleType())), T.StructField("mix_tokens", T.LongType())]
    schema = T.StructType([*docs.select(*keep).schema.fields, *fields])
    place = len(keep)

    def normed(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(place))
            sizes = tokenise(data, offsets, SPACE, lower=False).counts
            p = batch.column(place + 1).flatten().to_numpy().reshape(batch.num_rows, -1)
            p = np.maximum(p, 1e-12) ** power
            p = p / p.sum(1, keepdims=True)
            ends = np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(place)], lists, pa.array(sizes, pa.int64())], schema.names
            )

    return scored.mapInArrow(normed, schema)


def replayed(p: np.ndarray, moves: list[np.ndarray]) -> np.ndarray:
    """Rates after the given moves, from the probabilities alone."""
    return np.maximum(1 - p @ sum(moves, np.zeros(p.shape[1])), 0.0)


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, len(DOMAINS))


def _sums(table: DataFrame, moves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Domain totals at the rates after the moves, and the sums of products of the probabilities of
    documents whose rate is above 0, counted in tokens."""

    def partial(batches):
        total = 0.0
        for batch in batches:
            p, tokens = _matrix(batch, 0), batch.column(1).to_numpy().astype(np.float64)
            rate = replayed(p, moves)
            products = (p * (tokens * (rate > 0))[:, None]).T @ p
            total = total + np.concatenate([p.T @ (tokens * rate), products.ravel()])
        if not isinstance(total, float):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total))), pa.array(total)], ["at", "total"])

    parts = table.select("mix_domains", "mix_tokens").mapInArrow(partial, "at BIGINT, total DOUBLE")
    k = len(DOMAINS)
    sums = np.zeros(k + k * k)
    for row in parts.groupBy("at").agg(F.sum("total").alias("total")).collect():
        sums[row["at"]] = row["total"]
    return sums[:k], sums[k:].reshape(k, k)


def fit(table: DataFrame, target: "callable[[np.ndarray], np.ndarray]") -> list[np.ndarray]:
    """The moves that bring the domain totals of the table to target(totals at rate 1)."""
    start, products = _sums(table, [])
    now = start
    usable = start > 0
    aim = target(start)

    def error(totals: np.ndarray) -> float:
        return float(np.abs((totals - aim)[usable] / start[usable]).max(initial=0.0))

    moves: list[np.ndarray] = []
    part, nearest = 1.0, error(now)
    for _ in range(STEPS):
        if nearest < TOLERANCE:
            break
        gradient = np.where(usable, now - aim, 0.0)
        tried = [*moves, part * np.linalg.lstsq(products, gradient, rcond=1e-9)[0]]
        totals, matrix = _sums(table, tried)
        if error(totals) < nearest:
            moves, now, products, nearest = tried, totals, matrix, error(totals)
            part = min(2 * part, 1.0)
        else:
            part /= 4
            if part < SHORTEST:
                break
    return moves


def shares(weights: dict[str, float]):
    """Targets that keep the number of tokens and give each domain its share."""
    part = np.array([weights[d] for d in DOMAINS])
    return lambda start: start.sum() * part / part.sum()


def rated(table: DataFrame, moves: list[np.ndarray], name: str = "mix_rate") -> DataFrame:
    schema = T.StructType([*table.schema.fields, T.StructField(name, T.DoubleType())])
    at = table.columns.index("mix_domains")

    def rate(batches):
        for batch in batches:
            found = pa.array(replayed(_matrix(batch, at), moves))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], schema.names)

    return table.mapInArrow(rate, schema)


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """doc_id, source, mix_domains, mix_tokens and mix_rate of every document."""
    docs = docs.select("doc_id", "source", "text")
    table = written(posteriors(docs, labels, ["doc_id", "source"]), "posteriors")
    return rated(table, fit(table, shares(weights or TARGETS)))

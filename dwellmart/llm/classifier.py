"""Hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

A text is the sequence of its runs of letters or digits and of other signs; a run equal to the one
before is written as "same". Features are the 1- and 2-grams of that sequence, hashed into ``cells``
weights, with the square root of their share in the text as value (so a text has length one), and a
constant. A recipe may instead ask for presence: every feature that occurs has value 1, so that one word
tells as much in a long text as in a short one; a larger L1 then keeps only features that
tell labels apart again and again. Several yes/no labels can be learned at once over the same features.

Learning follows the updates in the order of a hash of the id, on about ``sample`` labelled ids at most
(a documented bound; drawn by hash of the id, from all labelled ids alike), in one task that holds their
features. An id that many rows bear is learned from once, from its text of the least hash, and rows
beyond ``SAMPLE_BYTES`` of features, in that order, are not learned from. Scoring is a sparse dot
product inside each task; nothing is shuffled.

Nulls and ties: a null or empty text has only the constant, and so gets the score of no evidence.
Null labels are not learned from. Several labels of one id count as their mean, at least one half
meaning yes. Without any label all scores are one half. Repeated rows score alike. Very long texts
are scored whole. Other columns are passed on as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellmart.llm.text import BASE, SECOND_BASE, mixed, sliced, tokenise_runs

CELLS, SAMPLE, PASSES, SAMPLE_BYTES = 1 << 18, 20_000, 3, 1 << 30
BETA, L2 = 1.0, 1e-3
_SAME = np.uint64(0x1D8E4E27C47D124F)


@dataclass(frozen=True)
class Recipe:
    """How features are valued and how fast weights are learned and dropped."""

    present: bool = False
    alpha: float = 5.0
    l1: float = 1e-3
    passes: int = PASSES


SHARES, PRESENCE = Recipe(), Recipe(present=True, alpha=1.0, l1=6.0, passes=4)


def features(data: np.ndarray, offsets: np.ndarray, cells: int, present: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, cell and value of every feature of consecutive texts; cell 0 is the constant."""
    words = tokenise_runs(data, offsets)
    owner, hashes = words.owners(), words.hashes().copy()
    follows = owner[1:] == owner[:-1]
    hashes[1:][follows & (words.hashes()[1:] == words.hashes()[:-1])] = _SAME
    pairs = mixed(hashes[:-1] * BASE + hashes[1:] * SECOND_BASE)[follows]
    room = np.uint64(cells - 1)
    cell = np.concatenate([hashes % room, pairs % room]).astype(np.int64) + 1
    owners = np.concatenate([owner, owner[1:][follows]])
    key, count = np.unique(owners * cells + cell, return_counts=True)
    owner, cell = key // cells, key % cells
    texts = np.arange(len(offsets) - 1)
    value = np.ones(len(cell)) if present else np.sqrt(count / np.bincount(owner, count, minlength=len(texts))[owner])
    return np.concatenate([owner, texts]), np.concatenate([cell, 0 * texts]), np.concatenate([value, 0.0 * texts + 1])


def featured(batches, cells: int, present: bool):
    """(rows, owner, cell, value) over slices of batches that have a text column."""
    for batch in batches:
        for part, data, offsets in sliced(batch, "text"):
            yield part, *features(data, offsets, cells, present)


class Leader:
    """Weights of several labels under follow-the-regularised-leader (proximal) updates."""

    def __init__(self, labels: int, cells: int, recipe: Recipe = SHARES):
        self.recipe = recipe
        self.z, self.n = np.zeros((labels, cells)), np.zeros((labels, cells))

    def _weights(self, z, n):
        l1, alpha = self.recipe.l1, self.recipe.alpha
        return np.where(
            np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / alpha + L2)
        )

    def learn(self, cell: np.ndarray, value: np.ndarray, truth: np.ndarray) -> None:
        z, n = self.z[:, cell], self.n[:, cell]
        weight = self._weights(z, n)
        miss = 1 / (1 + np.exp(-np.clip(weight @ value, -35, 35))) - truth
        step = miss[:, None] * value
        self.z[:, cell] += step - (np.sqrt(n + step * step) - np.sqrt(n)) / self.recipe.alpha * weight
        self.n[:, cell] += step * step

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n)


@dataclass
class Model:
    names: list[str]
    weights: np.ndarray  # float32, one row per label
    recipe: Recipe = SHARES

    def scores(self, owner, cell, value, texts: int) -> np.ndarray:
        """Probability of each label for each text."""
        sums = [np.bincount(owner, w[cell] * value, minlength=texts) for w in self.weights]
        return 1 / (1 + np.exp(-np.clip(np.array(sums), -35, 35)))


def labelled(docs: DataFrame, labels: DataFrame, names: list[str], sample: int = SAMPLE) -> DataFrame:
    """doc_id, truth (an array of the labels ``names``) and text of about ``sample`` labelled ids at most."""
    truth = labels.groupBy("doc_id").agg(*[(F.avg(c) >= 0.5).cast("double").alias(c) for c in names])
    truth = truth.dropna()
    total = truth.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 31))
    # About `sample` rows of two numbers: small enough to broadcast whatever the tables hold.
    chosen = F.broadcast(truth.where(draw < int(min(1.0, sample / max(total, 1)) * (1 << 31))))
    rows = docs.join(chosen, "doc_id").select("doc_id", F.array(*names).alias("truth"), "text")
    one = F.min_by(F.struct("truth", "text"), F.struct(F.xxhash64("text"), "text"))
    return rows.groupBy("doc_id").agg(one.alias("one")).select("doc_id", "one.*")


def train(
    docs: DataFrame,
    labels: DataFrame,
    names: list[str],
    cells: int = CELLS,
    sample: int = SAMPLE,
    recipe: Recipe = SHARES,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """A model of the 0/1 columns ``names`` of ``labels`` (doc_id and those), over docs (doc_id, text)."""
    rows = labelled(docs, labels, names, sample).select("truth", "text", F.xxhash64("doc_id").alias("place"))

    def prepare(batches):
        for part, owner, cell, value in featured(batches, cells, recipe.present):
            order = np.argsort(owner, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=part.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(2),
                    pa.ListArray.from_arrays(ends, pa.array(cell[order].astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(value[order].astype(np.float32))),
                ],
                ["truth", "place", "cell", "value"],
            )

    def follow(batches):
        rows, held = [], 0
        for batch in batches:
            truth = np.array(batch.column(0).to_pylist())
            for i in range(batch.num_rows):
                cell, value = (batch.column(c)[i].values.to_numpy() for c in (2, 3))
                held += cell.nbytes + value.nbytes
                if held <= sample_bytes:
                    rows.append((cell.copy(), value.copy(), truth[i]))
        leader = Leader(len(names), cells, recipe)
        for _ in range(recipe.passes):
            for cell, value, truth in rows:
                leader.learn(cell, value.astype(np.float64), truth)
        for number, weights in enumerate(leader.weights()):
            packed = pa.array([weights.astype(np.float32).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), packed], ["label", "weights"])

    prepared = rows.mapInArrow(
        prepare, "truth ARRAY<DOUBLE>, place BIGINT, cell ARRAY<INT>, value ARRAY<FLOAT>"
    )
    learned = prepared.repartition(1).sortWithinPartitions("place").mapInArrow(
        follow, "label INT, weights BINARY"
    )
    weights = np.zeros((len(names), cells), np.float32)
    for row in learned.toLocalIterator():
        weights[row.label] = np.frombuffer(bytes(row.weights), np.float32)
    return Model(names, weights, recipe)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns ``keep`` of docs (all by default) and an array column ``name`` of probabilities."""
    keep = docs.columns if keep is None else keep
    place, hidden = len(keep), "scored_text"
    while hidden in keep:
        hidden += "_"
    kept = [F.col(f"`{column}`") for column in keep]
    frame = docs.select(*kept, F.col("text").alias(hidden))
    schema = docs.select(*kept).schema.add(name, T.ArrayType(T.DoubleType()))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cells, present = model.weights.shape[1], model.recipe.present

    def scored(batches):
        for batch in batches:
            for part, data, offsets in sliced(batch, hidden):
                found = features(data, offsets, cells, present)
                p = shared.value.scores(*found, part.num_rows)
                ends = np.arange(0, p.size + 1, len(p), dtype=np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(p.T.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(place)] + [lists], schema.names
                )

    return frame.mapInArrow(scored, schema)

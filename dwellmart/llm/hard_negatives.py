"""Hard negatives by an inverted multi-index.

A vector is cut into two halves, each half has a codebook, and a pair of codewords is a cell. The table is
dealt by hash into parts of about ``PART_ROWS`` rows; each part is an index of its own, one stored row with its
vectors in the order of their cells and the radius of every codeword, the largest distance of a half from it.
Anchors are stored in blocks of about ``BLOCK_ROWS``. A task gets one block and one part at a time.

For an anchor, a half of a cell scores at most (half . codeword) + |half| * radius. The two lists of these
half bounds are sorted, and a heap visits the cells by their falling sums (multi-sequence order). A search ends
when the next bound certifies its window: it is below the last place of every list wanted, or below
the window. Bounds have room for the rounding of their floating-point sums, scores are exact whole numbers, so
the result is that of comparing the anchor with every row. What the parts find is ranked once more over all.

1. Positives: the best ``positives`` other rows of the anchor's label.
2. Negatives: for each positive, the best ``negatives`` rows of other labels whose score s is in the window
   low * p <= 100 * s <= high * p of the positive's score p; all windows of an anchor in one search.

Codebooks are fitted on at most ``SAMPLE_ROWS`` rows, those of the least hash of their vector; every row is indexed.

Nulls and odd rows: a row takes no part whose id, label or vector is null, or whose vector has null or
non-finite entries, is empty, or hasn't the dimension most vectors have (of equally frequent ones the larger).
Rows equal in id, label and vector count once. Rows of one id with different vectors are rows of their own;
none is a partner of an anchor with its own id, and ties between them go by the label, then the vector. No part is large
because a vector or a label is frequent: rows are dealt by id and vector. An empty table gives an empty result. Texts
aren't read, nor any column but the three named.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellmart.llm.whitening import SCALE, matrix, whole_vectors
from dwellmart.session import written

PART_ROWS, BLOCK_ROWS = 65_536, 256
SAMPLE_ROWS, CODEWORDS, STEPS = 8_192, 16, 8
_EXACT = {np.float32: float(1 << 24), np.float64: float(1 << 53)}  # whole numbers below are exact
_INDEX = "part INT, ids BINARY, labels BINARY, vectors BINARY, cells BINARY, radii BINARY"
_BLOCK = "block INT, anchors BINARY, labels BINARY, vectors BINARY, windows ARRAY<ARRAY<ARRAY<BIGINT>>>"


# -- the index -----------------------------------------------------------------------------------


def codebook(halves: np.ndarray, size: int = CODEWORDS, steps: int = STEPS) -> np.ndarray:
    """Codewords of a sample by Lloyd's steps, starting from evenly spaced rows in order of their first entries."""
    distinct = np.unique(halves, axis=0)
    words = distinct[np.linspace(0, len(distinct) - 1, min(size, len(distinct))).astype(int)]
    for _ in range(steps):
        near = nearest(halves, words)
        words = np.array([halves[near == k].mean(axis=0) if (near == k).any() else words[k] for k in range(len(words))])
    return words


def nearest(halves: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words**2).sum(axis=1) - 2 * halves @ words.T, axis=1)


def codebooks(rows: DataFrame, dimension: int) -> list[np.ndarray]:
    """The codebooks of both halves (the second may have no entries)."""
    sample = rows.select("x").orderBy(F.xxhash64("x")).limit(SAMPLE_ROWS).toArrow().column("x").combine_chunks()
    x = matrix(sample, dimension).astype(float)
    return [codebook(x[:, : dimension // 2]), codebook(x[:, dimension // 2 :])]


def narrowest(x: np.ndarray) -> type:
    """The smallest whole-number type that holds all entries."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    return next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def index_of(rows: DataFrame, books: list[np.ndarray], parts: int) -> DataFrame:
    """One row a part, with its rows in the order of their cells (second codeword within first)."""
    half, dimension = books[0].shape[1], books[0].shape[1] + books[1].shape[1]
    cells = len(books[0]) * len(books[1])

    def build(table: pa.Table) -> pa.Table:
        x = matrix(table.column("x").combine_chunks(), dimension)
        halves = [x[:, :half].astype(float), x[:, half:].astype(float)]
        near = [nearest(h, b) for h, b in zip(halves, books)]
        radii = [np.zeros(len(b)) for b in books]
        for h, b, k, r in zip(halves, books, near, radii):
            np.maximum.at(r, k, np.sqrt(((h - b[k]) ** 2).sum(axis=1)))
        cell = near[0] * len(books[1]) + near[1]
        order = np.argsort(cell, kind="stable")
        starts = np.searchsorted(cell[order], np.arange(cells + 1)).astype(np.int64)
        packed = [table.column(c).to_numpy()[order].astype(np.int64) for c in ("id", "label")]
        columns = [table.column("part")[0].as_py(), *[c.tobytes() for c in packed], x[order].astype(narrowest(x)).tobytes(),
                   starts.tobytes(), np.concatenate(radii).tobytes()]
        kinds = [pa.int32()] + [pa.binary()] * 5
        return pa.table([pa.array([c], k) for c, k in zip(columns, kinds)],
                        names=["part", "ids", "labels", "vectors", "cells", "radii"])

    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id", "x"), F.lit(parts)).cast("int"))
    return written(dealt.groupBy("part").applyInArrow(build, _INDEX), "multi-index")


def blocks_of(anchors: DataFrame, blocks: int) -> DataFrame:
    """Anchors (id, label, x, windows) in blocks of one stored row each."""

    def build(table: pa.Table) -> pa.Table:
        x = table.column("x").combine_chunks()
        row = [table.column("block")[0].as_py(),
               table.column("id").to_numpy().astype(np.int64).tobytes(),
               table.column("label").to_numpy().astype(np.int64).tobytes(),
               x.flatten().to_numpy(zero_copy_only=False).tobytes(),
               table.column("windows").to_pylist()]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.list_(pa.list_(pa.int64())))]
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds)],
                        names=["block", "anchors", "labels", "vectors", "windows"])

    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id", "x"), F.lit(blocks)).cast("int"))
    return written(dealt.groupBy("block").applyInArrow(build, _BLOCK), "anchor-blocks")


# -- the search of one part ------------------------------------------------------------------------


def half_bounds(query: np.ndarray, words: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """The most a half within the radius of a codeword can score, with room for rounding."""
    length = np.sqrt((query**2).sum())
    bounds = words @ query + length * radii
    return bounds + 1e-9 * (np.abs(words) @ np.abs(query) + length * radii) + 1e-6


def multi_sequence(first: np.ndarray, second: np.ndarray, used: np.ndarray) -> Iterator[tuple[float, int]]:
    """(bound, cell) of the used cells by falling sum of the bounds of their two codewords."""
    rows, columns = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[rows[0]] + second[columns[0]]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        cell = int(rows[i]) * len(second) + int(columns[j])
        if used[cell]:
            yield -bound, cell
        # Each pair has one predecessor: the one before it in its row, or the one above in the first column.
        if j + 1 < len(columns):
            heapq.heappush(heap, (-(first[rows[i]] + second[columns[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(rows):
            heapq.heappush(heap, (-(first[rows[i + 1]] + second[columns[0]]), i + 1, 0))


class Part:
    """A stored part, unpacked."""

    def __init__(self, row: dict, books: list[np.ndarray]):
        self.half = books[0].shape[1]
        dimension = self.half + books[1].shape[1]
        self.books = books
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        width = len(row["vectors"]) // (len(self.ids) * dimension)
        self.x = np.frombuffer(row["vectors"], f"i{width}").reshape(-1, dimension)
        self.starts = np.frombuffer(row["cells"], np.int64)
        self.used = np.diff(self.starts) > 0
        radii = np.frombuffer(row["radii"], float)
        self.radii = [radii[: len(books[0])], radii[len(books[0]) :]]
        self.largest = float(np.abs(self.x.astype(float)).max(initial=0))
        self.typed = {}

    def asked(self, query: np.ndarray) -> np.ndarray:
        """The query in the smallest floating type in which every partial sum is an exact whole number, else
        in Python's numbers."""
        most = self.largest * float(np.abs(query.astype(float)).max(initial=0)) * len(query)
        kind = next((t for t, limit in _EXACT.items() if most < limit), object)
        if kind not in self.typed:
            self.typed[kind] = self.x.astype(kind)
        return query.astype(kind)

    def scores(self, rows: slice, asked: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        return self.typed[asked.dtype.type if asked.dtype != object else object][rows] @ asked

    def search(self, anchor: int, label: int, query: np.ndarray, windows: list[tuple[int, int]], want: int, same: bool):
        """For each window (low, high) of scores the best ``want`` rows of the same, or of another, label as
        (score, id, label, vector), by falling score, then id."""
        q = query.astype(float)
        bounds = [half_bounds(h, b, r) for h, b, r in zip((q[: self.half], q[self.half :]), self.books, self.radii)]
        found: list[list] = [[] for _ in windows]
        least = [low for low, _ in windows]
        top = max(high for _, high in windows)
        asked = self.asked(query)
        for bound, cell in multi_sequence(bounds[0], bounds[1], self.used):
            need = min(least)
            if bound < need:
                break
            rows = slice(self.starts[cell], self.starts[cell + 1])
            scores = self.scores(rows, asked)
            hits = ((scores >= need) & (scores <= top)).nonzero()[0]
            if not len(hits):
                continue
            at = hits + rows.start
            right = ((self.labels[at] == label) == same) & (self.ids[at] != anchor)
            ordered = sorted(
                (-int(s), i, row) for s, i, row in zip(scores[hits[right]].tolist(), self.ids[at[right]].tolist(), at[right].tolist())
            )
            for w, (_, high) in enumerate(windows):
                start = bisect.bisect_left(ordered, (-high,))
                # Rows tied in score and id are told apart below, so all that tie with the last one come along.
                end = min(start + want, len(ordered))
                while start < end < len(ordered) and ordered[end][:2] == ordered[end - 1][:2]:
                    end += 1
                better = [f for f in ordered[start:end] if -f[0] >= least[w]]
                if better:
                    full = [(*f[:2], int(self.labels[f[2]]), self.x[f[2]].tolist()) for f in better]
                    found[w] = heapq.nsmallest(want, found[w] + full)
                    if len(found[w]) == want:
                        least[w] = -found[w][-1][0]
        return [[(-f[0], *f[1:]) for f in sorted(each)] for each in found]


def _found(blocks: DataFrame, index: DataFrame, books: list[np.ndarray], parts: int, want: int, same: bool) -> DataFrame:
    """(anchor, window, score, id, label, x) that single parts found; each block meets each part once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Part(row, books)
                dimension = part.x.shape[1]
                anchors, labels = (np.frombuffer(row[c], np.int64) for c in ("anchors", "anchor_labels"))
                queries = np.frombuffer(row["anchor_vectors"], np.int64).reshape(-1, dimension)
                out = []
                for anchor, label, query, windows in zip(anchors.tolist(), labels.tolist(), queries, row["windows"]):
                    ranges = [tuple(w) for w in windows]
                    for w, each in enumerate(part.search(anchor, label, query, ranges, want, same)):
                        out += [(anchor, label, query.tolist(), w, *f) for f in each]
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                    columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    copies = blocks.withColumnsRenamed({"labels": "anchor_labels", "vectors": "anchor_vectors"})
    copies = copies.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # A pair is much work for few bytes: pairs are spread by number, not merged by size.
    spark = blocks.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    copies = copies.repartition(tasks, "block", "part")
    return copies.join(index, "part").drop("block", "part").mapInArrow(
        run, "anchor LONG, anchor_label LONG, anchor_x ARRAY<LONG>, `window` INT, score LONG, id LONG, label LONG, x ARRAY<LONG>"
    )


_NAMES = ["anchor", "anchor_label", "anchor_x", "window", "score", "id", "label", "x"]
_RANKED = [F.desc, F.asc, F.asc, F.asc]


def _best(found: DataFrame, of: list[str], want: int) -> DataFrame:
    order = [f(c) for f, c in zip(_RANKED, ("score", "id", "label", "x"))]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*of).orderBy(*order)))
    return ranked.where(F.col("rank") <= want)


# -- the operator ------------------------------------------------------------------------------------


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    vector: str = "embedding",
    label: Column | str = "label",
    key: str = "vec_id",
    scale: int = SCALE,
    part_rows: int = PART_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). ``is_anchor`` is a condition on the column ``id``; scores must be longs."""
    labelled = rows.select(
        F.struct(F.col(f"`{key}`").cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label")).alias("k"),
        F.col(f"`{vector}`").alias("v"),
    )
    sound = whole_vectors(labelled.where("k.id IS NOT NULL AND k.label IS NOT NULL"), "v", "k", scale=scale)
    table = written(sound.select("k.id", "k.label", "x").distinct(), "vectors")
    count, anchors, dimension = table.agg(F.count("*"), F.count_if(is_anchor), F.max(F.size("x"))).first()
    result = "anchor_id LONG, positive_id LONG, rank INT, negative_id LONG, positive_score LONG, negative_score LONG"
    if not anchors:
        return rows.sparkSession.createDataFrame([], result)
    parts, blocks = math.ceil(count / part_rows), math.ceil(anchors / block_rows)
    books = codebooks(table, dimension)
    index = index_of(table, books, parts)

    everything = F.array(F.array(F.lit(-(2**63)), F.lit(2**63 - 1)))
    first = blocks_of(table.where(is_anchor).withColumn("windows", everything), blocks)
    pairs = _best(_found(first, index, books, parts, positives, same=True), ["anchor", "anchor_label", "anchor_x"], positives)
    pairs = written(pairs, "positives")

    # The window of a positive, in whole scores; a positive below 0 has none.
    window = F.array(F.expr(f"CAST(ceil(CAST({low} AS DECIMAL(38,0)) * score / 100) AS BIGINT)"),
                     F.expr(f"CAST(floor(CAST({high} AS DECIMAL(38,0)) * score / 100) AS BIGINT)"))
    opened = pairs.withColumn("w", window).where("w[0] <= w[1]")
    grouped = opened.groupBy("anchor", "anchor_label", "anchor_x").agg(
        F.sort_array(F.collect_list(F.struct("rank", "w", F.col("id").alias("positive"), F.col("score").alias("positive_score")))).alias("wanted")
    )
    wanted = written(grouped, "windows")
    second = blocks_of(
        wanted.select(F.col("anchor").alias("id"), F.col("anchor_label").alias("label"), F.col("anchor_x").alias("x"),
                      F.transform("wanted", lambda s: s["w"]).alias("windows")),
        blocks,
    )
    chosen = _best(_found(second, index, books, parts, negatives, same=False),
                   ["anchor", "anchor_label", "anchor_x", "window"], negatives)
    asked = wanted.select("anchor", "anchor_label", "anchor_x", F.posexplode("wanted").alias("window", "positive"))
    same = ["anchor", "anchor_label", "anchor_x", "window"]
    return chosen.join(asked, same).select(
        F.col("anchor").alias("anchor_id"), F.col("positive.positive").alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), F.col("positive.positive_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )

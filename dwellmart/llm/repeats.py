"""Removal of passages that occurred before, with a count-min prefilter.

A window is ``size`` consecutive words of one document. Every word covered by a window whose words
also start earlier (in a smaller doc_id, or earlier in the document) is removed.

First pass: each partition sketches its windows, the sketches are merged. Every window is counted
by its anchor, the run of size / 2 words in it with the smallest hash: equal windows have equal
anchors at equal places, so the count of an anchor is never below that of its windows, while
neighbouring windows share anchors and there are only about a sixth as many. Counters stop at two.
Second pass: only windows whose anchor is estimated to occur twice are grouped exactly, by 96 bits
of hash. A task first keeps one row for each window among its own rows, so a passage that a third
of all documents share reaches the shuffle once for each task. None can be lost: a sketch that is
too small for its input only lets more windows through to the exact pass.

The sketch has two rows of counters, one bit of each is sent to the executors: at most
2 x ``max_cells`` bits. Merging it is split by blocks of counters.

Nulls and ties: a null or empty text, or one with fewer than ``size`` words, loses nothing. Rows
that repeat both id and text are one document, so neither removes the other; rows with the same id
and different texts are ordered by a 64-bit hash of the text, which tells them apart. A null id comes after all others. Ids must
be integers.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellmart.llm.text import SECOND_BASE, SPACE, Words, mixed, signed, window_hashes, worded

SIZE, MAX_CELLS, BLOCK_CELLS, ROWS = 20, 1 << 29, 1 << 18, 2
CHUNK_WINDOWS = 1 << 20
_SALT = np.uint64(0xA0761D6478BD642F)


def anchors(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and text of every window, hash and place of its anchor (leftmost smallest run)."""
    at, owner = words.windows(size)
    runs = window_hashes(words.hashes(), size // 2)
    best, place = runs[at], at.copy()
    for step in range(1, size - size // 2 + 1):
        other = runs[at + step]
        better = other < best
        best = np.where(better, other, best)
        place[better] = at[better] + step
    return at, owner, best, place


def _cells(values: np.ndarray, width: int) -> list[np.ndarray]:
    """The counter of each value in each row of the sketch."""
    mask = np.uint64(width - 1)
    return [values & mask, mixed(values ^ _SALT) & mask]


def sketch(docs: DataFrame, size: int, width: int) -> DataFrame:
    """Merged counters as (row, block, bits), a bit for each counter that reached two."""

    def partial(batches):
        pending: list[np.ndarray] = []
        for batch in batches:
            for _, words in worded(batch, "text", SPACE, lower=False):
                _, owner, value, place = anchors(words, size)
                if len(place):
                    new = np.concatenate([[True], place[1:] != place[:-1]])
                    pending.append(value[new])
            if sum(map(len, pending)) >= 4 * CHUNK_WINDOWS:
                yield from _counted(np.concatenate(pending))
                pending = []
        if pending:
            yield from _counted(np.concatenate(pending))

    def _counted(values):
        for row, cells in enumerate(_cells(values, width)):
            cells = np.sort(cells)
            first = np.concatenate([[True], cells[1:] != cells[:-1]])
            cell, count = cells[first], np.diff(np.append(np.flatnonzero(first), len(cells)))
            block = (cell // BLOCK_CELLS).astype(np.int64)
            inside = (cell % BLOCK_CELLS).astype(np.uint32)
            # A counter at two or more is sent twice.
            inside, block = np.repeat(inside, np.minimum(count, 2)), np.repeat(block, np.minimum(count, 2))
            cuts = np.flatnonzero(np.diff(block)) + 1
            parts = [x.tobytes() for x in np.split(inside, cuts)]
            numbers = block[np.concatenate([[0], cuts])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row] * len(parts), pa.int32()), pa.array(numbers), pa.array(parts, pa.binary())],
                ["row", "block", "cells"],
            )

    def merge(batches):
        state: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row, block, cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one, two = state.setdefault((row, block), (np.zeros(BLOCK_CELLS, bool), np.zeros(BLOCK_CELLS, bool)))
                inside = np.frombuffer(cells, np.uint32)
                again = np.concatenate([[False], inside[1:] == inside[:-1]])
                two[inside[again]] = True
                fresh = inside[~again]
                two[fresh[one[fresh]]] = True
                one[fresh] = True
        for (row, block), (_, two) in state.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([row], pa.int32()), pa.array([block]), pa.array([np.packbits(two).tobytes()], pa.binary())],
                ["row", "block", "bits"],
            )

    parts = docs.select("text").mapInArrow(partial, "row INT, block BIGINT, cells BINARY")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(tasks, "row", "block").mapInArrow(merge, "row INT, block BIGINT, bits BINARY")


def later_windows(docs: DataFrame, size: int, bits: np.ndarray) -> DataFrame:
    """doc_id, version, start, length: runs of windows that also start earlier.

    ``bits`` holds the packed counters of each sketch row; docs has doc_id, version and text.
    """
    width = bits.shape[1] * 8
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    last = np.iinfo(np.int64).max

    def candidates(batches):
        packed, pending = shared.value, []
        for batch in batches:
            for part, words in worded(batch, "text", SPACE, lower=False):
                at, owner, value, _ = anchors(words, size)
                seen = np.ones(len(at), bool)
                for row, cells in zip(packed, _cells(value, width), strict=True):
                    seen &= (row[cells >> np.uint64(3)] >> (7 - (cells & np.uint64(7)))) & 1 > 0
                at, owner = at[seen], owner[seen]
                ids = part.column(0)
                null = np.asarray(ids.is_null())
                ids = np.where(null, last, ids.fill_null(0).to_numpy(zero_copy_only=False))
                version = part.column(1).to_numpy()
                one = window_hashes(words.hashes(), size)[at]
                two = window_hashes(words.hashes(), size, SECOND_BASE)[at] & np.uint64(0xFFFFFFFF)
                pending.append((one, two, ids[owner], version[owner], at - words.first[owner]))
                if sum(len(x[0]) for x in pending) >= CHUNK_WINDOWS:
                    yield own_first(pending)
                    pending = []
        if pending:
            yield own_first(pending)

    def own_first(pending):
        """One row per window, for the shuffle; runs of windows this chunk had earlier, done already."""
        one, two, ids, version, start = (np.concatenate(x) for x in zip(*pending, strict=True))
        order = np.lexsort((start, version, ids, two, one))
        one, two, ids, version, start = (x[order] for x in (one, two, ids, version, start))
        group = np.ones(len(one), bool)
        group[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        head = np.maximum.accumulate(np.where(group, np.arange(len(one)), 0))
        later = (ids != ids[head]) | (version != version[head]) | (start != start[head])
        done = np.lexsort((start[later], version[later], ids[later]))
        d_ids, d_version, d_start = (x[later][done] for x in (ids, version, start))
        begin = np.ones(len(done), bool)
        begin[1:] = (
            (d_ids[1:] != d_ids[:-1]) | (d_version[1:] != d_version[:-1]) | (d_start[1:] > d_start[:-1] + 1)
        )
        runs = np.flatnonzero(begin)
        ends = np.append(runs[1:], len(done)) - 1
        d_length = d_start[ends] - d_start[runs] + 1 if len(runs) else np.zeros(0, np.int64)
        d_ids, d_version, d_start = d_ids[runs], d_version[runs], d_start[runs]
        # A finished run takes part in the shuffle under a key of its own.
        d_one = mixed(d_ids.astype(np.uint64) ^ mixed(d_start.astype(np.uint64) + _SALT))
        columns = [
            pa.array(signed(np.concatenate([one[group], d_one]))),
            pa.array(np.concatenate([two[group], np.zeros(len(runs), np.uint64)]).astype(np.uint32).view(np.int32)),
            pa.array(np.concatenate([ids[group], d_ids])),
            pa.array(np.concatenate([version[group], d_version])),
            pa.array(np.concatenate([start[group], d_start]).astype(np.int32)),
            pa.array(np.concatenate([np.zeros(int(group.sum()), np.int64), d_length]).astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["one", "two", "id", "version", "start", "length"])

    rows = docs.select("doc_id", "version", "text").mapInArrow(
        candidates, "one BIGINT, two INT, id BIGINT, version BIGINT, start INT, length INT"
    )
    # Finished runs are kept apart from windows that happen to have their key.
    same = Window.partitionBy("one", "two", F.col("length") > 0).orderBy("id", "version", "start")
    ranked = rows.withColumn("rank", F.rank().over(same))
    return ranked.where((F.col("rank") > 1) | (F.col("length") > 0)).select(
        "id", "version", "start", F.greatest("length", F.lit(1)).alias("length")
    )


def without_repeats(
    docs: DataFrame,
    size: int = SIZE,
    max_cells: int = MAX_CELLS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words joined by a space) of every row."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("version"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    # About eight counters for each anchor: one anchor for six words of six bytes.
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("long")).first()[0]
    width = BLOCK_CELLS
    while width < min(total / 8, max_cells):
        width *= 2
    bits = np.zeros((ROWS, width // 8), np.uint8)
    for r in sketch(rows, size, width).toLocalIterator():
        part = np.frombuffer(bytes(r.bits), np.uint8)
        bits[r.row, r.block * len(part) : (r.block + 1) * len(part)] = part
    runs = later_windows(rows, size, bits)
    runs = runs.groupBy("id", "version").agg(
        F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths")
    )
    joined = rows.withColumn("id", F.coalesce("doc_id", F.lit(int(np.iinfo(np.int64).max)))).join(
        runs, ["id", "version"], "left"
    )

    def remove(batches):
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, start, length in zip(
                batch.column(1), batch.column(2), batch.column(3), strict=True
            ):
                words = text.as_py().encode().split()
                counts.append(len(words))
                if start.is_valid:
                    change = np.zeros(len(words) + 1, np.int64)
                    begin = start.values.to_numpy()
                    np.add.at(change, begin, 1)
                    np.add.at(change, begin + length.values.to_numpy() + size - 1, -1)
                    keep = np.cumsum(change)[:-1] == 0
                    words = list(compress(words, keep.tolist()))
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return joined.select("doc_id", "text", "starts", "lengths").mapInArrow(
        remove, "doc_id BIGINT, n_words BIGINT, n_removed BIGINT, kept STRING"
    )

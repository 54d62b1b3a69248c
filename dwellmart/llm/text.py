"""Words, word hashes and windows of Arrow text columns, computed with numpy over slices of rows.

A slice holds whole texts, about SLICE_BYTES of them (one longer text is a slice of its own), so a
task needs memory for a slice and not for its partition. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BASE, SECOND_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


# Bytes that separate words, and the lower-casing of A-Z alone.
SPACE = _byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = _byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, base: np.uint64, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo 2 ** 64, kept for the next call up to a few slices."""
    known = _powers[which]
    if len(known) < count:
        steps = np.full(max(count, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if count <= 4 * SLICE_BYTES:
            _powers[which] = known
    return known[:count]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of consecutive texts; positions are bytes of ``data``."""

    data: np.ndarray
    offsets: np.ndarray  # of the texts in data, one more than there are texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # number of the first word of each text, then the number of all words
    _hashes: np.ndarray | None = field(default=None, repr=False)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words, the same in every process."""
        if self._hashes is None:
            self._hashes = span_hashes(self.data, self.starts, self.ends)
        return self._hashes

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words at which a window of ``size`` words of one text starts; their texts."""
        owners = self.owners()
        room = self.first[1:][owners] - np.arange(len(owners)) >= size
        at = np.flatnonzero(room)
        return at, owners[at]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial over the bytes, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power("up", BASE, len(data)), _power("down", _BASE_INVERSE, len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[data] * up, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(hashes: np.ndarray, size: int, base: np.uint64 = BASE) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values, by joining runs of doubling length."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    done, total = None, 0  # runs of `total` values
    run, length, factor = hashes, 1, base
    left = size
    while left:
        if left & 1:
            if done is None:
                done, total = run, length
            else:
                n = len(hashes) - total - length + 1
                done = done[:n] * factor + run[total : total + n]
                total += length
        left >>= 1
        if left:
            n = len(hashes) - 2 * length + 1
            run = run[:n] * factor + run[length : length + n]
            length *= 2
            factor = np.uint64(int(factor) * int(factor) % (1 << 64))
    return mixed(done)


def tokenise(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool) -> Words:
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    if len(data):
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def tokenise_runs(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lower-cased runs of letters and digits, and runs of other visible ASCII, as words."""
    data = LOWER[data]
    kind = np.where(SPACE[data], 0, np.where(NOT_ALNUM[data], 1, 2)).astype(np.int8)
    before, after = np.zeros(len(data), np.int8), np.zeros(len(data), np.int8)
    if len(data):
        before[1:], after[:-1] = kind[:-1], kind[1:]
        before[offsets[:-1][offsets[:-1] < len(data)]] = 0
        after[offsets[1:][offsets[1:] > 0] - 1] = 0
    starts = np.flatnonzero((kind > 0) & (kind != before))
    ends = np.flatnonzero((kind > 0) & (kind != after)) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with about SLICE_BYTES of text each, with the bytes and offsets of the text."""
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    row = 0
    while row < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), batch.num_rows)
        part = data[offsets[row] : offsets[stop]]
        yield batch.slice(row, stop - row), part, offsets[row : stop + 1] - offsets[row]
        row = stop


def worded(batch: pa.RecordBatch, column: str, separators: np.ndarray, lower: bool):
    """(rows, words) of each slice of a batch."""
    for rows, data, offsets in sliced(batch, column):
        yield rows, tokenise(data, offsets, separators, lower)


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Lists of the given lengths cut from one array."""
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values).cast(kind))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)

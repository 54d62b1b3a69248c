"""Test items that occur in training documents, by a distributed positional inverted index.

The index is partitioned by document, so it needs no shuffle: each row stores the posting lists
(term, positions) of one document for the terms that test items use. How often each term occurs in
the whole corpus is counted over the stored index. The test windows then go to every partition;
there each window starts from the list of its rarest term and is intersected, in order of rising
frequency, with the lists of its other terms, each shifted by the term's offset in the window.
What is left after the last term is an exact phrase match. Proximity matches are documents in which,
for some window of an item, the ``near_terms`` rarest different terms of the window all occur, each
within ``slop`` words of where it stands in the window as seen from the rarest one. So every exact
match is a proximity match too, and part of an item or an edited passage is found by the windows that
kept their rarest terms. Terms of equal frequency are taken in the order of the window.

Terms are 64-bit word hashes numbered from 0. Test items are handled in blocks of about
``block_words`` words, which bounds what is broadcast; the results of several blocks are merged.

Nulls and ties: a null or empty text has no words, is never hit, and as an item matches nothing.
Every input row gives one result row, repeated rows equal ones. Items with equal texts all match. A
null item id is reported as an item without a name: it counts, and is left out of the list of ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.text import NOT_ALNUM, lists, signed, worded
from dwellmart.session import written

WINDOW, SLOP, NEAR_TERMS, BLOCK_WORDS = 10, 20, 3, 5_000_000
SLICE_POSTINGS = 1 << 20
INDEX = "doc_id {0}, text_key BINARY, n_words BIGINT, terms ARRAY<INT>, positions ARRAY<INT>"


class Tests:
    """The windows of one block of test items, over numbered terms."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        self.names = [name for name, _ in items]
        self.terms = np.unique(np.concatenate([h for _, h in items] or [np.zeros(0, np.uint64)]))
        self.items = [np.searchsorted(self.terms, hashes) for _, hashes in items]
        found: dict[tuple[int, ...], set[int]] = {}
        for number, words in enumerate(self.items):
            for start in range(max(1, len(words) - window + 1) if len(words) else 0):
                found.setdefault(tuple(words[start : start + window].tolist()), set()).add(number)
        self.windows, self.owners = list(found), [sorted(x) for x in found.values()]
        self.size = window

    def ranked(self, frequency: np.ndarray):
        """Terms and offsets of each window, rarest first; -1 beyond the end of a shorter one."""
        terms = np.full((len(self.windows), self.size), -1, np.int64)
        for row, words in zip(terms, self.windows, strict=True):
            row[: len(words)] = words
        lengths = (terms >= 0).sum(1)
        key = np.where(terms >= 0, frequency[terms], np.iinfo(np.int64).max)
        offsets = np.argsort(key, axis=1, kind="stable")
        return np.take_along_axis(terms, offsets, 1), offsets, lengths

    def nearby(self, terms: np.ndarray, offsets: np.ndarray, count: int):
        """The ``count`` rarest different terms of each window, -1 where it has fewer, and their distances
        from the rarest, given ranked windows. Windows that agree in both are one row; its items."""
        rare, away = np.full((len(terms), count), -1, np.int64), np.zeros((len(terms), count), np.int64)
        taken = np.zeros(len(terms), np.int64)
        for rank in range(terms.shape[1]):
            term = terms[:, rank]
            rows = np.flatnonzero((term >= 0) & (taken < count) & ~(rare == term[:, None]).any(1))
            rare[rows, taken[rows]] = term[rows]
            away[rows, taken[rows]] = offsets[rows, rank] - offsets[rows, 0]
            taken[rows] += 1
        both, row = np.unique(np.concatenate([rare, away], axis=1), axis=0, return_inverse=True)
        items: list[set[int]] = [set() for _ in both]
        for i, owners in zip(row.ravel().tolist(), self.owners, strict=True):
            items[i].update(owners)
        return both[:, :count], both[:, count:], [sorted(x) for x in items]


def build_index(
    docs: DataFrame, terms: np.ndarray, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of posting lists per document, sorted by term and position, for the given terms."""
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.unhex(F.md5(F.coalesce(text_column, F.lit("")).cast("binary"))).alias("text_key"),
        F.col(text_column).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def index(batches):
        known = shared.value
        for batch in batches:
            for part, words in worded(batch, "text", NOT_ALNUM, lower=True):
                hashes, owners = words.hashes(), words.owners()
                found = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                at = np.flatnonzero(known[found] == hashes) if len(known) else np.zeros(0, np.int64)
                term, owner = found[at], owners[at]
                position = at - words.first[owner]
                order = np.lexsort((position, term, owner))
                counts = np.bincount(owner, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(words.counts, pa.int64()),
                        lists(term[order], counts, pa.int32()),
                        lists(position[order], counts, pa.int32()),
                    ],
                    ["doc_id", "text_key", "n_words", "terms", "positions"],
                )

    return rows.mapInArrow(index, INDEX.format(rows.schema["doc_id"].dataType.simpleString()))


def term_frequencies(index: DataFrame, count: int) -> np.ndarray:
    """Occurrences of each term in the whole corpus; one number per term of the block."""

    def partial(batches):
        total = np.zeros(count, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=count)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "n"])

    counted = index.select("terms").mapInArrow(partial, "term BIGINT, n BIGINT")
    frequency = np.zeros(count, np.int64)
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        frequency[row.term] = row.n
    return frequency


def _index_slices(batch: pa.RecordBatch):
    ends = np.concatenate([[0], np.cumsum(batch.column(3).value_lengths().to_numpy())])
    row = 0
    while row < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[row] + SLICE_POSTINGS, side="right")) - 1
        stop = min(max(stop, row + 1), batch.num_rows)
        yield batch.slice(row, stop - row)
        row = stop


def matches(
    index: DataFrame, tests: Tests, frequency: np.ndarray, slop: int = SLOP, near_terms: int = NEAR_TERMS
) -> DataFrame:
    """doc_id, text_key, n_words, hits (numbers of the words in an exact match), items, near_items."""
    terms, offsets, lengths = tests.ranked(frequency)
    rare, away, near_owners = tests.nearby(terms, offsets, near_terms)
    shared = index.sparkSession.sparkContext.broadcast((terms, offsets, lengths, rare, away))
    names = index.sparkSession.sparkContext.broadcast((tests.names, tests.owners, near_owners))

    def search(batches):
        for batch in batches:
            for part in _index_slices(batch):
                yield _search(part, *shared.value)

    def _search(part, terms, offsets, lengths, rare, away):
        owner = np.repeat(np.arange(part.num_rows), part.column(3).value_lengths().to_numpy())
        sizes = part.column(2).to_numpy()
        base = np.concatenate([[0], np.cumsum(sizes)])
        span = int(base[-1]) + 1
        place = base[owner] + part.column(4).flatten().to_numpy()
        postings = np.sort(part.column(3).flatten().to_numpy().astype(np.int64) * span + place)

        def expanded(term):
            """Every posting of each term: which of the terms, and the place."""
            low = np.searchsorted(postings, term * span)
            many = np.searchsorted(postings, (term + 1) * span) - low
            which = np.repeat(np.arange(len(term)), many)
            inside = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            return which, postings[low[which] + inside] - term[which] * span

        def there(key):
            found = np.searchsorted(postings, key)
            return (found < len(postings)) & (postings[np.minimum(found, len(postings) - 1)] == key)

        window, start = expanded(terms[:, 0]) if len(terms) and len(postings) else (np.zeros(0, int),) * 2
        if len(window):
            at = np.searchsorted(base, start, side="right") - 1
            start = start - offsets[window, 0]
            fits = (start >= base[at]) & (start + lengths[window] <= base[at + 1])
            window, start, at = window[fits], start[fits], at[fits]
            for rank in range(1, terms.shape[1]):
                term = terms[window, rank]
                good = (term < 0) | there(term * span + start + offsets[window, rank])
                window, start, at = window[good], start[good], at[good]
        change = np.zeros(span + 1, np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, start + lengths[window], -1)
        hit = np.flatnonzero(np.cumsum(change)[: span - 1] > 0)
        hit_doc = np.searchsorted(base, hit, side="right") - 1
        hits = lists(hit - base[hit_doc], np.bincount(hit_doc, minlength=part.num_rows), pa.int32())
        items: list[set] = [set() for _ in range(part.num_rows)]
        for w, d in (np.unique(np.stack([window, at]), axis=1).T.tolist() if len(window) else []):
            items[d].update(names.value[1][w])
        near: list[set] = [set() for _ in range(part.num_rows)]
        probe, place = expanded(rare[:, 0]) if len(rare) and len(postings) else (np.zeros(0, int),) * 2
        at = np.searchsorted(base, place, side="right") - 1
        for rank in range(1, rare.shape[1]):
            term, there_about = rare[probe, rank], place + away[probe, rank]
            low = np.maximum(there_about - slop, base[at])
            found = np.minimum(np.searchsorted(postings, term * span + low), max(len(postings) - 1, 0))
            next_place = postings[found] - term * span if len(postings) else place
            high = np.minimum(there_about + slop, base[at + 1] - 1)
            good = (term < 0) | ((next_place >= low) & (next_place <= high))
            probe, place, at = probe[good], place[good], at[good]
        for p, d in (np.unique(np.stack([probe, at]), axis=1).T.tolist() if len(probe) else []):
            near[d].update(names.value[2][p])
        named = [[names.value[0][i] for i in sorted(x)] for x in items]
        also = [[names.value[0][i] for i in sorted(x)] for x in near]
        kind = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), part.column(2), hits, pa.array(named, kind), pa.array(also, kind)],
            ["doc_id", "text_key", "n_words", "hits", "items", "near_items"],
        )

    kind = index.schema["doc_id"].dataType.simpleString()
    columns = "text_key BINARY, n_words BIGINT, hits ARRAY<INT>, items ARRAY<STRING>, near_items ARRAY<STRING>"
    return index.mapInArrow(search, f"doc_id {kind}, {columns}")


def contamination(
    docs: DataFrame,
    tests: DataFrame,
    window: int = WINDOW,
    slop: int = SLOP,
    near_terms: int = NEAR_TERMS,
    block_words: int = BLOCK_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """For every document: n_words, hits, items (ids as strings, sorted) and near_items."""

    def item_words(batches):
        for batch in batches:
            for part, words in worded(batch, "text", NOT_ALNUM, lower=True):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists(signed(words.hashes()), words.counts, pa.int64())],
                    ["item_id", "words"],
                )

    items = tests.select(F.col(item_column).cast("string").alias("item_id"), F.col(item_text_column).alias("text"))
    items = written(items.mapInArrow(item_words, "item_id STRING, words ARRAY<BIGINT>"), "test-items")
    total = items.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_words))
    parts = []
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).collect()
        found = Tests([(r.item_id, np.array(r.words, np.int64).view(np.uint64)) for r in chosen], window)
        index = written(build_index(docs, found.terms, id_column, text_column), "postings")
        frequency = term_frequencies(index, len(found.terms))
        parts.append(matches(index, found, frequency, slop, near_terms))
    result = parts[0]
    if blocks > 1:
        for part in parts[1:]:
            result = result.unionAll(part)
        together = result.groupBy("doc_id", "text_key", "n_words").agg(
            (F.count("*") / blocks).cast("int").alias("copies"),
            *[F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "items", "near_items")],
        )
        result = together.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return result.select(
        "doc_id", "text_key", "n_words",
        *[F.array_sort(F.array_distinct(c)).alias(c) for c in ("hits", "items", "near_items")],
    )

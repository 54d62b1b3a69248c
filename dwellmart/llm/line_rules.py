"""Line-first cleaning: lines are judged, failing ones removed, and documents that lose too much go.

A line is what stands between two line feeds. A line with a word fails if one of these rules holds.

* punctuation: fewer than ``least_letters`` of its visible characters are letters or digits, or its
  words are mostly signs (such as bars between cells of a table), or most of them are shouted (end
  in an exclamation mark);
* navigation: it has a navigation phrase and no more than ``short_line`` words;
* boilerplate: it has a boilerplate phrase, or repeats an earlier line of the document.

A document is kept if it passes the base rules and its remaining words are at least ``least_left``
of all. The statistics that the base rules use are those of the whole text.

Nulls and ties: a null text is empty; a text without words fails the base rules. Repeated rows are
judged alike. Lines without a word are neither counted nor removed. Phrases are looked for in the words
of a line joined by single spaces, whatever white space stands between them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.text import SPACE, Words, window_hashes, worded

# Fixed values of the rules.
LEAST_WORDS, REPEATED_SHARE = 50, 50
LEAST_LETTERS, SIGN_WORDS, SHORT_LINE, LEAST_LEFT = 0.6, 0.3, 12, 0.5
NAVIGATION = ["home", "next page", "previous page", "back to top", "sign in", "log in", "site map", "skip to content", "read more"]
BOILERPLATE = ["all rights reserved", "terms of use", "privacy policy", "cookie policy", "accept cookies", "javascript is disabled"]
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
VISIBLE_SIGN = np.array([33 <= b <= 126 and not chr(b).isalnum() for b in range(256)])
_navigation = regex.compile(r"\b(?:" + "|".join(NAVIGATION) + r")\b", regex.IGNORECASE)
_boilerplate = regex.compile(r"\b(?:" + "|".join(BOILERPLATE) + r")\b", regex.IGNORECASE)


def _per_text(sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(sums)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(words: Words, size: int = 3) -> np.ndarray:
    """Words of each text inside windows of ``size`` words that the text has twice or more."""
    at, owner = words.windows(size)
    if not len(at):
        return np.zeros(len(words.counts), np.int64)
    value = window_hashes(words.hashes(), size)[at]
    order = np.lexsort((value, owner))
    same = (value[order][1:] == value[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    change = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(change, at[again], 1)
    np.add.at(change, at[again] + size, -1)
    return _per_text((np.cumsum(change)[:-1] > 0).astype(np.int64), words.first)


def judged_lines(text: bytes) -> tuple[int, bytes, list[str]]:
    """Repeated lines, the text of the lines left, and the reasons of the lines removed."""
    earlier: set[bytes] = set()
    repeats = 0
    left, reasons = [], []
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            left.append(line)
            continue
        repeated = line in earlier
        repeats += repeated
        earlier.add(line)
        # Signs are ASCII; every byte of a longer character counts as a letter's.
        signs = len(line) - len(line.translate(None, SIGN_BYTES))
        shown = sum(map(len, words))
        bare = sum(not w.translate(None, SIGN_BYTES) for w in words)
        phrase = b" ".join(words).decode("utf-8", "replace")
        if shown - signs < LEAST_LETTERS * shown or bare > SIGN_WORDS * len(words) or (
            len(words) > 3 and line.count(b"!") > len(words) / 2
        ):
            reasons.append("punctuation")
        elif len(words) <= SHORT_LINE and _navigation.search(phrase):
            reasons.append("navigation")
        elif repeated or _boilerplate.search(phrase):
            reasons.append("boilerplate")
        else:
            left.append(line)
    return repeats, b"\n".join(left), reasons


SIGN_BYTES = bytes(np.flatnonzero(VISIBLE_SIGN).tolist())


def cleaned(docs: DataFrame, least_left: float = LEAST_LEFT, id_column: str = "doc_id", text_column: str = "text"):
    """Statistics and verdict of every document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, words_left, removed (lines removed for each reason), base_failed, kept, and text: the
    lines left, joined by line feeds (those of a document that isn't kept, too)."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def judge(batches):
        for batch in batches:
            for part, words in worded(batch, "text", SPACE, lower=False):
                begins = ((words.data & 0xC0) != 0x80).astype(np.int64)  # one for each code point
                chars = _per_text(begins * ~SPACE[words.data], words.offsets)
                symbols = _per_text(SYMBOLS[words.data].astype(np.int64), words.offsets)
                data = words.data.tobytes()
                lines = [judged_lines(data[a:b]) for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
                repeated = repeated_words(words)
                n = words.counts
                left = np.array([len(x[1].split()) for x in lines], np.int64)
                failed = (n < LEAST_WORDS) | (100 * repeated > REPEATED_SHARE * n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(n, pa.int64()), pa.array(chars, pa.int64()),
                        pa.array(symbols, pa.int64()), pa.array([x[0] for x in lines], pa.int64()),
                        pa.array(repeated, pa.int64()), pa.array(left),
                        pa.array([x[2] for x in lines], pa.list_(pa.string())),
                        pa.array(failed), pa.array(~failed & (left >= least_left * n)),
                        pa.array([x[1] for x in lines], pa.binary()).cast(pa.string()),
                    ],
                    names,
                )

    names = [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "words_left",
        "removed", "base_failed", "kept", "text",
    ]
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{name} BIGINT" for name in names[1:7])
    return rows.mapInArrow(judge, f"doc_id {kind}, {counts}, removed ARRAY<STRING>, base_failed BOOLEAN, kept BOOLEAN, text STRING")

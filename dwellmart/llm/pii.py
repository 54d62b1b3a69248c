"""Personal data by patterns and by a skip-chain conditional random field.

Patterns give the base spans. The field then labels the words with a digit or an at-sign of a
document. Neighbouring ones are linked in a chain; those equal but for signs and case are linked
with the next such word however far away, and so are long ones that agree in their first or last half,
so a mention that no pattern accepts takes the label of its clear occurrence. Loopy sum-product message passing over both kinds of links gives marginals,
and words with a marginal of ``least`` or more become further spans where no base span lies.

The field is trained on the whole corpus, piece by piece: base spans label the words. That a number with
the digits of a card fails its check digit says no more than that it was mistyped or run together with
its neighbour, so the words of such a number are labelled neither way and not learned from. Counts of
(features, label), (label, next label) and (label, skip label) are summed by Spark. There are no
more than 2 ** FEATURES feature patterns; word weights are fitted to those counts, link weights are
the smoothed log ratios of joint to separate counts.

Nulls and ties: a null text is empty. Touching or overlapping base spans of different kinds all
stay. A text without digits and at-signs is not looked at further. Repeated rows have equal results.
Very long texts are taken whole, in time linear in their length. Other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.text import SPACE, worded

# Kinds in the order of the output, and the patterns of the base.
KINDS = ["email", "ip", "card", "phone"]
_local = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_not_digits, _not_alnum = re.compile(r"[^0-9]+"), re.compile(r"[\W_]+")

LABELS, FEATURES, ROUNDS, LEAST, HALVED = 1 + len(KINDS), 14, 8, 0.95, 12


def _emails(text: str):
    """Matches of local part, at-sign and domain, found from each at-sign in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _domain.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str, doubtful: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start, in code points. Numbers with the digits of a card that fail its check
    are added to ``doubtful``."""
    spans = [(0, a, b) for a, b in _emails(text)]
    for m in _ip.finditer(text):
        parts = [x.lstrip("0") or "0" for x in m[0].split(".")]
        if all(len(x) <= 3 and int(x) <= 255 for x in parts):
            spans.append((1, *m.span()))
    for m in _card.finditer(text):
        digits = _not_digits.sub("", m[0])
        if 16 <= len(digits) <= 19:
            if _luhn(digits):
                spans.append((2, *m.span()))
            elif doubtful is not None:
                doubtful.append(m.span())
    if "+" in text:
        for m in _phone.finditer(text):
            if 8 <= len(_not_digits.sub("", m[0])) <= 15:
                spans.append((3, *m.span()))
    return spans


def _pattern(word: str, before: str, adjacent: bool) -> int:
    """Features of a word as bits."""
    digits, at = sum(c.isdigit() for c in word), word.find("@")
    bits = [
        at >= 0, at >= 0 and "." in word[at:], word.count(".") == 3, word.count(".") > 3,
        word[0] == "+", before[:1] == "+" and adjacent, "(" in word, "-" in word,
        0 < digits < 4, 4 <= digits < 8, 8 <= digits < 16, 16 <= digits < 20, digits >= 20,
        sum(c.isalpha() for c in word) > 1,
    ]
    return sum(1 << i for i, bit in enumerate(bits) if bit)


class Graph:
    """The words of one document that the field labels."""

    def __init__(self, text: str, spans, starts: list[int], ends: list[int], numbers: list[int], doubtful=()):
        self.text, self.spans = text, [(a, b) for a, b in zip(starts, ends, strict=True)]
        words = [text[a:b] for a, b in self.spans]
        adjacent = [False] + [y - x == 1 for x, y in zip(numbers, numbers[1:])]
        self.chain = [(i - 1, i) for i in range(1, len(words)) if adjacent[i]]
        self.patterns = [_pattern(w, words[i - 1] if i else "", adjacent[i]) for i, w in enumerate(words)]
        last: dict[tuple[int, str], int] = {}
        self.skip = []
        for i, word in enumerate(words):
            form = _not_alnum.sub("", word).lower()
            if len(form) > 3:
                keys = [(0, form)]
                if len(form) >= HALVED:
                    keys += [(1, form[: len(form) // 2]), (2, form[len(form) // 2 :])]
                alike = {last[key] for key in keys if key in last}
                self.skip += [(j, i) for j in sorted(alike) if (j, i) not in self.chain[-1:]]
                last.update(dict.fromkeys(keys, i))
        self.labels = self._met([(kind + 1, a, b) for kind, a, b in spans])
        met = self._met([(1, a, b) for a, b in doubtful])
        self.unsure = [bool(doubt and not label) for doubt, label in zip(met, self.labels, strict=True)]

    def _met(self, marked: list[tuple[int, int, int]]) -> list[int]:
        """For each word the mark of the first marked span that it meets, 0 for none."""
        found = [0] * len(self.spans)
        order = sorted(marked, key=lambda s: s[1])
        k = 0
        for i, (a, b) in enumerate(self.spans):
            while k < len(order) and order[k][2] <= a and order[k][1] < a:
                k += 1
            for at in range(k, len(order)):
                mark, x, y = order[at]
                if x >= b:
                    break
                if y > a:
                    found[i] = mark
                    break
        return found


def _documents(batches):
    """(row number in slice, text, base spans, graph) of the texts with a digit or an at-sign."""
    marked = np.isin(np.arange(256), list(b"0123456789@"))
    for batch in batches:
        for part, words in worded(batch, "text", SPACE, lower=False):
            seen = np.concatenate([[0], np.cumsum(marked[words.data])])
            candidate = np.flatnonzero(seen[words.ends] > seen[words.starts])
            owner = np.searchsorted(words.first, candidate, side="right") - 1
            point = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
            data, found = words.data.tobytes(), []
            cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
            for i in np.unique(owner).tolist():
                mine = candidate[cuts[i] : cuts[i + 1]]
                begin = words.offsets[i]
                text = data[begin : words.offsets[i + 1]].decode()
                doubtful: list[tuple[int, int]] = []
                spans = base_spans(text, doubtful)
                starts, ends = (point[x[mine]] - point[begin] for x in (words.starts, words.ends))
                found.append((i, spans, Graph(text, spans, starts.tolist(), ends.tolist(), mine.tolist(), doubtful)))
            yield part, found


class Field:
    """Weights of the field, fitted to counts over the corpus."""

    def __init__(self, words: np.ndarray, chain: np.ndarray, skip: np.ndarray, steps: int = 300):
        """words: rows of (pattern, label, count); chain, skip: counts of label pairs."""
        x = ((words[:, :1] >> np.arange(FEATURES)) & 1).astype(float)
        x = np.hstack([x, np.ones((len(x), 1))])
        y, n = np.eye(LABELS)[words[:, 1]], words[:, 2:] / max(1, words[:, 2].sum())
        self.weights = np.zeros((FEATURES + 1, LABELS))
        pace = np.zeros_like(self.weights)
        for _ in range(steps):  # gradient steps scaled by their own size so far
            p = self._softmax(x @ self.weights)
            gradient = x.T @ ((p - y) * n) + 1e-5 * self.weights
            pace += gradient * gradient
            self.weights -= 0.5 * gradient / np.sqrt(pace + 1e-12)
        self.chain, self.skip = self._links(chain), self._links(skip)

    @staticmethod
    def _softmax(a):
        a = np.exp(a - a.max(-1, keepdims=True))
        return a / a.sum(-1, keepdims=True)

    @staticmethod
    def _links(counts):
        joint = (counts + 0.5) / (counts + 0.5).sum()
        return np.clip(np.log(joint / np.outer(joint.sum(1), joint.sum(0))), -4, 4)

    def marginals(self, graph: Graph) -> np.ndarray:
        patterns = np.array(graph.patterns)
        x = np.hstack([(patterns[:, None] >> np.arange(FEATURES)) & 1, np.ones((len(patterns), 1))])
        own = x @ self.weights
        edges = np.array(graph.chain + graph.skip, int).reshape(-1, 2)
        if not len(edges):
            return self._softmax(own)
        weights = np.array([self.chain] * len(graph.chain) + [self.skip] * len(graph.skip))
        # Messages in both directions of every edge, in logarithms.
        source, sink = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        weights = np.concatenate([weights, weights.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        messages = np.zeros((len(source), LABELS))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, sink, messages)
            out = belief[source] - messages[back]
            out = out[:, :, None] + weights
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None]).sum(1))
            messages = 0.5 * messages + 0.5 * (new - new.max(1, keepdims=True))
        belief = own.copy()
        np.add.at(belief, sink, messages)
        return self._softmax(belief)


def train(docs: DataFrame) -> Field:
    """A field from the counts of all documents."""

    def partial(batches):
        counts: dict[tuple[str, int, int], int] = {}
        for _, found in _documents(batches):
            for _, _, graph in found:
                labels, unsure = graph.labels, graph.unsure
                keys = [("word", p, y) for p, y, u in zip(graph.patterns, labels, unsure, strict=True) if not u]
                for what, links in (("chain", graph.chain), ("skip", graph.skip)):
                    keys += [(what, labels[a], labels[b]) for a, b in links if not (unsure[a] or unsure[b])]
                for key in keys:
                    counts[key] = counts.get(key, 0) + 1
        if counts:
            what, a, b = zip(*counts, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(what), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(counts.values(), pa.int64())],
                ["what", "a", "b", "n"],
            )

    counted = docs.select("text").mapInArrow(partial, "what STRING, a BIGINT, b BIGINT, n BIGINT")
    rows = sorted(counted.groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect())
    words = np.array([(r.a, r.b, r.n) for r in rows if r.what == "word"], np.int64).reshape(-1, 3)
    links = {"chain": np.zeros((LABELS, LABELS)), "skip": np.zeros((LABELS, LABELS))}
    for r in rows:
        if r.what != "word":
            links[r.what][r.a, r.b] = r.n
    return Field(words, links["chain"], links["skip"])


def added_spans(graph: Graph, spans, marginals: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """Runs of words the field is sure of, where no base span lies."""
    best = marginals.argmax(1)
    sure = (best > 0) & (marginals.max(1) >= least) & (np.array(graph.labels) == 0)
    linked = set(graph.chain)
    runs: list[list[int]] = []
    for i in np.flatnonzero(sure).tolist():
        a, b = graph.spans[i]
        if runs and (runs[-1][3], i) in linked and runs[-1][0] == best[i] - 1:
            runs[-1][2:] = [b, i]
        else:
            runs.append([int(best[i]) - 1, a, b, i])
    found = []
    for kind, a, b, _ in runs:
        while b > a and not (graph.text[b - 1].isalnum() or graph.text[b - 1] == ")"):
            b -= 1
        while a < b and not (graph.text[a].isalnum() or graph.text[a] in "+("):
            a += 1
        found += [(kind, a, b)] * (a < b)
    return found


def spans(docs: DataFrame, least: float = LEAST, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, base and spans of every document: arrays of (kind, start, end), by kind and start."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(train(rows))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def named(found):
        return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(found)]

    def find(batches):
        for part, found in _documents(batches):
            base, every = [[] for _ in range(part.num_rows)], [[] for _ in range(part.num_rows)]
            for i, known, graph in found:
                more = added_spans(graph, known, shared.value.marginals(graph), least)
                base[i], every[i] = named(known), named(known + more)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(base, kind), pa.array(every, kind)], ["doc_id", "base", "spans"]
            )

    one = "ARRAY<STRUCT<kind: STRING, start: INT, end: INT>>"
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {id_type}, base {one}, spans {one}")

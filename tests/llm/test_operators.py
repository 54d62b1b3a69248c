"""Each operator against plain Python, on awkward rows and (where small enough) the smallest table."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from dwellmart.llm import (
    contamination, licences, line_rules, mixing, ngram_join, pages, pii, quality, repeats, shards, text,
)
from dwellmart.llm.components import connected_components

from .conftest import ROWS

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_words_are_those_of_the_expression():
    import pyarrow as pa

    values = [row[1] for row in ROWS]
    words = text.tokenise(*text.text_bytes(pa.array(values)), text.NOT_ALNUM, lower=True)
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]
    expected = [ALNUM.findall((v or "").translate(LOWER)) for v in values]
    assert found == [w for ws in expected for w in ws]
    assert words.counts.tolist() == [len(ws) for ws in expected]


def shingles(value, size):
    words = SPACED.findall((value or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


@pytest.mark.parametrize(("size", "num", "den"), [(4, 85, 100), (5, 8, 10)])
def test_join(docs, size, num, den):
    sets = [(r[0], shingles(r[1], size)) for r in ROWS]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            if None not in (a, b) and x and y and den * len(x & y) >= num * len(x | y):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (a, _) in enumerate(sets):
        if a is not None:
            least[find(i)] = min(least.get(find(i), a), a)
    expected = [(a, len(x), least[find(i)] if a is not None else None) for i, (a, x) in enumerate(sets)]
    found = [tuple(r) for r in ngram_join.groups(docs, size, num, den).collect()]
    assert collections.Counter(found) == collections.Counter(expected)


def test_copies_in_several_slices_are_signed_once(spark, monkeypatch):
    """Copies must not multiply the lists: a list with r rows of one class and s of another makes r times s pairs."""
    words = [f"w{i}" for i in range(30)]
    near = " ".join(words[:-1] + ["other"])
    rows = [(i, " ".join(words)) for i in range(8)] + [(10 + i, near) for i in range(8)] + [(3, "another text of this id")]
    made, make = [], ngram_join.signatures
    monkeypatch.setattr(ngram_join, "signatures", lambda *given: made.append(make(*given).collect()) or make(*given))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(8)
    found = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.groups(docs).collect()}
    assert found == {**{(i, 26): 0 for i in [*range(8), *range(10, 18)]}, (3, 1): 3}
    listed = collections.Counter((r.signature, bytes(r.key)) for r in made[0])
    assert listed and max(listed.values()) == 1


def test_join_needs_a_similarity_above_one_half():
    with pytest.raises(ValueError):
        ngram_join.Rule(4, 1, 2)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51), (7, 7), (None, 3)], "a INT, b INT")
    found = {r.node: r.component for r in connected_components(edges, "a", "b").collect()}
    assert found == {**dict.fromkeys(range(21), 0), 50: 50, 51: 50}


def test_quality(docs, labels, empty):
    found = quality.quality_scores(docs, labels).collect()
    assert len(found) == len(ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found if r.doc_id is not None)
    none = quality.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_scores(empty, labels).count() == 0


def test_shards(docs, empty):
    found = shards.assign(docs, shards=3).collect()
    assert len(found) == len(ROWS)
    places = collections.defaultdict(list)
    for r in found:
        places[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    text_of = collections.defaultdict(set)
    for r in found:
        text_of[r["text_crc32"], r["size"]].add(r.shard)
    assert all(len(x) == 1 for x in text_of.values())
    assert collections.Counter(r["size"] for r in found) == collections.Counter(len((v or "").encode()) + 1 for _, v, *_ in ROWS)
    assert shards.assign(empty, shards=3).count() == 0


def test_best_fit_decreasing_takes_the_tightest_bin():
    sizes = [7, 6, 5, 4, 3, 2, 2, 1]
    bins = collections.defaultdict(int)
    for size, shard in zip(sizes, shards.best_fit_decreasing(sizes, 10), strict=True):
        bins[shard] += size
    assert sorted(bins.values()) == [10, 10, 10]
    assert shards.best_fit_decreasing([12, 1], 10) == [0, 1]


def test_spans(docs, empty):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    }
    for value in ["a@b.c_d@e.f x@y @z.z", "1.2.3.4.5.6.7.8 999.1.1.1 a@b..c", "éa@b.cd 1.2.3.4"]:
        expected = [
            (pii.KINDS.index(k), m.start(), m.end())
            for k, p in patterns.items() for m in re.finditer(p, value)
            if k == "email" or all(int(x) <= 255 for x in m[0].split("."))
        ]
        assert [s for s in pii.base_spans(value) if s[0] < 2] == expected
    zeros = "0" * 5_000
    assert pii.base_spans(f"{zeros}1.2.3.4 {zeros}256.2.3.4") == [(1, 0, 5_007)]
    found = {r.doc_id: r for r in pii.spans(docs).collect()}
    assert [s.kind for s in found[8].base] == ["email", "ip", "card", "phone"]
    assert found[4].spans == found[5].spans == []
    assert pii.spans(empty).count() == 0


def test_licences(docs, empty):
    found = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert found[9].places[0].label == "mit" and found[9].places[0].word == 3
    assert [m.label for m in found[9].matches] == ["mit"]
    for doc_id, value, *_ in ROWS:
        assert found[doc_id].n_words == len(ALNUM.findall((value or "").translate(LOWER)))
    assert licences.scan(empty).count() == 0


@pytest.mark.parametrize("block_words", [5_000_000, 20])
def test_contamination(spark, docs, empty, block_words):
    items = [(1, ROWS[0][1][40:160]), (2, "lost words"), (3, None), (4, ""), (5, "absent words only"), (None, "one two")]
    tests = spark.createDataFrame(items, "item_id LONG, text STRING")
    windows = {}
    for item, value in items:
        words = ALNUM.findall((value or "").translate(LOWER))
        for i in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item)
    expected = []
    for doc_id, value, *_ in ROWS:
        words = ALNUM.findall((value or "").translate(LOWER))
        hit, names = set(), set()
        for window, owners in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    names |= owners
        expected.append((doc_id, len(words), tuple(sorted(hit)), tuple(sorted(str(n) for n in names if n is not None))))
    rows = contamination.contamination(docs, tests, block_words=block_words).collect()
    found = [(r.doc_id, r.n_words, tuple(r.hits), tuple(i for i in r["items"] if i is not None)) for r in rows]
    assert collections.Counter(found) == collections.Counter(expected)
    assert contamination.contamination(empty, tests).count() == 0


PAGE = """<html><body><nav><a href=/>Home</a></nav><article><h1>T&eacute;st</h1><p><b>one
 two<br>three<p>four</p><div class="ad">buy</div></article><footer>end</footer><script>x="</p>"</script></body></html>"""


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "<"), (1, "u", PAGE)]
    frame = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")
    found = [(r.page_id, r.text) for r in pages.extract(frame).collect()]
    main = "Tést\n\none two three\n\nfour"
    assert sorted(found) == [(1, main), (1, main), (2, ""), (3, ""), (4, "")]
    assert pages.extract(frame.limit(0)).count() == 0


def test_line_rules(docs, empty):
    found = {r.doc_id: r for r in line_rules.cleaned(docs).collect()}
    for doc_id, value, *_ in ROWS:
        words, earlier, again = SPACED.findall(value or ""), set(), 0
        for line in (value or "").split("\n"):
            if SPACED.search(line):
                again += line in earlier
                earlier.add(line)
        triples = collections.Counter(zip(words, words[1:], words[2:]))
        inside = {j + k for j in range(len(words) - 2) if triples[tuple(words[j : j + 3])] > 1 for k in range(3)}
        r = found[doc_id]
        expected = (len(words), sum(map(len, words)), again, len(inside))
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(words) < 50 or 100 * len(inside) > 50 * len(words))
    assert line_rules.cleaned(empty).count() == 0


@pytest.mark.parametrize("max_cells", [repeats.MAX_CELLS, 1])
def test_repeats(docs, empty, max_cells):
    seen, expected = {}, collections.Counter()
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in ROWS})
    results = {}
    for null, doc_id, value in order:
        words, gone = SPACED.findall(value), set()
        for i in range(len(words) - 19):
            if seen.setdefault(tuple(words[i : i + 20]), (doc_id, i)) != (doc_id, i):
                gone.update(range(i, i + 20))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        results[None if null else doc_id, value] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    for doc_id, value, *_ in ROWS:
        expected[doc_id, *results[doc_id, value or ""]] += 1
    rows = repeats.without_repeats(docs, max_cells=max_cells).collect()
    found = collections.Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in rows)
    assert found == expected
    assert repeats.without_repeats(empty).count() == 0


def test_mixing(docs, labels, empty):
    found = mixing.mix(docs, labels).collect()
    assert len(found) == len(ROWS)
    assert all(abs(sum(r.mix_domains) - 1) < 1e-9 and r.mix_rate >= 0 for r in found)
    assert mixing.mix(empty, labels).count() == 0


def test_mixing_meets_its_targets(monkeypatch):
    draw = np.random.default_rng(5)
    p = draw.dirichlet([0.3, 0.2, 0.1], 4000)
    tokens = draw.integers(0, 500, 4000).astype(float)

    def sums(_, moves):
        rate = mixing.replayed(p, moves)
        return p.T @ (tokens * rate), (p * (tokens * (rate > 0))[:, None]).T @ p

    monkeypatch.setattr(mixing, "_sums", sums)
    moves = mixing.fit(None, mixing.shares(mixing.TARGETS))
    rate = mixing.replayed(p, moves)
    share = p.T @ (tokens * rate) / (tokens * rate).sum()
    assert (rate >= 0).all() and len(moves) < 20
    assert np.allclose(share, [mixing.TARGETS[d] for d in mixing.DOMAINS], rtol=5e-3)


def near_by_hand(texts, items, window=10, slop=20, count=3):
    """Items of each text by the rule of proximity, word by word."""
    texts = [ALNUM.findall((v or "").translate(LOWER)) for v in texts]
    frequency = collections.Counter(w for words in texts for w in words)
    found = [set() for _ in texts]
    for item, value in items:
        words = ALNUM.findall((value or "").translate(LOWER))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            first = sorted({w: k for k, w in reversed(list(enumerate(part)))}.items(), key=lambda x: (frequency[x[0]], x[1]))
            (rarest, origin), *others = first[:count]
            for names, text in zip(found, texts, strict=True):
                for p in (p for p, w in enumerate(text) if w == rarest):
                    ranges = [(w, p + k - origin) for w, k in others]
                    if all(w in text[max(0, q - slop) : max(0, q + slop + 1)] for w, q in ranges):
                        names.add(str(item))
    return found


@pytest.mark.parametrize("block_words", [5_000_000, 60])
def test_contamination_nearby(spark, block_words):
    draw = np.random.default_rng(3)
    rare = [" ".join(f"w{n}" for n in draw.zipf(1.3, 60)) for _ in range(6)]
    items = [(i, value + f" end{i}") for i, value in enumerate(rare)]
    whole = items[0][1]
    part = " ".join(items[1][1].split()[15:35])
    edited = items[2][1].split()
    edited[7::9] = ["changed"] * len(edited[7::9])
    texts = [whole, "before " * 30 + part + " after" * 30, " ".join(edited), " ".join(f"w{n}" for n in draw.zipf(1.2, 400)), None, ""]
    frame = ship_frame(spark, texts)
    rows = contamination.contamination(
        frame, spark.createDataFrame(items, "item_id LONG, text STRING"), block_words=block_words
    ).collect()
    found = {r.doc_id: r for r in rows}
    assert [set(found[i].near_items) for i in range(len(texts))] == near_by_hand(texts, items)
    assert "0" in found[0].near_items and "1" in found[1].near_items and "2" in found[2].near_items
    assert all(set(r["items"]) <= set(r.near_items) for r in rows)


def ship_frame(spark, texts):
    from dwellmart.llm.shipping import ship

    return ship(spark).createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(3)


NOTICES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files, to deal without restriction.""",
    "bsd": """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following are met.""",
    "cc-by-nc": """This work is licensed under the Creative
Commons Attribution-NonCommercial 4.0 International terms.""",
    "": "This work is licensed under a Creative\nCommons Attribution International terms.",
}


def test_wrapped_notices(spark):
    pad = "some other words of the text\n" * 30
    texts = [f"{pad}{notice}\n{pad}" for notice in NOTICES.values()] + ["", None, "under the\n\nmit\n", "a copy of this software"]
    found = {r.doc_id: r for r in licences.scan(ship_frame(spark, texts)).collect()}
    for i, label in enumerate(NOTICES):
        assert {m.label for m in found[i].matches or []} == ({label} if label else set())
        assert all(m.containment == 1 for m in found[i].matches or [])


def test_blocks_are_all_runs_of_words(spark):
    draw = np.random.default_rng(7)
    templates = [("aa bb cc dd ee ff gg hh ii jj", "ten"), ("aa bb aa kk", "three"), ("kk", "one")]
    pool = np.array([*"aa bb cc dd ee ff gg hh ii jj".split(), "kk", *[f"x{i}" for i in range(4)]])
    texts = ["\n".join(draw.choice(pool[: 10 + i % 6], 3 + i)) for i in range(40)]
    found = {r.doc_id: r for r in licences.scan(ship_frame(spark, texts), templates).collect()}
    for i, value in enumerate(texts):
        words, expected = value.split(), set()
        for template, label in templates:
            want, room = set(template.split()), 2 * len(template.split())
            best = max(len(want & set(words[j : j + room])) for j in range(len(words)))
            if best >= 0.9 * len(want):
                expected.add((label, best / len(want)))
        assert {tuple(m) for m in found[i].matches or []} == expected
    assert any(len(r.matches or []) > 1 for r in found.values())


def test_shards_of_a_capacity(spark):
    texts = [f"{i:09d}" for i in range(6000)] + ["y" * 5000]
    capacity = 20  # 3,000 shards and more than that; two texts of ten bytes fill one
    found = shards.assign(ship_frame(spark, texts), capacity=capacity, items=64).collect()
    filled = collections.Counter()
    for r in found:
        filled[r.shard] += r["size"]
    assert sorted(filled.values()) == [20] * 3000 + [5001]


def test_no_parcel_beyond_the_capacity(spark, monkeypatch):
    monkeypatch.setattr(shards, "PARCELS", 1)
    found = shards.assign(ship_frame(spark, [f"{i:03d}" for i in range(1000)]), capacity=400, items=1).collect()
    filled = collections.Counter()
    for r in found:
        filled[r.shard] += r["size"]
    assert max(filled.values()) <= 400


def test_lines_are_removed(spark):
    prose = [" ".join(f"plain{i}word{k}" for k in range(9)) for i in range(12)]
    lines = [prose[0], "Home\tAbout\tContact", *prose[1:6], "", "All  rights\treserved", prose[0], "| | | |", *prose[6:]]
    rows = line_rules.cleaned(ship_frame(spark, ["\n".join(lines), None, "é\n\n"])).collect()
    found = {r.doc_id: r for r in rows}
    assert found[0].text == "\n".join([*prose[:6], "", *prose[6:]])
    assert found[0].removed == ["navigation", "boilerplate", "boilerplate", "punctuation"]
    assert found[0].kept and found[0].words_left == 12 * 9
    assert (found[1].text, found[2].text) == ("", "é\n\n")


def test_texts_of_one_id_are_told_apart(spark):
    from dwellmart.llm.shipping import ship

    # These two have the same 32-bit hash.
    passage = " ".join(f"same{i}" for i in range(25))
    texts = [f"{passage} tail{n}" for n in (147664, 233688)]
    frame = ship(spark).createDataFrame([(None, t) for t in texts], "doc_id LONG, text STRING")
    assert frame.selectExpr("hash(text) AS h").distinct().count() == 1
    assert sorted(r.n_removed for r in repeats.without_repeats(frame).collect()) == [0, 25]

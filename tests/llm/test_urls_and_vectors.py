"""URL filter, whitening and hard negatives against plain Python and DuckDB, on awkward rows."""

import math
import os
import sys
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, differences, normal

from dwellmart.llm import hard_negatives, queries, url_filter, whitening
from dwellmart.llm.shipping import ship
from dwellmart.llm.sql import ORACLE_SQL
from pyspark.sql import functions as F

SMALLEST = "/root/testdata/sf0.001"
RULES = {
    "net/": "block", "example.net/en/": "allow", "Example.COM/de/": "block", "org/fr/": "allow", "bare.io": "block",
    "a.b.example/x": "allow", "example/xyz": "block", "b.example/xy": "block",
}
URLS = [
    None, "", "no scheme", "http://", "://net/", "http://net", "http://net/", "HTTP://WWW.Example.NET/en/Page?x=/en/#a", "http://example.net/EN/",
    "ftp://user@example.net/en/", "http://xexample.net/en/", "http://example.com/de/?q", "http://example.com/de", "http://m.bare.io", "http://bare.io?x",
    "http://a.b.example/xyz", "http://c.b.example/xyz", "http://b.example/xyz", "http://free-bets.example", "http://my.bets.org/fr/1", "http://betsy.example",
    "http://é.org/fr/ü", "x://y://net/", "http://listed.example/p?q=1", "http://listed.example/p", "http://" + "a." * 20_000 + "net/" + "p" * 50_000, "http://net\n/x",
]


def judged_plainly(url, rules, words, urls):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for rule, verdict in rules.items():
        at = rule.index("/") if "/" in rule else len(rule)
        own, start = rule[:at].lower(), rule[at:]
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            best = max(best or (0,), (len(rule), len(own), own + start, verdict))
    if best:
        return host, path, best[2], best[3]
    found = set(url_filter._word.findall(host))
    return host, path, None, urls.get(url, "block" if found & set(words) else "allow")


@pytest.fixture(scope="module")
def entries(spark):
    rows = [("rule", r, v) for r, v in RULES.items()] + [("word", w, "block") for w in ("BETS", "ads")]
    rows += [("url", "http://listed.example/p?q=1", "block"), ("rule", None, "block"), ("rule", "org/", "perhaps"), (None, "x", "block"),
             ("other", "org/", "block"), ("word", "ads", "allow"), ("word", "ads", "block")]
    return ship(spark).createDataFrame(rows, "kind STRING, entry STRING, verdict STRING")


@pytest.mark.parametrize("mapped_bytes", [1 << 20, 0])
def test_urls(spark, entries, mapped_bytes):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(3, URLS[3], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id INT, url STRING, host STRING, __url STRING").repartition(3)
    found = url_filter.judge(pages, entries, ["page_id"], mapped_bytes=mapped_bytes).collect()
    expected = [(r[0], *judged_plainly(r[1], RULES, ["bets", "ads"], {"http://listed.example/p?q=1": "block"})) for r in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_urls_of_empty_tables(spark, entries):
    pages = spark.createDataFrame([(1, "http://net/")], "page_id INT, url STRING")
    assert url_filter.judge(pages.limit(0), entries, ["page_id"]).collect() == []
    for bound in (1 << 20, -1):
        found = url_filter.judge(pages, entries.limit(0), ["page_id"], mapped_bytes=bound).collect()
        assert [tuple(r) for r in found] == [(1, "net", "/", None, "allow")]
    with pytest.raises(ValueError, match="host"):
        url_filter.judge(pages.withColumn("host", F.lit(1)), entries, ["host"])


def test_digest_compares_strings_where_keys_collide():
    def weak(texts):
        return np.array([len(t) % 3 for t in texts], np.uint64)

    texts = [f"w{'x' * i}{i}" for i in range(40)]
    data = url_filter.array_of(texts, [i % 2 == 0 for i in range(40)], weak)
    digest = url_filter.Digest.read(pa.py_buffer(data), weak)
    found = digest.find([*texts, "wx", "", "wz1"])
    assert [digest.texts[int(k)].as_py() for k in found[:40]] == texts
    assert (found[40:] == -1).all() and (np.diff(digest.keys.astype(int)) >= 0).all()
    assert digest.blocked[found[:40]].tolist() == [i % 2 == 0 for i in range(40)]


def test_keys_are_those_of_spark(spark):
    texts = ["", "wads", "rexample.net/en/", "hé"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select(F.xxhash64("t")).collect()
    assert url_filter.digests(texts).astype(np.int64).tolist() == [r[0] for r in rows]


# -- vectors -----------------------------------------------------------------------------------------

NAN, INF = float("nan"), float("inf")
GOOD = [(i, [math.sin(i * (k + 1)) * (k + 1) for k in range(5)], i % 3) for i in range(40)]
ODD = [
    (100, None, 1), (101, [], 1), (102, [1.0, None, 1.0, 1.0, 1.0], 1), (103, [NAN] * 5, 1), (104, [1.0, 2.0, INF, 0.0, 0.0], 1),
    (105, [1.0, 2.0], 1), (0, GOOD[0][1], 0), (106, GOOD[0][1], 2), (None, GOOD[1][1], 1), (107, GOOD[2][1], None), (7, GOOD[9][1], 1),
]
VECTORS = "vec_id LONG, embedding ARRAY<DOUBLE>, label INT, x INT, id STRING, part STRING, `window` INT"


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(*row, 1, "a", "b", 2) for row in GOOD + ODD]
    return ship(spark).createDataFrame(rows, VECTORS).repartition(3)


def fitted(rows):
    x = [tuple(math.floor(256 * c) for c in v) for _, v, _ in rows]
    return x, sorted(set(x))


def test_whitening(vectors):
    rows = [r for r in GOOD + ODD if r[1] and len(r[1]) == 5 and all(c is not None and math.isfinite(c) for c in r[1])]
    x, fit = fitted(rows)
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = [[sum((n * v[i] - sums[i]) * (n * v[j] - sums[j]) for v in fit) for j in range(5)] for i in range(5)]
    cov = np.array([[float(Fraction(c, n**3)) for c in row] for row in exact])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    found = whitening.whiten(vectors, components=4).collect()
    assert len(found) == len(rows) and {r["n"] for r in found} == {n}
    expected = sorted((str(r[0]), sum((n * c - s) ** 2 for c, s in zip(v, sums))) for r, v in zip(rows, x))
    assert sorted((str(r["vec_id"]), int(r["deviation"])) for r in found) == expected
    plain = {v: (np.array(v) - np.array(sums) / n) @ axes / np.sqrt(values) for v in x}
    by_id = {r["vec_id"]: r for r in found}
    signs = np.sign(np.array(by_id[3]["whitened"]) / plain[x[3]])
    for row, v in zip(rows[:40], x):
        assert np.allclose(by_id[row[0]]["whitened"] if row[0] != 7 else plain[v] * signs, plain[v] * signs, atol=1e-9)
    assert np.allclose(found[0]["explained"], values / np.trace(cov), rtol=1e-12)
    assert all(r["identity_error"] < 1e-9 for r in found)


def test_covariance_of_polarised_squares_is_exact(spark):
    rng = np.random.default_rng(3)
    values = rng.integers(-(2**40), 2**40, (300, 4)).tolist() + [[2**62, -(2**62), 1, 0]]
    fit = ship(spark).createDataFrame([(v,) for v in values], "x ARRAY<LONG>").repartition(3)
    n, sums, cov = whitening.covariance(fit, 4)
    assert n == 301 and sums == [sum(c) for c in zip(*values)]
    for i in range(4):
        for j in range(4):
            exact = sum((n * v[i] - sums[i]) * (n * v[j] - sums[j]) for v in values)
            assert cov[i, j] == float(Fraction(exact, n**3))


@pytest.mark.parametrize("top", [3, 2**30, 2**60])
def test_squares(top):
    y = np.random.default_rng(1).integers(-top, top, (500, 3))
    assert whitening.squares(y) == [sum(int(v) ** 2 for v in c) for c in y.T]
    parts = whitening._parts(top**2 * 500)
    assert whitening._joined(parts) == top**2 * 500 and max(parts[:-1]) < 1 << whitening.PART


def test_whitening_without_variance(spark, vectors):
    assert whitening.whiten(vectors.limit(0)).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id LONG, embedding ARRAY<FLOAT>")
    found = whitening.whiten(same).collect()
    assert [(r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in found] == [
        (1, 0, [None, None], [None, None], None)
    ] * 2


def mined_plainly(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    sound = sorted({(i, l, tuple(math.floor(256 * c) for c in v)) for i, v, l in rows if None not in (i, l) and v and len(v) == len(rows[0][1])
                    and all(c is not None and math.isfinite(c) for c in v)})
    out = []
    for a, label, q in sound:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, l, v) for i, l, v in sound if i != a)
        for p in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and low * -p[0] <= 100 * -s[0] <= high * -p[0]]
            out += [(a, p[1], k + 1, s[1], -p[0], -s[0]) for k, s in enumerate(fit[:negatives])]
    return sorted(out)


@pytest.mark.parametrize(("part_rows", "block_rows"), [(16_384, 1_024), (7, 3)])
def test_hard_negatives(vectors, part_rows, block_rows):
    found = hard_negatives.mine(vectors, F.col("id") % 5 == 0, part_rows=part_rows, block_rows=block_rows)
    expected = mined_plainly(GOOD + ODD, lambda i: i % 5 == 0)
    assert expected and sorted(map(tuple, found.collect())) == expected


def test_hard_negatives_of_large_entries_and_ties(spark):
    """Scores beyond the whole numbers of doubles, one vector on a third of the rows."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 6) * 2.0**21 + (i % 4)).tolist(), int(i % 2)) for i in range(60)]
    rows = [(i, rows[0][1] if i % 3 == 0 else v, label) for i, v, label in rows]
    table = ship(spark).createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>, label INT")
    found = hard_negatives.mine(table, F.col("id") % 6 == 0, part_rows=16)
    expected = mined_plainly(rows, lambda i: i % 6 == 0)
    assert expected and sorted(map(tuple, found.collect())) == expected


def test_hard_negatives_of_few_rows(spark, vectors):
    assert hard_negatives.mine(vectors.limit(0), F.col("id") > 0).collect() == []
    one = spark.createDataFrame([(50, [1.0], 1), (51, [2.0], 1), (52, [1.5], 2)], "vec_id LONG, embedding ARRAY<FLOAT>, label INT")
    found = hard_negatives.mine(one, F.col("id") == 50).collect()
    assert [tuple(r) for r in found] == [(50, 51, 1, 52, 131072, 98304)]


def test_cells_come_by_falling_bounds_and_certify():
    rng = np.random.default_rng(2)
    first, second = rng.normal(size=5), rng.normal(size=7)
    used = rng.random(35) < 0.6
    visited = list(hard_negatives.multi_sequence(first, second, used))
    assert [b for b, _ in visited] == sorted((b for b, _ in visited), reverse=True)
    assert sorted(c for _, c in visited) == np.flatnonzero(used).tolist()
    assert all(math.isclose(b, first[c // 7] + second[c % 7]) for b, c in visited)
    points, words = rng.normal(size=(200, 3)), rng.normal(size=(4, 3))
    near = hard_negatives.nearest(points, words)
    radii = np.array([np.sqrt(((points[near == k] - words[k]) ** 2).sum(axis=1)).max(initial=0) for k in range(4)])
    query = rng.normal(size=3)
    assert (points @ query <= hard_negatives.half_bounds(query, words, radii)[near]).all()


def test_a_search_visits_few_cells_of_clustered_rows(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 8)) * 4
    x = np.floor(256 * (centres[np.arange(2000) % 20] + rng.normal(size=(2000, 8)) * 0.02)).astype(np.int64)
    books = [hard_negatives.codebook(x[:, :4].astype(float)), hard_negatives.codebook(x[:, 4:].astype(float))]
    rows = ship(spark).createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(x)], "id LONG, label LONG, x ARRAY<LONG>")
    part = hard_negatives.Part(hard_negatives.index_of(rows, books, 1).first().asDict(), books)
    seen = []
    plain = part.scores
    part.scores = lambda cells, query: seen.append(cells) or plain(cells, query)
    found = part.search(0, 0, x[0], [(-(2**63), 2**63 - 1)], 5, same=True)[0]
    scores = sorted(((int(x[i] @ x[0]), -i) for i in range(2, 2000, 2)), reverse=True)[:5]
    assert [(f[0], -f[1]) for f in found] == scores
    assert len(seen) < part.used.sum() / 2


@pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    found = queries.QUERIES[name](spark, SMALLEST)
    answer = connect(SMALLEST).execute(ORACLE_SQL[name])
    left = normal(found.columns, [tuple(r) for r in found.collect()])
    assert differences(left, normal([c[0] for c in answer.description], answer.fetchall())) == ""


@pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="no test tables")
def test_whitening_query(spark):
    found = queries.op12_whitening(spark, SMALLEST)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = spark.read.parquet(f"{SMALLEST}/embeddings.parquet").collect()
    x = np.array([[math.floor(256 * float(c)) for c in r["embedding"]] for r in rows])
    fit = np.unique(x, axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    plain = np.abs((x - fit.mean(axis=0)) @ axes[:, ::-1][:, :4] / np.sqrt(values[::-1][:4]))
    got = {(r["vec_id"], r["component"]): r for r in found.collect()}
    assert len(got) == 4 * len(rows)
    for row, line, v in zip(rows, plain, x):
        for k in range(4):
            r = got[row["vec_id"], k + 1]
            assert math.isclose(abs(r["whitened"]), line[k], abs_tol=1e-8) and r["identity_error"] < 1e-4
            assert r["deviation"] == sum((len(fit) * int(a) - int(b)) ** 2 for a, b in zip(v, fit.sum(axis=0)))
            assert math.isclose(r["explained"], values[::-1][k] / values.sum(), rel_tol=1e-9)

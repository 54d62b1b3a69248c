"""URL filter over a sorted digest array.

The list is one sorted array of 64-bit xxhash keys beside the full strings they stand for, an Arrow
file that every task maps into memory, so that the Python workers of a machine share its pages. A batch
of URLs is probed by vectorised binary search; a key that is found counts only if the stored string is
the probed one, and where several strings share a key all of them are compared.

Entries have a kind, a text and a verdict (``allow`` or ``block``):

* ``rule``: a host and the start of a path, such as ``example.net/en/``. It fits the host and its
  subdomains where the URL's path starts with the rule's; of several the longest wins, of equally long
  ones that of the longer host;
* ``url``: a whole URL, asked where no rule fits;
* ``word``: a word of the host (a run of letters and digits), asked where neither fits; a blocked word
  outweighs an allowed one. Without any entry the verdict is ``allow``.

Which probes are needed follows from the list: a host is tried at its label boundaries up to the length
of the longest host listed, a path at the lengths that rules have. A list beyond ``MAPPED_BYTES`` isn't
sent to the executors: keys and strings are then joined by a shuffle, with the same result.

Nulls, ties, texts: a null URL, or one without ``://``, has an empty host and path; entries that are null
or have an unknown verdict are no entries; an entry with both verdicts blocks. Repeated rows are judged
alike, in batches by distinct host and path. Very long URLs cost what their listed lengths cost. An empty
list allows all, an empty table gives an empty result. Only the URL and the columns named in ``keep``
are read; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import itertools
import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmart.session import scratch_root, written

MAPPED_BYTES = 256 << 20
ENTRY_BYTES = 48  # of an entry besides its text
SEED = 42  # that of Spark's xxhash64, so both sides digest alike
_CHUNK = 1 << 20
_RULE, _URL, _WORD, _HOST = "r", "u", "w", "h"
KINDS = {"rule": _RULE, "url": _URL, "word": _WORD}
_word = re.compile(r"[a-z0-9]+")

# Words of hosts that serve advertising, betting, adult content, spam or sham pharmacy.
HOST_WORDS = [
    "ad", "ads", "adserver", "adult", "advert", "banner", "bet", "bets", "betting", "casino", "clickbait",
    "doubleclick", "escort", "gambling", "jackpot", "lottery", "malware", "phishing", "pills", "poker",
    "popup", "porn", "roulette", "sex", "slots", "spam", "spyware", "torrent", "track", "tracker", "tracking",
    "viagra", "warez", "xxx",
]


def entries_of(spark: SparkSession, rules: dict[str, str], words: Sequence[str] = HOST_WORDS) -> DataFrame:
    """A list from rules with their verdicts and from blocked words."""
    rows = [("rule", rule, verdict) for rule, verdict in rules.items()] + [("word", w, "block") for w in words]
    return spark.createDataFrame(rows, "kind STRING, entry STRING, verdict STRING")


def lower(text: Column | str) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return lower(host), F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)


def tagged(entries: DataFrame) -> DataFrame:
    """(text, blocked) of each entry once; the text begins with a letter for its kind. The host of a rule
    is an entry of its own, so that paths are only tried below hosts that have rules."""
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[F.col("kind")]
    host = F.substring_index("entry", "/", 1)
    rule = F.concat(lower(host), F.substring("entry", F.length(host) + 1, F.length("entry")))
    text = F.when(F.col("kind") == "rule", rule).when(F.col("kind") == "word", lower("entry")).otherwise(F.col("entry"))
    known = entries.where(F.col("verdict").isin("allow", "block") & F.col("kind").isin(*KINDS) & F.col("entry").isNotNull())
    known = known.select(F.concat(kind, text).alias("text"), (F.col("verdict") == "block").alias("blocked"))
    rules = known.where(F.col("text").startswith(_RULE))
    hosts = rules.select(F.concat(F.lit(_HOST), F.substring_index(F.expr("substring(text, 2)"), "/", 1)).alias("text"), F.lit(False).alias("blocked"))
    return known.unionAll(hosts).groupBy("text").agg(F.max("blocked").alias("blocked"))


# -- the array -----------------------------------------------------------------------------------


def digests(texts: Sequence[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t.encode(), SEED) for t in texts), np.uint64, len(texts))


def array_of(texts: list[str], blocked: list[bool], digest=digests) -> bytes:
    """The file of the sorted array, with the lengths that probes need."""
    keys = digest(texts)
    order = np.argsort(keys, kind="stable")
    paths = {len(t) - 1 - len(t.split("/", 1)[0][1:]) for t in texts if t[0] == _RULE}
    longest = {tag: max((len(t) - 1 for t in texts if t[0] == tag), default=0) for tag in (_HOST, _WORD, _URL)}
    schema = pa.schema(
        [("key", pa.uint64()), ("text", pa.large_string()), ("blocked", pa.bool_())],
        {b"probes": json.dumps({"paths": sorted(paths), **longest}).encode()},
    )
    columns = [pa.array(keys[order]), pa.array(texts, pa.large_string()).take(pa.array(order)),
               pa.array(blocked, pa.bool_()).take(pa.array(order))]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, schema) as file:
        file.write_batch(pa.record_batch(columns, schema=schema))
    return sink.getvalue().to_pybytes()


@dataclass
class Digest:
    """The array, in a buffer that may be a mapped file."""

    keys: np.ndarray
    texts: pa.Array
    blocked: np.ndarray
    probes: dict
    digest: object = digests

    @classmethod
    def read(cls, source: pa.Buffer | pa.NativeFile, digest=digests) -> Digest:
        file = pa.ipc.open_file(source)
        batch = file.get_batch(0)
        return cls(batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_numpy(zero_copy_only=False),
                   json.loads(file.schema.metadata[b"probes"]), digest)

    @classmethod
    def mapped(cls, path: str) -> Digest:
        return cls.read(pa.memory_map(path))

    def find(self, texts: list[str]) -> np.ndarray:
        """The place of each text in the array, -1 where it isn't listed."""
        found = np.full(len(texts), -1, np.int64)
        if not len(texts) or not len(self.keys):
            return found
        probed = self.digest(texts)
        at = np.searchsorted(self.keys, probed)
        open_ = np.arange(len(texts))
        while len(open_):
            inside = at[open_] < len(self.keys)
            open_ = open_[inside]
            open_ = open_[self.keys[at[open_]] == probed[open_]]
            if not len(open_):
                break
            asked = pa.array([texts[i] for i in open_], pa.large_string())
            same = pc.equal(self.texts.take(pa.array(at[open_])), asked).to_numpy(zero_copy_only=False)
            found[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
        return found


def suffixes(host: str, longest: int) -> list[str]:
    """The host and what follows each of its dots, as far as it may be listed."""
    starts = [0] + [i + 1 for i, c in enumerate(host) if c == "."]
    return [host[i:] for i in starts if i < len(host) and len(host) - i <= longest]


def judge_batch(digest: Digest, urls: list, hosts: list[str], paths: list[str]) -> tuple[list, list]:
    """The rule (or None) and the verdict of each URL of a batch."""
    probes = digest.probes
    own = list(dict.fromkeys(hosts))
    ways = [suffixes(h, probes[_HOST]) for h in own]
    known = digest.find([_HOST + s for way in ways for s in way])
    split = np.split(known, np.cumsum([len(w) for w in ways])[:-1]) if own else []
    listed = {h: [s for s, k in zip(way, ks) if k >= 0] for h, way, ks in zip(own, ways, split)}
    words = [[w for w in _word.findall(h) if len(w) <= probes[_WORD]] for h in own]
    of_word = iter(digest.find([_WORD + w for ws in words for w in ws]).tolist())
    by_word = {}
    for host, ws in zip(own, words):
        places = [k for k in itertools.islice(of_word, len(ws)) if k >= 0]
        by_word[host] = bool(places) and bool(digest.blocked[places].any())

    places = list(dict.fromkeys(zip(hosts, paths)))
    tries = [
        [(s, n) for s in listed[h] for n in probes["paths"] if n <= len(p)] for h, p in places
    ]
    texts = [_RULE + s + p[:n] for (_, p), way in zip(places, tries) for s, n in way]
    at = iter(zip(digest.find(texts).tolist(), texts))
    of_place = {}
    for place, way in zip(places, tries):
        fits = [(len(text), len(s), text[1:], k) for (s, _), (k, text) in zip(way, itertools.islice(at, len(way))) if k >= 0]
        of_place[place] = max(fits, default=None)

    whole = np.full(len(urls), -1)
    if probes[_URL]:
        asked = [i for i, u in enumerate(urls) if u is not None and len(u) <= probes[_URL]]
        whole[asked] = digest.find([_URL + urls[i] for i in asked])
    rules, verdicts = [], []
    for host, path, entry in zip(hosts, paths, whole.tolist()):
        best = of_place[(host, path)]
        blocked = digest.blocked[best[3]] if best else digest.blocked[entry] if entry >= 0 else by_word[host]
        rules.append(best[2] if best else None)
        verdicts.append("block" if blocked else "allow")
    return rules, verdicts


# -- over a table ----------------------------------------------------------------------------------


def judge(rows: DataFrame, entries: DataFrame, keep: Sequence[str], url: str = "url", mapped_bytes: int = MAPPED_BYTES) -> DataFrame:
    """The columns ``keep`` with host, path, rule (null where none fits) and verdict of every row."""
    spark = rows.sparkSession
    taken = {"host", "path", "rule", "verdict"} & set(keep)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are named like results; rename them or leave them out of keep")
    host, path = host_and_path("__url")
    asked = rows.select(*[F.col(f"`{k}`") for k in keep], F.col(f"`{url}`").cast("string").alias("__url"))
    asked = asked.withColumn("host", host).withColumn("path", path)
    listed = written(tagged(entries), "url-list")
    size = listed.agg(F.coalesce(F.sum(F.octet_length("text") + ENTRY_BYTES), F.lit(0))).first()[0]
    if size > mapped_bytes:
        return _joined(asked, listed, keep)
    name = _sent(spark, listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = Digest.mapped(SparkFiles.get(name))
        for batch in batches:
            urls, hosts, paths = (batch.column(c).to_pylist() for c in ("__url", "host", "path"))
            rules, verdicts = judge_batch(digest, urls, hosts, paths)
            kept = [batch.column(c) for c in (*keep, "host", "path")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=[*keep, "host", "path", "rule", "verdict"],
            )

    result = asked.select(*[F.col(f"`{k}`") for k in keep], "host", "path").withColumn("rule", F.lit(None).cast("string"))
    result = result.withColumn("verdict", F.lit(None).cast("string"))
    return asked.mapInArrow(run, result.schema)


def _sent(spark: SparkSession, listed: DataFrame) -> str:
    """Stores the array in the shared folder, whence every executor fetches it; returns its name."""
    table = listed.toArrow()
    data = array_of(table.column("text").to_pylist(), table.column("blocked").to_pylist())
    name = f"url-digest-{uuid.uuid4().hex}.arrow"
    path = f"{scratch_root(spark)}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        for at in range(0, len(data), _CHUNK):
            out.write(bytearray(data[at : at + _CHUNK]))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return name


def _joined(asked: DataFrame, listed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The same for a list too long to send: keys and strings meet in shuffled joins. Hosts, and pairs of
    host and path, are taken once each, so a frequent host is looked up once."""
    listed = listed.withColumn("key", F.xxhash64("text"))

    def found(probes: DataFrame, name: str) -> DataFrame:
        """(probe columns, blocked) of the probes whose text is listed."""
        probes = probes.withColumn("key", F.xxhash64(name)).withColumnRenamed(name, "__text")
        same = (F.col("p.key") == F.col("l.key")) & (F.col("__text") == F.col("text"))
        return probes.alias("p").join(listed.alias("l"), same).drop("key", "text")

    rules = listed.where(F.col("text").startswith(_RULE)).select(
        F.substring_index(F.expr("substring(text, 2)"), "/", 1).alias("__host"), F.length("text").alias("__n")
    )
    lengths = rules.groupBy("__host").agg(F.collect_set(F.col("__n") - F.length("__host") - 1).alias("__lengths"))
    places = asked.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    ends = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    hosts = asked.select("host").distinct()
    below = hosts.select("host", F.explode(ends).alias("__host")).where("__host <> ''").join(lengths, "__host")
    tries = places.join(below, "host").select("host", "path", "__host", F.explode("__lengths").alias("__n"))
    tries = tries.where(F.col("__n") <= F.length("path")).withColumn(
        "__rule", F.concat(F.lit(_RULE), "__host", F.expr("substring(path, 1, __n)"))
    )
    longest = F.max(F.struct(F.length("__text"), F.length("__host"), "__text", "blocked"))
    fits = found(tries, "__rule").groupBy("host", "path").agg(longest.alias("__best"))
    fits = fits.select("host", "path", F.expr("substring(__best.__text, 2)").alias("rule"), F.col("__best.blocked").alias("__by_rule"))
    words = hosts.select("host", F.explode(F.expr("regexp_extract_all(host, '[a-z0-9]+', 0)")).alias("__w"))
    words = words.withColumn("__word", F.concat(F.lit(_WORD), "__w"))
    by_word = found(words, "__word").groupBy("host").agg(F.max("blocked").alias("__by_word"))
    urls = asked.where("__url IS NOT NULL").select("__url").distinct().withColumn("__whole", F.concat(F.lit(_URL), "__url"))
    by_url = found(urls, "__whole").select("__url", F.col("blocked").alias("__by_url"))
    joined = asked.join(fits, ["host", "path"], "left").join(by_word, "host", "left").join(by_url, "__url", "left")
    blocked = F.coalesce("__by_rule", "__by_url", "__by_word", F.lit(False))
    verdict = F.when(blocked, "block").otherwise("allow").alias("verdict")
    return joined.select(*[F.col(f"`{k}`") for k in keep], "host", "path", "rule", verdict)

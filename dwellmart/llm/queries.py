"""The registered queries of the operators: contract columns from each operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmart.llm import (
    contamination, hard_negatives, licences, line_rules, mixing, ngram_join, pages, pii, quality, repeats, shards, url_filter,
    whitening,
)
from dwellmart.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return ship(spark).read.parquet(f"{folder}/{table}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.groups(read(spark, folder, "documents"), size=4, num=85, den=100)


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(read(spark, folder, "documents"), read(spark, folder, "labels"), least=0.3)


def op3_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.assign(read(spark, folder, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.spans(read(spark, folder, "documents"))

    def told(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(told("base").cast("binary"), 256).alias("base_sha256"), told("spans").alias("spans")
    )


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(read(spark, folder, "documents"))
    places, matches = (F.coalesce(c, F.array()) for c in ("places", "matches"))
    at, base = F.transform("places", lambda p: p["word"]), F.transform(places, lambda p: p["label"])
    every = F.array_union(base, F.transform(matches, lambda m: m["label"]))
    best = F.array_max(F.transform("matches", lambda m: m["containment"]))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op7_pages(spark: SparkSession, folder: str) -> DataFrame:
    found = pages.extract(read(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks")


def op8_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.cleaned(read(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "words_left", F.size("removed").cast("long").alias("n_removed_lines"),
    )


def op6_contamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeats.without_repeats(read(spark, folder, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"), read(spark, folder, "labels"))
    parts = [F.col("mix_domains")[i].alias(f"p_{domain}") for i, domain in enumerate(mixing.DOMAINS)]
    return mixed.select("doc_id", "source", F.col("mix_tokens").alias("n_words"), *parts, F.col("mix_rate").alias("rate"))


URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read(spark, folder, "pages"), url_filter.entries_of(spark, URL_RULES), ["page_id"])


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(read(spark, folder, "embeddings"), components=4)
    each = found.select("*", F.posexplode("whitened").alias("at", "value"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", F.col("deviation").cast("long").alias("deviation"),
        F.col("value").alias("whitened"), F.get("explained", F.col("at")).alias("explained"), "identity_error",
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, folder, "embeddings"), F.col("id") % 50 == 0, label=label)


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_quality": op2_quality,
    "op3_shards": op3_shards,
    "op4_pii": op4_pii,
    "op5_licences": op5_licences,
    "op7_pages": op7_pages,
    "op8_line_rules": op8_line_rules,
    "op6_contamination": op6_contamination,
    "op9_repeats": op9_repeats,
    "op10_mixing": op10_mixing,
    "op11_url_filter": op11_url_filter,
    "op12_whitening": op12_whitening,
    "op13_hard_negatives": op13_hard_negatives,
}

"""License notices in text, by an exact set-similarity join against templates.

A block is any run of words of a text, ``ROOM`` times as long as the template it is held against, so
that line breaks, comment signs and a few words in between don't matter. A template is a set of words. A
block matches a template when it holds at least ``share`` of the template's words (containment). The
join is exact: template words are put in the order of their frequency in the whole corpus, rarest
first; a block that reaches the threshold must hold one of the first |T| - need + 1 of them (prefix
filter), so only the surroundings of such words are looked at. These must have at least ``need`` words of
the vocabulary (length filter). Both sides in that order, no more words can be common than the lesser
number before the prefix word and the lesser number from it on (positional filter). What passes is
counted out on every block of the surroundings. Templates are a few short texts and fixed, so their side
of the join is broadcast.

Besides, the places of fixed phrases are found (base). Everything is built from DataFrame functions.

Nulls and ties: a null text is empty: no words, no places, no labels. A text that matches several
templates gets all their labels, each with its best containment. Repeated rows have equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and labels of the base, and templates of license notices.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
TEMPLATES = [
    ("under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions", "mit"),
    ("under the apache license", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("under the gnu general public license", "gpl"),
    ("under the terms of the gnu general public license", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("under cc by nc", "cc-by-nc"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution non commercial", "cc-by-nc"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("redistributions of source code must retain the above copyright notice this list of conditions", "bsd"),
    ("redistributions in binary form must reproduce the above copyright notice this list of conditions", "bsd"),
]
SHARE = 0.9
ROOM = 2  # times the words of a template

_SEPARATORS = [chr(c) for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122 or 65 <= c <= 90)]


def words_of(text: Column) -> Column:
    """Words of ASCII letters (lower-cased), digits and everything beyond ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.translate(text, "".join(_SEPARATORS[1:]) + upper, " " * (len(_SEPARATORS) - 1) + upper.lower())
    # The zero character can't stand in translate's arguments.
    return F.array_remove(F.split(F.replace(plain, F.lit("\0"), F.lit(" ")), " "), "")


def _places(words: Column, phrase: str) -> Column:
    """Word numbers at which the phrase starts."""
    parts = phrase.split()

    def stands(i):
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return found

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)


def vocabulary_frequencies(texts: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many texts of the corpus each template word occurs."""
    found = texts.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, vocabulary)))).alias("word"))
    counted = {r.word: r["count"] for r in found.groupBy("word").count().collect()}
    return {word: counted.get(word, 0) for word in vocabulary}


def template_matches(texts: DataFrame, templates: list[tuple[str, str]], share: float) -> DataFrame:
    """doc_key, label and containment of every text and template that match, by the best block.

    ``texts`` has doc_key and words.
    """
    spark = texts.sparkSession
    sets = [(i, label, sorted(set(t.split())), ROOM * len(t.split())) for i, (t, label) in enumerate(templates)]
    frequency = vocabulary_frequencies(texts, sorted({w for _, _, words, _ in sets for w in words}))
    ordered = sorted(frequency, key=lambda w: (frequency[w], w))
    index, full = [], []
    for i, label, words, room in sets:
        words = sorted(words, key=ordered.index)
        need = max(1, -int(-share * len(words) // 1))
        full.append((i, label, words, need, room))
        index += [(word, i, place) for place, word in enumerate(words[: len(words) - need + 1])]
    prefix = F.broadcast(spark.createDataFrame(index, "word STRING, template INT, place INT"))
    full = F.broadcast(
        spark.createDataFrame(full, "template INT, label STRING, template_words ARRAY<STRING>, need INT, room INT")
    )
    wanted = sorted({word for word, *_ in index})
    some = texts.where(F.arrays_overlap("words", F.array(*map(F.lit, wanted))))
    reach = max(room for *_, room in sets) - 1
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(wanted))
    around = F.transform(
        places,
        lambda i: F.struct(
            F.get("words", i).alias("word"),
            F.least(i, F.lit(reach)).alias("before"),
            F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("words"),
        ),
    )
    hits = some.select("doc_key", F.explode(around).alias("hit")).select("doc_key", "hit.*")
    # The surroundings of the prefix word, as wide as blocks of this template reach.
    start = F.greatest(F.col("before") - F.col("room") + 1, F.lit(0))
    near = F.slice("words", start + 1, F.col("before") - start + F.col("room"))
    candidates = hits.join(prefix, "word").join(full, "template").select(
        "doc_key", "word", "template", "place", "label", "template_words", "need", "room", near.alias("words")
    )
    shared = F.array_intersect(F.array(*map(F.lit, ordered)), F.col("words"))
    candidates = candidates.withColumn("known", shared).withColumn(
        "at", F.array_position("known", F.col("word")).cast("int") - 1
    )
    size = F.size("template_words")
    bound = F.least("place", "at") + F.least(size - F.col("place"), F.size("known") - F.col("at"))
    candidates = candidates.where((F.size("known") >= F.col("need")) & (bound >= F.col("need")))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - F.col("room"), F.lit(0)) + 1)
    held = F.array_max(
        F.transform(starts, lambda i: F.size(F.array_intersect(F.slice("words", i, F.col("room")), "template_words")))
    )
    return (
        candidates.withColumn("held", held)
        .where(F.col("held") >= F.col("need"))
        .groupBy("doc_key", "template", "label")
        .agg(F.max(F.col("held") / size).alias("containment"))
        .select("doc_key", "label", "containment")
    )


def scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    share: float = SHARE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_words, places (label and word number of each phrase), matches (label and containment
    of each template) of every document."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    key = F.unhex(F.md5(F.col("text").cast("binary")))
    found = template_matches(rows.select(key.alias("doc_key"), "words"), templates, share).groupBy("doc_key").agg(
        F.sort_array(F.collect_set(F.struct("label", "containment"))).alias("matches")
    )

    def labelled(phrase: str, label: str) -> Column:
        return F.transform(
            _places(F.col("words"), phrase), lambda i: F.struct(F.lit(label).alias("label"), i.alias("word"))
        )

    places = F.flatten(F.array(*[labelled(*x) for x in PHRASES]))
    # Few texts have a phrase's last word at all; the others are not looked through word by word.
    some = F.array_contains("words", "license")
    rows = rows.select(
        "doc_id", key.alias("doc_key"), F.size("words").alias("n_words"), F.when(some, places).alias("places")
    )
    return rows.join(found, "doc_key", "left").drop("doc_key")

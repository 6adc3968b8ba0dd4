"""Licence scan by a positional index of rare words.

The index lists, for each licence notice, the places of its highest-IDF words; how rare a word is
is counted over all documents. A document's words are looked up, and a hit says where the notice
would begin. Places that enough different words agree on are candidates, and a candidate counts if
the notice's mandatory key phrase stands there too. Base phrases are found word by word besides.

A null or wordless text has no labels and score 0. The score is the largest share of a notice's
indexed words that agree on one place, 1 where a base phrase stands. Rows that repeat each get
their row, and all of them the same; notices that tie are all named. A very long text is one list of words. An empty
table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import literal_rows

# Phrases of the contract, and the opening words of public licence notices with the
# phrase that each must hold.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    "apache-2.0": ("licensed under the apache license version 2 0", "apache license"),
    "bsd": ("redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer", "redistributions of source code"),
    "cc-by-4.0": ("licensed under the creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", "cc by nc"),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", "gnu general public license"),
    "lgpl": ("under the terms of the gnu lesser general public license", "lesser general public license"),
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files", "permission is hereby granted"),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    "unlicense": ("this is free and unencumbered software released into the public domain", "released into the public domain"),
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Indexed words of a notice, and how many of them must agree on a place.
RARE, AGREE = 4, 3
AROUND = 32


def words_of(text: Column) -> Column:
    """Lower-case words. Capitals beyond A-Z are folded too, which no phrase can tell."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def rare_words(documents: DataFrame, rare: int = RARE) -> list[dict]:
    """Postings of each notice's rarest words: label, word, at, weight (its IDF)."""
    vocabulary = sorted({w for text, _ in NOTICES.values() for w in text.split()})
    listed = F.array(*map(F.lit, vocabulary))
    seen = documents.select(F.explode(F.array_intersect(words_of(F.col("text")), listed)).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in seen.collect()}  # at most the words of the notices
    idf = {w: -math.log((found.get(w, 0) + 1) / (max(found.values(), default=0) + 2)) for w in vocabulary}
    postings = []
    for label, (text, _) in NOTICES.items():
        words = text.split()
        best = sorted(set(words), key=lambda w: (-idf[w], w))[:rare]
        postings += [{"label": label, "word": w, "at": i, "weight": idf[w]} for i, w in enumerate(words) if w in best]
    return postings


def phrase_places(words: Column, phrase: str) -> Column:
    """Places where the phrase's words stand one after another, from 0."""
    parts = phrase.split()
    there = F.lit(True)
    for p in parts:
        there = there & F.array_contains(words, p)

    def stands(i: Column) -> Column:
        hit = F.get(words, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            hit = hit & (F.get(words, i + k) == p)
        return F.coalesce(hit, F.lit(False))

    return F.when(there, F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)).otherwise(F.array().cast("array<int>"))


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row."""
    spark = documents.sparkSession
    postings = rare_words(documents)
    index = F.broadcast(literal_rows(spark, postings, "label string, word string, at int, weight double"))
    keys = F.broadcast(literal_rows(
        spark, [{"label": label, "phrase": f" {phrase} ", "need": min(AGREE, n), "indexed": n} for label, (_, phrase) in NOTICES.items()
                for n in [len({p["word"] for p in postings if p["label"] == label})]],
        "label string, phrase string, need int, indexed int"))

    rows = documents.select("doc_id", F.xxhash64("text").alias("digest"), words_of(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "digest", "words", F.size("words").alias("n_words"),
                       *[phrase_places(F.col("words"), p).alias(f"at_{i}") for i, p in enumerate(BASE)])
    indexed = sorted({p["word"] for p in postings})
    hits = F.when(F.arrays_overlap("words", F.array(*map(F.lit, indexed))), F.transform(
        F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(indexed)),
        lambda i: F.struct(F.get("words", i).alias("word"), i.alias("at"), F.concat(
            F.lit(" "), F.array_join(F.slice("words", F.greatest(i - AROUND, F.lit(0)) + 1, 2 * AROUND + 1), " "), F.lit(" ")).alias("near"))))
    places = F.concat(*[F.col(f"at_{i}") for i in range(len(BASE))])
    base = F.filter(F.array(*[F.when(F.size(f"at_{i}") > 0, F.lit(label)) for i, label in enumerate(BASE.values())]), lambda x: x.isNotNull())
    rows = rows.select(
        "doc_id", "digest", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"), base.alias("base"), hits.alias("hits"))

    # a row of figures for each document, and one for each of its hits
    figures = rows.select("doc_id", "digest", F.explode(F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("word"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("string").alias("near"))),
        F.coalesce("hits", F.array()))).alias("h"), "n_words", "n_base", "first_word", "last_word", "base")
    of = ["doc_id", "digest", "n_words", "n_base", "first_word", "last_word", "base"]
    per_place = (
        figures.select(*of, F.col("h.word").alias("word"), F.col("h.at").alias("seen"), F.col("h.near").alias("near"))
        .join(index, "word", "left")
        .groupBy(*of, "label", (F.col("seen") - F.col("at")).alias("begin"))
        .agg(F.count(F.when(F.col("word").isNull(), 1)).alias("copies"), F.size(F.collect_set("word")).alias("agree"), F.min("near").alias("near"))
        .join(keys, "label", "left")
    )
    sure = (F.col("agree") >= F.col("need")) & F.contains("near", "phrase")
    per_row = per_place.groupBy(*of).agg(
        F.sum("copies").alias("copies"), F.collect_set(F.when(sure, F.col("label"))).alias("found"),
        F.max(F.when(sure, F.col("agree") / F.col("indexed"))).alias("share"))
    return per_row.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "found")), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")

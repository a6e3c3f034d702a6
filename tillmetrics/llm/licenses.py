"""License scans: fixed phrases, and an exact containment join of text blocks with templates.

A block is a window of a text's words, whatever its line breaks: as many as a template's
words make up ``THRESHOLD`` of, from every place (``width_of``). Blocks and templates are sets of
words. A block matches a template if it has at least ``THRESHOLD`` of the template's words.
The join finds every such pair; it first compares whole texts, which hold their blocks:

* All words of all templates are put in one order, from the word that the fewest texts
  of the corpus have to the one that the most have.
* Prefix: of a template of ``n`` words of which ``k`` must be found, one of the first
  ``n - k + 1`` is in every matching text. Texts without such a word go first.
* Length: of a text's words those in some template count; it needs ``k`` of them.
* Position: when a word stands at place ``i`` of the template and at place ``j`` of the text's words,
  both in the common order, at most ``min(i, j) + 1 + min(words behind i, words behind j)``
  words are shared; fewer than ``k`` cannot match.
* What is left is decided by intersecting the template with each block that begins with
  one of its words; no other block holds more.

The index of prefix words is as large as the templates, whatever the data. Matches are
brought back to texts by the digest of the text, so equal texts are matched alike.

Defined results: null and empty texts have no words and no labels. Repeated rows are
each answered. Without templates only the phrases count. Other columns are not looked at.
"""

from __future__ import annotations

import math
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.llm.tables import stored

THRESHOLD = 0.8
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# How licenses are usually named or begin.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("lgpl-3", "this work is licensed under the gnu lesser general public license version 3"),
    ("agpl-3", "this work is licensed under the gnu affero general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
]


def words_of(text: Column) -> Column:
    lowered = F.translate(text, ascii_uppercase, ascii_lowercase)  # A-Z only
    return F.filter(F.split(lowered, BETWEEN), lambda w: w != "")


def _words(text: str) -> list[str]:
    return list(dict.fromkeys(text.lower().split()))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_places(words: Column, phrases: dict[str, str] = PHRASES) -> dict[str, Column]:
    """n_base, first_word, last_word and base_labels of an array of words."""
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        # Text between places: in front of the first one stand as many spaces as words.
        parts = F.split(joined, f" {phrase}(?= )", -1)
        found = F.contains(joined, F.lit(f" {phrase} "))
        behind = _spaces(F.element_at(parts, -1)) - 1
        counts.append(F.when(found, F.size(parts) - 1).otherwise(0))
        firsts.append(F.when(found, _spaces(F.element_at(parts, 1))))
        lasts.append(F.when(found, F.size(words) - behind - len(phrase.split())))
        labels.append(F.when(found, F.lit(label)))
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return {
        "n_base": total.cast("bigint"),
        "first_word": F.least(*firsts).cast("bigint"),
        "last_word": F.greatest(*lasts).cast("bigint"),
        "base_labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }


def word_order(docs: DataFrame, templates: list[tuple[str, str]], text: str = "text") -> list[str]:
    """The templates' words, those that fewest texts have first."""
    vocabulary = sorted({w for _, t in templates for w in _words(t)})
    own = F.array_intersect(words_of(F.col(text)), F.array(*[F.lit(w) for w in vocabulary]))
    counts = docs.select(F.explode(own).alias("word")).groupBy("word").count().collect()  # as many as words
    seen = {r["word"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def width_of(template: str, threshold: float = THRESHOLD) -> int:
    """Words of a block that is compared with the template."""
    return math.floor(round(len(template.split()) / threshold, 9))


def block_matches(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """Rows (digest, block, template, label, width, shared, containment) of every match;
    ``block`` is the place of the block's first word from 0, ``digest`` that of the text."""
    spark = docs.sparkSession
    order = word_order(docs, templates, text)
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for n, (label, t) in enumerate(templates):
        own = sorted(_words(t), key=rank.__getitem__)
        need = math.ceil(round(threshold * len(own), 9))
        width = width_of(t, threshold)
        index += [(own[i], n, label, own, i, need, width) for i in range(len(own) - need + 1)]
    schema = "word string, template int, label string, own array<string>, i int, need int, width int"
    prefixes = spark.createDataFrame(index, schema)
    first = F.array(*[F.lit(w) for w in sorted({x[0] for x in index})])
    ordered = F.array(*[F.lit(w) for w in order])

    texts = docs.select(F.col(text).alias("text")).filter(F.arrays_overlap(words_of(F.col("text")), first))
    # The text's words that any template has, in the common order.
    texts = texts.select("text", F.array_intersect(ordered, words_of(F.col("text"))).alias("words"))
    held = texts.select("*", F.posexplode("words").alias("j", "word"))
    pairs = held.join(F.broadcast(prefixes), "word")  # as large as the templates
    size, need = F.size("words"), F.col("need")
    bound = F.least("i", "j") + 1 + F.least(F.size("own") - F.col("i") - 1, size - F.col("j") - 1)
    pairs = pairs.filter((size >= need) & (bound >= need))
    pairs = pairs.filter(F.size(F.array_intersect("own", "words")) >= need)
    # A pair is taken up once, at the first of the template's words that the text has.
    pairs = pairs.filter(F.col("word") == F.element_at(F.array_intersect("own", "words"), 1))

    pairs = pairs.withColumn("all", words_of(F.col("text")))
    places = F.array_compact(F.transform("all", lambda w, at: F.when(F.array_contains("own", w), at)))

    def block(at: Column) -> Column:
        shared = F.array_intersect("own", F.slice("all", at + 1, F.col("width")))
        return F.struct(at.alias("block"), shared.alias("shared"))

    full = F.filter(F.transform(places, block), lambda b: F.size(b["shared"]) >= F.col("need"))
    digest = F.sha1(F.col("text").cast("binary")).alias("digest")
    found = pairs.select(digest, "template", "label", "width", "own", F.inline(full))
    containment = (F.size("shared") / F.size("own")).alias("containment")
    return found.select("digest", "block", "template", "label", "width", "shared", containment).distinct()


def best_labels(matches: DataFrame, widest: int) -> DataFrame:
    """Per text the labels of its blocks, without those that a better match of an
    overlapping block explains: one that shares all their words and is more complete, or longer.
    ``widest`` is the largest width; blocks further apart than that do not overlap."""
    one = F.struct("containment", F.size("shared").alias("size"), "label", "shared", "block", "width", "cell")
    cell = F.floor(F.col("block") / widest)
    near = matches.withColumn("cell", cell).withColumn("at", F.explode(F.array(*[F.col("cell") + i for i in (-1, 0, 1)])))
    # At most 3 * widest places and each template.
    per_cell = near.groupBy("digest", "at").agg(F.collect_set(one).alias("found"))

    def better(a: Column, b: Column) -> Column:
        higher = (b["containment"] > a["containment"]) | (
            (b["containment"] == a["containment"]) & (b["size"] > a["size"])
        )
        overlap = (a["block"] < b["block"] + b["width"]) & (b["block"] < a["block"] + a["width"])
        return higher & overlap & (F.size(F.array_except(a["shared"], b["shared"])) == 0)

    own = F.filter("found", lambda a: a["cell"] == F.col("at"))
    kept = F.filter(own, lambda a: ~F.exists("found", lambda b: better(a, b)))
    rows = per_cell.select("digest", F.explode(kept).alias("m"))
    return rows.groupBy("digest").agg(
        F.collect_set("m.label").alias("found_labels"), F.max("m.containment").alias("containment")
    )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: key, n_words, places of phrases, base_labels, labels, score."""
    labels = block_matches(docs, text=text)
    labels = stored(best_labels(labels, max(width_of(t) for _, t in TEMPLATES)), "license-labels")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    rows = rows.select(
        "key",
        F.sha1(F.col("text").cast("binary")).alias("digest"),
        F.size("words").cast("bigint").alias("n_words"),
        *[c.alias(n) for n, c in phrase_places(F.col("words")).items()],
    )
    found = F.coalesce("found_labels", F.array().cast("array<string>"))
    return rows.join(labels, "digest", "left").select(
        F.col("key").alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", found)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )

"""License scans: an exact set-similarity join of text blocks (lines) against license templates.

A block matches a template when it holds at least ``CONTAINMENT`` of the
template's distinct words. Words are ordered by document frequency over the
whole table, rarest first. A match must then share a word of the template's
prefix (its rarest words, one more than may be missing), so only texts holding
such a word are split into blocks (prefix filter); a block must hold enough
template words (length filter), and a shared word must leave enough words
behind it in both orders (positional filter). What is left is verified exactly.

A notice that is wrapped over lines is met by windows: as many neighbouring words of
a paragraph as the template has. Only texts with enough words of the template are
searched, from places of its words.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, stage, with_columns_checked
from .sharding import values

CONTAINMENT = 0.85

# License notices and the label that each carries.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"
            " provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("reserved", "All rights reserved."),
]
# Phrases and the label that each gives.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PARAGRAPHS = r"\n(?:[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]*\n)+"  # lines without words
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """``A-Z`` in lower case (other letters stay); null: empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words_of(low: Column) -> Column:
    return F.array_remove(F.split(low, SEPARATORS), "")


def template_rows(templates: list[tuple[str, str]], containment: float) -> list[dict]:
    """Label, distinct words and the number of words needed, for each template."""
    import re

    rows = []
    for i, (label, text) in enumerate(templates):
        words = sorted(set(re.split(SEPARATORS, text.lower())) - {""})
        if words:
            length = len([w for w in re.split(SEPARATORS, text.lower()) if w])
            rows.append({"template": i, "label": label, "words": words, "length": length,
                         "need": max(1, math.ceil(containment * len(words) - 1e-9))})
    return rows


def _phrase_starts(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + k) == part)
        return found

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def block_matches(docs: DataFrame, slim: DataFrame, order: list[str], templates: list[dict]) -> DataFrame:
    """``(text_key, label, score)`` for every text and template matched by one of its lines.

    ``order``: all template words, rarest first. ``slim`` has the template
    words that each text holds: only texts with a word of some prefix, and
    enough words, are read again.
    """
    spark = docs.sparkSession
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for t in templates:
        ordered = sorted(t["words"], key=rank.__getitem__)
        for place, word in enumerate(ordered[:len(ordered) - t["need"] + 1]):
            index.append({"word": word, "place": place, "words": ordered, "need": t["need"], "label": t["label"], "template": t["template"]})
    prefix = sorted({x["word"] for x in index}, key=rank.__getitem__)
    least = min(t["need"] for t in templates)

    may = F.arrays_overlap("held", F.array(*[F.lit(w) for w in prefix])) & (F.size("held") >= least)
    keys = checked_broadcast(slim.where(may).select("text_key").distinct())
    lines = (docs.join(keys, "text_key", "left_semi")
             .select("text_key", F.explode(F.split(lowered(F.col("text")), "\n")).alias("line")).where(F.length("line") > 0))
    vocabulary = F.array(*[F.lit(w) for w in order])
    blocks = lines.select("text_key", F.array_intersect(vocabulary, words_of(F.col("line"))).alias("held"))
    blocks = blocks.where(F.size("held") >= least)
    # the rarest words first; a match shares a word before the last `least` - 1
    seeds = blocks.select("text_key", "held", F.posexplode(F.slice("held", F.lit(1), F.size("held") - least + 1)).alias("at", "word"))
    inverted = values(spark, index, "word string, place int, words array<string>, need int, label string, template int")
    # a few rows for each template: bounded by the parameter
    met = seeds.join(F.broadcast(inverted), "word")
    behind = 1 + F.least(F.size("held") - F.col("at") - 1, F.size("words") - F.col("place") - 1)
    met = met.where((F.size("held") >= F.col("need")) & (behind >= F.col("need")))
    shared = F.size(F.array_intersect("held", "words"))
    return (met.withColumn("shared", shared).where("shared >= need")
            .groupBy("text_key", "label").agg(F.max(F.col("shared") / F.size("words")).alias("score")))


def window_matches(docs: DataFrame, slim: DataFrame, templates: list[dict]) -> DataFrame:
    """``(text_key, label, score)`` for every text and template matched by neighbouring words of a paragraph of several lines."""
    enough = [F.size(F.array_intersect("held", F.array(*[F.lit(w) for w in t["words"]]))) >= t["need"] for t in templates]
    some = enough[0]
    for e in enough[1:]:
        some = some | e
    marked = slim.where(some).select("text_key", *[e.alias(f"t{k}") for k, e in enumerate(enough)]).distinct()
    texts = docs.join(checked_broadcast(marked), "text_key")
    parts = texts.select("text_key", *[f"t{k}" for k in range(len(templates))],
                         F.explode(F.split(lowered(F.col("text")), PARAGRAPHS)).alias("part"))
    parts = parts.where(F.contains("part", F.lit("\n")))
    parts = parts.withColumn("ws", words_of(F.col("part"))).drop("part")

    def best(t: dict, here: Column) -> Column:
        own = F.array(*[F.lit(w) for w in t["words"]])
        # the best window can begin with a word of the template
        starts = F.filter(F.sequence(F.lit(1), F.size("ws")), lambda i: F.array_contains(own, F.get("ws", i - 1)))
        shared = F.transform(starts, lambda i: F.size(F.array_intersect(own, F.slice("ws", i, t["length"]))))
        able = here & (F.size(F.array_intersect(own, F.col("ws"))) >= t["need"])
        return F.struct(F.lit(t["label"]).alias("label"), F.lit(t["need"]).alias("need"), F.lit(len(t["words"])).alias("n"),
                        F.when(able, F.array_max(shared)).alias("shared"))

    met = parts.select("text_key", F.explode(F.array(*[best(t, F.col(f"t{k}")) for k, t in enumerate(templates)])).alias("m")).select("text_key", "m.*")
    return met.where("shared >= need").groupBy("text_key", "label").agg(F.max(F.col("shared") / F.col("n")).alias("score"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT, wrapped: bool = False) -> DataFrame:
    """License labels of every row of ``docs``: ``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)``.

    ``n_base`` counts the places of the fixed phrases, ``first_word`` and
    ``last_word`` are their smallest and largest start (null without any);
    ``labels`` adds the labels of matched templates, ``score`` is the largest
    containment (0 without a match). ``wrapped``: blocks are single lines, and
    windows of neighbouring words that go over line ends but not over a line without words. Null texts are empty. Equal texts are
    matched once; rows of one text, repeated ids and null ids get the same labels.
    """
    rows_of_templates = template_rows(templates, containment)
    vocabulary = sorted({w for t in rows_of_templates for w in t["words"]})
    keyed = with_columns_checked(docs, "doc_id", "text").withColumn(
        "text_key", F.struct(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c")))

    low = lowered(F.col("text"))
    per_phrase = [p for p, _ in PHRASES]
    one = lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), words).alias("held"),
        F.when(low.contains("license"), F.array(*[_phrase_starts(words, p) for p in per_phrase])).alias("starts"))
    # the word array is bound to one variable, so the text is split once
    info = F.get(F.transform(F.array(words_of(low)), one), F.lit(0))
    slim = stage(keyed.select("doc_id", "text_key", info.alias("i")).select("doc_id", "text_key", "i.*"))

    seen = slim.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    count = {r.word: r.n for r in seen.collect()}  # at most the words of the templates
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    blocks = block_matches(keyed, slim, order, rows_of_templates)
    if wrapped:
        blocks = blocks.unionByName(window_matches(keyed, slim, rows_of_templates))
    matched = stage(blocks.groupBy("text_key").agg(
        F.collect_set("label").alias("found"), F.max("score").alias("score")))

    starts = F.flatten("starts")
    base = F.array_compact(F.array(*[F.when(F.size(F.get("starts", F.lit(k))) > 0, F.lit(label))
                                     for k, (_, label) in enumerate(PHRASES)]))
    out = slim.join(matched, "text_key", "left").withColumn("base", base)
    joined = F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>"))))), ",")
    return out.select(
        "doc_id", "n_words", F.coalesce(F.size(starts), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"), joined.alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))

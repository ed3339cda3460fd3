"""Spelling variants of words by permuterm rotations.

A word marked with a terminator, ``word$``, has a rotation for each character
that ends in it: ``d$wor``, ``$word`` ... Sorted, the rotations of words that differ by one
replaced character stand together: they share the rotation up to its last
character, the one that is skipped. A word that lacks that character altogether
has this prefix as a whole rotation, so insertions and deletions fall into the same
prefix range. A range holds at most one word for each replacing character and one
word without it: ranges are bounded by the alphabet, whatever the corpus.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, with_columns_checked

LETTERS = r"[A-Za-zÀ-ÿ]"
END = "$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, least_chars: int = 7) -> DataFrame:
    """``(doc_id, run)``: each maximal run of letters from ``least_chars`` on, A-Z in lower case (null text: none)."""
    slim = with_columns_checked(docs, "doc_id", "text")
    found = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_chars},}}"), F.lit(0))
    return slim.select("doc_id", F.explode(found).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def thinned(doc_id: Column, run: Column, one_in: int) -> Column:
    """``run``, without one of its characters if ``one_in`` divides the crc32 of ``<doc_id>:<run>`` (null id: empty)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % one_in == 0, cut).otherwise(run)


def counted(occurrences: DataFrame, least_chars: int = 7, least_count: int = 2) -> DataFrame:
    """``(word)`` rows -> distinct ``(word, n)``."""
    return (occurrences.where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


def rotations(words: DataFrame) -> DataFrame:
    """``(prefix, last, kind, n)``: all rotations of ``word$`` that end in a letter, split before it.

    ``kind`` 1 and 2 are such rotations; 2 if the same letter stands before, so
    that dropping either gives the same word and only the first counts as an
    indel. ``kind`` 0 are whole rotations, what remains of a longer word without one letter.
    """
    i, word = F.col("i"), F.col("word")
    at = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    whole = at.select(F.concat(F.substr(word, i + 1), F.lit(END), F.substr(word, F.lit(1), i)).alias("prefix"),
                      F.lit("").alias("last"), F.lit(0).alias("kind"), "n")
    letter = F.substr(word, i, F.lit(1))
    edited = at.where("i > 0").select(
        F.concat(F.substr(word, i + 1), F.lit(END), F.substr(word, F.lit(1), i - 1)).alias("prefix"), letter.alias("last"),
        F.when((i > 1) & (F.substr(word, i - 1, F.lit(1)) == letter), 2).otherwise(1).alias("kind"), "n")
    return whole.unionAll(edited)


def _word(prefix: Column, last: Column) -> Column:
    """The word of a rotation: what stands after the terminator comes first."""
    return F.concat(F.substring_index(prefix, END, -1), last, F.substring_index(prefix, END, 1))


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` for words with a near word; ``best`` is ``(-n, word)`` of the most frequent one.

    Each prefix range is scanned once; a pair of near words meets in exactly one.
    """
    ranges = rotations(words).groupBy("prefix").agg(F.collect_list(F.struct("last", "kind", "n")).alias("all")).where(F.size("all") > 1)
    each = ranges.select("prefix", "all", F.explode("all").alias("me"))

    def near(o: Column) -> Column:
        kinds = F.col("me.kind") + o["kind"]
        swapped = (F.col("me.kind") > 0) & (o["kind"] > 0) & (F.col("me.last") != o["last"])
        return swapped | ((F.least(F.col("me.kind"), o["kind"]) == 0) & (kinds == 1))

    met = each.select("prefix", "me", F.filter("all", near).alias("near")).where(F.size("near") > 0)
    hits = met.select(
        _word(F.col("prefix"), F.col("me.last")).alias("word"), F.size("near").cast("long").alias("n_near"),
        F.array_min(F.transform("near", lambda o: F.struct((-o["n"]).alias("minus_n"), _word(F.col("prefix"), o["last"]).alias("word")))).alias("best"))
    return hits.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, form)`` -> ``(word, root)``: forms followed to the last. Each round doubles the steps taken.

    A form is more frequent than its word, so there are no circles; with a ratio
    of r, chains are no longer than the logarithm to r of the largest count.
    """
    links = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        up = links.select(F.col("word").alias("root"), F.col("root").alias("above"))
        longer = stage(links.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        links = longer.select("word", "root")
        if not longer.where("moved").limit(1).count():
            return links


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``(word, n)``, distinct words -> ``word, form, root, n, n_near, form_n``.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point. ``form`` is the near word of largest ``n`` (ties: the
    smallest in code-point order) if its ``n`` is at least ``ratio`` times the
    word's; else null. Words must not hold the terminator. An empty table
    gives an empty result.
    """
    words = stage(with_columns_checked(words, "word", "n"))
    near = neighbours(words)
    strong = -F.col("best.minus_n") >= ratio * F.col("n")
    formed = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("best.word")).alias("form"), F.when(strong, -F.col("best.minus_n")).alias("form_n")))
    last = roots(formed.where("form IS NOT NULL"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

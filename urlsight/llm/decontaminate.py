"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet on shared seeds (windows of ``LEAST`` words).
For each document and item with enough shared seeds, the longest common runs of
words are marked again and again, never overlapping, until no run of ``LEAST``
words is left (running Karp-Rabin: window hashes from long to short). The share
of the item's words under tiles is its coverage; order does not matter, so a
passage whose sentences were moved is found too.

An item shorter than a seed is a seed of its own length: it is found where it stands whole.

A small benchmark (its bytes are counted) is sent to every task, and seeds
are looked up there. Beyond ``MAX_SENT_BYTES``, seeds are joined by a shuffle and
only texts that may be covered far enough are tiled. Both ways tell items apart by
row, since ids may repeat.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stage, with_columns_checked, word_lists

LEAST = 5  # words
COVERAGE = 0.8
MAX_SENT_BYTES = 4 << 20
LEAK = "item_id long, item_words int, covered_words int, coverage double, tiles int, longest int"
# ASCII letters in lower case and digits stay, other ASCII becomes a space; bytes beyond ASCII stay
FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())
BASE = np.uint64(0x9E3779B97F4A7C15)


def folded(text: bytes | None) -> Iterator[list[bytes]]:
    return word_lists((text or b"").translate(FOLD))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _mixed(ids: np.ndarray) -> np.ndarray:
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def hashes_at(ids: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """``window_hashes`` at some starts only, for short windows."""
    found = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in reversed(range(length)):
            found = found * BASE + _mixed(ids[starts + k])
    return found


def window_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2**64) of all windows of ``length`` ids."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power = np.ones(len(ids), np.uint64)
        power[1:] = np.cumprod(np.full(len(ids) - 1, BASE))
        back = np.ones(n, np.uint64)
        back[1:] = np.cumprod(np.full(n - 1, np.uint64(_inverse(int(BASE)))))
        mixed = _mixed(ids) * power
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        return (sums[length:] - sums[:-length]) * back


def tile(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> tuple[int, list[int]]:
    """Covered words of ``item`` and the lengths of the tiles, longest marked first.

    Ids are compared as numbers; negative ids never match.
    """
    free_item, free_text = item >= 0, text >= 0
    tiles: list[int] = []
    search = max(least, min(len(item), len(text)) // 2)
    while True:
        found = []
        places: dict[int, list[int]] = {}
        for p, h in enumerate(window_hashes(item, search).tolist()):
            if free_item[p:p + search].all():
                places.setdefault(h, []).append(p)
        longest = 0
        if places:
            hashes = window_hashes(text, search)
            for t in np.flatnonzero(np.isin(hashes, np.array(list(places), np.uint64))).tolist():
                if not free_text[t:t + search].all():
                    continue
                for p in places[int(hashes[t])]:
                    n = 0
                    while (p + n < len(item) and t + n < len(text) and free_item[p + n] and free_text[t + n]
                           and item[p + n] == text[t + n]):
                        n += 1
                    if n >= search:
                        found.append((n, p, t))
                        longest = max(longest, n)
        if longest > 2 * search:  # look for runs of that length first
            search = longest
            continue
        for n, p, t in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            # what an earlier tile took is no longer free
            if free_item[p:p + n].all() and free_text[t:t + n].all():
                free_item[p:p + n] = free_text[t:t + n] = False
                tiles.append(n)
        # shorter rests of runs that a tile cut are met again with a shorter search
        if search == least:
            if found and any(free_item[p:p + search].all() and free_text[t:t + search].all() for _, p, t in found):
                continue
            return sum(tiles), tiles
        search = max(least, search // 2)


class Benchmark:
    """Items as word ids, with an index from seed hashes to items for each length of seeds."""

    def __init__(self, items: list[tuple[int, bytes]], least: int, coverage: float):
        self.least, self.coverage = least, coverage
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.items = [], []
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for part in folded(text) for w in part]
            if words:
                self.ids.append(item_id)
                self.items.append(np.array(words, np.int64))
        self.index = {}
        for size in sorted({min(least, len(x)) for x in self.items}):
            seeds = [(window_hashes(x, size), k) for k, x in enumerate(self.items) if min(least, len(x)) == size]
            hashes = np.concatenate([h for h, _ in seeds])
            order = np.argsort(hashes, kind="stable")
            owner, place = np.concatenate([np.full(len(h), k) for h, k in seeds]), np.concatenate([np.arange(len(h)) for h, _ in seeds])
            self.index[size] = hashes[order], owner[order], place[order]

    def leaks(self, text: bytes | None) -> list[tuple]:
        """Every item that the text covers far enough, as rows of ``LEAK``."""
        get = self.vocabulary.get
        parts = [np.fromiter(map(get, part, repeat(-1)), np.int64, len(part)) for part in folded(text)]
        words = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return sorted(leak for size in self.index if size <= len(words) for leak in self._leaks(words, size))

    def _leaks(self, words: np.ndarray, size: int) -> Iterator[tuple]:
        known, (seeds_, owner, place) = words >= 0, self.index[size]
        run = known[:len(words) - size + 1].copy()
        for k in range(1, size):
            run &= known[k:len(words) - size + 1 + k]
        starts = np.flatnonzero(run)
        hashes = hashes_at(words, starts, size)
        left = np.searchsorted(seeds_, hashes, "left")
        right = np.searchsorted(seeds_, hashes, "right")
        starts, left, right = starts[right > left], left[right > left], right[right > left]
        met: dict[int, tuple[set, list]] = {}
        for s, a, b in zip(starts.tolist(), left.tolist(), right.tolist()):
            for k in range(a, b):
                seeds, at = met.setdefault(int(owner[k]), (set(), []))
                seeds.add(int(place[k]))
                at.append(s)
        for k, (seeds, at) in met.items():
            item = self.items[k]
            reach = np.zeros(len(item), bool)
            for p in seeds:
                reach[p:p + size] = True
            if reach.sum() < self.coverage * len(item) - 1e-9:
                continue
            covered, tiles = tile(item, near(words, at, size), size)
            if covered >= self.coverage * len(item) - 1e-9:
                yield self.ids[k], len(item), covered, covered / len(item), len(tiles), max(tiles)


def near(words: np.ndarray, at: list[int], least: int) -> np.ndarray:
    """The parts of a text under seeds, kept apart by ids that match nothing."""
    inside = np.zeros(len(words) + 1, bool)
    for s in set(at):
        inside[s:s + least] = True
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    parts = []
    for a, b in zip(edges[::2], edges[1::2]):
        parts += [words[a:b], np.array([-1])]
    return np.concatenate(parts)


def _small(bench: DataFrame) -> bool:
    return (bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0) <= MAX_SENT_BYTES


def _benchmark(bench: DataFrame) -> DataFrame:
    return with_columns_checked(bench, "item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text"))


def leak_column(bench: DataFrame, text: Column, least: int, coverage: float) -> Column:
    """``array<struct<LEAK>>`` of a text; ``bench`` is small."""
    items = [(r.item_id, bytes(r.text)) for r in bench.collect()]  # at most MAX_SENT_BYTES
    shared = bench.sparkSession.sparkContext.broadcast((items, least, coverage))
    kept: dict = {}

    @F.pandas_udf(f"array<struct<{LEAK.replace(' ', ':').replace(',:', ',')}>>")
    def run(texts: pd.Series) -> pd.Series:
        if "index" not in kept:
            kept["index"] = Benchmark(*shared.value)
        names = [x.split(" ")[0] for x in LEAK.split(", ")]
        return pd.Series([[dict(zip(names, row)) for row in kept["index"].leaks(t)] for t in texts])

    return run(text.cast("binary"))


def _text_key() -> Column:
    text = F.coalesce("text", F.lit(""))
    return F.struct(F.xxhash64(text).alias("h"), F.crc32(text.cast("binary")).alias("c"))


def _by_shuffle(docs: DataFrame, bench: DataFrame, least: int, coverage: float) -> DataFrame:
    """``(text_key, LEAK)`` for every text of ``docs``: seeds are joined, then candidates are tiled."""
    def seeds_of(words: list[bytes], size: int) -> np.ndarray:
        import xxhash
        grams = map(b" ".join, zip(*(words[i:] for i in range(size))))
        return np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, max(0, len(words) - size + 1)).view(np.int64)

    def words_of(text: bytes | None) -> list[bytes]:
        return [w for part in folded(text) for w in part]

    @F.pandas_udf("n int, seeds array<long>")
    def in_order(texts: pd.Series) -> pd.DataFrame:
        found = [words_of(t) for t in texts]
        return pd.DataFrame({"n": [len(w) for w in found], "seeds": [seeds_of(w, min(least, len(w))) if w else [] for w in found]})

    @F.pandas_udf(LEAK.replace("item_id long, ", ""))
    def tiled(texts: pd.Series, items: pd.Series) -> pd.DataFrame:
        rows = []
        for text, item in zip(texts, items):
            known: dict[bytes, int] = {}
            a = np.array([known.setdefault(w, len(known)) for w in words_of(item)], np.int64)
            b = np.array([known.get(w, -1) for w in words_of(text)], np.int64)
            covered, tiles = tile(a, b, min(least, len(a)))
            rows.append((len(a), covered, covered / len(a), len(tiles), max(tiles, default=0)))
        return pd.DataFrame(rows, columns=["item_words", "covered_words", "coverage", "tiles", "longest"])

    items = stage(bench.withColumn("s", in_order("text")).where("s.n > 0").select(
        F.monotonically_increasing_id().alias("item_row"), "item_id", "text", F.col("s.n").alias("n"), F.col("s.seeds").alias("seeds")))
    sizes = sorted(r[0] for r in items.select(F.least("n", F.lit(least)).alias("size")).distinct().collect())    # at most ``least`` numbers

    @F.pandas_udf("array<struct<size:int,seed:long>>")
    def distinct(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"size": size, "seed": seed} for size in sizes for seed in np.unique(seeds_of(words, size)).tolist()] for words in map(words_of, texts)])

    by_seed = items.select("item_row", "n", F.least("n", F.lit(least)).alias("size"), F.posexplode("seeds").alias("at", "seed"))
    texts = docs.select(_text_key().alias("text_key"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")
    of_texts = texts.select("text_key", F.explode(distinct("text")).alias("s")).select("text_key", "s.*").distinct()
    met = of_texts.join(by_seed, ["size", "seed"]).groupBy("text_key", "item_row", "n", "size").agg(F.countDistinct("at").alias("shared"))
    # a seed covers at most its own number of words of the item
    pairs = stage(met.where(F.col("shared") * F.col("size") >= F.col("n") * coverage - 1e-9).select("text_key", "item_row"))
    once = texts.join(pairs.select("text_key").distinct(), "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    both = pairs.join(once, "text_key").join(items.select("item_row", "item_id", F.col("text").alias("item")), "item_row")
    found = both.select("text_key", "item_id", tiled("text", "item").alias("t")).select("text_key", "item_id", "t.*")
    return found.where(F.col("covered_words") >= F.col("item_words") * coverage - 1e-9)


def find(docs: DataFrame, bench: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """``(doc_id, LEAK)``: each row of ``docs`` with each benchmark item that it holds.

    Null and empty texts hold nothing, items of fewer than ``least`` words are
    found where they stand whole, items without words never. Repeated rows of either table
    are found each, and rows of ``docs`` without id keep a null id. Other
    columns are not read; empty tables give an empty result.
    """
    bounded_batches(docs.sparkSession)
    docs, bench = with_columns_checked(docs, "doc_id", "text"), _benchmark(bench)
    if _small(bench):
        found = docs.select("doc_id", F.explode(leak_column(bench, F.col("text"), least, coverage)).alias("l"))
        return found.select("doc_id", "l.*")
    found = stage(_by_shuffle(docs, bench, least, coverage))
    return docs.select("doc_id", _text_key().alias("text_key")).join(found, "text_key").drop("text_key")


def clean(docs: DataFrame, bench: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    bounded_batches(docs.sparkSession)
    items = _benchmark(bench)
    rows = docs.select(F.struct("*").alias("row"), "text")      # whatever the columns are called
    if _small(items):
        return rows.where(F.size(leak_column(items, F.col("text"), least, coverage)) == 0).select("row.*")
    found = stage(_by_shuffle(docs.select("text"), items, least, coverage).select("text_key").distinct())
    return rows.select("row", _text_key().alias("text_key")).join(found, "text_key", "left_anti").select("row.*")

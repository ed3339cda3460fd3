"""Phrase collocations by dynamic itemset counting.

The corpus is cut into ``shards`` that are scanned in a circle. Scans count
phrases of all lengths at once: a phrase becomes active at the scan after both
its subphrases (all but the last word, all but the first) have reached the
threshold in what was counted so far, and is counted for one full cycle from
there. Its count is then whole, and since a phrase is never more frequent than
its subphrases none that reaches the threshold is missed.

Scans count by 57 bits of a phrase's hash, so a counter is two numbers. Phrases
that share a hash share a counter, which can only be too high; one more scan counts
the phrases that are left word by word, and what is returned is exact.

What is active is known from one table of ``2 ** SLOT_BITS`` bytes that is sent
with each scan, whatever the corpus: a phrase's hash names a slot, which holds the
scan from which the phrase is taken as reached. Phrases that share a slot may become
active early or in vain; they are counted for a full cycle all the same.
"""
from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import batches_of, discard, free_shuffles, stage, with_columns_checked

SHARDS = 2
LONGEST = 4
SLOT_BITS = 24
SEGMENT = 1 << 18          # tokens of a segment, rounded up to whole documents
SEGMENTS_AT_ONCE = 8       # segments that a task counts together
SEGMENTS_A_TASK = 24       # of a scan, at least
SEGMENTS_CHECKED = 64      # of the last scan, whose phrases are fewer and recur
NEVER = 255
BREAK = b"."               # every character that ends a piece is written as this one
_TABLE = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d", BREAK * 10)
_SEGMENT = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("words", pa.list_(pa.binary())), ("hashes", pa.binary()), ("ids", pa.binary()), ("n_words", pa.int64())])
_SEGMENT_DDL = "shard int, lang string, words array<binary>, hashes binary, ids binary, n_words long"
# a counter's key: 57 bits of hash, one for phrases of the greatest length, six for the scan that began to count
START, WHOLE_LENGTH, HASH = 0x3F, 0x40, ~0x7F
_COUNTS = pa.schema([("key", pa.int64()), ("n", pa.int64())])
_PHRASES = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("phrase", pa.binary()), ("n", pa.int64())])


class _Ids(dict):
    """Numbers words in the order met; 0 is the end of a piece."""

    def __init__(self, words=(BREAK,)):
        super().__init__((w, i) for i, w in enumerate(words))

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def tokens(text: bytes) -> list[bytes]:
    """The words of a text in order, with ``BREAK`` before, between and after pieces."""
    return (BREAK + text.lower().translate(_TABLE) + BREAK).replace(BREAK, b" " + BREAK + b" ").split()


def segmented(shards: int, size: int) -> Callable:
    """Batches of ``(lang, text)`` -> segments: one language's documents as word numbers with their own word list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, open_, held = TaskContext.get().partitionId(), {}, 0

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal turn, held
            ids, parts = open_.pop(lang)
            all_ids = np.concatenate(parts)
            held -= len(all_ids)
            turn += 1
            row = {"shard": turn % shards, "lang": lang, "words": list(ids), "hashes": _hashed(lang, list(ids)).tobytes(), "ids": all_ids.tobytes(),
                   "n_words": int((all_ids > 0).sum())}
            return pa.RecordBatch.from_pylist([row], _SEGMENT)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = tokens((text.as_py() or b""))
                ids, parts = open_.setdefault(lang, (_Ids(), []))
                parts.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
                held += len(words)
                if sum(map(len, parts)) >= size:
                    yield closed(lang)
                while held > 8 * size:   # many languages with little text each
                    yield closed(max(open_, key=lambda k: sum(map(len, open_[k][1]))))
        for lang in list(open_):
            yield closed(lang)
    return run


def segments(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The tokenised corpus, written once by shard. A null text is empty, a null language ``und``."""
    spark = docs.sparkSession
    slim = with_columns_checked(docs, "lang", "text").select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.col("text").cast("binary"))
    path = f"{ensure_checkpoint_dir(spark)}/segments-{uuid.uuid4().hex}"
    made = slim.mapInArrow(segmented(shards, SEGMENT), _SEGMENT_DDL)
    made.write.partitionBy("shard").parquet(path)
    corpus = spark.read.schema(_SEGMENT_DDL).parquet(path)
    corpus.stage_path = path
    return corpus


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _slots(h: np.ndarray, slots: int = 1 << SLOT_BITS) -> np.ndarray:
    return (h >> np.uint64(65 - slots.bit_length())).astype(np.int32)


def _hashed(lang: str, words: list[bytes]) -> np.ndarray:
    """The hashes of numbered words; that of the end of a piece is 0, and no other."""
    import xxhash

    seed = xxhash.xxh64_intdigest(lang.encode())
    out = np.fromiter((xxhash.xxh64_intdigest(w, seed=seed) or 1 for w in words), np.uint64, len(words))
    out[:1] = 0
    return out


def active_counts(one: np.ndarray, since: np.ndarray, step: int, shards: int, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Counters (keys and counts) of all phrases active at this step, in texts given as hashes of their words (0: end of a piece)."""
    found = []

    def add(h: np.ndarray, start: np.ndarray, length: int) -> None:
        flags = start.astype(np.uint64) | np.uint64(WHOLE_LENGTH if length == longest else 0)
        found.append((h & np.uint64(HASH & (1 << 64) - 1)) | flags)

    h, reached = one, np.where(one > 0, since[_slots(one, len(since))], np.uint8(NEVER))
    if step < shards:
        words = one[one > 0]
        add(words, np.zeros(len(words)), 1)
    for length in range(2, longest + 1):
        start = np.maximum(reached[:-1], reached[1:])
        known = np.flatnonzero(start <= step)
        if not len(known):
            break
        h_ = np.zeros(len(start), np.uint64)
        h_[known] = h = _mixed(h[known], one[known + length - 1])
        first = start[known]
        now = first.astype(np.int32) + shards > step
        add(h[now], first[now], length)
        reached = np.full(len(start), NEVER, np.uint8)
        # a slot may have been marked by another phrase before this one was counted: longer ones begin no earlier
        reached[known] = np.maximum(since[_slots(h, len(since))], first)
        h = h_
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def exact_counts(lang: str, words: list[bytes], hashed: np.ndarray, ids: np.ndarray, marked: np.ndarray, longest: int = LONGEST) -> Iterator[pa.RecordBatch]:
    """The phrases in ``ids`` whose slots, and those of all their subphrases, are marked, with their counts."""
    texts = pa.array(words, pa.binary())
    one = hashed[ids]
    h, held = one, (one > 0) & marked[_slots(one, len(marked))]
    for length in range(1, longest + 1):
        if length > 1:
            held = held[:-1] & held[1:]
            h = _mixed(h[:len(held)], one[length - 1:])
            held &= marked[_slots(h, len(marked))]
        at = np.flatnonzero(held)
        if not len(at):
            return
        what = ids[at].astype(np.int64)
        if length > 1:
            what = what << 32 | ids[at + 1]
        if length > 2:   # exact numbers for the pairs, then for the phrase
            rest = ids[at + 2].astype(np.int64) << 32 | (ids[at + 3] if length == 4 else 0)
            both = np.unique(np.concatenate([what, rest]), return_inverse=True)[1]
            what = both[:len(at)].astype(np.int64) << 32 | both[len(at):]
        _, first, n = np.unique(what, return_index=True, return_counts=True)
        parts = [texts.take(pa.array(ids[at[first] + k])) for k in range(length)]
        phrase = pc.binary_join_element_wise(*parts, b" ") if length > 1 else parts[0]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), length, np.int32)), phrase,
                                          pa.array(n.astype(np.int64))], schema=_PHRASES)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """The segments of each batch as one ``(lang, words, ids)`` a language."""
    for batch in batches:
        by_lang: dict[str, tuple[_Ids, list[np.ndarray]]] = {}
        for lang, words, blob in zip(batch.column("lang").to_pylist(), batch.column("words").to_pylist(), batch.column("ids")):
            ids, parts = by_lang.setdefault(lang, (_Ids(), []))
            own = np.fromiter(map(ids.__getitem__, words), np.int32, len(words))
            parts.append(own[np.frombuffer(blob.as_buffer(), np.int32)])
        for lang, (ids, parts) in by_lang.items():
            yield lang, list(ids), np.concatenate(parts)


def scanned(since, step: int, shards: int, longest: int) -> Callable:
    """Batches of segments -> counters of active phrases; ``since`` is a broadcast table of slots.

    Hashes differ by language, so the segments of a batch are counted as one text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(h.as_buffer(), np.uint64)[np.frombuffer(i.as_buffer(), np.int32)]
                     for h, i in zip(batch.column("hashes"), batch.column("ids"))]
            if parts:
                keys, n = active_counts(np.concatenate(parts), since.value, step, shards, longest)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], schema=_COUNTS)
    return run


def checked(marked, longest: int) -> Callable:
    """Batches of segments -> marked phrases with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _joined(batches):
            yield from exact_counts(lang, words, _hashed(lang, words), ids, marked.value, longest)
    return run


def in_tasks(rows: DataFrame, segments: int, each: int) -> DataFrame:
    """About ``segments`` rows in a task for each ``each``, but no fewer tasks than cores: a task sends a phrase's count once."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(segments / each)))


def frequent_phrases(docs: DataFrame, threshold: int, longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, length, phrase, n)`` of all phrases with at least ``threshold`` occurrences, and ``(lang, words)``.

    Phrases of up to ``longest`` (at most four) words stand within a piece; overlapping occurrences all count.
    """
    if not 1 <= longest <= LONGEST or threshold < 1 or shards < 1:
        raise ValueError("phrases have one to four words, threshold and shards are at least 1")
    spark = docs.sparkSession
    corpus = segments(docs, shards)
    totals, n_segments = stage(corpus.groupBy("lang").agg(F.sum("n_words").alias("words"))), corpus.count()
    since, often = np.full(1 << SLOT_BITS, NEVER, np.uint8), np.full(1 << SLOT_BITS, NEVER, np.uint8)
    step, last, carried = 0, 0, None
    with batches_of(spark, SEGMENTS_AT_ONCE):      # segments are large rows
        while step < last + shards:
            sent = spark.sparkContext.broadcast(since.copy())
            part = in_tasks(corpus.where(F.col("shard") == step % shards).select("hashes", "ids"), math.ceil(n_segments / shards), SEGMENTS_A_TASK)
            counts = part.mapInArrow(scanned(sent, step, shards, longest), "key long, n long")
            held = counts if carried is None else counts.unionAll(carried)
            merged = stage(held.groupBy("key").agg(F.sum("n").alias("n")))
            sent.destroy()
            if carried is not None:
                discard(carried)
            enough = merged.where(F.col("n") >= threshold)
            if _mark(enough.where(F.col("key").bitwiseAND(F.lit(WHOLE_LENGTH)) == 0), since, step + 1):
                last = step + 1
            complete = F.col("key").bitwiseAND(F.lit(START)) + shards - 1 <= step
            _mark(enough.where(complete), often, 0)
            carried = stage(merged.where(~complete))
            discard(merged)
            free_shuffles(spark)
            step += 1
    discard(carried)
    sent = spark.sparkContext.broadcast(often != NEVER)
    with batches_of(spark, SEGMENTS_AT_ONCE // 2):      # exact numbers take more room than hashes
        found = stage(in_tasks(corpus.select("lang", "words", "ids"), n_segments, SEGMENTS_CHECKED).mapInArrow(checked(sent, longest), "lang string, length int, phrase binary, n long")
                      .groupBy("lang", "length", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= threshold))
    sent.destroy()
    discard(corpus)
    return found, totals


def _mark(counters: DataFrame, table: np.ndarray, value: int) -> bool:
    """Writes ``value`` into the slots of ``counters`` that are not marked yet; tells whether there are any.

    The slots come as a bit map: at most ``2 ** SLOT_BITS / 64`` rows.
    """
    slot = F.shiftrightunsigned("key", 64 - SLOT_BITS)
    bits = counters.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("mask")).toArrow()
    if not bits.num_rows:
        return False
    words, masks = (bits.column(c).to_numpy() for c in ("word", "mask"))
    on = np.unpackbits(masks.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(on)
    slots = words[row].astype(np.int64) * 64 + bit
    new = slots[table[slots] == NEVER]
    table[new] = value
    return bool(len(new))


def collocations(docs: DataFrame, threshold: int = 30, top: int = 2000, share: int = 80, shards: int = SHARDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases of two to four words.

    A phrase with ``a >= threshold`` occurrences is cut after each of its words; a cut with
    ``l`` and ``r`` occurrences of its parts scores ``floor(2000000 a / (l + r))`` and the
    lowest counts (ties: the first cut). Phrases inside a longer one with at least
    ``share`` percent of their occurrences are dropped. ``n`` are all words of the language.
    All of it is integer arithmetic in decimals. Rows with a null text add nothing,
    rows without language are ``und``; repeated rows count each time; an empty table gives no rows.
    """
    found, totals = frequent_phrases(docs, threshold, LONGEST, shards)
    counted = stage(found.select("lang", "length", F.col("phrase").cast("string").alias("phrase"), "n"))
    words = F.split("phrase", " ")
    phrases = counted.where("length > 1").select("lang", "length", "phrase", F.col("n").alias("a"))

    def joined(start, length):
        return F.array_join(F.slice(words, start, length), " ")

    cuts = phrases.select("lang", "length", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("length") - F.col("k")).alias("tail"))
    heads = counted.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = counted.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    scored = (cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")))

    spans = [(i, size) for size in range(2, LONGEST) for i in range(1, LONGEST - size + 2)]
    inner = phrases.where("length > 2").select("lang", F.col("a").alias("above"), "length", words.alias("words")).select(
        "lang", "above", F.explode(F.array(*[
            F.when(F.lit(i + size - 1) <= F.col("length"), F.when(F.col("length") > size, F.array_join(F.slice("words", i, size), " "))) for i, size in spans])).alias("phrase"))
    above = inner.where("phrase IS NOT NULL").groupBy("lang", "phrase").agg(F.max("above").alias("above"))
    covered = F.expr(f"CAST(above AS DECIMAL(19,0)) * 100 >= CAST(a AS DECIMAL(19,0)) * {int(share)}")
    kept = scored.join(above, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = flat.selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank").where(F.col("rank") <= top)
    return ranked.join(totals.withColumnRenamed("words", "n"), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))

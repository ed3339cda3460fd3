"""Language-model scores: a log-bilinear neural model beside a smoothed unigram base.

The model predicts a word from the two before it, in two steps: first the word's
class, then the word within it. The most frequent words are classes of their own;
the other words of the ``HEAD`` (all above a count that at most so many exceed) share
classes with words that stand beside the same frequent words. For the class,
each context word's class has a vector for its position, their sum is matched with the
vectors of all classes, and the scores are normalised; within its class a word has its
smoothed share of the class by corpus counts. Tokens outside the head are the last class.

The class model is trained in numpy by noise-contrastive estimation on every
training text: texts are dealt by their hash into logical shards of ``SHARD_TOKENS``
(so the result doesn't hang on partitions), the first shard makes a common
start, then each shard trains from there and the parameters are averaged by words (parameter
mixing).

As the score of a class is a sum over context positions, matrix products give
all of it ahead of scoring: position tables ``context @ words.T``, and the
normaliser of every context pair as one product of their exponentials. So every token has
a normalised probability.

Counts of all tokens never travel whole: those of the head
are sent to the tasks, the others (which no key can dominate) are joined by a shuffle.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stage, with_columns_checked, word_lists

END = b"\n"  # no word holds it
CLASSES = 1024  # of the model, at most
SINGLES = 640  # the end and the most frequent words: a class each
CUES = 48  # frequent words beside which the other words are counted, to find their classes
HEAD = 200_000  # tokens whose counts are sent to every task
WIDTH = 16
NOISE, NOISE_WEIGHT = 16, 4.0  # shared noise words in a batch; noise samples that they stand for
BATCH = 8192
RATE = 0.08
ROUNDS = 1
SHARD_TOKENS = 4_000_000
FLUSH = 500_000  # distinct tokens that a counting task holds at most


def tokens(text: bytes | None) -> Iterator[list[bytes]]:
    """The lower-case words of a whole text in lists, then the end."""
    yield from word_lists((text or b"").lower())
    yield [END]


def count_tokens(train: DataFrame) -> DataFrame:
    """``(token, c)`` over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(seen: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])

        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                for words in tokens(text.as_py()):
                    seen.update(words)
                if len(seen) > FLUSH:
                    yield batch_of(seen)
                    seen = Counter()
        yield batch_of(seen)

    counted = train.select(F.col("text").cast("binary")).mapInArrow(run, "token binary, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("c"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The tokens above a count that at most ``most`` tokens exceed.

    The count comes from a histogram of powers (16 steps to a doubling), so no
    task and no driver sorts tokens.
    """
    step = F.floor(F.log2("c") * 16)
    bars = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()  # under 1,024 rows
    above, least = 0, None
    for bar in bars:
        above += bar.n
        if above > most:
            break
        least = bar.step
    return counts.where(step >= least) if least is not None else counts.where("false")


@dataclass
class Model:
    """Counts of the head's tokens (the end first), their classes, corpus totals and model parameters."""
    head: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    class_of: np.ndarray = field(default=None)  # of each head token, then of all others
    near: np.ndarray = field(default=None)  # (classes + 1) x WIDTH: the word before; the last row is the start
    far: np.ndarray = field(default=None)  # the word before that
    words: np.ndarray = field(default=None)  # classes x WIDTH
    bias: np.ndarray = field(default=None)

    @property
    def classes(self) -> int:
        return int(self.class_of[-1]) + 1

    def start(self, groups: np.ndarray) -> "Model":
        """``groups``: the class of each token after the single ones, from 0 on without gaps."""
        singles = len(self.head) - len(groups)
        last = singles + (int(groups.max()) + 1 if len(groups) else 0)
        self.class_of = np.concatenate([np.arange(singles), singles + groups, [last]]).astype(np.int64)
        rng, k = np.random.default_rng(11), self.classes
        shape = lambda n: (rng.standard_normal((n, WIDTH)) * 0.05).astype(np.float32)
        self.near, self.far, self.words = shape(k + 1), shape(k + 1), shape(k)
        self.bias = np.log(self.unigram()).astype(np.float32)
        return self

    def unigram(self) -> np.ndarray:
        """Smoothed shares of the classes in the training tokens."""
        c = np.bincount(self.class_of[:-1], weights=self.counts, minlength=self.classes)
        c[-1] = self.total - c[:-1].sum()
        return (c + 1) / (c.sum() + len(c))

    def log_shares(self) -> np.ndarray:
        """log10 of each head token's share of its class, (count + 1) over their sum; 0 for all others."""
        sums = np.bincount(self.class_of[:-1], weights=self.counts + 1.0, minlength=self.classes)
        return np.append(np.log10((self.counts + 1.0) / sums[self.class_of[:-1]]), 0.0)

    @property
    def others(self) -> float:
        """The sum of (count + 1) over tokens outside the head, and one for all unseen ones."""
        return float(self.total - self.counts.sum() + self.distinct - (self.counts > 0).sum() + 1)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-probability of a class = near[a, w] + far[b, w] - norm[a, b] for the words a, b before it."""
        near, far = self.near @ self.words.T, self.far @ self.words.T + self.bias
        top = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        norm = np.log(np.exp(near - top[0]) @ np.exp(far - top[1]).T) + top[0] + top[1].T
        return near, far, norm


class Reader:
    """Turns texts into token numbers; ``len(head)`` stands for all other tokens."""

    def __init__(self, head: list[bytes]):
        self.get = {w: i for i, w in enumerate(head)}.get
        self.other = len(head)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.get, words, repeat(self.other)), np.int64, len(words))

    def contexts(self, classes: np.ndarray, before: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """The word before and the one before that, for each token."""
        joined = np.concatenate([np.array(before, np.int64), classes])
        return joined[1:-1], joined[:-2]


def train_part(model: Model, texts: Iterator[bytes | None], seed: int) -> int:
    """Noise-contrastive estimation over some texts, in place (AdaGrad steps); the tokens seen."""
    reader, rng, k = Reader(model.head), np.random.default_rng(seed), model.classes
    noise_p = model.unigram()
    cut = np.cumsum(noise_p)
    shift = np.log(NOISE_WEIGHT * noise_p).astype(np.float32)
    parts = {"near": model.near, "far": model.far, "words": model.words}
    squares = {name: np.full(x.shape, 1e-2, np.float32) for name, x in parts.items()}
    bias_squares = np.full(k, 1e-2, np.float32)
    columns = np.arange(WIDTH)

    def scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        flat = (rows[:, None] * WIDTH + columns).ravel()
        return np.bincount(flat, weights=values.ravel(), minlength=size * WIDTH).reshape(size, WIDTH).astype(np.float32)

    def step(w: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        context = model.near[a] + model.far[b]
        noise = np.minimum(np.searchsorted(cut, rng.random(NOISE)), k - 1)
        mine = np.einsum("ij,ij->i", context, model.words[w]) + model.bias[w] - shift[w]
        theirs = context @ model.words[noise].T + (model.bias[noise] - shift[noise])
        up = 1 / (1 + np.exp(np.clip(mine, -30, 30)))
        down = (-NOISE_WEIGHT / NOISE) / (1 + np.exp(-np.clip(theirs, -30, 30)))
        of_context = up[:, None] * model.words[w] + down @ model.words[noise]
        of_words = scatter(w, up[:, None] * context, k) + scatter(noise, down.T @ context, k)
        of_bias = np.bincount(w, weights=up, minlength=k) + np.bincount(noise, weights=down.sum(axis=0), minlength=k)
        for name, g in (("near", scatter(a, of_context, k + 1)), ("far", scatter(b, of_context, k + 1)), ("words", of_words)):
            squares[name] += g * g
            parts[name] += RATE * g / np.sqrt(squares[name])
        np.add(bias_squares, (of_bias * of_bias).astype(np.float32), out=bias_squares)
        model.bias += (RATE * 0.1 * of_bias / np.sqrt(bias_squares)).astype(np.float32)

    seen, waiting, held = 0, [], 0
    for text in texts:
        before = (k, k)
        for words in tokens(text):
            classes = model.class_of[reader.numbers(words)]
            a, b = reader.contexts(classes, before)
            waiting.append((classes, a, b))
            held += len(classes)
            before = (before + tuple(classes[-2:].tolist()))[-2:]
            while held >= BATCH:
                w, a, b = (np.concatenate(x) for x in zip(*waiting))
                step(w[:BATCH], a[:BATCH], b[:BATCH])
                waiting, held = [(w[BATCH:], a[BATCH:], b[BATCH:])], held - BATCH
                seen += BATCH
    if held:
        step(*(np.concatenate(x) for x in zip(*waiting)))
        seen += held
    return seen


def beside_cues(train: DataFrame, head: list[bytes], singles: int) -> np.ndarray:
    """How often each head token after the ``singles`` first stands beside each of the ``CUES`` most frequent words."""
    shared = train.sparkSession.sparkContext.broadcast(head)      # at most HEAD tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, met, held = Reader(shared.value), [], 0

        def counted() -> pa.RecordBatch:
            at, n = np.unique(np.concatenate(met), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n)], ["at", "n"])

        for batch in batches:
            for text in batch.column(0):
                before = np.zeros(0, np.int64)
                for words in tokens(text.as_py()):
                    x = np.concatenate([before, reader.numbers(words)])
                    before = x[-1:]
                    for word, cue in ((x[1:], x[:-1]), (x[:-1], x[1:])):
                        ok = (word >= singles) & (word < reader.other) & (cue > 0) & (cue <= CUES)
                        met.append((word[ok] - singles) * CUES + cue[ok] - 1)
                        held += len(met[-1])
                if held > 4 * FLUSH:
                    yield counted()
                    met, held = [], 0
        if met:
            yield counted()

    counts = train.select(F.col("text").cast("binary")).mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((len(head) - singles) * CUES)      # at most HEAD x CUES
    out[counts.column("at").to_numpy()] = counts.column("n").to_numpy()
    return out.reshape(-1, CUES)


def grouped(beside: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Groups of tokens with like neighbours, and of like frequency within those: about ``most``, numbered without gaps."""
    if not len(beside):
        return np.zeros(0, np.int64)
    kinds, parts = max(1, most // 12), 12
    x = np.sqrt(beside / np.maximum(beside.sum(axis=1, keepdims=True), 1)).astype(np.float32)
    centres = x[np.unique(np.linspace(0, len(x) - 1, kinds).astype(int))]
    nearest = lambda y: np.concatenate([(y[i:i + 8192] @ centres.T - (centres ** 2).sum(axis=1) / 2).argmax(axis=1) for i in range(0, len(y), 8192)])
    for _ in range(8):
        own = nearest(x[:20_000])
        for k in np.unique(own):
            centres[k] = x[:20_000][own == k].mean(axis=0)
    kind = nearest(x)
    # tokens come by falling count: cut each kind where its weight passes a twelfth
    out = np.zeros(len(x), np.int64)
    for k in np.unique(kind):
        at = np.flatnonzero(kind == k)
        w = weights[at].cumsum()
        out[at] = k * parts + np.minimum((w - weights[at]) * parts // w[-1], parts - 1).astype(np.int64)
    return np.unique(out, return_inverse=True)[1]


def _dealt(train: DataFrame, shards: int) -> DataFrame:
    """``(shard, text)``, each shard in one task and in an order that follows from the rows alone."""
    h = F.xxhash64(F.coalesce("text", F.lit("")), "doc_id")
    slim = train.select(F.pmod(h, F.lit(shards)).cast("int").alias("shard"), h.alias("h"), F.col("text").cast("binary").alias("text"))
    return slim.repartition(shards, "shard").sortWithinPartitions("shard", "h").select("shard", "text")


def _round(model: Model, shards: DataFrame, number: int) -> Model:
    shared = shards.sparkSession.sparkContext.broadcast(model)  # HEAD tokens and CLASSES vectors: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import copy
        from itertools import groupby
        rows = ((n, x.as_py()) for batch in batches for n, x in zip(batch.column(0).to_pylist(), batch.column(1)))
        for shard, part in groupby(rows, key=lambda r: r[0]):
            own = copy.copy(shared.value)
            own.near, own.far, own.words, own.bias = (x.copy() for x in (own.near, own.far, own.words, own.bias))
            seen = train_part(own, (x for _, x in part), 1_000_003 * number + shard)
            if seen:
                flat = np.concatenate([x.ravel() for x in (own.near, own.far, own.words, own.bias)]).astype(np.float64) * seen
                flat = np.append(flat, seen)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["at", "value"])

    mixed = shards.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    got = mixed.toPandas().sort_values("at")["value"].to_numpy()  # one row for each parameter
    if not len(got):
        return model
    flat = (got[:-1] / got[-1]).astype(np.float32)
    for name in ("near", "far", "words", "bias"):
        shape = getattr(model, name).shape
        setattr(model, name, flat[:math.prod(shape)].reshape(shape))
        flat = flat[math.prod(shape):]
    return model


def fit(train: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model and the written table of all token counts, from all rows of ``train``."""
    bounded_batches(train.sparkSession)
    counts = stage(count_tokens(train))
    whole = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    head = frequent(counts.where(F.col("token") != END), HEAD - 1).toPandas()
    head["token"] = head["token"].map(bytes)
    head = head.sort_values(["c", "token"], ascending=[False, True])
    ends = counts.where(F.col("token") == END).first()
    names = [END, *head["token"]]
    model = Model(names, np.array([ends.c if ends else 0, *head["c"]], np.int64), whole.n or 0, whole.v)
    singles = min(SINGLES, len(names))
    model.start(grouped(beside_cues(train, names, singles), model.counts[singles:], CLASSES - 1 - SINGLES))
    shards = max(1, math.ceil(model.total / SHARD_TOKENS))
    dealt = _dealt(train, shards)
    if shards > 1:
        model = _round(model, dealt.where("shard = 0"), 0)     # one shard: a common start
    for number in range(1, rounds + 1):
        model = _round(model, dealt, number)
    return model, counts


RESULT = ("rid long, doc_id long, n_tokens long, known long, head_log double, lm_log double, n_others long,"
          " tail array<struct<token: binary, n: int>>")


def _read(docs: DataFrame, model: Model) -> DataFrame:
    """All that a text's own words give; ``tail``: the tokens whose counts the head doesn't hold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        fitted = shared.value
        reader, last = Reader(fitted.head), fitted.classes - 1
        near, far, norm = fitted.tables()
        log_counts, log_shares = np.append(np.log10(fitted.counts + 1.0), 0.0), fitted.log_shares()
        known = np.append(fitted.counts > 0, False)
        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows, ends, names, times = [], [0], [], []
            for text in batch.column(1):
                n = n_known = n_others = 0
                head_log = lm_log = 0.0
                tail: Counter = Counter()
                before = (fitted.classes, fitted.classes)
                for words in tokens(text.as_py()):
                    numbers = reader.numbers(words)
                    classes = fitted.class_of[numbers]
                    a, b = reader.contexts(classes, before)
                    before = (before + tuple(classes[-2:].tolist()))[-2:]
                    lm_log += float((near[a, classes] + far[b, classes] - norm[a, b]).sum(dtype=np.float64)) / math.log(10)
                    lm_log += float(log_shares[numbers].sum())
                    head_log += float(log_counts[numbers].sum())
                    other = classes == last
                    n, n_known, n_others = n + len(words), n_known + int(known[numbers].sum()), n_others + int(other.sum())
                    tail.update(words[i] for i in np.flatnonzero(other))
                rows.append((rid, n, n_known, head_log, lm_log, n_others))
                rid += 1
                names += tail
                times += tail.values()
                ends.append(len(names))
            r = list(zip(*rows)) if rows else [()] * 6
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(names, pa.binary()), pa.array(times, pa.int32())], ["token", "n"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(r[0], pa.int64()), batch.column(0), pa.array(r[1], pa.int64()), pa.array(r[2], pa.int64()),
                 pa.array(r[3], pa.float64()), pa.array(r[4], pa.float64()), pa.array(r[5], pa.int64()), lists],
                ["rid", "doc_id", "n_tokens", "known", "head_log", "lm_log", "n_others", "tail"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, RESULT)


def score(docs: DataFrame, trained_on: Column, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs``.

    ``trained_on``: a condition on ``docs`` for the rows to learn from. Null texts
    are empty (one token, the end); repeated rows count and are scored each;
    without any training row every token has base score 0. Other columns are not
    read, an empty table gives an empty result.
    """
    slim = with_columns_checked(docs, "doc_id", "text")
    model, counts = fit(slim.where(trained_on), rounds)
    rows = stage(_read(slim, model))
    tail = rows.select("rid", F.explode("tail").alias("t")).select("rid", "t.token", "t.n")
    looked_up = (tail.join(counts, "token", "left").groupBy("rid")
                 .agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("tail_log"),
                      F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("tail_known")))
    per_token = math.log10(model.total + model.distinct + 1)
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    return rows.drop("tail").join(looked_up, "rid", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("lm_log") + tail_log - F.col("n_others") * math.log10(model.others)).alias("score"))

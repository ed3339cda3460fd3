"""Vector duplicates, collocations and spelling variants against brute force, and their odd rows."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import duckdb_run, rows_of
from urlsight.llm import collocations, registry, spelling_variants, vector_duplicates

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VEC = "vec_id long, embedding array<float>, label int, node string, copies string"


# ------------------------------------------------------------------ vectors
def plain_links(rows, threshold=0.9):
    """``vec_id -> (n_links, component_id)`` from all pairs in double precision."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {i: (0, i) for i, _ in rows}
    if not good:
        return out
    root = {i: i for i, _ in good}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for dim in {len(v) for _, v in good}:
        part = [(i, v) for i, v in good if len(v) == dim]
        x = np.stack([v for _, v in part])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= threshold
        for a, (i, _) in enumerate(part):
            out[i] = (int(near[a].sum()) - 1, i)
            for b in np.flatnonzero(near[a]):
                p, q = sorted((find(i), find(part[b][0])))
                root[q] = p
    return {i: (n, find(i) if i in root else i) for i, (n, _) in out.items()}


def vectors(rng, n=900, dims=24):
    """Random vectors; copies, scaled copies, near copies, chains of links and a dense group."""
    x = rng.normal(size=(n, dims))
    rows = [v.tolist() for v in x[:n // 2]]
    for v in x[:n // 12]:
        unit = v / np.linalg.norm(v)
        for cos in (0.999, 0.95, 0.91, 0.89, 0.7):
            away = rng.normal(size=dims)
            away -= away @ unit * unit
            rows.append((cos * unit + math.sqrt(1 - cos ** 2) * away / np.linalg.norm(away)).tolist())
        rows += [v.tolist(), (2 * v).tolist()]
    rows += [(x[0] + 0.12 * np.linalg.norm(x[0]) / math.sqrt(dims) * rng.normal(size=dims)).tolist() for _ in range(n // 3)]
    step, at = math.acos(0.95), np.eye(dims)
    rows += [(math.cos(k * step) * at[0] + math.sin(k * step) * at[1]).tolist() for k in range(12)]     # a chain
    return [(3 * i, v) for i, v in enumerate(rows)]


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("chunk", [8192, 64])
def test_links_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(vector_duplicates, "CHUNK", chunk)       # 64: every list and its queries are cut into chunks
    rows = vectors(np.random.default_rng(4))
    got = result(vector_duplicates.links(spark.createDataFrame([(i, v, 0, "a", "b") for i, v in rows], VEC)))
    want = plain_links(rows)
    linked = sum(n for n, _ in want.values())
    assert len(got) == len(rows) and abs(linked - sum(n for n, _, _ in got.values())) <= 0.01 * linked
    assert all(got[i][0] <= n for i, (n, _) in want.items())                         # none below the threshold
    assert sum(got[i][1] == c for i, (_, c) in want.items()) >= 0.99 * len(rows)
    assert all(kept == (i == c) for i, (_, c, kept) in got.items())


def test_recall_in_many_lists(spark):
    """Partners at the threshold itself, in an index of many lists."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=(1500, 32))
    away -= (away * x[:1500]).sum(axis=1, keepdims=True) * x[:1500]
    y = 0.901 * x[:1500] + math.sqrt(1 - 0.901 ** 2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([x, y]))]
    got = result(vector_duplicates.links(spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], VEC)))
    found = sum(got[i][1] == got[6000 + i][1] for i in range(1500))
    assert found >= 0.99 * 1500
    want = plain_links(rows)
    assert sum(got[i][0] for i in got) >= 0.98 * sum(n for n, _ in want.values())


def test_bound_never_passes_over_a_link():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 20))
    x[200:] = x[:200] + 0.3 * rng.normal(size=(200, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = vector_duplicates.fit(x, 1)
    _, codes, _ = vector_duplicates.encode(x, model, 0.9)
    links, pointer, root = vector_duplicates.linked_in_list(
        model.centres[0].astype(float), model, codes, x, np.full(400, 80), np.ones(400, int), x, np.full(400, 80), 0.9)
    near = x @ x.T >= 0.9
    assert (links == near.sum(axis=1)).all() and all(near[i, p] for i, p in enumerate(pointer))
    assert near.sum() > 500


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1e-30, 0.0]),
            (9, [1.0, 0.0, 0.0]), (10, [3e38, 0.0]), (11, [-1.0, 0.0]), (12, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, None, "x", "y") for i, v in rows], VEC)
    got = result(vector_duplicates.links(df))
    want = {i: (0, i, True) for i in range(1, 7)} | {7: (2, 7, True), 8: (2, 7, False), 10: (2, 7, False), 9: (1, 9, True), 12: (1, 9, False), 11: (0, 11, True)}
    assert got == want
    again = spark.createDataFrame([(7, [1.0, 0.0]), (7, [1.0, 0.0]), (None, [2.0, 0.0]), (None, [0.0, 5.0])], "vec_id long, embedding array<double>")
    found = sorted(map(tuple, vector_duplicates.links(again).collect()), key=str)
    assert found == sorted([(7, 2, 7, True), (7, 2, 7, True), (None, 2, 7, False), (None, 0, None, False)], key=str)
    assert vector_duplicates.links(df.limit(0)).count() == 0
    assert vector_duplicates.links(df.where("vec_id < 4")).count() == 3
    with pytest.raises(ValueError):
        vector_duplicates.links(df, threshold=0.0)


# ------------------------------------------------------------------ phrases
def pieces(text):
    return [[w for w in re.split("[\x20\x09]+", p) if w] for p in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UP))]


def plain_collocations(docs, threshold, top=2000, share=80):
    f, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            total[lang] += len(ws)
            for k in range(1, 5):
                f[lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        c = {p: n for p, n in c.items() if n >= threshold}
        rows = []
        for p, a in c.items():
            if len(p) == 1:
                continue
            if any(100 * n >= share * a for q, n in c.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, total[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return out


LANG_DOCS = "lang string, text string, shard string, words string, n string"


def phrase_docs(seed=1, n=400):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "new", "york", "city", "É", "é", "don't", "a-b", "x"]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(30)):
            words += rng.choice([["new", "york"], ["New", "York", "CITY"], ["a"] * rng.randrange(6), [rng.choice(vocabulary)], ["one", "two", "three", "four", "five"]])
            words.append(rng.choice(["", "", "", ".", ",", "\n", "!", " \t", " "]))
        docs.append((rng.choice(["en", "en", "fr", None]), " ".join(words)))
    return docs + [("en", None), ("de", ""), ("en", ". ,;\r\n"), (None, "late late late " * 40)]


@pytest.mark.parametrize("shards", [1, 3, 5])
def test_collocations_equal_brute_force(spark, monkeypatch, shards):
    monkeypatch.setattr(collocations, "SEGMENT", 300)            # many small segments
    docs = phrase_docs()
    df = spark.createDataFrame([(*d, "x", "y", "z") for d in docs], LANG_DOCS).repartition(3)
    got = [tuple(r) for r in collocations.collocations(df, threshold=12, shards=shards).collect()]
    assert sorted(got) == sorted(plain_collocations(docs, 12)) and len(got) > 10


def test_active_phrases_of_a_scan():
    words = [b".", b"p", b"q"]
    ids = np.array([0, 1, 2, 1, 2, 0, 1, 2, 1, 0], np.int32)     # p q p q . p q p
    hashed = collocations._hashed("en", words)
    never = np.full(1 << collocations.SLOT_BITS, collocations.NEVER, np.uint8)
    counts = lambda *a: sorted(collocations.active_counts(hashed[ids], *a)[1].tolist())
    assert counts(never, 0, 3) == [3, 4] and counts(never, 3, 3) == []           # words, for one cycle
    since = never.copy()
    since[collocations._slots(hashed[1:])] = 2
    assert counts(since, 1, 3) == [3, 4] and counts(since, 2, 3) == [2, 3, 3, 4]      # and pairs, from the scan after
    assert counts(since, 4, 3) == [2, 3] and counts(since, 5, 3) == []
    assert counts(np.zeros_like(never), 2, 3) == [1, 1, 2, 2, 3, 3, 4]         # all slots taken: pqp, qpq and pqpq too


def test_a_phrase_whose_slots_were_taken_early_is_counted_for_a_full_cycle():
    hashed = collocations._hashed("en", [b".", b"p", b"q", b"r"])
    one = hashed[[0, 1, 2, 3, 0]]                               # p q r, in both of two shards
    since = np.full(1 << collocations.SLOT_BITS, collocations.NEVER, np.uint8)
    since[collocations._slots(hashed[1:])] = [1, 1, 2]          # r is reached one scan later than p and q
    pairs = collocations._mixed(hashed[[1, 2]], hashed[[2, 3]])
    since[collocations._slots(pairs)] = 1                       # others took the slots of both pairs
    seen = Counter()
    for step in range(1, 6):
        keys, n = collocations.active_counts(one, since, step, 2)
        seen.update({k: c for k, c in zip(keys.tolist(), n.tolist())})
    whole = {k: n for k, n in seen.items() if k >> 7 == int(collocations._mixed(pairs[:1], hashed[3:])[0]) >> 7}
    assert list(whole.values()) == [2]


@pytest.mark.parametrize("bits", [6, 9])
def test_few_slots_lose_no_phrase(spark, monkeypatch, bits):
    monkeypatch.setattr(collocations, "SEGMENT", 2000)
    monkeypatch.setattr(collocations, "SLOT_BITS", bits)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(150)]
    phrases = [" ".join(rng.choices(words, k=5)) for _ in range(60)]
    docs = [("en", " ".join(rng.choice(phrases) if rng.random() < .3 else words[int(150 * rng.random() ** 2)] for _ in range(40))) for _ in range(300)]
    df = spark.createDataFrame([(*d, "x", "y", "z") for d in docs], LANG_DOCS).repartition(3)
    got = [tuple(r) for r in collocations.collocations(df, threshold=12).collect()]
    assert sorted(got) == sorted(plain_collocations(docs, 12)) and len(got) > 10


def test_scans_of_many_files_take_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SEGMENT", 1)              # a segment for each text
    asked, in_tasks = [], collocations.in_tasks

    def kept(*args):
        out = in_tasks(*args)
        asked.append((args[0].rdd.getNumPartitions(), out.rdd.getNumPartitions()))
        return out

    monkeypatch.setattr(collocations, "in_tasks", kept)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")    # a task for each file
    try:
        df = spark.createDataFrame([("en", "so far so good")] * 80, "lang string, text string").repartition(40)
        found, _ = collocations.frequent_phrases(df, 30)
        assert {r["phrase"].decode(): r["n"] for r in found.collect()}["so far so good"] == 80
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    cores = spark.sparkContext.defaultParallelism
    assert all(before > cores for before, _ in asked) and {after for _, after in asked} == {cores}


def test_phrases_that_reach_the_threshold_late(spark, monkeypatch):
    """A phrase whose words become frequent in the last shard is counted through a cycle that goes round."""
    monkeypatch.setattr(collocations, "SEGMENT", 1)
    docs = [("en", "p q r s")] * 5 + [("en", "z")] * 20 + [("en", "p q r s")] * 4
    df = spark.createDataFrame(docs, "lang string, text string").coalesce(1)
    found, totals = collocations.frequent_phrases(df, 9, shards=4)
    got = {r.phrase.decode(): r.n for r in found.select(F.col("phrase").cast("binary").alias("phrase"), "n").collect()}
    want = Counter(" ".join("pqrs"[i:i + k]) for k in range(1, 5) for i in range(5 - k))
    assert got == {p: 9 for p in want} | {"z": 20} and totals.first()["words"] == 9 * 4 + 20


def test_collocations_of_odd_tables(spark):
    empty = spark.createDataFrame([], LANG_DOCS)
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None, "", "", "")] * 3, LANG_DOCS)).count() == 0
    long = spark.createDataFrame([("en", "to be " * 50_000, "", "", "")], LANG_DOCS)
    got = [tuple(r) for r in collocations.collocations(long).collect()]
    assert got == plain_collocations([("en", "to be " * 50_000)], 30)
    with pytest.raises(ValueError):
        collocations.frequent_phrases(empty, 30, longest=5)


def test_score_of_numbers_beyond_64_bits(spark):
    row = spark.sql("SELECT 5000000000000000000L AS a, 6000000000000000000L AS l, 7000000000000000000L AS r")
    score = "(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))"
    import inspect
    assert score in inspect.getsource(collocations.collocations)
    assert row.selectExpr(score).first()[0] == 2000000 * 5 // 13


# ------------------------------------------------------------------ words
def plain_words(docs, one_in=31):
    c = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(words):
    form, count = {}, {}
    for w, n in words.items():
        others = [v for v in words if v != w and near(v, w)]
        count[w] = len(others)
        if others:
            best = min(others, key=lambda v: (-words[v], v))
            if words[best] >= 10 * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, count[w], words[form[w]] if w in form else None) for w, n in words.items()}


def variants_of(spark, words):
    df = spark.createDataFrame([(w, n, "x", "y") for w, n in words.items()], "word string, n long, form string, prefix string")
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants.variants(df).collect()}


def test_variants_equal_all_pairs(spark):
    rng = random.Random(8)
    words = {}
    for _ in range(40):
        word = "".join(rng.choice("abÀé÷") for _ in range(rng.randrange(7, 11)))
        n = 10 ** rng.randrange(6)
        for _ in range(8):       # chains of edits, ever rarer
            words.setdefault(word, max(2, n))
            i, c = rng.randrange(len(word) + 1), rng.choice("abÀé÷")
            word = rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1:], word[:i] + c + word[i + 1:]])
            n //= rng.choice([1, 10, 12])
    words |= {"aaaaaaa": 5, "aaaaaaaa": 50, "aaaaaaaaa": 500, "abababab": 3, "babababa": 3, "tiestie": 2, "tiestia": 20, "tiestib": 20}
    got = variants_of(spark, words)
    assert got == plain_variants(words)
    assert got["tiestie"][0] == "tiestia" and got["aaaaaaa"][1] == "aaaaaaaaa"


def test_long_chains_of_forms(spark):
    words = {"a" * (7 + i): 2 * 10 ** i for i in range(12)}
    got = variants_of(spark, words)
    assert {w: r[1] for w, r in got.items()} == {w: "a" * 18 for w in words}


def test_words_of_texts(spark, docs_of):
    rng = random.Random(3)
    parts = ["Étranger", "ÉTRANGER", "estrange", "Strangers", "stranger", "naïveté", "übergrößen", "x" * 40, "a1b2c3d4e5f6g7"]
    rows = [(i if i % 7 else None, " ".join(rng.choice(parts) for _ in range(rng.randrange(20)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "Ābcdefgh nnnnnnn" * 3), (500, rows[1][1])]
    docs = docs_of(rows, "run word prefix")
    runs = spelling_variants.runs(docs)
    words = spelling_variants.counted(runs.select(spelling_variants.thinned(F.col("doc_id"), F.col("run"), 3).alias("word")))
    got = {r.word: r.n for r in words.collect()}
    assert got == plain_words(rows, 3) and len(got) > 15
    assert spelling_variants.variants(words.limit(0)).count() == 0
    assert spelling_variants.counted(spelling_variants.runs(docs.limit(0)).select(F.col("run").alias("word"))).count() == 0


# ------------------------------------------------------------------ queries
@pytest.mark.parametrize("name", ["op11_vector_duplicates", "op12_collocations"])
def test_query_equals_its_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert rows_of(registry.QUERIES[name](spark, sf).toPandas()) == rows_of(duckdb_run(registry.ORACLE[name], sf))


def test_spelling_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    words = plain_words(docs)
    shorter = defaultdict(set)      # only words that share a deletion can be near: keeps the plain search short
    for w in words:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1:]].add(w)
        shorter[w].add(w)
    got = {r.word: tuple(r) for r in registry.QUERIES["op13_spelling_variants"](spark, sf).collect()}
    assert {w: r[3] for w, r in got.items()} == words
    for w in words:
        close = {v for i in range(len(w)) for v in shorter[w[:i] + w[i + 1:]]} | shorter[w]
        others = [v for v in close if v != w and near(v, w)]
        assert got[w][4] == len(others), w
        best = min(others, key=lambda v: (-words[v], v), default=None)
        assert got[w][1] == (best if best and words[best] >= 10 * words[w] else None)

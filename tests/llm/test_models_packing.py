"""Quality classifier, language model, packing, decontamination and the pipeline."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from urlsight.llm import decontaminate, lm_score, packing, quality_model

SF = "/root/testdata/sf0.01"


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_quality_of_held_out_rows(spark):
    import __spark_entry__ as E
    scored = E.queries()["op5_quality_model"](spark, SF)
    rows = scored.join(table(spark, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.held_out for r in rows} == {False, True}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert scored.count() == table(spark, "documents").count()


def test_quality_of_odd_rows(spark, docs_of):
    df = docs_of([(1, "good words here " * 9), (1, "good words here " * 9), (2, "### $$$ " * 9), (3, None), (None, ""), (4, "x" * 2_500_000)], "score label found at")
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (2, 1), (9, 1)], "doc_id long, quality int").withColumn("text", F.lit("clash"))
    model = quality_model.fit(df, labels, "quality", F.lit(True))
    got = quality_model.score(df, model, "__s").collect()
    by_id = {r.doc_id: r["__s"] for r in got}
    assert len(got) == 6 and all(0 <= r["__s"] <= 1 for r in got) and by_id[1] > by_id[2]
    for some in (labels.where("quality = 1"), labels.where("false")):  # one class, or none
        constant = quality_model.fit(df, some, "quality", F.lit(True))
        assert len({r["__s"] for r in quality_model.score(df, constant, "__s").collect()}) == 1
    assert quality_model.score(df.where("false"), model).count() == 0


def test_features_of_a_text_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 71}é" for i in range(900)).encode()
    seen = np.zeros(quality_model.DIMS, bool)
    whole = quality_model.features(text, seen)
    monkeypatch.setattr(quality_model, "PIECE", 100)
    assert (quality_model.features(text, seen) == whole).all() and not seen.any()


def test_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 12) + 40 * (i % 2)).astype(np.int32) for i in range(200)]
    y = np.arange(200) % 2
    weight, bias = quality_model.descend(rows, y, np.ones(100))
    model = quality_model.Model(np.ones(100), weight, bias, 1.0, 0.0)
    assert np.mean([(model.margin(r) > 0) == t for r, t in zip(rows, y)]) > 0.97


def test_descent_reaches_the_least_loss():
    """The weights' loss against that of a plain projected ascent over the dual, from many passes."""
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 30, 6)).astype(np.int32) for _ in range(80)]
    y = np.array([int((r < 12).sum() + rng.integers(0, 3) > 3) for r in rows])
    ratio = rng.normal(size=30)
    x = np.zeros((80, 31))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r]
        x[i] /= np.linalg.norm(x[i]) or 1
    x[:, 30] = 1      # the bias is one more input
    signs = np.where(y > 0, 1.0, -1.0)
    limit = np.array([quality_model.COST * 80 / (2 * (signs == s).sum()) for s in signs])
    loss = lambda w: w @ w / 2 + (limit * np.maximum(0, 1 - signs * (x @ w))).sum()
    gram = (signs[:, None] * x) @ (signs[:, None] * x).T
    alpha, step = np.zeros(80), 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(50_000):
        alpha = np.clip(alpha + step * (1 - gram @ alpha), 0, limit)
    best = loss(x.T @ (alpha * signs))
    weight, bias = quality_model.descend(rows, y, ratio)
    assert loss(np.append(weight[:30], bias)) <= best * 1.02 and best > 0


def plain_tokens(text):
    return [w for w in (text or "").encode().lower().split()] + [lm_score.END]


@pytest.mark.parametrize("head", [200_000, 5])
def test_language_model(spark, docs_of, monkeypatch, head):
    monkeypatch.setattr(lm_score, "HEAD", head)
    rows = [(i, " ".join(f"W{(i * j) % 13}" for j in range(1 + i % 9))) for i in range(80)] + [
        (80, None), (81, ""), (None, "never seen before"), (3, "twice"), (3, "twice"), (82, "one " * 300_000)]
    df = docs_of(rows, "rid token c n tail known")
    train = [t for i, t in rows if i is not None and i % 4]
    monkeypatch.setattr(lm_score, "SINGLES", 4)
    got = lm_score.score(df, F.coalesce(F.col("doc_id") % 4 != 0, F.lit(False))).collect()
    c = Counter(w for t in train for w in plain_tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i or -1, len(plain_tokens(t)), sum(c[w] > 0 for w in plain_tokens(t)), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in plain_tokens(t)), 4)) for i, t in rows))
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm_score.score(df.where("false"), F.lit(True)).count() == 0
    untrained = lm_score.score(df.where("doc_id < 3"), F.lit(False)).collect()
    assert [r.base_score for r in untrained] == [0.0] * len(untrained) and all(r.n_known == 0 for r in untrained)


def small_model():
    texts = [b"a b a c a b", b"b a x y z", b"a a b"] * 40
    counts = Counter(w for t in texts for ws in lm_score.tokens(t) for w in ws)
    top = [w for w, _ in counts.most_common() if w != lm_score.END][:5]      # of six: one stays outside
    head = [lm_score.END, *top]
    model = lm_score.Model(head, np.array([counts[w] for w in head]), sum(counts.values()), len(counts))
    model.start(np.array([0, 1, 0]))      # three single tokens, two shared classes
    return model, counts, texts


def plain_lm(model, counts, text):
    """log10 of the text's probability, token by token from the vectors."""
    def class_of(w):
        return int(model.class_of[model.head.index(w)]) if w in model.head else model.classes - 1

    total, before = 0.0, (model.classes, model.classes)
    for w in plain_tokens(text):
        c = class_of(w)
        match = (model.near[before[0]] + model.far[before[1]]).astype(float) @ model.words.T.astype(float) + model.bias
        total += (match[c] - np.log(np.exp(match).sum())) / math.log(10)
        if c == model.classes - 1:
            inside = sum(n + 1 for v, n in counts.items() if v not in model.head) + 1
        else:
            inside = sum(counts[v] + 1 for v in model.head if class_of(v) == c)
        total += math.log10((counts[w] + 1) / inside)
        before = (c, before[0])
    return total


def test_probabilities_sum_to_one_and_scores_add_up():
    model, counts, texts = small_model()
    before = model.words.copy()
    assert lm_score.train_part(model, iter(texts), 0) == sum(counts.values())
    assert not (model.words == before).all() and model.classes == 6
    near, far, norm = model.tables()
    for a in range(model.classes + 1):
        for b in range(model.classes + 1):
            assert math.isclose(np.exp(near[a] + far[b] - norm[a, b]).sum(), 1, rel_tol=1e-4)
    outside = [w for w in counts if w not in model.head]
    assert len(outside) == 1 and sum(counts[w] + 1 for w in outside) + 1 == model.others
    shares = 10 ** model.log_shares()[:-1]
    for c in range(model.classes - 1):
        assert math.isclose(shares[model.class_of[:-1] == c].sum(), 1)
    # over all next tokens, the outside and one unseen one included, it sums to one
    follow = [plain_lm(model, counts, f"a {w.decode()}") - plain_lm(model, counts, "a") for w in counts if w != lm_score.END]
    assert len(follow) == len(counts) - 1 and sum(10.0 ** x for x in follow) < 1.2


def test_scores_equal_a_plain_reference(spark, docs_of, monkeypatch):
    """The shipped path, model and all, against scores computed token by token."""
    monkeypatch.setattr(lm_score, "SINGLES", 4)
    monkeypatch.setattr(lm_score, "HEAD", 8)
    made = []
    monkeypatch.setattr(lm_score, "fit", lambda *a, fit=lm_score.fit: made.append(fit(*a)) or made[0])
    rows = [(i, " ".join(f"w{(i * j) % 13}" for j in range(1 + i % 9))) for i in range(60)] + [(60, None), (61, "new words here w1"), (62, "w1 " * 70_000)]
    got = {r.doc_id: r.score for r in lm_score.score(docs_of(rows), F.col("doc_id") < 50).collect()}
    model, counts = made[0][0], Counter({bytes(r.token): r.c for r in made[0][1].collect()})
    assert len(model.head) <= 8 < len(counts)
    for i, t in rows[:62]:
        assert got[i] == pytest.approx(plain_lm(model, counts, t), rel=1e-5)


def test_scores_do_not_hang_on_partitions(spark, docs_of, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 500)      # several logical shards
    df = docs_of([(i, " ".join(f"w{(i * j) % 11}" for j in range(40))) for i in range(90)])
    one, many = ({r.doc_id: r.score for r in lm_score.score(df.repartition(n), F.col("doc_id") % 7 != 2).collect()} for n in (1, 6))
    assert one == pytest.approx(many, abs=1e-3)


def test_the_shipped_model_gains_on_held_out_documents(spark):
    """At least 0.1 a token (log10) over the counts of words, on documents that it has not seen."""
    import __spark_entry__ as E
    r = E.queries()["op9_lm_score"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] / r[2] > r[1] / r[2] + 0.1


def test_frequent_tokens(spark):
    counts = spark.createDataFrame([(f"t{i}".encode(), 1 + 1000 // (i + 1)) for i in range(500)], "token binary, c long").cache()
    for most in (0, 1, 7, 499, 500, 9999):
        got = [r.c for r in lm_score.frequent(counts, most).collect()]
        assert len(got) <= most and sorted(got) == sorted([r.c for r in counts.collect()])[500 - len(got):]
    assert lm_score.frequent(counts, 500).count() == 500 and lm_score.frequent(counts, 7).count() > 3


def test_training_beats_the_unigram(spark, docs_of):
    # the next word follows from the last
    df = docs_of([(i, " ".join(f"w{(i + j) % 7}" for j in range(60))) for i in range(400)])
    rows = lm_score.score(df, F.col("doc_id") % 5 != 0).where("doc_id % 5 = 0").collect()
    assert sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows)


def plain_best_fit(sizes, sources, clusters, capacity, per_source):
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [(capacity - b["used"], i) for i, b in enumerate(bins) if b["used"] + size <= capacity and (c is None or c not in b["c"])
                and (s is None or b["s"].count(s) < per_source)]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"used": 0, "s": [], "c": []})
        out.append((i, bins[i]["used"]))
        bins[i]["used"] += size
        bins[i]["s"].append(s)
        bins[i]["c"].append(c)
    return out


def test_best_fit_against_a_search_of_all_bins():
    rng = np.random.default_rng(3)
    for per_source in (1, 2, 3):
        sizes = sorted(rng.integers(1, 99, 400).tolist(), reverse=True)
        sources = [None if x > 7 else f"s{max(0, x - 2)}" for x in rng.integers(0, 9, 400)]
        clusters = [None if x > 60 else int(x) for x in rng.integers(0, 80, 400)]
        assert packing.best_fit(sizes, sources, clusters, 100, per_source) == plain_best_fit(sizes, sources, clusters, 100, per_source)


def test_packing(spark, docs_of):
    rows = [(i, " ".join(f"w{i}-{j}" for j in range(1 + i * 37 % 90))) for i in range(300)] + [
        (None, "same words here"), (7, "Same  words HERE"), (7, "same words\nhere"), (500, None), (501, " \n "), (502, "long " * 100_000)]
    df = docs_of(rows, "n_words cluster group place bin").withColumn("source", F.when(F.col("doc_id") % 3 != 0, "hot"))
    packed = packing.pack(df, 64, 2, 50).collect()
    words = Counter((i, len((t or "").split())) for i, t in rows)
    whole = Counter()
    for r in packed:
        whole[r.doc_id] += r.n_words
    assert whole == Counter({i: sum(n * k for (j, n), k in words.items() if j == i) for i, _ in rows})
    bins = {}
    for r in packed:
        assert (r.bin is None) == (r.n_words == 0)
        if r.bin:
            bins.setdefault(r.bin, []).append(r)
    same = {None, 7}
    for inside in bins.values():
        inside.sort(key=lambda r: r.bin_offset)
        assert sum(r.n_words for r in inside) <= 64
        assert [r.bin_offset for r in inside] == [sum(x.n_words for x in inside[:i]) for i in range(len(inside))]
        assert sum(r.source == "hot" for r in inside) <= 2
        assert sum(r.n_words == 3 and r.doc_id in same for r in inside) <= 1 or all(r.doc_id == 7 and r.piece for r in inside)
    assert packing.pack(df.where("false")).count() == 0
    assert packing.pack(df.drop("source")).where("bin IS NOT NULL").count() > 0


def test_near_copies_share_no_bin(spark, tmp_path, docs_of):
    import __spark_entry__ as E
    words = [f"w{k * k % 977}" for k in range(400)]
    near = [" ".join(words[:i] + ["changed"] + words[i + 1:]) for i in (50, 150, 250, 350)] + [" ".join(words), " ".join(words).upper() + " É", " ".join(words) + " é"]
    rows = [(7, t) for t in near[:3]] + [(None, near[3]), (8, near[4]), (9, near[5]), (10, near[6]), (11, "all else " * 9), (12, None), (12, " ")]
    df = docs_of(rows).withColumn("source", F.monotonically_increasing_id().cast("string"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    packed = E.queries()["op7_packing"](spark, str(tmp_path)).collect()
    bins = [r.bin for r in packed if r.n_words > 100]
    assert len(bins) == len(set(bins)) == 7 and sum(r.bin is None for r in packed) == 2 and len(packed) == 10
    with pytest.raises(ValueError):
        packing.pack(df, cluster=F.col("doc_id"), shingle=3)


def plain_tiles(item, text, least):
    item, text, total = list(item), list(text), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while p + n < len(item) and t + n < len(text) and item[p + n] is not None and item[p + n] == text[t + n]:
                    n += 1
                best = max(best, (n, -p, -t))
        n, p, t = best[0], -best[1], -best[2]
        if n < least:
            return total
        total += n
        item[p:p + n] = [None] * n
        text[t:t + n] = [object()] * n


def test_tiles_against_a_plain_search():
    rng = np.random.default_rng(4)
    for k in range(60):
        item = rng.integers(0, 30 if k % 2 else 3, 40)
        parts = [item[a:a + n] for a, n in zip(rng.integers(0, 35, 5), rng.integers(3, 20, 5))]
        text = np.concatenate([rng.integers(0, 3, 5), *parts, rng.integers(0, 30, 5)])
        covered, tiles = decontaminate.tile(item, text, 5)
        plain = plain_tiles(item.tolist(), text.tolist(), 5)
        assert covered == sum(tiles) and min(tiles, default=5) >= 5
        # equal but for the choice between runs of one length
        assert covered == plain if k % 2 else abs(covered - plain) <= 10


def contaminated(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(40))
    w = item.split()
    bench = spark.createDataFrame([(1, item), (2, "a short one"), (3, None), (4, " ".join(f"v{i}" for i in range(10))), (None, item), (5, "")],
                                  "item_id long, text string").withColumn("seeds", F.lit("clash"))
    rows = [(1, "before " + item.upper() + ", after"), (2, " ".join(w[20:] + ["and"] + w[:20])), (3, " ".join(w[:31])), (4, " ".join(w[:33])),
            (5, " ".join(w[:6] * 30)), (6, None), (7, ""), (8, "a short one"), (None, item), (9, item), (9, item),
            (10, "x " * 50_000 + item + " y" * 50_000 + " " + " ".join(f"v{i}" for i in range(10))), (11, " ".join(reversed(w)))]
    return docs_of(rows, "item_id coverage text_key __x"), bench


@pytest.mark.parametrize("sent", [decontaminate.MAX_SENT_BYTES, 0])
def test_leaks(spark, docs_of, monkeypatch, sent):
    monkeypatch.setattr(decontaminate, "MAX_SENT_BYTES", sent)
    df, bench = contaminated(spark, docs_of)
    got = sorted((r.doc_id or 0, r.item_id, r.covered_words, r.tiles) for r in decontaminate.find(df, bench).collect())
    assert got == [(0, 1, 40, 1), (1, 1, 40, 1), (2, 1, 40, 2), (4, 1, 33, 1), (8, 2, 3, 1), (9, 1, 40, 1), (9, 1, 40, 1), (10, 1, 40, 1), (10, 4, 10, 1)]
    left = decontaminate.clean(df, bench)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [3, 5, 6, 7, 11]
    assert decontaminate.find(df.where("false"), bench).count() == 0
    assert decontaminate.find(df, bench.where("false")).count() == 0
    assert decontaminate.clean(df, bench.where("false")).count() == df.count()


@pytest.mark.parametrize("sent", [decontaminate.MAX_SENT_BYTES, 0])
def test_items_of_one_id_and_short_items(spark, docs_of, monkeypatch, sent):
    """Items are judged each, whatever their ids; items shorter than a seed are found where they stand whole."""
    monkeypatch.setattr(decontaminate, "MAX_SENT_BYTES", sent)
    long, short = [f"w{i}" for i in range(40)], "s1 s2 s3 s4 s5 s6"
    items = [(7, " ".join(long)), (7, short), (8, "t1 t2 t3"), (9, "solo"), (9, "solo"), (10, " . ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_of([(1, f"x {short} y " + " ".join(long[:10])), (2, "t1 T2, t3"), (3, "t1 t2 x t3 t2"), (4, "a Solo b solo"), (5, "solos"), (6, " ".join(long[3:]))])
    got = sorted((r.doc_id, r.item_id, r.item_words, r.covered_words) for r in decontaminate.find(df, bench).collect())
    assert got == [(1, 7, 6, 6), (2, 8, 3, 3), (4, 9, 1, 1), (4, 9, 1, 1), (6, 7, 40, 37)]
    assert sorted(r.doc_id for r in decontaminate.clean(df, bench).collect()) == [3, 5]


def test_stages_keep_columns_of_any_name(spark, docs_of):
    import corpus_pipeline as P
    names = "__m __bits __leaks __key __fp __root __score row score text_key root fp"
    good = " ".join(f"word{i}" for i in range(80))
    df = docs_of([(1, good), (1, "other " + good), (2, good), (None, good + " end")], names)
    for sent in (decontaminate.MAX_SENT_BYTES, 0):
        decontaminate.MAX_SENT_BYTES, before = sent, decontaminate.MAX_SENT_BYTES
        try:
            for _, run in P.STAGES[:4]:
                out = run(spark, df, "/root/testdata/sf0.001")
                assert out.columns == df.columns
                assert all(r[n] == "clash" for r in out.collect() for n in names.split())
        finally:
            decontaminate.MAX_SENT_BYTES = before


def plain_leaks(items, texts, least=5, coverage=0.8):
    """Every item against every text by the plain tiling."""
    import re
    words = lambda t: re.findall("[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = set()
    for i, item in items.items():
        a, number = words(item), {}
        x = [number.setdefault(w, len(number)) for w in a]
        for d, text in texts.items():
            y = [number.get(w, -1 - k) for k, w in enumerate(words(text))]
            if sum(v >= 0 for v in y) >= coverage * len(x) and plain_tiles(x, y, min(least, len(x))) >= coverage * len(x) - 1e-9:
                out.add((d, i))
    return out


def test_registered_leaks_are_those_of_a_plain_search(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    items = {r.item_id: r.text for r in table(spark, "benchmark", sf).collect()}
    texts = {r.doc_id: r.text for r in table(spark, "documents", sf).collect() if len(r.text) < 20_000}
    got = {(r.doc_id, r.item_id) for r in E.queries()["op10_decontaminate"](spark, sf).collect() if r.doc_id in texts}
    assert got == plain_leaks(items, texts)


def test_registered_leaks_against_all_pairs(spark):
    import re
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    words = lambda t: re.findall("[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    items = {r.item_id: " ".join(words(r.text)) for r in table(spark, "benchmark", sf).collect()}
    want = {(r.doc_id, i) for r in table(spark, "documents", sf).collect() for i, t in items.items() if t in " ".join(words(r.text))}
    got = {(r.doc_id, r.item_id) for r in E.queries()["op10_decontaminate"](spark, sf).collect()}
    assert want and want <= got


def test_pipeline_against_plain_stages(spark):
    import corpus_pipeline as P
    from urlsight.llm import quality_rules, registry
    from .test_simhash import plain_fingerprint, smallest_reachable
    sf = "/root/testdata/sf0.001"
    docs = table(spark, "documents", sf)
    texts = {r.doc_id: r.text for r in docs.collect()}
    measured = {i: dict(zip(quality_rules.MEASURES, quality_rules.measure(t.encode()))) for i, t in texts.items()}
    # the rules, said in Python
    fails = lambda m: (m["n_words"] < 50 or m["n_repeat_words"] > 0.5 * m["n_words"] or m["n_symbols"] > 0.2 * m["n_words"]
                       or m["n_dup_lines"] > 0.5 * m["n_lines"] or m["n_upper_words"] > 0.5 * m["n_words"]
                       or not 2 <= m["word_chars"] / m["n_words"] <= 15)
    left = {i for i, m in measured.items() if not fails(m)}
    model = registry.quality_classifier(spark, sf)
    seen = np.zeros(quality_model.DIMS, bool)
    left = sorted(i for i in left if model.score(quality_model.features(texts[i].encode(), seen)) >= 0.5)
    named = smallest_reachable(left, [plain_fingerprint(texts[i], 3) for i in left])
    left = sorted(set(named.values()))
    items = decontaminate.Benchmark([(r.item_id, r.text.encode()) for r in table(spark, "benchmark", sf).collect()], 5, 0.8)
    left = [i for i in left if not items.leaks(texts[i].encode())]
    for _, stage in P.STAGES[:4]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = P.run(spark, sf).groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {i: len(texts[i].encode().split()) for i in left}


@pytest.mark.parametrize("rows", [[], [(None, None), (1, None), (1, ""), (2, "x")]])
def test_pipeline_stages_of_odd_rows(spark, docs_of, rows):
    import corpus_pipeline as P
    df = docs_of(rows or ["x"], "label score root __y")
    df = df if rows else df.where("false")
    for name, stage in P.STAGES:
        out = stage(spark, df, "/root/testdata/sf0.001")
        assert out.count() <= df.count()
        if stage is not P.STAGES[-1][1]:
            assert out.columns == df.columns

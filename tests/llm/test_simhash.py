"""SimHash links against all pairs, fingerprints against a plain version."""
import random

import numpy as np
import pytest
import xxhash

from urlsight.llm import common, simhash


def plain_fingerprint(text, k):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def smallest_reachable(ids, fps, distance=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= distance:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(i)
    return {i: min((ids[j] for j in g if ids[j] is not None), default=None) for g in groups.values() for i in g}


@pytest.mark.parametrize("text", ["", "  \n\t ", "one", "One TWO", "a b c", "É é Ä b c d e f g", "x " * 50, "a b c d " * 9 + "\x0b\x0c\r q"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode(), 3) == plain_fingerprint(text, 3)


def test_fingerprint_of_a_text_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    monkeypatch.setattr(simhash, "word_lists", lambda t: common.word_lists(t, 64))
    assert simhash.fingerprint(text.encode(), 3) == plain_fingerprint(text, 3)
    assert simhash.fingerprint(None, 3) == 0


@pytest.mark.parametrize("hot", [512, 1])
def test_links_equal_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_HALF", hot)       # 1: every shared half is split
    rng = random.Random(5)
    fps = []
    for _ in range(60):
        fp = rng.getrandbits(64)
        fps.append(fp)
        for _ in range(rng.randrange(6)):  # chains of copies, one to five bits on
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                fp ^= 1 << b
            fps.append(fp)
    base = rng.getrandbits(64)  # a dense group: eight loose bits
    fps += [base ^ sum(1 << (7 * i) for i in range(8) if m >> i & 1) for m in range(0, 256, 3)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps} | {0, -1, 7, -(1 << 63)})
    ids = list(range(len(fps)))
    rng.shuffle(ids)
    found = simhash.canonical(spark.createDataFrame(list(zip(fps, ids)), "fp long, first_doc long")).collect()
    expected = smallest_reachable(ids, fps)
    assert len(found) == len(fps)
    assert {r.fp: r.component_id for r in found} == {fp: expected[i] for i, fp in enumerate(fps)}


def test_one_half_shared_by_many(spark):
    """Pairs three bits apart among 3,000 fingerprints of one half: more than ``HOT_HALF``."""
    rng = random.Random(6)
    half, fps = rng.getrandbits(32), set()
    for _ in range(1000):
        rest = rng.getrandbits(32)
        fps |= {half << 32 | rest, half << 32 | rest ^ sum(1 << b for b in rng.sample(range(32), 3)), half << 32 | rest ^ sum(1 << b for b in rng.sample(range(32), 4))}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    got = {r.fp: r.component_id for r in simhash.canonical(spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, first_doc long")).collect()}
    x = np.array(fps, np.int64).view(np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1:] ^ x[i]) <= 3) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    assert got == {f: find(i) for i, f in enumerate(fps)}
    assert len(set(got.values())) < len(fps) - 900


def test_exploded_halves_are_not_broadcast(spark):
    """Both sides are exploded from a small file: by its size Spark would send them through the driver."""
    rng = random.Random(7)
    fps = sorted({rng.getrandbits(63) for _ in range(300)})
    clustered = common.stage(spark.createDataFrame([(f, f) for f in fps] + [(fps[0] ^ 7, fps[0] ^ 7)], "fp long, cluster long"))
    links = simhash.half_links(clustered)
    assert [(r.a, r.b) for r in links.collect()] == [tuple(sorted((fps[0], fps[0] ^ 7)))]
    joins = [x for x in links._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and "slot#" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)


def test_components_of_odd_rows(docs_of):
    words = " ".join(f"w{i}" for i in range(400))
    rows = [(5, words), (3, words), (3, words), (9, words.replace("w17 ", "v17 ")), (7, None), (8, ""), (2, " \n"),
            (None, words), (None, "alone here and nowhere else"), (11, "Some OTHER text of its own"), (12, "x " * 200_000)]
    got = simhash.components(docs_of(rows, "fp root component_id first_doc"), 3).collect()
    fps = [plain_fingerprint(t, 3) for _, t in rows]
    expected = smallest_reachable([i for i, _ in rows], fps)
    want = sorted(((rows[i][0], fps[i], expected[i]) for i in range(len(rows))), key=repr)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got), key=repr) == want


def test_representatives(docs_of):
    words = " ".join(f"w{i}" for i in range(400))
    rows = [(5, words), (3, words), (3, words), (7, None), (2, ""), (4, "one"), (4, "quite another text"), (None, "no id")]
    df = docs_of(rows, "copies __x")
    got = simhash.representatives(df, 3)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.doc_id is not None) == [
        (2, ""), (3, words), (4, "one"), (4, "quite another text")]
    assert [r.text for r in got.collect() if r.doc_id is None] == ["no id"]


def test_empty_table(docs_of):
    assert simhash.components(docs_of([]).where("false"), 3).count() == 0
    assert simhash.representatives(docs_of([("x")]).where("false"), 3).count() == 0


def test_whole_table_against_all_pairs(spark):
    import __spark_entry__ as E
    rows = E.queries()["op1_simhash"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    fps = [plain_fingerprint(texts[r.doc_id], 3) for r in rows]
    assert [r.fingerprint for r in rows] == [f"{f & (2**64 - 1):016x}" for f in fps]
    expected = smallest_reachable([r.doc_id for r in rows], fps)
    assert [r.component_id for r in rows] == [expected[i] for i in range(len(rows))]

"""Rule ledger and ring sharding."""
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from urlsight.llm import quality_rules, sharding


def plain_repeats(words):
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    return len({p for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)})


@pytest.mark.parametrize("text", ["", "a", "a b c", "a a a a", "a b c d a b c", "x y " * 40, "a b c a b d a b c", "q " * 3])
def test_repeated_words(text):
    assert quality_rules.repeated_words(text.encode().split()) == plain_repeats(text.split())


def test_ledger_of_odd_rows(docs_of):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, good), (3, good), (None, good), (4, good + " ###" * 20), (5, (good + "\n") * 5), (6, good.upper()),
            (7, "é# \n é# \n\nx"), (8, "z " * 100_000)]
    got = {(r.doc_id, r.n_words): r for r in quality_rules.ledger(docs_of(rows, "fail_bits n_words __m")).collect()}
    assert got[1, 0].fail_bits == got[2, 0].fail_bits == quality_rules.bits("too_few_words")
    assert got[3, 60].fail_bits == got[None, 60].fail_bits == 0
    assert got[4, 80].fail_bits == quality_rules.bits("symbol_heavy")
    assert got[5, 300].fail_bits == quality_rules.bits("repeated_windows", "repeated_lines")
    assert got[6, 60].fail_bits == quality_rules.bits("shouting")
    # "é# " and " é# " differ; the empty line has no word
    assert (got[7, 3].word_chars, got[7, 3].n_symbols, got[7, 3].n_dup_lines, got[7, 3].n_lines) == (5, 2, 0, 3)
    assert got[8, 100_000].n_repeat_words == 100_000
    kept = quality_rules.keep(docs_of(rows, "__x"), "v1")
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 3]
    assert kept.columns == docs_of(rows, "__x").columns


def test_policies_and_ablations(spark, docs_of):
    good = " ".join(f"word{i}" for i in range(60))
    ledger = quality_rules.ledger(docs_of(["", good, good + " ###" * 20, "# " * 30, good.upper() + " ###" * 20]))
    rows = {r.rule: r for r in quality_rules.ablations(ledger, "v1").collect()}
    bits = [r.fail_bits for r in ledger.collect()]
    for rule in quality_rules.RULES:
        bit = quality_rules.bits(rule.name)
        assert rows[rule.name].n_failed == sum(b & bit > 0 for b in bits)
        assert rows[rule.name].n_failed_only == sum(b == bit for b in bits)
        assert rows[rule.name].n_kept_without == sum(b & ~bit == 0 for b in bits)
    assert ledger.where(quality_rules.passes("base")).count() == 3
    assert quality_rules.ablations(ledger.where("false"), "v1").count() == 0
    assert quality_rules.ledger(docs_of(["x"]).where("false")).count() == 0


def check_shards(rows, placed, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in placed) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    counts = Counter(r.shard for r in placed)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    for s in range(shards):
        assert sorted(r.slot for r in placed if r.shard == s) == list(range(counts[s]))


@pytest.mark.parametrize("rows", [
    [], [(1, "only one")], [(i, f"text {i}") for i in range(1000)],
    [(i, "the same text" if i % 3 else f"text {i}") for i in range(900)],
    [(None, None), (None, None), (7, ""), (7, ""), (7, "é" * 70_000)] + [(3, "x")] * 50])
def test_sharding(docs_of, monkeypatch, rows):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 10)
    df = docs_of([*rows, (0, "x")], "arc shard slot bucket rank").where(F.lit(bool(rows)) & (F.lit(not rows) | (F.col("text").isNull() | (F.col("text") != "\0"))))
    placed = sharding.assign(df, 16).collect()
    check_shards([*rows, (0, "x")] if rows else [], placed, 16)


def plain_ring(rows, shards, buckets):
    """Every row walked clockwise from its point of the ring, in rounds: shard by shard, arc by arc, rank by rank."""
    import struct

    import xxhash

    def mixed(*values):      # Spark's hash of columns: nulls leave it as it is
        h = 42
        for v in values:
            if v is not None:
                b = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
                h = xxhash.xxh64_intdigest(b, seed=h)
        return h - (1 << 64) if h >> 63 else h

    nodes = {}
    for shard in range(shards):
        for replica in range(sharding.VIRTUAL_NODES):
            cell = mixed((shard,), replica) % sharding.CELLS
            nodes[cell] = min(shard, nodes.get(cell, shard))
    cells = sorted(nodes)
    waiting = {c: [] for c in cells}
    for i, t in rows:
        cell = mixed(t or "") % sharding.CELLS
        mix = mixed(i, "order within an arc")
        own = next((c for c in cells if c >= cell), cells[0])
        waiting[own].append((mix % buckets, mix, -1 if i is None else i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1))
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    taken, found = [0] * shards, []
    ways = {c: list(dict.fromkeys([nodes[x] for x in cells[k:] + cells[:k]] + list(range(shards)))) for k, c in enumerate(cells)}
    for step in range(shards):
        for k, c in enumerate(cells):
            shard, left = ways[c][step], []
            for row in sorted(waiting[c]):
                if taken[shard] < room[shard]:
                    found.append((row[2], row[4], row[3], shard, taken[shard]))
                    taken[shard] += 1
                else:
                    left.append(row)
            waiting[c] = left
    return sorted(found)


@pytest.mark.parametrize("shards", [3, 16, 40])
def test_sharding_equals_a_ring_walked_row_by_row(docs_of, monkeypatch, shards):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 25)
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i // 2}") for i in range(700)] + [(900, None), (901, ""), (None, "no id"), (902, "é" * 9)]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in sharding.assign(docs_of(rows), shards).collect())
    assert got == plain_ring(rows, shards, max(16, -(-len(rows) // 25)))


def test_sharding_query_equals_the_ring(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in E.queries()["op4_sharding"](spark, sf).collect())
    assert got == plain_ring(rows, 16, 16)


def test_overflow_moves_on_clockwise():
    arcs = [{"arc": i, "cell": i, "shard": s} for i, s in enumerate([0, 1, 2, 1])]
    pieces = sharding.deal(arcs, {0: 10, 1: 0, 2: 1, 3: 1}, [4, 4, 4])
    assert [(p["arc"], p["start"], p["until"], p["shard"], p["base"]) for p in pieces] == [
        (0, 0, 4, 0, 0), (2, 0, 1, 2, 0), (3, 0, 1, 1, 0), (0, 4, 7, 1, 1), (0, 7, 10, 2, 1)]


def test_copies_stay_together_and_few_rows_move(docs_of):
    df = docs_of([(i, f"text {i // 4}") for i in range(4000)]).cache()
    a, b = sharding.assign(df, 16), sharding.assign(df, 17)
    spread = a.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).where("n = 1").count()
    assert spread > 800  # of 1,000 texts
    moved = a.select("doc_id", F.col("shard").alias("before")).join(b, "doc_id").where("shard <> before").count()
    assert moved < 0.4 * 4000  # a modulo would move 94 %


def test_shards_without_an_arc_get_their_quota():
    arcs = [{"arc": i, "cell": i, "shard": s} for i, s in enumerate((0, 2, 0))]
    pieces = sharding.deal(arcs, {0: 5, 2: 6}, [3, 3, 3, 2])
    assert [sum(p["until"] - p["start"] for p in pieces if p["shard"] == s) for s in range(4)] == [3, 3, 3, 2]
    assert [sum(p["until"] - p["start"] for p in pieces if p["arc"] == a) for a in range(3)] == [5, 0, 6]

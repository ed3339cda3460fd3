"""SimHash near-duplicates: meet-in-the-middle ball hashing over 64-bit fingerprints.

Two fingerprints at most ``d`` bits apart meet in the middle: some point lies
within half of ``d`` of both. With ``d = 3``:

* distance 1 and 2: every distinct fingerprint emits all 65 points within one
  bit. Fingerprints that meet at a point are at most two bits apart, so a
  point links all of them to the smallest one: no pairs are listed, and at most
  65 distinct fingerprints can meet at a point.
* distance 3: no point is within one bit of both. The pair's differing bits
  fall on two 32-bit halves, and one half has at most one of them. Each
  fingerprint emits its two halves, and all variants of a half within one bit;
  collisions are deduplicated and verified on the whole 64 bits. Halves one bit
  apart have different parity, so only those of odd parity emit neighbours.

  Halves that many fingerprints share are split: of five slices of the other half
  two at least are equal, so pairs meet on the half and one of the ten pairs of slices.

The plain form of the second step (radius two on one side, one on the other)
emits 2,081 points a fingerprint; the halves need 34 at most.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, checked_broadcast, stage, with_columns_checked, word_lists
from .components import connected_components

MAX_DISTANCE = 3
HOT_HALF = 512      # fingerprints that share a half before it is split
SLICES = [(0, 6), (6, 6), (12, 6), (18, 7), (25, 7)]      # first bit and width, in a half


def measured(text: bytes | None, shingle: int) -> tuple[int, int]:
    """SimHash of one text as a signed 64-bit number (no words: 0), and its words."""
    from functools import partial

    import xxhash

    digest = partial(xxhash.xxh64_intdigest, seed=42)
    counts, total, carry, n_words = np.zeros(64, np.int64), 0, [], 0
    for words in word_lists((text or b"").lower()):
        n_words += len(words)
        words = carry + words
        n = len(words) - shingle + 1
        if n > 0:
            grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            hashes = np.fromiter(map(digest, grams), np.uint64, n)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            total += n
        carry = words[max(0, n):]
    if not total:
        if not carry:
            return 0, 0
        value = digest(b" ".join(carry))
    else:
        value = int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")
    return (value - (1 << 64) if value >> 63 else value), n_words


def fingerprint(text: bytes | None, shingle: int) -> int:
    return measured(text, shingle)[0]


def fingerprint_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return run(text.cast("binary"))


def measured_column(text: Column, shingle: int) -> Column:
    """``struct<fp, n_words>`` of a text."""
    @F.pandas_udf("fp long, n_words long")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measured(x, shingle) for x in texts], columns=["fp", "n_words"], dtype="int64")

    return run(text.cast("binary"))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` for every row; a null text counts as one without words."""
    bounded_batches(docs.sparkSession)
    slim = with_columns_checked(docs, "doc_id", "text")
    return slim.select(F.col("doc_id").cast("long"), fingerprint_column(F.col("text"), shingle).alias("fp"))


def _flipped(value: Column, bits: int) -> Column:
    """The value and all its variants with one of the lowest ``bits`` bits changed."""
    masks = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(bits)])
    return F.transform(masks, lambda m: value.bitwiseXOR(m))


def ball_links(fps: DataFrame) -> DataFrame:
    """Edges that connect all fingerprints at most two bits apart; ``fps`` has distinct ``fp``."""
    points = fps.select("fp", F.explode(_flipped(F.col("fp"), 64)).alias("point"))
    met = points.groupBy("point").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    return (met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b").distinct())


def _slots(half: Column) -> Column:
    """A number for each pair of slices of a half, with the values of both."""
    cut = [F.shiftrightunsigned(half, at).bitwiseAND(F.lit((1 << width) - 1).cast("long")) for at, width in SLICES]
    pairs = combinations(range(len(SLICES)), 2)
    return F.array(*[F.lit(k << 14).cast("long") + cut[a] * (1 << SLICES[b][1]) + cut[b] for k, (a, b) in enumerate(pairs)])


def half_links(clustered: DataFrame) -> DataFrame:
    """Cluster pairs with members exactly three bits apart; ``clustered`` is ``(fp, cluster)``."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    high = F.shiftrightunsigned("fp", 32)
    halves = clustered.select("fp", "cluster", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), low.alias("half"), high.alias("rest")),
        F.struct(F.lit(1).alias("side"), high.alias("half"), low.alias("rest")))).alias("h")).select("fp", "cluster", "h.*")
    hot = checked_broadcast(halves.groupBy("side", "half").agg(F.count("*").alias("n")).where(F.col("n") > HOT_HALF)
                            .select("side", "half", F.lit(True).alias("hot")))

    def met_on(df: DataFrame) -> DataFrame:
        """With one row for each place where a pair may meet: the half, or the half and two slices of the rest."""
        slots = F.when(F.col("hot"), _slots(F.col("rest"))).otherwise(F.array(F.lit(-1).cast("long")))
        return df.join(hot, ["side", "half"], "left").select("side", "half", "fp", "cluster", F.explode(slots).alias("slot"))

    odd = F.bit_count("half") % 2 == 1
    around = F.when(odd, _flipped(F.col("half"), 32)).otherwise(F.array("half"))
    centres = met_on(halves).withColumnsRenamed({"fp": "fp1", "cluster": "c1"})
    probes = met_on(halves.select("side", "rest", F.explode(around).alias("half"), "fp", "cluster")).withColumnsRenamed({"fp": "fp2", "cluster": "c2"})
    apart = F.bit_count(F.col("fp1").bitwiseXOR(F.col("fp2")))
    # Spark sizes both sides by the file they are exploded from, many times too low: neither may be broadcast
    met = centres.join(probes.hint("merge"), ["side", "half", "slot"]).where((F.col("c1") != F.col("c2")) & (apart <= MAX_DISTANCE))
    return met.select(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b")).distinct()


def canonical(fps: DataFrame) -> DataFrame:
    """Distinct ``(fp, first_doc)`` -> ``(fp, root, component_id)``."""
    near = connected_components(ball_links(fps))
    clustered = stage(fps.join(near.withColumnRenamed("node", "fp"), "fp", "left")
                      .select("fp", "first_doc", F.coalesce("root", "fp").alias("cluster")))
    merged = connected_components(half_links(clustered)).withColumnRenamed("node", "cluster")
    rooted = stage(clustered.join(merged, "cluster", "left")
                   .select("fp", "first_doc", F.coalesce("root", "cluster").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return stage(rooted.join(least, "root").select("fp", "root", "component_id"))


def components(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp, root, component_id)``: one row for each row of ``docs`` (any columns besides).

    Rows whose fingerprints differ in at most three bits are linked;
    ``component_id`` is the smallest ``doc_id`` reachable and ``root`` the
    smallest fingerprint. Equal texts meet in one fingerprint before any
    variant is emitted, so a group of copies costs one fingerprint. Null or
    wordless texts have fingerprint 0 and are linked like others. A row without
    ``doc_id`` takes part, but never names a component (null only if no member
    has an id). Repeated rows stay repeated; an empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, shingle))
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")))
    return rows.join(canonical(fps), "fp").select("doc_id", "fp", "root", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def representatives(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the one that names it.

    If several rows of a component carry that ``doc_id``, one of them stays.
    Rows without ``doc_id`` all stay: nothing tells them apart.
    """
    found = stage(components(docs, shingle).where("doc_id = component_id"))
    ids = stage(found.groupBy("doc_id").agg(F.count("*").alias("copies")))
    # ids are joined to the texts, so that no text moves while they are few enough to be sent
    out = docs.join(checked_broadcast(ids.where("copies = 1").select("doc_id")), "doc_id", "left_semi")
    if ids.where("copies > 1").limit(1).count():
        # an id that stands on several rows, perhaps in several components
        again = docs.join(checked_broadcast(ids.where("copies > 1").select("doc_id")), "doc_id", "left_semi").select(
            "doc_id", F.struct(*docs.columns).alias("row"), fingerprint_column(F.col("text"), shingle).alias("fp"))
        roots = found.select("fp", "root").distinct()
        out = out.select(*docs.columns).unionByName(again.join(roots, "fp").dropDuplicates(["doc_id", "root"]).select("row.*"))
    if docs.where("doc_id IS NULL").limit(1).count():
        out = out.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
    return out.select(*docs.columns)

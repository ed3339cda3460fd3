"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger keeps the
measurements and one bit for each failed rule. A policy is a version with a mask
of the rules it enforces, so a new policy or an ablation reads the ledger and
never the texts.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, with_columns_checked

SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words"]


class Rule(NamedTuple):
    name: str
    fails: str  # SQL condition on the measurements


# The position of a rule is its bit; new rules are only appended.
RULES = [
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbol_heavy", "5 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("shouting", "2 * n_upper_words > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
]
BASE = ("too_few_words", "repeated_windows")
# Policy versions: the rules that each enforces.
POLICIES = {"base": BASE, "v1": tuple(r.name for r in RULES)}


def repeated_words(words: list[bytes]) -> int:
    """How many words stand in a 3-word window that the text has at least twice."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    first = ids[:-2] * len(known) + ids[1:-1]
    if len(known) > 2_000_000:  # three ids no longer fit into 63 bits
        first = np.unique(first, return_inverse=True)[1]
    windows = first * len(known) + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(windows, twice)
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= hit
    return int(covered.sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``."""
    text = text or b""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(b"".join(words).decode("utf-8", "replace")),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
            repeated_words(words), sum(map(bytes.isupper, words)))


def bits(*names: str) -> int:
    order = [r.name for r in RULES]
    return sum(1 << order.index(n) for n in set(names))


def passes(policy: str) -> Column:
    """Whether a ledger row passes a policy version."""
    return F.col("fail_bits").bitwiseAND(F.lit(bits(*POLICIES[policy])).cast("long")) == 0


def _measured(docs: DataFrame) -> DataFrame:
    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=MEASURES, dtype="int64")

    bounded_batches(docs.sparkSession)
    return docs.withColumn("__m", run(F.col("text").cast("binary")))


def fail_bits(prefix: str = "") -> Column:
    total = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        condition = rule.fails
        if prefix:
            for m in MEASURES:
                condition = condition.replace(m, f"{prefix}.{m}")
        total = total + F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return total


def ledger(docs: DataFrame) -> DataFrame:
    """``(doc_id, <measurements>, fail_bits)``, one row for each row of ``docs``.

    A null text has no words; repeated rows stay repeated; other columns of
    ``docs`` are not read. An empty table gives an empty ledger.
    """
    found = _measured(with_columns_checked(docs, "doc_id", "text")).select("doc_id", "__m.*")
    return found.withColumn("fail_bits", fail_bits())


def keep(docs: DataFrame, policy: str) -> DataFrame:
    """The rows of ``docs`` that pass a policy, with their columns."""
    rows = docs.select(F.struct("*").alias("row"), "text")      # whatever the columns are called
    wanted = F.lit(bits(*POLICIES[policy])).cast("long")
    return _measured(rows).where(fail_bits("__m").bitwiseAND(wanted) == 0).select("row.*")


def ablations(ledger_rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail only it, and that the policy keeps without it.

    The ledger first shrinks to a count for each bit pattern (at most two to
    the number of rules), so the rest is bitwise sums over a few rows.
    """
    mask = bits(*POLICIES[policy])
    patterns = ledger_rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(bits(r.name)).cast("long").alias("bit"))
                      for r in RULES if r.name in POLICIES[policy]])
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    only = F.col("bits") == F.col("bit")
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).cast("long")
    return (each.groupBy("rule").agg(count(fails).alias("n_failed"), count(only).alias("n_failed_only"),
                                     count(only | (F.col("bits") == 0)).alias("n_kept_without"))
            .withColumn("policy", F.lit(policy)))

"""Quality rules as a ledger: every rule is evaluated once and leaves a failure bit next to the measurements.

Policies are versioned masks over those bits. Applying another policy, or asking what one rule removes by itself, reads
the ledger only; texts are not looked at again.

Defined cases: a null text has no words; a text without words fails `too_short`; repeated rows and rows without an
id are judged one by one; columns besides `doc_id` and `text` are not read by `ledger`, and kept by `keep_passing`.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import unused

WINDOW = 8
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rules by bit: name and condition of failure over the measurements, in SQL that every engine reads alike.
RULES = (
    ("too_short", "{n_words} < 20"),
    ("repeated_passages", "100 * {n_repeat_words} > 30 * {n_words}"),
    ("symbols", "10 * {n_symbols} > 2 * {n_words}"),
    ("duplicate_lines", "{n_lines} >= 4 AND 100 * {n_dup_lines} > 30 * {n_lines}"),
    ("short_words", "{word_chars} < 2 * {n_words}"),
    ("long_words", "{word_chars} > 20 * {n_words}"),
)
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version name and the rules that reject a document under it."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[name] for name in self.rules)


BASE = Policy("base-1", ("too_short", "repeated_passages"))
FULL = Policy("full-1", tuple(BITS))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of `window` words that occur at least twice, the first occurrence included."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    width = 1
    while width < window:  # ids of runs of twice the width, exact at every step
        step = min(width, window - width)
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1]
        width += step
    twice = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()  # bytes are split at ASCII blanks only
    seen: set[str] = set()
    lines = duplicates = 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    characters = len(text) - sum(text.count(c) for c in _SPACE)
    return len(words), characters, symbols, lines, duplicates, repeated_words(words)


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def _measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(text) for text in texts], columns=list(MEASURES), dtype="int64")


def _bits(prefix: str = "") -> Column:
    columns = {name: prefix + name for name in MEASURES}
    bits = [f"CASE WHEN {c.format(**columns)} THEN {1 << i} ELSE 0 END" for i, (_, c) in enumerate(RULES)]
    return F.expr(f"CAST({' | '.join(bits)} AS BIGINT)")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and `failed_bits` of every row."""
    measured = docs.select("doc_id", _measured("text").alias("m")).select("doc_id", "m.*")
    return measured.withColumn("failed_bits", _bits())


def passes(policy: Policy, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def apply_policies(entries: DataFrame, policies: Mapping[str, Policy]) -> DataFrame:
    """The ledger with one boolean column per policy: whether it keeps the document."""
    return entries.withColumns({name: passes(policy) for name, policy in policies.items()})


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and all that the policy keeps without it."""
    failed = F.col("failed_bits").bitwiseAND(F.lit(policy.mask))
    patterns = entries.groupBy(failed.alias("failed")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(BITS[name]).alias("bit")) for name in policy.rules])
    rows = patterns.select("failed", "n", F.inline(rules))
    others = F.col("failed").bitwiseAND(F.lit(policy.mask) - F.col("bit"))
    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return rows.groupBy("rule").agg(
        total(hit).alias("n_failed"), total(hit & (others == 0)).alias("n_failed_alone"), total(others == 0).alias("n_kept_without")
    )


def judged(docs: DataFrame, policy: Policy = FULL) -> DataFrame:
    """The ledger with base_failed (the base policy's verdict) and kept (the given policy's, never for a base failure)."""
    return ledger(docs).withColumns({"base_failed": ~passes(BASE), "kept": passes(BASE) & passes(policy)})


def keep_passing(docs: DataFrame, policy: Policy = FULL) -> DataFrame:
    """The rows that the policy keeps, with their own columns."""
    m = unused(docs.columns, "measured")
    bits = unused(docs.columns, "rule_bits")
    with_bits = docs.withColumn(m, _measured("text")).withColumn(bits, _bits(f"{m}."))
    return with_bits.where(passes(BASE, bits) & passes(policy, bits)).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source's natural share of all tokens is raised to an exponent between 0 (all sources equal) and 1 (as they are), which is
bisected: for a target entropy to the largest exponent whose weights reach it, for a repetition limit to the smallest whose
most repeated source stays within it. Weights times the budget give each source's tokens. A source is read in passes; every
pass is a permutation of its documents, by hash, and the last one stops where the budget is used up. The stream so made is
cut into blocks that each take an equal part of every source's budget, and the documents of a block are permuted again.

Running sums over a source are taken in two steps, within buckets of about a thousand documents and over the buckets'
totals, so that no task handles a whole source.

Defined cases: rows without a source are a source of their own; a null or empty text counts as one token, so that it takes
part; if even exponent 1 breaks the repetition limit, the budget is cut to what the limit allows; if exponent 0 misses
the entropy, 0 is used; an empty table gives no rows; repeated rows are separate documents; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD, join_small, stored, unused

BUCKET_ROWS = 1024
BLOCK_TOKENS = 65_536
LEVELS_PER_JOB = 4
HALVINGS = 32


def token_count(text: Column) -> Column:
    """Words of a text, at least 1."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)), F.lit(1)).cast("long")


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def source_totals(docs: DataFrame) -> DataFrame:
    """source_key, tokens and n_docs of each source."""
    return docs.groupBy(_source_key(F.col("source")).alias("source_key")).agg(
        F.sum(token_count(F.col("text"))).alias("tokens"), F.count("*").alias("n_docs")
    )


def _moments(totals: DataFrame, exponents: list[float], all_tokens: int, budget: int) -> dict[float, tuple[float, float, float]]:
    """For each exponent: the sum of the raised shares, the entropy of the weights and the most repetitions of a source."""
    share = F.col("tokens") / F.lit(float(all_tokens))
    rows = totals.select(share.alias("p"), F.explode(F.array(*map(F.lit, exponents))).alias("exponent"))
    raised = F.pow("p", "exponent")
    found = rows.groupBy("exponent").agg(
        F.sum(raised).alias("norm"),
        F.sum(raised * F.log("p")).alias("weighed_logs"),
        F.max(raised / F.col("p")).alias("most"),
    )
    return {
        r.exponent: (
            r.norm,
            math.log(r.norm) - r.exponent * r.weighed_logs / r.norm,
            r.most / r.norm * budget / all_tokens,
        )
        for r in found.collect()
    }


def bisect_exponent(
    totals: DataFrame, all_tokens: int, budget: int, entropy: float | None = None, repetitions: float | None = None
) -> tuple[float, float]:
    """The exponent and the sum of the raised shares under it. Several halvings are evaluated by one job."""

    def good_below(moments: tuple[float, float, float]) -> bool:
        """Whether the answer lies at or below an exponent with these moments."""
        return moments[1] < entropy if entropy is not None else moments[2] <= repetitions

    ends = _moments(totals, [0.0, 1.0], all_tokens, budget)
    if entropy is not None:
        if ends[1.0][1] >= entropy:
            return 1.0, ends[1.0][0]
        if ends[0.0][1] < entropy:
            return 0.0, ends[0.0][0]
    else:
        if ends[0.0][2] <= repetitions:
            return 0.0, ends[0.0][0]
        if ends[1.0][2] > repetitions:
            return 1.0, ends[1.0][0]
    low, high = 0.0, 1.0
    norms = {}
    for _ in range(HALVINGS // LEVELS_PER_JOB):
        parts = 1 << LEVELS_PER_JOB
        inner = [low + (high - low) * i / parts for i in range(1, parts)]
        moments = _moments(totals, inner, all_tokens, budget)
        norms |= {exponent: m[0] for exponent, m in moments.items()}
        for _ in range(LEVELS_PER_JOB):
            middle = (low + high) / 2
            if good_below(moments[middle]):
                high = middle
            else:
                low = middle
    chosen = low if entropy is not None else high
    return chosen, norms.get(chosen) or _moments(totals, [chosen], all_tokens, budget)[chosen][0]


def budgets(
    docs: DataFrame,
    budget: int | None = None,
    entropy: float | None = None,
    repetitions: float | None = None,
) -> DataFrame:
    """source_key, tokens, n_docs, weight and quota (tokens to take) of each source.

    `budget` is the number of tokens to take (default: as many as there are); `entropy` is a share of the largest
    entropy possible. Give one of `entropy` and `repetitions`.
    """
    if (entropy is None) == (repetitions is None):
        raise ValueError("give either entropy or repetitions")
    totals = stored(source_totals(docs), "source-totals")
    all_tokens, sources = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    if not sources:
        return totals.withColumns({"weight": F.lit(0.0), "quota": F.lit(0).cast("long")})
    budget = all_tokens if budget is None else budget
    if repetitions is not None:
        budget = min(budget, int(repetitions * all_tokens))
    target = None if entropy is None else entropy * math.log(sources)
    exponent, norm = bisect_exponent(totals, all_tokens, budget, target, repetitions)
    weight = F.pow(F.col("tokens") / F.lit(float(all_tokens)), F.lit(exponent)) / F.lit(norm)
    return totals.withColumn("weight", weight).withColumn("quota", F.floor(F.col("weight") * budget + 0.5).cast("long"))


def _document_key() -> Column:
    """Tells documents apart by id, source and text; only rows that repeat all three share a key."""
    number = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-"))
    return F.md5(F.concat_ws("|", number, _source_key(F.col("source")), F.md5(F.coalesce("text", F.lit("")))))


def _row_key(docs: DataFrame) -> Column:
    """Tells rows apart by all of their columns; rows that share it are alike."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "source", "text")]
    rest = F.md5(F.to_json(F.struct(*others))) if others else F.lit("")
    return F.concat(_document_key(), rest)


def realise(docs: DataFrame, quotas: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = 0) -> DataFrame:
    """block, place (in the block, from 1), doc_id, row (key), source, epoch and n_tokens of every document taken."""
    total = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_tokens))
    rows = docs.select(
        "doc_id",
        "source",
        _source_key(F.col("source")).alias("key"),
        _document_key().alias("document"),
        _row_key(docs).alias("row"),
        token_count(F.col("text")).alias("n_tokens"),
    )
    taken = join_small(rows, quotas.where("quota > 0"), F.col("key") == F.col("source_key"), "inner")
    passes = F.sequence(F.lit(0).cast("long"), F.expr("(quota + tokens - 1) div tokens") - 1)
    taken = taken.withColumn("epoch", F.explode(passes))
    # The first half of a digest orders a pass, the second half a block.
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), "document"))
    buckets = F.expr(f"(n_docs + {BUCKET_ROWS - 1}) div {BUCKET_ROWS}")
    bucket = F.shiftright(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * buckets, 32)
    taken = taken.withColumn("order", order).withColumn("bucket", bucket)
    group = ["key", "epoch", "bucket"]
    sums = taken.groupBy(*group).agg(F.sum("n_tokens").alias("bucket_tokens"))
    earlier = Window.partitionBy("key", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("bucket_tokens").over(earlier), F.lit(0))).drop("bucket_tokens")
    inside = Window.partitionBy(*group).orderBy("order", "row").rowsBetween(Window.unboundedPreceding, -1)
    running = taken.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    placed = running.join(before, group).withColumn("start", F.expr("epoch * tokens + before + inside"))
    within = placed.where("start < quota")
    per_block = F.expr(f"(quota + {blocks - 1}) div {blocks}")
    blocked = within.withColumn("per_block", per_block).withColumn("block", F.expr("start div per_block"))
    shuffled = Window.partitionBy("block").orderBy(F.substring("order", 17, 16), "order", "row")
    place = F.row_number().over(shuffled).cast("long")
    return blocked.select("block", place.alias("place"), "doc_id", "row", "source", "epoch", "n_tokens")


def mix(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = 0, **target) -> DataFrame:
    """The realised mixture: block, place, doc_id, source, epoch and n_tokens. `target` goes to `budgets`."""
    docs = docs.select("doc_id", "source", "text")
    quotas = stored(budgets(docs, **target), "source-quotas")
    return realise(docs, quotas, block_tokens, seed).drop("row")


def mix_texts(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = 0, **target) -> DataFrame:
    """The mixture with all columns of `docs`, and block, place and epoch under names that `docs` does not use."""
    quotas = stored(budgets(docs, **target), "source-quotas")
    names = {name: unused(docs.columns, name) for name in ("block", "place", "epoch")}
    key, order_key = unused(docs.columns, "row_key"), unused(docs.columns, "ordered_row")
    order = realise(docs, quotas, block_tokens, seed).select(F.col("row").alias(order_key), *names)
    # Rows alike in all columns are in the order as often as they occur, and stand for each other.
    texts = docs.withColumn(key, _row_key(docs)).dropDuplicates([key])
    joined = texts.join(order.withColumnsRenamed(names).hint("merge"), F.col(key) == F.col(order_key))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], *names.values())

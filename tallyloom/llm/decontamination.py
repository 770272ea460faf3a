r"""Benchmark decontamination: exact containment of benchmark windows in documents, by a prefix-filtered set join.

A benchmark item is cut into windows of ten words (a shorter item is one window), a window into shingles of three. As a
contained window has all its shingles in the document, one necessary shingle is enough to find it: the one that is rarest
in the documents. Documents are joined on that shingle only; its place in the window and both lengths bound where the window
would lie, and there its words are compared one by one. Windows whose rarest shingle no document has are dropped at once.

Defined cases: null and empty texts have no words and hit nothing; an item without words has no window, an item without
an id hits words but is not listed or counted; repeated items count once; repeated rows and rows without an id are
judged one for one; columns besides `doc_id`, `text`, `item_id` are not read by `contamination`, and kept by `clean`.

Words are runs of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` in lower-cased text. `ITEM_WORD` says the same positively, as a
negated union costs the JVM's matcher several times as much.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import BROADCAST_LIMIT_BYTES, ascii_lower, join_small, stored, words_of
from tallyloom.operators.lookup import size_in_bytes

WINDOW = 10
SHINGLE = 3
BLOCK_WORDS = 512
ITEM_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"


def _words(text: str = "text") -> Column:
    return words_of(F.col(text), ITEM_WORD)


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: gram (their words) and items (sorted ids, as text, of the items that have them)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), _words().alias("w")).where(F.size("w") > 0)
    starts = items.withColumn("start", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))))
    grams = starts.select("item", F.slice("w", F.col("start") + 1, F.lit(window)).alias("gram"))
    return grams.groupBy("gram").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _shingle(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[words[at + i] for i in range(size)])


def _shingles_of_windows(grams: DataFrame, size: int) -> DataFrame:
    sizes = F.least(F.size("gram"), F.lit(SHINGLE))
    at = F.sequence(F.lit(0), F.size("gram") - size)
    rows = grams.where(sizes == size).withColumn("offset", F.explode(at))
    return rows.withColumn("shingle", _shingle(F.col("gram"), F.col("offset"), size))


def _positions(blocks: DataFrame, size: int) -> DataFrame:
    """A row for each place in each block, with the shingle that begins there."""
    rows = blocks.select("*", F.posexplode("w").alias("pos", "word")).where(F.col("pos") <= F.size("w") - size)
    return rows.withColumn("shingle", _shingle(F.col("w"), F.col("pos"), size)).drop("word")


def _blocks(docs: DataFrame, window: int) -> DataFrame:
    """The words of documents in blocks, each with the words that a window beginning in it may still need.

    However long a text is, what goes along with one of its places is a block. A document is known by its id and its
    text, so that repeated and missing ids are no trouble.
    """
    # Exploding an array of one keeps the optimiser from copying the tokenisation into the function that runs per block.
    whole = docs.select("doc_id", F.xxhash64("text").alias("content"), F.explode(F.array(_words())).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - 1, F.lit(0)), F.lit(BLOCK_WORDS))
    parts = F.transform(starts, lambda start: F.slice("all", start + 1, F.lit(BLOCK_WORDS + window - 1)))
    return whole.select("doc_id", "content", F.posexplode(parts).alias("block", "w"))


def _needed_shingles(blocks: DataFrame, grams: DataFrame, sizes: list[int], limit: int) -> DataFrame:
    """Windows with the rarest of their shingles (and its offset) over all documents; impossible windows are gone."""
    shingles = reduce(DataFrame.unionByName, [_shingles_of_windows(grams, size) for size in sizes])
    wanted = stored(shingles.select(F.col("shingle").alias("wanted")).distinct(), "wanted-shingles")
    places = [_positions(blocks, size).where(F.col("pos") < BLOCK_WORDS).select("shingle") for size in sizes]
    in_docs = reduce(DataFrame.unionByName, places)
    counts = join_small(in_docs, wanted, F.col("shingle") == F.col("wanted"), "left_semi", limit)
    frequency = counts.groupBy("shingle").agg(F.count("*").alias("frequency"))
    ranked = shingles.join(frequency, "shingle", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    rarest = ranked.groupBy("gram", "items").agg(F.min(F.struct("frequency", "shingle", "offset")).alias("rarest"))
    return rarest.where("rarest.frequency > 0").select("gram", "items", "rarest.shingle", "rarest.offset")


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """doc_id, content (hash of the text), start, length and items of every place where a window occurs."""
    grams = stored(windows(benchmark, window), "windows")
    sizes = [row[0] for row in grams.select(F.least(F.size("gram"), F.lit(SHINGLE)).alias("s")).distinct().collect()]
    sizes = sorted(sizes) or [SHINGLE]
    blocks = _blocks(docs, window)
    needed = stored(_needed_shingles(blocks, grams, sizes, limit), "needed-shingles")
    needed = needed.withColumnRenamed("shingle", "needed")
    places = reduce(DataFrame.unionByName, [_positions(blocks, size) for size in sizes])
    start = F.col("pos") - F.col("offset")
    in_bounds = (start >= 0) & (start < BLOCK_WORDS) & (start + F.size("gram") <= F.size("w"))
    same_shingle = F.col("shingle") == F.col("needed")
    if size_in_bytes(needed) <= limit:
        candidates = places.join(F.broadcast(needed), same_shingle)
    else:
        # Too many windows to broadcast: words stay behind while places are matched, and rejoin those that matched.
        found = places.drop("w").join(needed.hint("merge"), same_shingle)
        back = blocks.toDF("id", "c", "b", "w").dropDuplicates(["id", "c", "b"])
        same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("c")) & (F.col("block") == F.col("b"))
        candidates = found.join(back.hint("merge"), same)
    verified = candidates.where(in_bounds).where(F.slice("w", start + 1, F.size("gram")) == F.col("gram"))
    return verified.select("doc_id", "content", (start + F.col("block") * BLOCK_WORDS).alias("start"), F.size("gram").alias("length"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row."""
    found = occurrences(docs, benchmark, window, limit)
    hit_words = F.transform(
        F.sequence(F.col("start"), F.col("start") + F.col("length") - 1),
        lambda at: F.struct(at.alias("word"), F.lit(None).cast("string").alias("item")),
    )
    hit_items = F.transform("items", lambda item: F.struct(F.lit(None).cast("int").alias("word"), item.alias("item")))
    facts = found.select("doc_id", "content", F.inline(F.concat(hit_words, hit_items))).distinct()
    hits = facts.groupBy(F.col("doc_id").alias("id"), F.col("content").alias("c")).agg(
        F.count("word").alias("n_hit"),
        F.count("item").alias("n_items"),
        F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"),
    )
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("content"), F.regexp_count(ascii_lower(F.col("text")), F.lit(ITEM_WORD)).cast("long").alias("n_words")
    )
    joined = rows.join(
        hits.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("c")), "left"
    )
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """The rows without any hit, with their own columns."""
    found = occurrences(docs, benchmark, window, limit).select("doc_id", "content").distinct()
    hit = stored(found, "contaminated").toDF("hit_id", "hit_content")
    same = docs["doc_id"].eqNullSafe(F.col("hit_id")) & (F.xxhash64(docs["text"]) == F.col("hit_content"))
    return join_small(docs, hit, same, "left_anti", limit)

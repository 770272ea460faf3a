"""Near duplicates by an exact Jaccard join over word n-grams, with vertical partitioning.

All n-grams have one global order. It is cut into fragments; for a pair of documents the overlap is counted within each
fragment by itself, and the counts are added up per pair. Which pairs are counted is found in four steps:

1. Documents with equal sets are one class; only classes are compared.
2. Under a first order (by hash) similar sets share many of their first n-grams. Classes without enough n-grams that occur
   elsewhere cannot be similar to anything and are done.
3. For the rest, n-grams are ordered by frequency. Similar sets share one of their rarest n-grams. For each such n-gram
   classes of about one size are compared with a leader, the one with the fewest n-grams of its own, which joins most of
   a large group at once.
4. For n-grams whose classes are still in different components, pairs across components (and only those) are compared,
   as far as their sizes, places and sketches allow an overlap that is large enough.

A sketch has one bit for each of 256 groups of n-grams, set if the set has an odd number of them. Two sketches differ in
no more bits than the sets differ in n-grams, so the bound never loses a pair.

Step 4 makes the result exact: two similar classes are in one component after step 3, or are compared in step 4. Exact
up to hashing, that is: n-grams are 64-bit hashes that are not compared with their words. Two of N distinct n-grams share
a hash with a probability of N * N / 2 ** 65 (about 0.03 for 10 ** 9), and one such pair can change an overlap by one.

Defined cases: texts that are null, or have no words, have empty sets and are linked with nothing; rows that repeat an
id are compared one by one; rows without an id are linked like any others and get the smallest id of their component, or
none where no row has one; columns besides `doc_id` and `text` are not read by `components`, and kept by `keep_one`. For `keep_one` every row
is a document of its own, whatever its id. It stores digests of rows, not the rows, so the table must not change meanwhile.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import BROADCAST_LIMIT_BYTES, join_small, stored, unused
from tallyloom.operators.lookup import Lookup, lookup_join

N = 4
PERCENT = 85
FRAGMENTS = 8
#: A class is compared with a leader of each of so many groups of n-grams that it shares.
LEADERS = 4
#: A set's sketch is kept in so many numbers of 64 bits.
_SKETCH = 4
_DF_BITS = 20
#: Bytes of a text that are hashed at a time.
_CHUNK_BYTES = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close values (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words, in order: sums of a mixture of each byte and its place in the word."""
    lowered = (text or "").encode("utf-8", "surrogatepass").lower()  # for bytes, A-Z only
    raw = np.frombuffer(lowered, dtype=np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    edges = np.append(starts, len(raw))
    hashes = []
    at = 0
    while at < len(starts):  # a bounded number of bytes at a time, but whole words
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + _CHUNK_BYTES)) - 1)
        low, high = edges[at], edges[to]
        own = starts[at:to] - low
        place = np.arange(high - low) - np.repeat(own, np.diff(np.append(own, high - low)))
        mixed = _mixed((place.astype(np.uint64) << np.uint64(8)) + raw[low:high] + np.uint64(0x9E3779B97F4A7C15))
        mixed[blank[low:high]] = 0
        hashes.append(_mixed(np.add.reduceat(mixed, own)))
        at = to
    return np.concatenate(hashes)


def gram_set(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's n-grams; of the whole sequence if there are fewer words, none without."""
    words = _word_hashes(text)
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    width = min(n, len(words))
    grams = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        grams = _mixed(grams + words[i : len(words) - width + 1 + i])
    return np.unique(grams.view(np.int64))


def class_of(grams: np.ndarray) -> tuple[int, int]:
    """Two hashes that equal sets share."""
    bits = grams.view(np.uint64)
    halves = (_mixed(bits ^ np.uint64(seed)).sum(dtype=np.uint64).astype(np.int64) for seed in (1, 0x5DEECE66D))
    return tuple(map(int, halves))


def _spare(n: Column, percent: int) -> Column:
    """How many of n n-grams a similar set may lack."""
    return F.floor(n * (100 - percent) / 100).cast("int")


def _extra(n: Column) -> Column:
    """How many n-grams beyond the necessary first ones are looked at in step 2."""
    return F.floor(n / 10).cast("int") + 1


def _classes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The columns but `text`, content (its hash), n_grams, the class (h1, h2) and the first n-grams (upper halves) by their hashes."""

    @F.pandas_udf("n_grams long, h1 long, h2 long, first array<int>")
    def outline(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                grams = gram_set(text, n)
                seen = len(grams) * (100 - percent) // 100 + len(grams) // 10 + 1
                rows.append((len(grams), *class_of(grams), (grams[:seen] >> 32).astype(np.int32)))
            del texts  # before the next batch is read
            yield pd.DataFrame(rows, columns=["n_grams", "h1", "h2", "first"])
            del rows

    others = [c for c in docs.columns if c != "text"]
    found = docs.select(*others, F.xxhash64("text").alias("content"), outline("text").alias("o"))
    return found.select(*others, "content", "o.*")


def _survivors(classes: DataFrame, percent: int) -> DataFrame:
    """Classes that share enough of their first n-grams with others: h1, h2, representative, content and n_grams."""
    one_each = classes.where("n_grams > 0")
    grams = one_each.select("h1", F.explode("first").alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select(F.col("gram").alias("shared"))
    common = grams.join(stored(shared, "shared-grams").hint("merge"), F.col("gram") == F.col("shared"), "left_semi")
    found = common.groupBy("h1").agg(F.count("*").alias("n_found"))
    smallest = F.ceil(F.col("n_grams") * percent / 100)
    kept = one_each.drop("first").dropDuplicates(["h1"]).join(found.hint("merge"), "h1")
    return kept.where(F.col("n_found") >= _extra(smallest)).drop("n_found")


def _ordered_sets(docs: DataFrame, survivors: DataFrame, n: int, limit: int, repeats: bool) -> DataFrame:
    """h1, representative, n_grams and the set's shared n-grams in global order: structs of df and gram.

    `repeats` tells whether rows repeat both id and text.
    """
    wanted = survivors.select("h1", "h2", "representative", "content")
    same_text = F.xxhash64("text") == F.col("content")

    def texts_of(some: DataFrame, same_id: Column) -> DataFrame:
        found = join_small(docs.select("doc_id", "text"), some, same_id & same_text, "inner", limit)
        return found.select("h1", "h2", "text")

    texts = texts_of(wanted.where("representative is not null"), F.col("doc_id") == F.col("representative"))
    if repeats:
        texts = texts.dropDuplicates(["h1", "h2"])
    nameless = wanted.where("representative is null")
    if not nameless.isEmpty():
        # Classes whose rows all lack an id: any number of rows may have the text.
        texts = texts.union(texts_of(nameless, F.col("doc_id").isNull()).dropDuplicates(["h1", "h2"]))

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(zip(batch["h1"], batch["h2"], batch["text"], strict=True))
            del batch
            for h1, h2, text in rows:
                grams = gram_set(text, n)
                if class_of(grams) == (h1, h2):  # another text may have the same id and hash
                    yield pd.DataFrame({"h1": h1, "gram": grams})

    # Sets are computed once more for the few survivors instead of being kept for all documents.
    grams = stored(texts.select("h1", "h2", "text").mapInPandas(sets_of, "h1 long, gram long"), "survivors-grams")
    frequency = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1").withColumnRenamed("gram", "shared")
    common = grams.join(frequency, F.col("gram") == F.col("shared"))
    df = F.least("df", F.lit((1 << _DF_BITS) - 1)).cast("int").alias("df")
    ordered = common.groupBy("h1").agg(F.sort_array(F.collect_set(F.struct(df, "gram"))).alias("ordered"))
    return survivors.drop("h2", "content").join(ordered.hint("merge"), "h1")


def _place(g: str) -> Column:
    """A number that grows with the global order of structs of df and gram: all of df, and the upper bits of gram."""
    upper = F.shiftrightunsigned(f"{g}.gram", _DF_BITS + 1).bitwiseXOR(F.lit(1 << (62 - _DF_BITS)))  # grams are signed
    return F.shiftleft(F.col(f"{g}.df").cast("long"), 63 - _DF_BITS).bitwiseOR(upper)


def _sketches(ordered: str) -> list[Column]:
    """The sketch of a set of structs with a gram, as columns k0 to k3."""

    def word(i: int) -> Column:
        def toggle(bits: Column, g: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(g["gram"], 2).bitwiseAND(63).cast("int"))
            return F.when(F.pmod(g["gram"], F.lit(_SKETCH)) == i, bits.bitwiseXOR(bit)).otherwise(bits)

        return F.aggregate(ordered, F.lit(0).cast("long"), toggle)

    return [word(i).alias(f"k{i}") for i in range(_SKETCH)]


def _differing(a: str, b: str) -> Column:
    """The number of bits in which two sketches (columns k0_a and so on) differ; 0 where one is unknown."""
    bits = [F.bit_count(F.col(f"k{i}_{a}").bitwiseXOR(F.col(f"k{i}_{b}"))) for i in range(_SKETCH)]
    return F.coalesce(reduce(lambda total, one: total + one, bits), F.lit(0))


def _most_shared() -> Column:
    """A bound on the overlap of sets that share n_shared n-grams with any, by what they have and by their sketches."""
    return F.least("s_a", "s_b", F.floor((F.col("s_a") + F.col("s_b") - _differing("a", "b")) / 2))


def _size_band(n: Column, percent: int) -> Column:
    """Bands of sizes, as wide as similar sets may differ; an even cut, so similar sets may lie in neighbouring bands."""
    return F.floor(F.log(n) / F.log(F.lit(100 / min(percent, 99)))).cast("int")


def _fragments(sets: DataFrame, fragments: int) -> DataFrame:
    """h1, fragment and the n-grams of the set in it. The global order is cut where equal numbers of n-grams lie between."""
    cuts = [i / fragments for i in range(1, fragments)]
    rows = sets.select("h1", F.explode("ordered").alias("g"))
    pivots = rows.agg(F.percentile_approx(_place("g"), cuts)).first()[0] or []
    fragment = reduce(lambda total, cut: total + (_place("g") >= cut).cast("int"), pivots, F.lit(0))
    return rows.groupBy("h1", fragment.alias("fragment")).agg(F.collect_list("g.gram").alias("grams"))


def similar(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, n_a, n_b), those that are similar: overlaps are counted by fragment and added up."""
    left = segments.select(F.col("h1").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    right = segments.select(F.col("h1").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), ["b", "fragment"])
    partial = both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("partial"))
    overlap = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("partial").alias("overlap"))
    enough = F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * percent
    return overlap.where(enough).select("a", "b")


def connected(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of all linked nodes, by alternating large and small stars."""
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("of"), F.least("u", "low").alias("low"))
        low = stored(low, "lowest")
        large = both.where("v > u").join(low.hint("merge"), F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        moved = large.join(low.withColumnRenamed("u", "of").hint("merge"), F.col("u") == F.col("of"))
        small = moved.select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.select("u", F.col("low").alias("v")))
        edges = stored(small.where("u != v").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now


def _labelled(sets: DataFrame, links: DataFrame | None) -> DataFrame:
    """h1 and component of every survivor."""
    nodes = sets.select("h1")
    if links is None:
        return nodes.withColumn("component", F.col("h1"))
    found = connected(links)
    named = nodes.join(found.hint("merge"), F.col("h1") == F.col("node"), "left")
    return named.select("h1", F.coalesce("component", "h1").alias("component"))


def _possible(n_a: str, n_b: str, most: Column, percent: int) -> Column:
    """Whether sets of these sizes with at most so much overlap can be similar."""
    return most * 100 >= (F.col(n_a) + F.col(n_b) - most) * percent


def _side(name: str) -> list[Column]:
    """The columns of the index that bound an overlap, named for one side of a pair."""
    short = {"n_grams": "n", "n_shared": "s"} | {f"k{i}": f"k{i}" for i in range(_SKETCH)}
    return [F.col(column).alias(f"{new}_{name}") for column, new in short.items()]


def _leader_pairs(index: DataFrame, percent: int) -> DataFrame:
    """Each class with a leader for each group of n-grams; leaders are chosen alike for the n-grams of a group."""
    band, group = _size_band(F.col("n_grams"), percent), F.pmod(F.col("gram"), F.lit(LEADERS))
    # Edits leave n-grams that no other set has. The set with the fewest is the closest to the others.
    own = (1 - F.col("n_shared") / F.col("n_grams")).alias("own")
    choice = F.struct(own, F.xxhash64("h1", group).alias("lot"), F.col("h1").alias("a"), *_side("a"))
    leaders = index.groupBy(F.col("gram").alias("of"), band.alias("band_of")).agg(F.min(choice).alias("leader"))
    leaders = stored(leaders.select("of", "band_of", "leader.*"), "leaders")
    members = index.select("gram", band.alias("band"), F.col("h1").alias("b"), *_side("b"))
    same = (F.col("gram") == F.col("of")) & (F.col("band") == F.col("band_of"))
    pairs = members.join(leaders.hint("merge"), same).where("a != b")
    possible = pairs.where(_possible("n_a", "n_b", _most_shared(), percent))
    # A class of a large group meets another leader at nearly every n-gram; one for each group of n-grams links it as well.
    first = F.min(F.struct("own", "lot", "a", "n_a")).alias("first")
    one_each = possible.groupBy("b", "n_b", group.alias("group")).agg(first)
    return one_each.select("first.a", "b", "first.n_a", "n_b").distinct()


def _crossing_pairs(index: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes that share an n-gram of the index, lie in different components, and may be similar."""
    named = stored(index.join(labels.withColumnRenamed("h1", "node").hint("merge"), F.col("h1") == F.col("node")), "index")
    ends = named.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = stored(ends.where("low != high").select(F.col("gram").alias("mixed")), "mixed-grams")
    rows = stored(named.join(mixed.hint("merge"), F.col("gram") == F.col("mixed"), "left_semi"), "mixed-index")

    # The shared n-gram need not be the first one, so its places bound only what follows it and what may precede it.
    most = F.least(_most_shared(), F.least("pos_a", "pos_b") + 1 + F.least("after_a", "after_b"))
    after = F.col("n_shared") - F.col("pos")
    single = F.min("h1") == F.max("h1")
    band = _size_band(F.col("n_grams"), percent).alias("band")
    parts = rows.groupBy("gram", "component", band).agg(
        F.min("n_grams").alias("n_grams"),
        F.max("n_shared").alias("n_shared"),
        F.max("pos").alias("pos"),
        F.max(after).alias("after"),
        *[F.when(single, F.min(f"k{i}")).alias(f"k{i}") for i in range(_SKETCH)],
    )
    parts = stored(parts, "parts")

    def part(name: str) -> DataFrame:
        places = [F.col(c).alias(f"{c}_{name}") for c in ("component", "band", "pos", "after")]
        return parts.select("gram", *places, *_side(name))

    # Similar sets lie in the same band of sizes or in neighbouring ones.
    near = F.explode(F.array(*[F.col("band_b") + i for i in (-1, 0, 1)])).alias("band_a")
    crossings = part("a").join(part("b").select("*", near).hint("merge"), ["gram", "band_a"]).where("component_a < component_b")
    bounds_b = [f"{c}_b" for c in ("component", "band", "n", "s", "pos", "after", *(f"k{i}" for i in range(_SKETCH)))]
    crossings = crossings.where(_possible("n_a", "n_b", most, percent)).select("gram", "component_a", "band_a", *bounds_b)

    def side(name: str) -> DataFrame:
        places = [F.col("h1").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("component", "pos"))]
        of_band = _size_band(F.col("n_grams"), percent).alias(f"band_{name}")
        return rows.select("gram", *places, of_band, after.alias(f"after_{name}"), *_side(name))

    # A class of a large component need not meet what only another class of its component may be similar to.
    left = crossings.join(side("a").hint("merge"), ["gram", "component_a", "band_a"])
    left = left.where(_possible("n_a", "n_b", most, percent)).drop(*(c for c in bounds_b if c not in ("component_b", "band_b")))
    pairs = left.join(side("b").hint("merge"), ["gram", "component_b", "band_b"])
    return pairs.where(_possible("n_a", "n_b", most, percent)).select("a", "b", "n_a", "n_b").distinct()


def components(docs: DataFrame, n: int = N, percent: int = PERCENT, fragments: int = FRAGMENTS, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """doc_id, n_shingles (the size of its set) and component_id (the smallest id reachable by links) of every row."""
    return _components(docs.select("doc_id", "text"), n, percent, fragments, limit)


def _components(docs: DataFrame, n: int, percent: int, fragments: int, limit: int) -> DataFrame:
    """What `components` returns, and further columns of `docs`, which are read once."""
    rows = stored(_classes(docs, n, percent), "first-grams")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")).alias("one")
    classes = rows.groupBy("h1", "h2", "n_grams").agg(one, F.first("first").alias("first"))
    named = [F.col("one.doc_id").alias("representative"), F.col("one.content").alias("content")]
    classes = stored(classes.select("h1", "h2", "n_grams", *named, "first"), "classes")
    survivors = stored(_survivors(classes, percent), "survivors")
    repeats = not rows.where("n_grams > 0").groupBy("doc_id", "content").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    sets = stored(_ordered_sets(docs, survivors, n, limit, repeats), "ordered-sets")
    segments = stored(_fragments(sets, fragments), "segments")

    # Of the necessary first n-grams, those that occur in this set alone come first and lead nowhere.
    alone = F.col("n_grams") - F.size("ordered")
    length = F.greatest(_spare(F.col("n_grams"), percent) + 1 - alone, F.lit(0)).cast("int")
    sketched = sets.where(length > 0).select("h1", "n_grams", "ordered", length.alias("length"), *_sketches("ordered"))
    bounds = ["h1", "n_grams", F.size("ordered").cast("long").alias("n_shared"), *[f"k{i}" for i in range(_SKETCH)]]
    first = F.posexplode(F.slice("ordered", F.lit(1), F.col("length"))).alias("pos", "g")
    index = sketched.select(*bounds, first).select("*", "g.gram").drop("g")
    index = stored(index, "first-shared-grams")

    near = stored(similar(_leader_pairs(index, percent), segments, percent), "links")
    labels = stored(_labelled(sets, near), "labels")
    rest = stored(similar(_crossing_pairs(index, labels, percent), segments, percent), "links")
    if not rest.isEmpty():
        kept = labels.select(F.col("h1").alias("a"), F.col("component").alias("b"))
        labels = stored(_labelled(sets, kept.union(rest)), "labels")

    names = survivors.join(labels.hint("merge"), "h1").select("component", "representative", "h1")
    smallest = names.groupBy("component").agg(F.min("representative").alias("smallest"))
    named = lookup_join(names, Lookup(smallest, "component", {"smallest": "smallest"}), "component")
    named = named.select(F.col("h1").alias("node"), "smallest")
    of_class = classes.drop("first").join(named.hint("merge"), F.col("h1") == F.col("node"), "left")
    of_class = stored(
        of_class.select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.coalesce("smallest", "representative").alias("component")),
        "class-components",
    )
    joined = rows.drop("first", "content").join(of_class.hint("merge"), (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    component = F.when(F.col("n_grams") == 0, F.col("doc_id")).otherwise(F.col("component"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return joined.select("doc_id", F.col("n_grams").alias("n_shingles"), component.alias("component_id"), *others)


def _digest(docs: DataFrame) -> Column:
    """Two hashes that only rows alike in all columns share."""
    cells = []
    for field in docs.schema:
        cell = F.col(f"`{field.name}`")
        nested = field.dataType.typeName() in ("array", "map", "struct", "variant")
        cells += [F.to_json(F.struct(cell)) if nested else cell, cell.isNull()]  # a hash passes over nulls
    return F.struct(*[F.xxhash64(F.lit(seed), *cells).alias(f"d{seed}") for seed in (1, 2)])


def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """One row of each component with its own columns: that with the smallest id, rows without an id last.

    Every row counts, whatever its id: rows are told apart by a digest of all their columns, which need not be stored with
    them, and numbered as they are first read. Of rows alike in all columns any one stays.
    """
    key = unused(docs.columns, "row_key")
    keyed = docs.withColumn(key, _digest(docs))
    number = F.monotonically_increasing_id().alias("number")
    rows = keyed.select(F.col(f"`{key}`").alias("doc_id"), "text", F.col("doc_id").alias("of_id"), number)
    linked = stored(_components(rows, n, percent, FRAGMENTS, limit).where("n_shingles > 0"), "row-components")
    first = F.min(F.struct(F.col("of_id").isNull().alias("none"), "of_id", "number", "doc_id")).alias("first")
    winners = linked.groupBy("component_id").agg(first).select(F.col("first.doc_id").alias("winner"))
    counts = linked.groupBy("doc_id").agg(F.count("*").alias("n"))
    judged = counts.join(winners.hint("merge"), F.col("doc_id") == F.col("winner"), "left").where("winner is null or n > 1")
    judged = stored(judged, "copies")
    gone = judged.where("winner is null").select(F.col("doc_id").alias("copied_row"))
    kept = join_small(keyed, gone, F.col(f"`{key}`") == F.col("copied_row"), "left_anti", limit)
    repeated = judged.where("winner is not null").select(F.col("doc_id").alias("repeated_row"))
    if repeated.isEmpty():
        return kept.drop(key)
    alike = F.col(f"`{key}`") == F.col("repeated_row")
    one_each = join_small(kept, repeated, alike, "left_semi", limit).dropDuplicates([key])
    return join_small(kept, repeated, alike, "left_anti", limit).unionByName(one_each).drop(key)

"""Alignment of two tokenizers on the same texts, by the byte positions where both of them end a token.

Every text is encoded as space + text by A and by B. The ascending end positions of the shorter token list drive a galloping
search into the longer one: from the place found for an earlier element the probe's reach doubles until it passes the
value, then a binary search closes in. The positions in both lists cut the tokens into groups. The ranks of two
neighbouring elements bound the tokens of the other list that overlap the token between them, which are its links.
How many documents hold an id pair linked is counted over the whole corpus.

The search runs over many elements at once: first every 2^k-th element gallops, then those half-way between, each from
the place of the element before it, so that the distances to cover shrink from pass to pass. Texts are put end to end in
chunks of about a megabyte of text for that; the end of a text is a position where both lists end, so no group or link leaves its text.

Counts of pairs: at most `HOT_PAIRS` of the most frequent ones are broadcast; every other pair is in fewer documents than
those, so its links can be joined by a shuffle without a hot key. Neither bound depends on the corpus.

Defined cases: null and empty texts have no tokens and zeros everywhere, as have texts whose joined token bytes under A or B
are not those of space + text; every row counts as a document of its own, repeated rows and rows without an id too;
columns besides `doc_id` and `text` are not read; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import stored
from tallyloom.llm.token_counts import tokenizer_path

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: The most id pairs whose counts are broadcast (17 bytes each).
HOT_PAIRS = 1_500_000
_CHUNK_BYTES = 1 << 20
_PENDING_LINKS = 1 << 22

#: Fixed value: how byte-level BPE cuts a text before merging.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass
class Encoder:
    """Token ids of texts with a space in front, and the bytes of every token."""

    encode: Callable[[list[str]], list]
    token_bytes: list[bytes]
    lossless: bool = False  # the tokens of every text spell it


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_encoder(path: str) -> Encoder:
    """Encoder for a byte-level BPE vocabulary in a .json file.

    Where the file's ids are its merge order and it asks for nothing else, its entries are run by tiktoken, which gives
    the same ids several times faster (compared over all code points in the tests); other files by tokenizers itself.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    alphabet = _byte_alphabet()
    vocabulary = content["model"]["vocab"]
    size = max([*vocabulary.values(), *(one["id"] for one in content.get("added_tokens") or [])]) + 1
    token_bytes = [b""] * size
    for piece, number in vocabulary.items():
        token_bytes[number] = bytes(alphabet[c] for c in piece)
    for one in content.get("added_tokens") or []:
        token_bytes[one["id"]] = one["content"].encode()
    pre, model = content.get("pre_tokenizer") or {}, content["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model.get("merges", [])]
    in_order = all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and len(vocabulary) == 256 + len(merges)
    plain = (
        content.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space")
        and pre.get("use_regex", True)
        and not any(model.get(name) for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if in_order and plain:
        import tiktoken

        ranks = {token_bytes[number]: number for number in vocabulary.values()}
        encoding = tiktoken.Encoding("byte-level", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        return Encoder(lambda texts: [encoding.encode_ordinary(" " + text) for text in texts], token_bytes, lossless=True)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True

    def encode(texts: list[str]) -> list:
        return [one.ids for one in tokenizer.encode_batch([" " + text for text in texts], add_special_tokens=False)]

    return Encoder(encode, token_bytes)


def piece_encoder(path: str) -> Encoder:
    """Encoder for a sentencepiece model that adds the space itself; control pieces have no bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    token_bytes = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            token_bytes.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            token_bytes.append(b"")
        else:
            token_bytes.append(piece.replace("▁", " ").encode())
    return Encoder(lambda texts: model.encode(texts, num_threads=1), token_bytes)


def load(path: str) -> Encoder:
    return piece_encoder(path) if path.endswith(".model") else byte_level_encoder(path)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of `short` how many values of `long` are smaller; both ascend strictly."""
    n, m = len(short), len(long)
    place = np.zeros(n, dtype=np.int64)
    if not n or not m:
        return place
    padded = np.append(long, np.iinfo(np.int64).max)
    stride = 1 << max(n - 1, 0).bit_length()
    todo = np.zeros(1, dtype=np.int64)
    known = -np.ones(1, dtype=np.int64)
    while True:
        value = short[todo]
        low = np.where(known >= 0, place[known], 0)  # values before it are smaller
        reach = np.zeros(len(todo), dtype=np.int64)
        high = low.copy()
        step = 1
        moving = np.flatnonzero(padded[high] < value)
        while len(moving):
            low[moving] = high[moving] + 1
            reach[moving] = step
            high[moving] = np.minimum(high[moving] + step, m)
            moving = moving[padded[high[moving]] < value[moving]]
            step *= 2
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            smaller = padded[middle] < value[open_]
            low[open_[smaller]] = middle[smaller] + 1
            high[open_[~smaller]] = middle[~smaller]
            open_ = open_[low[open_] < high[open_]]
        place[todo] = low
        stride >>= 1
        if not stride:
            return place
        todo = np.arange(stride, n, 2 * stride)
        known = todo - stride


@dataclass
class Aligned:
    """Tokens put end to end, their groups and their links, for texts one after the other."""

    group_ends: tuple[np.ndarray, np.ndarray]  # token numbers after the last of each group, under A and B
    links: tuple[np.ndarray, np.ndarray]  # token numbers under A and B


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Aligned:
    """Groups and links of two token lists over the same bytes, from their end positions."""
    swapped = len(ends_b) < len(ends_a)
    short, long = (ends_b, ends_a) if swapped else (ends_a, ends_b)
    rank = gallop(short, long)
    common = np.append(long, -1)[rank] == short if len(short) else np.zeros(0, dtype=bool)
    groups = np.flatnonzero(common) + 1, rank[common] + 1
    first = np.concatenate(([0], rank[:-1] + common[:-1])) if len(short) else rank
    count = rank - first + 1
    of_short = np.repeat(np.arange(len(short)), count)
    of_long = np.arange(len(of_short)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    if swapped:
        return Aligned((groups[1], groups[0]), (of_long, of_short))
    return Aligned(groups, (of_short, of_long))


class Pair:
    """Both tokenizers with the tables that whole chunks are worked on with."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = load(path_a), load(path_b)
        self.size_a, self.size_b = len(self.a.token_bytes), len(self.b.token_bytes)
        self.lengths = tuple(np.array([len(t) for t in one.token_bytes], dtype=np.int64) for one in (self.a, self.b))
        ids_a, ids_b = ([str(i) for i in range(n)] for n in (self.size_a, self.size_b))
        written = [*(i + "," for i in ids_a), *(i + "|" for i in ids_a), *(i + "," for i in ids_b), *(i + ";" for i in ids_b)]
        #: How an id is written inside a group and at its end, as bytes of one width.
        self.written = np.array(written, dtype=np.bytes_)

    def _tokens(self, text: str, a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
        """The ids, or none where they do not spell the text."""
        if not text:
            return [], []
        raw = b" " + text.encode("utf-8", "surrogatepass")
        for one, ids in ((self.a, a), (self.b, b)):
            if not one.lossless and b"".join(map(one.token_bytes.__getitem__, ids)) != raw:
                return [], []
        return a, b

    def chunk(self, texts: list[str | None]) -> dict[str, list]:
        """Columns of `aligned` for some texts."""
        whole = [text or "" for text in texts]
        tokens = [self._tokens(*one) for one in zip(whole, self.a.encode(whole), self.b.encode(whole))]
        n = np.array([[len(a), len(b)] for a, b in tokens], dtype=np.int64).reshape(-1, 2)
        ids = [np.fromiter(chain.from_iterable(pair[side] for pair in tokens), dtype=np.int64, count=int(n[:, side].sum())) for side in (0, 1)]
        del tokens
        found = align(*(np.cumsum(lengths[i]) for lengths, i in zip(self.lengths, ids)))
        to = np.cumsum(n, axis=0)
        link_a, link_b = found.links
        last_group = np.searchsorted(found.group_ends[0], to[:, 0], side="right")
        n_groups = np.diff(last_group, prepend=0)
        links_to = np.searchsorted(link_a, to[:, 0], side="left")  # links ascend by A's tokens

        code = ids[0][link_a] * self.size_b + ids[1][link_b]
        doc = np.searchsorted(to[:, 0], link_a, side="right")
        key = np.sort(doc * (self.size_a * self.size_b) + code)
        start = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(np.append(start, len(key)))
        pair_doc, pair = np.divmod(key[start], self.size_a * self.size_b)
        cuts = np.searchsorted(pair_doc, np.arange(len(texts) + 1))
        return {
            "n_a": n[:, 0],
            "n_b": n[:, 1],
            "n_groups": n_groups,
            "n_links": np.diff(links_to, prepend=0),
            "groups": self._written(ids, found.group_ends, to.sum(1)),
            "pairs": (cuts, pair // self.size_b, pair % self.size_b, times),
        }

    def _written(self, ids: list[np.ndarray], group_ends: tuple[np.ndarray, np.ndarray], to: np.ndarray) -> list[str]:
        """Per text its groups as `a1,a2|b1;a3|b2,b3`."""
        (a, b), (ends_a, ends_b) = ids, group_ends
        if not len(ends_a):
            return [""] * len(to)
        entry_a, entry_b = a.copy(), b + 2 * self.size_a
        entry_a[ends_a - 1] += self.size_a
        entry_b[ends_b - 1] += self.size_b
        sizes_a, sizes_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        out = np.empty(len(a) + len(b), dtype=np.int64)
        out[np.arange(len(a)) + np.repeat(ends_b - sizes_b, sizes_a)] = entry_a
        out[np.arange(len(b)) + np.repeat(ends_a, sizes_b)] = entry_b
        # bytes of one width are filled up with NUL
        return [
            self.written[out[x:y]].tobytes().translate(None, b"\0")[:-1].decode() for x, y in zip([0, *to[:-1].tolist()], to.tolist())
        ]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a piece have about a chunk of bytes, or are one text."""
    for batch in batches:
        texts = batch.column("text")
        ends = np.cumsum([len(text) if (text := one.as_buffer()) is not None else 0 for one in texts.cast(pa.binary())])
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(int(np.searchsorted(ends, before + _CHUNK_BYTES, side="right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups (text), link_a, link_b and link_n of every row.

    The last three are arrays: the distinct id pairs that are linked, and how often.
    """
    path_a, path_b = path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B)
    ids = T.ArrayType(T.IntegerType())
    kinds = [*((name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")), ("groups", T.StringType())]
    kinds += [(name, ids) for name in ("link_a", "link_b", "link_n")]
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(name, kind) for name, kind in kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Pair(path_a, path_b)
        for piece in _pieces(batches):
            found = both.chunk(piece.column("text").to_pylist())
            cuts, *pairs = found.pop("pairs")
            offsets = pa.array(cuts, type=pa.int32())
            columns = [piece.column("doc_id"), *(pa.array(column) for column in found.values())]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(values, type=pa.int32())) for values in pairs]
            yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in schema])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, docs (how many rows of `links` hold the pair) and best (whether no pair of its A id has more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            columns = [(codes >> 32).astype(np.int32), (codes & 0xFFFFFFFF).astype(np.int32), n]
            return pa.RecordBatch.from_arrays([pa.array(one) for one in columns], names=["a", "b", "docs"])

        for batch in batches:
            a, b = (batch.column(name).flatten().to_numpy().astype(np.int64) for name in ("link_a", "link_b"))
            held.append(a << 32 | b)
            size += len(a)
            if size >= _PENDING_LINKS:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    partial = links.select("link_a", "link_b").mapInArrow(run, "a int, b int, docs long")
    counts = partial.groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    # an A id has at most as many pairs as B has ids
    most = F.max("docs").over(Window.partitionBy("a"))
    return counts.withColumn("best", F.col("docs") == most)


def hot_from(counts: DataFrame, bound: int) -> int:
    """The least power of two such that at most `bound` pairs are in that many documents or more."""
    bits = F.length(F.bin("docs"))
    left = bound
    least = 1 << 62
    for row in sorted(counts.groupBy(bits.alias("bits")).agg(F.count("*").alias("n")).collect(), reverse=True):
        left -= row.n
        if left < 0:
            break
        least = 1 << (row.bits - 1)
    return least


def _with_hot(links: DataFrame, hot: DataFrame) -> DataFrame:
    """key, n_best and count_sum over the pairs in `hot`, and the other pairs as arrays a, b and n."""
    rows = hot.select((F.col("a").cast("long") * (1 << 32) + F.col("b")).alias("code"), "docs", "best").toArrow()
    codes = rows.column("code").to_numpy().astype(np.int64)
    order = np.argsort(codes)
    tables = tuple(one[order] for one in (codes, rows.column("docs").to_numpy().astype(np.int64), np.array(rows.column("best").to_pylist(), dtype=bool)))
    shared = links.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, docs, best = shared.value
        for batch in batches:
            offsets = batch.column("link_a").offsets.to_numpy()
            offsets = offsets - offsets[0]
            a, b, n = (batch.column(name).flatten().to_numpy().astype(np.int64) for name in ("link_a", "link_b", "link_n"))
            code = a << 32 | b
            at = np.searchsorted(codes, code)
            is_hot = np.append(codes, -1)[at] == code
            at[~is_hot] = 0
            sums = [np.concatenate(([0], np.cumsum(np.where(is_hot, n * value[at], 0) if len(codes) else np.zeros(len(n), dtype=np.int64)))) for value in (best, docs)]
            columns = [batch.column("key"), *(pa.array(np.diff(one[offsets])) for one in sums)]
            cold = ~is_hot
            cuts = pa.array(np.concatenate(([0], np.cumsum(cold)))[offsets], type=pa.int32())
            columns += [pa.ListArray.from_arrays(cuts, pa.array(one[cold], type=pa.int32())) for one in (a, b, n)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_best", "count_sum", "a", "b", "n"])

    schema = "key long, n_best long, count_sum long, a array<int>, b array<int>, n array<int>"
    return links.select("key", "link_a", "link_b", "link_n").mapInArrow(run, schema)


def with_counts(aligned_docs: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Adds n_best and count_sum to the rows of `aligned`; the link arrays fall away."""
    rows = stored(aligned_docs.withColumn("key", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(rows), "pair-counts")
    least = hot_from(counts, hot_pairs)
    partial = _with_hot(rows, counts.where(F.col("docs") >= least))
    cold = counts.where(F.col("docs") < least)
    if cold.isEmpty():
        sums = partial.select("key", "n_best", "count_sum")
    else:
        partial = stored(partial, "hot-sums")
        links = partial.select("key", F.explode(F.arrays_zip("a", "b", "n")).alias("link")).select("key", "link.*")
        joined = links.join(cold.hint("merge"), ["a", "b"])
        n_best = F.when(F.col("best"), F.col("n")).otherwise(0).cast("long")
        cold_sums = joined.select("key", n_best.alias("n_best"), (F.col("n") * F.col("docs")).alias("count_sum"))
        both = partial.select("key", "n_best", "count_sum").unionByName(cold_sums)
        sums = both.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    kept = rows.drop("link_a", "link_b", "link_n")
    return kept.join(sums.hint("merge"), "key").drop("key")

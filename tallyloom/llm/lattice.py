"""Language-model scores of texts: the marginal probability over all segmentations into pieces of a given vocabulary.

The vocabulary is that of an existing tokenizer; piece probabilities are learned here, from the pieces of the training
words. A word (with the mark that begins it) has many segmentations; log-space forward recursion adds up all of them.
Pieces never run over a blank, so a text's probability is the product over its words and its end, and each distinct word
of the corpus is worked on once. A character that is no piece can only be spelled in bytes.

Word counts stay in a table that grows with the corpus. For scoring, the most frequent words, whose number is bounded, are
broadcast; all others are joined by a shuffle, after equal words of equal texts have been counted together. In these joins
a long word goes by its digest, so that keys are short and even a very frequent one can be broadcast. The sums of a
text are joined to its rows at the end; texts are known by 96 bits of hashes.

Defined cases: a null text is an empty one, of which only the end is scored; repeated rows and rows without an id are
returned one for one; with nothing to learn from, every count is 0 and pieces are equally likely; columns besides
`doc_id` and `text` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored, words_of
from tallyloom.llm.token_counts import tokenizer_path

END = " "  # no word contains a blank
MARK = "▁"
#: Bound of the broadcast table: so many words, whose keys have at most so many characters and a digest.
HOT_WORDS = 150_000
KEY_LENGTH = 64
_BINS_PER_DOUBLING = 4


@dataclass
class Pieces:
    """Natural-log probabilities of pieces, of single bytes (when no piece has a character) and of the end of a text."""

    scores: dict[str, float]
    bytes: list[float]
    end: float

    def __post_init__(self):
        self.longest = max(map(len, self.scores), default=1)

    def word(self, word: str) -> float:
        """Natural log of the probability of a word, summed over all its segmentations."""
        if word == END:
            return self.end
        text = MARK + word
        scores, longest = self.scores, self.longest
        forward = [0.0]
        for j in range(1, len(text) + 1):
            ways = []
            for i in range(max(0, j - longest), j):
                score = scores.get(text[i:j])
                if score is not None:
                    ways.append(forward[i] + score)
            if text[j - 1] not in scores:
                spelled = text[j - 1].encode("utf-8", "surrogatepass")
                ways.append(forward[j - 1] + sum(self.bytes[b] for b in spelled))
            if len(ways) == 1:
                forward.append(ways[0])
            else:
                most = max(ways)
                forward.append(most + math.log(sum(math.exp(way - most) for way in ways)))
        return forward[-1]


def _load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def count_words(docs: DataFrame, training: Column) -> DataFrame:
    """word, seen (in all rows) and c (in training rows) of all words; the end of a text counts as a word."""
    tokens = docs.select(
        training.alias("training"), F.explode(F.concat(words_of(F.col("text")), F.array(F.lit(END)))).alias("word")
    )
    return tokens.groupBy("word").agg(
        F.count("*").alias("seen"), F.sum(F.when(F.col("training"), 1).otherwise(0)).cast("long").alias("c")
    )


def learn_pieces(counts: DataFrame, path: str) -> Pieces:
    """Piece probabilities from the segmentation that the tokenizer itself gives the training words, plus one each."""

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _load(path)
        totals = np.zeros(model.get_piece_size(), dtype=np.int64)
        for batch in batches:
            ids = model.encode(batch["word"].tolist(), num_threads=1)
            lengths = [len(one) for one in ids]
            flat = np.fromiter((i for one in ids for i in one), dtype=np.int64, count=sum(lengths))
            np.add.at(totals, flat, np.repeat(batch["c"].to_numpy(), lengths))
        used = np.flatnonzero(totals)
        yield pd.DataFrame({"piece": used, "n": totals[used]})

    training = counts.where((F.col("c") > 0) & (F.col("word") != END)).select("word", "c")
    found = training.mapInPandas(segment, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    ends = counts.where(F.col("word") == END).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    model = _load(path)
    usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i))]
    n = dict(found)
    total = math.log(sum(n.get(i, 0) + 1 for i in usable) + ends + 1)
    log = {i: math.log(n.get(i, 0) + 1) - total for i in usable}
    scores = {model.id_to_piece(i): log[i] for i in usable if not model.is_byte(i)}
    spelled = {int(model.id_to_piece(i)[3:5], 16): log[i] for i in usable if model.is_byte(i)}
    return Pieces(scores, [spelled.get(b, -total) for b in range(256)], math.log(ends + 1) - total)


def score_words(counts: DataFrame, pieces: Pieces) -> DataFrame:
    """The table of words with log10 of their probabilities: base (add-one unigram) and lattice."""
    shared = counts.sparkSession.sparkContext.broadcast(pieces)

    @F.pandas_udf("double")
    def lattice(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for words in batches:
            yield pd.Series([model.word(word) / math.log(10) for word in words], dtype="float64")

    tokens, distinct = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum((F.col("c") > 0).cast("long")), F.lit(0))
    ).first()
    base = F.log10((F.col("c") + 1) / F.lit(float(tokens + distinct + 1)))
    return counts.select(
        "word",
        "seen",
        (F.col("c") > 0).cast("long").alias("known"),
        base.alias("base"),
        lattice("word").alias("lattice"),
        F.lit(tokens).cast("long").alias("train_tokens"),
    )


def _hot(words: DataFrame, most: int) -> Column:
    """Condition for the most frequent words, `most` at most: whole classes of frequency, from the top."""
    bin_of = F.floor(F.log2("seen") * _BINS_PER_DOUBLING)
    total, lowest = 0, math.inf
    for row in words.groupBy(bin_of.alias("bin")).count().orderBy(F.desc("bin")).collect():
        total += row["count"]
        if total > most:
            break
        lowest = row["bin"]
    return bin_of >= F.lit(float(lowest))


def _key(word: Column) -> Column:
    """The word, or, for a long one, two blanks, `#` and its digest, which no word equals."""
    return F.when(F.char_length(word) <= KEY_LENGTH, word).otherwise(F.concat(F.lit(END * 2 + "#"), F.sha2(word, 256)))


def score(docs: DataFrame, training: Column, path: str | None = None, hot_words: int = HOT_WORDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10 of the text's probability) of every row."""
    path = path or tokenizer_path()
    counts = stored(count_words(docs, training), "word-counts")
    words = stored(score_words(counts, learn_pieces(counts, path)), "word-scores")
    hot = _hot(words, hot_words)
    train_tokens = F.lit(words.agg(F.max("train_tokens")).first()[0]).cast("long")

    # A text without a frequent word still needs a row, and rare words of one text are counted together: frequent words
    # fall under one key of the text, two blanks and its hash, which no key of the other table equals.
    content = [F.xxhash64("text").alias("content"), F.hash("text").alias("check")]
    named = docs.select(*content, F.concat(words_of(F.col("text")), F.array(F.lit(END))).alias("w"))
    tokens = named.select("content", "check", F.explode("w").alias("word")).select("content", "check", _key(F.col("word")).alias("key"))
    frequent = words.where(hot).select(_key(F.col("word")).alias("key"), "known", "base", "lattice")
    matched = tokens.join(F.broadcast(frequent), "key", "left")
    rare = F.when(F.col("known").isNull(), F.col("key")).otherwise(F.concat(F.lit(END * 2), F.col("content").cast("string")))
    parts = matched.groupBy("content", "check", rare.alias("rare")).agg(
        F.count("*").alias("n"),
        F.sum((F.col("key") == END).cast("long")).alias("ends"),
        *[F.sum(c).alias(f"hot_{c}") for c in ("known", "base", "lattice")],
    )
    others = words.where(~hot).select(_key(F.col("word")).alias("rare"), "known", "base", "lattice")
    joined = parts.join(others.hint("merge"), "rare", "left")

    def total(c: str) -> Column:
        return F.sum(F.coalesce(f"hot_{c}", F.lit(0)) + F.coalesce(F.col(c) * F.col("n"), F.lit(0)))

    # Each row has one end, so a text has as many rows as ends under its key.
    sums = joined.groupBy("content", "check").agg(
        F.sum("n").alias("n"), F.sum("ends").alias("rows"), *[total(c).alias(c) for c in ("known", "base", "lattice")]
    )
    single = sums.select(
        F.col("content").alias("of_content"),
        F.col("check").alias("of_check"),
        F.expr("n div rows").alias("n_tokens"),
        F.expr("known div rows").alias("n_known"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("lattice") / F.col("rows")).alias("score"),
    )
    same = (F.col("content") == F.col("of_content")) & (F.col("check") == F.col("of_check"))
    # A text that many rows have is a hot key of the rows, where adaptive execution splits it.
    scored = docs.select("doc_id", *content).join(single.hint("merge"), same)
    return scored.select("doc_id", "n_tokens", "n_known", train_tokens.alias("train_tokens"), "base_score", "score")

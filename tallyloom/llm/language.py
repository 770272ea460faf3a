"""Language identification by words first, then by ever shorter character n-grams.

A word that a language model knows scores its log frequency in each language. An unknown word is cut into n-grams (its
ends marked) of the longest length, and any n-gram that is unknown is replaced by its shorter parts, down to single
characters; what even those lack scores a floor. A text gets the language with the highest mean score over its words.

The model is fitted on a bounded sample: `sample` labelled rows of every language, and of each language and length the
most frequent entries, at most `vocabulary` and `entries` in all. Only whole classes of frequency are kept, so that no
order among equals matters. A word beyond the vocabulary counts as unknown and is scored by its n-grams.

Words are runs of letters (Unicode category L); digits, marks and numbers such as one half or a raised two are none.

Defined cases: texts that are null or have no letter are `und` with score 0; so is every text if nothing was learned;
equal scores go to the first language by name; repeated rows and rows without an id are returned one for one; columns
besides `doc_id`, `text` and, for learning, `lang` are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import join_small, sampled_each, stored

SAMPLE_ROWS = 5_000
VOCABULARY = 20_000
ENTRIES = 2_000_000
LENGTHS = (5, 4, 3, 2, 1)
#: Scores that a task keeps for words it has met, in numbers (words x languages).
_REMEMBERED = 4_000_000
#: Characters of text that are scored at a time.
_CHUNK_CHARS = 1 << 20
_BINS_PER_DOUBLING = 8

_WORDS = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")


def words(text: str) -> list[str]:
    lowered = text.lower()
    found = _WORDS.findall(lowered)
    # The quick pattern also takes numbers that are no digits.
    return found if "".join(found).isalpha() else _LETTERS.findall(lowered)


def grams(word: str, length: int) -> list[str]:
    """The word's n-grams of one length, ends marked by a blank; a shorter word is one n-gram."""
    marked = f" {word} " if length > 1 else word
    return [marked[i : i + length] for i in range(max(1, len(marked) - length + 1))]


@dataclass
class Table:
    """Log probabilities of the entries of one length: those an entry has, by its row, and those of languages without it."""

    rows: dict[str, int]
    starts: np.ndarray
    languages: np.ndarray
    scores: np.ndarray
    unseen: np.ndarray

    def get(self, entry: str) -> np.ndarray | None:
        row = self.rows.get(entry)
        if row is None:
            return None
        out = self.unseen.copy()
        own = slice(self.starts[row], self.starts[row + 1])
        out[self.languages[own]] = self.scores[own]
        return out


@dataclass
class Model:
    """Languages, and a table for words (length 0) and for n-grams of each length."""

    languages: list[str]
    tables: dict[int, Table] = field(default_factory=dict)
    floor: float = 0.0

    def of_gram(self, gram: str, length: int) -> np.ndarray:
        known = self.tables[length].get(gram) if length in self.tables else None
        if known is not None:
            return known
        if length <= 1 or len(gram) <= 1:
            return np.full(len(self.languages), self.floor)
        return (self.of_gram(gram[:-1], length - 1) + self.of_gram(gram[1:], length - 1)) / 2

    def of_word(self, word: str) -> np.ndarray:
        known = self.tables[0].get(word) if 0 in self.tables else None
        if known is not None:
            return known
        pieces = grams(word, LENGTHS[0])
        return sum(self.of_gram(piece, len(piece)) for piece in pieces) / len(pieces)


class Scorer:
    """Predicts languages of many texts at a time: words become rows of one matrix, whose rows are added up per text."""

    def __init__(self, model: Model):
        self.model = model
        self.most = max(1024, _REMEMBERED // max(1, len(model.languages)))
        self._forget()

    def _forget(self) -> None:
        self.row_of: dict[str, int] = {}
        self.matrix = np.empty((0, len(self.model.languages)))
        self.gram_row_of: dict[str, int] = {}
        self.grams: list[np.ndarray] = []

    def _gram_row(self, gram: str) -> int:
        row = self.gram_row_of[gram] = len(self.grams)
        self.grams.append(self.model.of_gram(gram, len(gram)))
        return row

    def _add(self, new: list[str]) -> None:
        """Rows for words that were not met before: known ones as they are, the others as means of their n-grams."""
        rows = np.empty((len(new), len(self.model.languages)))
        unknown: list[int] = []
        of_grams: list[int] = []
        sizes: list[int] = []
        table, known = self.model.tables.get(0), self.gram_row_of.get
        for i, word in enumerate(new):
            own = table.get(word) if table else None
            if own is not None:
                rows[i] = own
                continue
            pieces = grams(word, LENGTHS[0])
            of_grams += [row if (row := known(piece)) is not None else self._gram_row(piece) for piece in pieces]
            unknown.append(i)
            sizes.append(len(pieces))
        if unknown:
            size = np.array(sizes)
            sums = np.add.reduceat(np.array(self.grams)[np.array(of_grams)], np.cumsum(size) - size)
            rows[unknown] = sums / size[:, None]
        self.matrix = np.concatenate([self.matrix, rows])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language and score of every text."""
        if not self.model.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        if len(self.row_of) + len(self.grams) > self.most:
            self._forget()
        rows: list[int] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        row_of = self.row_of
        for i, text in enumerate(texts):
            if text:
                found = words(text)
                counts[i] = len(found)
                # a word that was not met before gets the next row
                rows += [row_of.setdefault(word, len(row_of)) for word in found]
        if len(row_of) > len(self.matrix):
            self._add(list(islice(row_of, len(self.matrix), None)))
        some = np.flatnonzero(counts)
        languages, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not len(some):
            return languages, scores
        starts = np.cumsum(counts[some]) - counts[some]
        total = np.add.reduceat(self.matrix[np.array(rows)], starts) / counts[some, None]
        best = total.argmax(1)
        scores[some] = 1 / np.exp(total - total[np.arange(len(some)), best][:, None]).sum(1)
        for i, language in zip(some.tolist(), best.tolist()):
            languages[i] = self.model.languages[language]
        return languages, scores


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, length, gram and n of the words (length 0) and n-grams of all rows (columns: lang, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            by_lang: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                by_lang[lang].update(words(text) if text else ())
            for lang, found in by_lang.items():
                counts: Counter = Counter()
                for word, n in found.items():
                    counts[0, word] += n
                    for length in LENGTHS:
                        for gram in grams(word, length):
                            counts[len(gram), gram] += n
                yield pd.DataFrame(
                    [(lang, length, gram, n) for (length, gram), n in counts.items()], columns=["lang", "length", "gram", "n"]
                )

    counted = rows.mapInPandas(count, "lang string, length int, gram string, n long")
    return counted.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, vocabulary: int) -> DataFrame:
    """Entries (with `total` of their language and length) in whole classes of frequency, `vocabulary` at most of each."""
    group = ["lang", "length"]
    bin_of = F.floor(F.log2("n") * _BINS_PER_DOUBLING).cast("int")
    bins = counts.groupBy(*group, bin_of.alias("bin")).agg(F.count("*").alias("entries"), F.sum("n").alias("n"))
    # Some hundred bins for each language and length, however many entries there are.
    from_top = Window.partitionBy(*group).orderBy(F.desc("bin"))
    ranked = bins.withColumns({"place": F.sum("entries").over(from_top), "total": F.sum("n").over(Window.partitionBy(*group))})
    lowest = F.min(F.when(F.col("place") <= vocabulary, F.col("bin"))).alias("lowest")
    limits = ranked.groupBy(*group).agg(lowest, F.first("total").alias("total")).where("lowest is not null")
    limits = limits.withColumnsRenamed({"lang": "of_lang", "length": "of_length"})
    same = (F.col("lang") == F.col("of_lang")) & (F.col("length") == F.col("of_length"))
    kept = join_small(counts, limits, same, "inner").where(bin_of >= F.col("lowest"))
    return kept.select("lang", "length", "gram", "n", "total")


def _tables(found: pd.DataFrame, languages: list[str]) -> dict[int, Table]:
    tables = {}
    sizes = found.drop_duplicates(["lang", "length"])
    most = max(found["total"].max(), 1)
    for length, part in found.groupby("length"):
        total = np.full(len(languages), most, dtype=float)
        of_length = sizes[sizes["length"] == length]
        total[np.searchsorted(languages, of_length["lang"].to_numpy())] = of_length["total"]
        row, entries = pd.factorize(part["gram"])
        order = np.argsort(row, kind="stable")
        starts = np.searchsorted(row[order], np.arange(len(entries) + 1))
        language = np.searchsorted(languages, part["lang"].to_numpy()[order])
        scores = np.log(part["n"].to_numpy()[order] / part["total"].to_numpy()[order])
        rows = {entry: i for i, entry in enumerate(entries)}
        tables[int(length)] = Table(rows, starts, language, scores, np.log(0.5 / total))
    return tables


def learn(
    docs: DataFrame,
    rows_to_learn: Column,
    sample: int = SAMPLE_ROWS,
    vocabulary: int = VOCABULARY,
    entries: int = ENTRIES,
) -> Model:
    """Fits a model on about `sample` rows of each language that meet the condition."""
    usable = docs.select("doc_id", "text", "lang").where(rows_to_learn & F.col("lang").isNotNull())
    counts = gram_counts(sampled_each(usable, "lang", F.struct("doc_id", "text"), sample).select("lang", "text"))
    counts = stored(counts, "gram-counts")
    groups = counts.select("lang", "length").distinct().count()
    found = _most_frequent(counts, min(vocabulary, entries // max(1, groups))).toPandas()
    languages = sorted(found["lang"].unique())
    if not languages:
        return Model([])
    return Model(languages, _tables(found, np.array(languages, dtype=object)), float(np.log(0.5 / found["total"].max())))


def identify(docs: DataFrame, model: Model, *kept: Column) -> DataFrame:
    """doc_id, the given columns, lang_pred and score (the best language's share of the likelihood per word)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            languages: list[str] = []
            scores: list[np.ndarray] = []
            chunk: list[str | None] = []
            held = 0
            for text in texts:
                chunk.append(text)
                held += len(text or "")
                if held >= _CHUNK_CHARS:
                    found, score = scorer.predict(chunk)
                    languages += found
                    scores.append(score)
                    chunk, held = [], 0
            found, score = scorer.predict(chunk)
            yield pd.DataFrame({"lang_pred": languages + found, "score": np.concatenate([*scores, score])})
            del texts

    rows = docs.select("doc_id", *kept, predict("text").alias("found"))
    return rows.select(*[c for c in rows.columns if c != "found"], "found.*")

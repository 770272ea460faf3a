"""Toxicity by compression distance.

Two zstandard dictionaries are made from a bounded sample of labelled texts. Both begin with the same part, trained by
zstandard on ordinary text, so that ordinary words cost the same under either. The toxic one ends with the words that
stand out in toxic text, the ordinary one with as many bytes that match nothing. Every text is cut into windows of 10
words; a window's saving is its compressed length under the ordinary dictionary less that under the toxic one. From
which saving on a window counts is calibrated on texts the dictionaries have not seen, and so is the score of a
document: a logistic function of its largest saving and of the number and share of its windows that count.

The pieces are chosen as in training by cover, with contrast: a run of MIN_MATCH bytes stands out if the lower bound of
its share of toxic contexts exceeds `RATIO` times the upper bound of its share of ordinary ones, and of the longest
stretches of such runs that which covers most of what is not covered yet comes next. A context is a word with its
neighbours, counted once per class, so that copies of a text count once.

Defined cases: null and empty texts have no windows and the score of a text without savings; labels that are null are
not learned from, and of repeated labels the larger counts, as does one text per id; without labels every score is 0.5,
with labels of one class only that class's share (as is the case if nothing stands out); repeated rows and rows without
an id are returned one for one; columns besides `doc_id` and `text` are not read. Texts are processed whole, in pieces
of at most `_PIECE_BYTES`, cut between windows.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_texts

WINDOW_WORDS = 10
#: Labelled rows that are learned from, at most, for each of the two labels, and the bytes of their texts in all.
SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 24 * 1024 * 1024
BASE_BYTES = 16 * 1024
TOXIC_BYTES = 2 * 1024
RATIO = 8.0
#: Standard deviations by which the bounds of the shares keep off the counts.
CONFIDENCE = 1.5
LEAST_CONTEXTS = 4
#: Pieces that stand out by less than this part of the most telling one are left out.
LEAST_WEIGHT = 0.01
#: Share of ordinary windows that may count.
FALSE_WINDOWS = 0.002
LEVEL = 5
MIN_MATCH = 5
_PIECE_BYTES = 1 << 20

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words of letters, A-Z lower-cased; every ASCII character that is no letter divides words."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows_of(words: Sequence[bytes]) -> list[bytes]:
    return [b" " + b" ".join(words[at : at + WINDOW_WORDS]) + b" " for at in range(0, len(words), WINDOW_WORDS)]


class Compressor:
    """Lengths of windows under one dictionary."""

    def __init__(self, dictionary: bytes):
        parameters = zstandard.ZstdCompressionParameters.from_level(
            LEVEL,
            min_match=MIN_MATCH,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=parameters)
        self._zstd = zstandard.ZstdCompressor(dict_data=content, compression_params=parameters)

    def lengths(self, windows: Sequence[bytes]) -> np.ndarray:
        out = self._zstd.multi_compress_to_buffer(windows, threads=0)
        return np.fromiter((len(out[i]) for i in range(len(out))), dtype=np.int64, count=len(windows))


@dataclass
class Model:
    """Both dictionaries, the saving from which a window counts, and the weights of the logistic function."""

    ordinary: bytes = b""
    toxic: bytes = b""
    threshold: int = 0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    constant: float | None = None

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if not name.startswith("_")}

    def savings(self, windows: Sequence[bytes]) -> np.ndarray:
        """Bytes each window is shorter by under the toxic dictionary."""
        if not hasattr(self, "_compressors"):
            self._compressors = Compressor(self.ordinary), Compressor(self.toxic)
        if not windows:
            return np.zeros(0, dtype=np.int64)
        ordinary, toxic = (one.lengths(windows) for one in self._compressors)
        return ordinary - toxic

    def features(self, texts: Sequence[str | None]) -> np.ndarray:
        """One row per text: largest saving, windows that count (logarithm), their share, and 1."""
        largest, counted, windows = (np.zeros(len(texts)) for _ in range(3))
        held: list[bytes] = []
        owners: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal size
            saved = self.savings(held)
            of = np.array(owners, dtype=np.int64)
            np.maximum.at(largest, of, saved)
            np.add.at(counted, of, saved >= self.threshold)
            held.clear(), owners.clear()
            size = 0

        for i, text in enumerate(texts):
            found = windows_of(words_of(text))
            windows[i] = len(found)
            for window in found:
                held.append(window)
                owners.append(i)
                size += len(window)
                if size >= _PIECE_BYTES:
                    flush()
        flush()
        share = counted / np.maximum(windows, 1)
        return np.column_stack([np.minimum(largest, 16) / 4, np.log1p(counted), np.sqrt(share) * 4, np.ones(len(texts))])

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return _sigmoid(self.features(texts) @ self.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _stretches(word: bytes, wanted: dict[bytes, float]) -> Iterator[bytes]:
    """The longest pieces of a word in which every run of MIN_MATCH bytes is wanted."""
    start = end = -1
    for at in range(len(word) - MIN_MATCH + 1):
        if word[at : at + MIN_MATCH] in wanted:
            start = at if start < 0 else start
            end = at + MIN_MATCH
        elif start >= 0:
            yield word[start:end]
            start = -1
    if start >= 0:
        yield word[start:end]


def standing_out(toxic: Sequence[str], ordinary: Sequence[str]) -> list[bytes]:
    """Pieces of words that stand out in toxic texts, the most telling first, as far as they fit into the dictionary."""

    def contexts(texts: Sequence[str]) -> Counter:
        seen: set[tuple[bytes, bytes, bytes]] = set()
        for text in texts:
            words = words_of(text)
            seen.update(zip([b"", *words[:-1]], words, [*words[1:], b""]))
        return Counter(word for _, word, _ in seen)

    def grams(words: Counter) -> Counter:
        counts: Counter = Counter()
        for word, n in words.items():
            word = b" " + word + b" "
            for gram in _grams(word):
                counts[gram] += n
        return counts

    words, other = contexts(toxic), contexts(ordinary)
    found, known = grams(words), grams(other)
    in_toxic, in_ordinary = max(sum(words.values()), 1), max(sum(other.values()), 1)
    wanted = {}
    for gram, n in found.items():
        m = known[gram]
        low, high = (n - CONFIDENCE * n**0.5) / in_toxic, (m + CONFIDENCE * (m + 1) ** 0.5) / in_ordinary
        if n >= LEAST_CONTEXTS and low > RATIO * high:
            wanted[gram] = low - high
    least = LEAST_WEIGHT * max(wanted.values(), default=0.0)
    wanted = {gram: weight for gram, weight in wanted.items() if weight >= least}
    pieces = {piece for word in words for piece in _stretches(b" " + word + b" ", wanted)}
    weights = {piece: sum(wanted[g] for g in _grams(piece)) for piece in pieces}
    waiting = [(-weight, piece) for piece, weight in weights.items()]
    heapq.heapify(waiting)
    covered: set[bytes] = set()
    taken: list[bytes] = []
    room = TOXIC_BYTES
    while waiting:
        weight, piece = heapq.heappop(waiting)
        now = -sum(wanted[g] for g in _grams(piece) if g not in covered)
        if now > weight + 1e-12:  # others have covered parts of it meanwhile
            if now < 0:
                heapq.heappush(waiting, (now, piece))
        elif len(piece) <= room:
            taken.append(piece)
            covered |= _grams(piece)
            room -= len(piece)
    return taken


def _grams(piece: bytes) -> set[bytes]:
    return {piece[at : at + MIN_MATCH] for at in range(len(piece) - MIN_MATCH + 1)}


def _base(texts: Sequence[str]) -> bytes:
    """The part of the dictionaries that zstandard trains on ordinary text; the text itself if that is too little."""
    samples = [window for text in texts for window in windows_of(words_of(text))]
    try:
        return zstandard.train_dictionary(BASE_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-BASE_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ weights)
        gradient = x.T @ (p - y) + ridge * weights
        curvature = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        weights -= np.linalg.solve(curvature, gradient)
    return weights


def fit(texts: Sequence[str], labels: Sequence[bool], share: float | None = None) -> Model:
    """Dictionaries from two of three texts, thresholds and score from the others.

    `share` is the share of toxic labels among all of them, if the sample has another.
    """
    y = np.array(labels, dtype=bool)
    share = share if share is not None or not len(y) else float(y.mean())
    if not len(y) or y.all() or not y.any():
        return Model(constant=0.5 if share is None else share)
    rank = np.empty(len(y), dtype=np.int64)  # place among the texts of the same label
    for label in (False, True):
        rank[y == label] = np.arange((y == label).sum())
    unseen = rank % 3 == 2
    if not (y & unseen).any() or not (~y & unseen).any():
        unseen[:] = True  # too few texts to keep some apart
    shown = ~unseen if not unseen.all() else unseen
    toxic = [text for text, label, use in zip(texts, y, shown) if use and label]
    ordinary = [text for text, label, use in zip(texts, y, shown) if use and not label]
    words = standing_out(toxic, ordinary)
    if not words:
        return Model(constant=share)
    tail = b"".join(reversed(words))
    base = _base(ordinary)
    model = Model(base + bytes(len(tail)), base + tail)
    plain = [window for text, label, use in zip(texts, y, unseen) if use and not label for window in windows_of(words_of(text))]
    saved = model.savings(plain)
    model.threshold = max(1, int(np.quantile(saved, 1 - FALSE_WINDOWS)) + 1) if len(saved) else 1
    tested = [text for text, use in zip(texts, unseen) if use]
    model.weights = _logistic(model.features(tested), y[unseen].astype(float))
    drawn = float(y[unseen].mean())
    model.weights[-1] += np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))
    return model


def learn(
    docs: DataFrame, labels: DataFrame, rows_to_learn: Column, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES
) -> Model:
    """Fits a model on at most `rows` texts of either label that meet the condition (on `doc_id`), `size` bytes in all."""
    usable = labels.where(rows_to_learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    usable = usable.groupBy("doc_id").agg((F.max("toxic") > 0).alias("label")).withColumn("stratum", F.col("label"))
    sample = bounded_texts(docs, usable, rows, size)
    share = usable.agg(F.avg(F.col("label").cast("double"))).first()[0]
    return fit([row.text for row in sample], [row.label for row in sample], share)


def score(docs: DataFrame, model: Model, *kept: Column, threshold: float = 0.5) -> DataFrame:
    """doc_id, the given columns, score and predicted (1 from the threshold on) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.scores(texts), dtype="float64")
            del texts

    scored = docs.select("doc_id", *kept, judge("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage is encoded (character classes, hashed character trigrams, word
statistics, a learned layer); gated attention, learned from document labels alone, weighs the passages; the score is that of
the weighted sum. Labels are learned from a bounded sample of labelled rows; every passage of every text is scored.

Defined cases: null and empty texts are one passage without words; labels that are null are not learned from, and of
repeated labels the larger counts, as does one text per id; with no usable labels every score is 0.5, with one class only that class's share;
repeated rows and rows without an id are returned one for one; columns besides `doc_id` and `text` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_texts

PASSAGE_WORDS = 64
SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 16 * 1024 * 1024
TRIGRAMS = 64
#: Bytes of text that are encoded at a time, and passages that are scored at a time.
_CHUNK_BYTES = 1 << 20
_BAG_PASSAGES = 4096

_BLANK, _LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL, _OTHER_ASCII, _HIGH, _LINE = range(9)
_CLASSES = 9
_WORD_STATS = 6
FEATURES = _CLASSES + _WORD_STATS + TRIGRAMS


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER_ASCII, dtype=np.int64)
    table[128:] = _HIGH
    for characters, kind in ((b" \t\x0b\x0c\r", _BLANK), (b"\n", _LINE), (b".,;:!?'\"()-", _STOP), (b"#*$%&|<>@=_+~^\\/{}[]`", _SYMBOL)):
        table[list(characters)] = kind
    table[ord("a") : ord("z") + 1] = _LOWER
    table[ord("A") : ord("Z") + 1] = _UPPER
    table[ord("0") : ord("9") + 1] = _DIGIT
    return table


_CLASS = _class_table()
_IS_BLANK = (_CLASS == _BLANK) | (_CLASS == _LINE)


def _pieces(text: bytes, size: int) -> tuple[int, Iterator[tuple[bytes, bytes]]]:
    """The number of words of a text, and the text in pieces of about `size` bytes, cut where a passage ends.

    Each piece comes with the two bytes behind it, which its last trigrams need.
    """
    blank = _IS_BLANK[np.frombuffer(text, dtype=np.uint8)]
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1]))) if len(text) else np.zeros(0, dtype=np.int64)
    cuts = [0]
    for start in starts[PASSAGE_WORDS::PASSAGE_WORDS].tolist():
        if start - cuts[-1] >= size:
            cuts.append(start)
    ends = [*cuts[1:], len(text)]
    return len(starts), ((text[x:y], text[y : y + 2]) for x, y in zip(cuts, ends))


def passage_features(text: bytes, n_words: int, before: np.uint64 | None = None, after: bytes = b"") -> tuple[np.ndarray, np.uint64 | None]:
    """One row of features per passage of a piece of a text, and the hash of its last word.

    `n_words` is the number of words of the whole text, `before` the hash of the word before the piece, `after` the
    bytes behind it. A piece without words is one passage.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    kinds = _CLASS[raw]
    blank = (kinds == _BLANK) | (kinds == _LINE)
    begins = ~blank & np.concatenate(([True], blank[:-1])) if len(raw) else np.zeros(0, dtype=bool)
    number = np.cumsum(begins)
    passage = np.maximum(number - 1, 0) // PASSAGE_WORDS
    n = int(passage[-1]) + 1 if len(raw) else 1
    out = np.zeros((n, FEATURES))
    if not len(raw):
        return out, before
    classes = np.bincount(passage * _CLASSES + kinds, minlength=n * _CLASSES).reshape(n, _CLASSES)
    length = np.maximum(classes.sum(1), 1)
    out[:, :_CLASSES] = classes / length[:, None]

    # Words: hashes of their bytes give repetition and variety.
    starts = np.flatnonzero(begins)
    if len(starts):
        inside = ~blank
        weights = (raw.astype(np.uint64) + 1) * np.uint64(0x9E3779B97F4A7C15)
        place = (np.arange(len(raw), dtype=np.uint64) - starts.astype(np.uint64)[np.maximum(number - 1, 0)] + 1) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = np.where(inside, (weights ^ place) * np.uint64(0xFF51AFD7ED558CCD), np.uint64(0))
        words = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts)
        sizes = np.add.reduceat(inside.astype(np.int64), starts)
        of_word = np.arange(len(words)) // PASSAGE_WORDS
        per = np.bincount(of_word, minlength=n)
        many = np.maximum(per, 1)
        mean = np.bincount(of_word, weights=sizes, minlength=n) / many
        same = np.concatenate(([before is not None and bool(words[0] == before)], words[1:] == words[:-1]))
        before = words[-1]
        order = np.lexsort((words, of_word))
        first = np.ones(len(words), dtype=bool)
        first[1:] = (words[order][1:] != words[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
        at = _CLASSES
        out[:, at] = per / PASSAGE_WORDS
        out[:, at + 1] = mean / 10
        out[:, at + 2] = np.bincount(of_word, weights=(sizes - mean[of_word]) ** 2, minlength=n) / many / 20
        out[:, at + 3] = np.bincount(of_word[order], weights=first, minlength=n) / many
        out[:, at + 4] = np.bincount(of_word, weights=same, minlength=n) / many
        out[:, at + 5] = np.log1p(n_words) / 10

    wide = np.concatenate((raw, np.frombuffer(after, dtype=np.uint8)))
    if len(wide) > 2:
        low = np.where(_CLASS[wide] == _UPPER, wide + 32, wide).astype(np.int64)
        trigrams = ((low[:-2] * 961 + low[1:-1] * 31 + low[2:]) * 2654435761 >> 12) % TRIGRAMS
        found = np.bincount(passage[: len(trigrams)] * TRIGRAMS + trigrams, minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
        out[:, -TRIGRAMS:] = np.sqrt(found / length[:, None])
    return out, before


def document_features(text: str | None, size: int = _CHUNK_BYTES) -> np.ndarray:
    """The features of all passages of a text; in how many pieces they are worked out makes no difference."""
    n_words, pieces = _pieces((text or "").encode("utf-8", "surrogatepass"), size)
    rows, last = [], None
    for piece, after in pieces:
        features, last = passage_features(piece, n_words, last, after)
        rows.append(features)
    return np.concatenate(rows)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the classifier."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, starts: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of bags whose passages are the rows of x from each start to the next."""
        w = self.weights
        z = (x - self.mean) / self.scale
        h = np.tanh(z @ w["encode"] + w["encode_b"])
        t, g = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
        logits = (t * g) @ w["attend"]
        sizes = np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        e = np.exp(logits - np.maximum.reduceat(logits, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        pooled = np.add.reduceat(a[:, None] * h, starts)
        out = pooled @ w["out"] + w["out_b"]
        if keep is not None:
            keep |= {"z": z, "h": h, "t": t, "g": g, "a": a, "bag": bag, "pooled": pooled}
        return out

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        starts = np.cumsum([0, *map(len, bags[:-1])])
        return _sigmoid(self.forward(np.concatenate(bags), starts))

    def gradients(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        k: dict[str, np.ndarray] = {}
        w = self.weights
        error = (_sigmoid(self.forward(x, starts, k)) - labels) / len(labels)
        d_pooled = error[:, None] * w["out"]
        along = (k["h"] * d_pooled[k["bag"]]).sum(1)
        mean_along = np.add.reduceat(k["a"] * along, starts)[k["bag"]]
        d_logit = k["a"] * (along - mean_along)
        d_t = d_logit[:, None] * w["attend"] * k["g"] * (1 - k["t"] ** 2)
        d_g = d_logit[:, None] * w["attend"] * k["t"] * k["g"] * (1 - k["g"])
        d_h = k["a"][:, None] * d_pooled[k["bag"]] + d_t @ w["tanh"].T + d_g @ w["gate"].T
        d_in = d_h * (1 - k["h"] ** 2)
        return {
            "encode": k["z"].T @ d_in,
            "encode_b": d_in.sum(0),
            "tanh": k["h"].T @ d_t,
            "gate": k["h"].T @ d_g,
            "attend": (k["t"] * k["g"]).T @ d_logit,
            "out": k["pooled"].T @ error,
            "out_b": error.sum(keepdims=True),
        }


def fit(bags: list[np.ndarray], labels: np.ndarray, width: int = 24, gates: int = 12, steps: int = 300) -> Model:
    """Fits the weights by full-batch Adam with a little weight decay."""
    if not len(bags) or labels.min() == labels.max():
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {}, float(labels.mean()) if len(bags) else 0.5)
    x = np.concatenate(bags)
    starts = np.cumsum([0, *map(len, bags[:-1])])
    random = np.random.default_rng(7)
    weights = {
        "encode": random.normal(0, FEATURES**-0.5, (FEATURES, width)),
        "encode_b": np.zeros(width),
        "tanh": random.normal(0, width**-0.5, (width, gates)),
        "gate": random.normal(0, width**-0.5, (width, gates)),
        "attend": random.normal(0, gates**-0.5, gates),
        "out": random.normal(0, width**-0.5, width),
        "out_b": np.zeros(1),
    }
    model = Model(x.mean(0), x.std(0) + 0.02, weights)
    first = {name: np.zeros_like(v) for name, v in weights.items()}
    second = {name: np.zeros_like(v) for name, v in weights.items()}
    for step in range(1, steps + 1):
        for name, d in model.gradients(x, starts, labels).items():
            d = d + 1e-4 * weights[name]
            first[name] = 0.9 * first[name] + 0.1 * d
            second[name] = 0.99 * second[name] + 0.01 * d * d
            weights[name] -= 0.02 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return model


def learn(docs: DataFrame, labels: DataFrame, rows_to_learn: Column, sample: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Model:
    """Fits a model on at most `sample` labelled texts, `size` bytes in all, that meet the condition (on `doc_id`)."""
    usable = labels.where(rows_to_learn & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    usable = usable.groupBy("doc_id").agg((F.max("quality") > 0).alias("label")).withColumn("stratum", F.lit(0))
    rows = bounded_texts(docs, usable, sample, size)
    return fit([document_features(row.text) for row in rows], np.array([float(row.label) for row in rows]))


def score(docs: DataFrame, model: Model, *kept: Column, threshold: float = 0.3) -> DataFrame:
    """doc_id, the given columns, score and predicted (1 from the threshold on) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found: list[float] = []
            bags: list[np.ndarray] = []
            held = 0
            for text in texts:
                bags.append(document_features(text))
                held += len(bags[-1])
                if held >= _BAG_PASSAGES:
                    found += shared.value.scores(bags).tolist()
                    bags, held = [], 0
            yield pd.Series(found + (shared.value.scores(bags).tolist() if bags else []), dtype="float64")

    rows = docs.select("doc_id", *kept, judge("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""Secrets in texts: known forms by pattern, other random strings by their token efficiency.

Readable strings are covered by long tokens of a byte-pair vocabulary, random ones by short tokens. A candidate (a run of
letters, digits and ``+/_=-``) whose characters per token stay below a threshold is a secret of kind ``random``, unless it
is a known digest (hexadecimal of a usual digest length, UUID), an alphabet, or an identifier (words, numbers and path
parts joined by separators, each covered by few tokens). Digits alone stay above the threshold and are no secrets.

Defined cases: null and empty texts have no spans; offsets are code points, ends exclusive; repeated rows and rows
without an id are returned one for one; columns besides `doc_id` and `text` are not read by `scan`, and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import unused

TOKENIZER = "byte_bpe_50k.tiktoken"
CHARS_PER_TOKEN = 2.0
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Texts without any of these have no span; Java's syntax, case-blind for ASCII where marked.
_PREFILTER = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[A-Za-z0-9+/_=-]{20,}"
_DIGEST = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|([0-9a-fA-F]{8}){4,16}")
_DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
_SEPARATORS = re.compile(r"[+/_=-]+")
#: Parts of identifiers: words with a number behind them, numbers, days and times.
_WORD_PART = re.compile(r"[A-Za-z]+[0-9]{0,4}")
_NUMBER_PART = re.compile(r"[0-9]{1,8}(T[0-9]{1,6})?Z?")

_SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def is_digest(text: str) -> bool:
    """Whether a string has the form of a digest or UUID, and so is no secret by itself."""
    return bool(_DIGEST.fullmatch(text)) and (text.count("-") == 4 or len(text) in _DIGEST_LENGTHS)


def is_sequence(text: str) -> bool:
    """Whether four fifths of a string's characters repeat or follow the one before, as in an alphabet."""
    return 5 * sum(ord(b) - ord(a) in (0, 1) for a, b in pairwise(text)) >= 4 * (len(text) - 1)


def is_identifier(text: str, count_tokens=None) -> bool:
    """Whether a string has parts between separators, and words covered by few tokens and numbers make up all but a fifth."""
    parts = [part for part in _SEPARATORS.split(text) if part]
    if len(parts) < 2:
        return False
    count_tokens = count_tokens or load_counter(vocabulary_path())

    def readable(part: str) -> bool:
        few = (len(part) + 1) // 2
        return bool(_NUMBER_PART.fullmatch(part)) or bool(_WORD_PART.fullmatch(part)) and count_tokens(part) <= few

    return 5 * sum(len(part) for part in parts if readable(part)) >= 4 * sum(map(len, parts))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def random_spans(text: str, count_tokens, chars_per_token: float = CHARS_PER_TOKEN) -> list[tuple[int, int, str]]:
    """Candidates that the vocabulary cannot cover with long tokens."""
    found = []
    for m in _CANDIDATE.finditer(text):
        word = m[0]
        if len(word) >= chars_per_token * count_tokens(word) or is_digest(word) or is_sequence(word):
            continue
        if not is_identifier(word, count_tokens):
            found.append((*m.span(), "random"))
    return found


def load_counter(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def vocabulary_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _all_spans(text: str, count_tokens, chars_per_token: float):
    base = base_spans(text)
    both = base + random_spans(text, count_tokens, chars_per_token)
    return base, sorted(both, key=lambda span: (span[0], KINDS.index(span[2])))


def _candidate_text(text: Column) -> Column:
    return F.when(text.rlike(_PREFILTER), text)


def scan(docs: DataFrame, path: str | None = None, chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (digest of the known forms' spans) and spans (all of them)."""
    path = path or vocabulary_path()

    @F.pandas_udf(_SCHEMA)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        count_tokens = load_counter(path)
        empty = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
        for texts in batches:
            rows = []
            for text in texts:
                if not text:
                    rows.append(empty)
                    continue
                base, both = _all_spans(text, count_tokens, chars_per_token)
                kinds = [kind for *_, kind in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*(kinds.count(kind) for kind in KINDS[:3]), digest, _joined(both)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    found = docs.select("doc_id", find(_candidate_text(F.col("text"))).alias("found"))
    return found.select("doc_id", "found.*")


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    merged: list[tuple[int, int, str]] = []
    for start, end, kind in spans:
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]), merged[-1][2])
        else:
            merged.append((start, end, kind))
    parts, at = [], 0
    for start, end, kind in merged:
        parts += [text[at:start], f"<{kind}>"]
        at = end
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, path: str | None = None, chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """The same rows and columns, secrets in `text` masked; texts without any stay as they are."""
    path = path or vocabulary_path()

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count_tokens = load_counter(path)
        for texts in batches:
            yield pd.Series([t and masked(t, _all_spans(t, count_tokens, chars_per_token)[1]) for t in texts], dtype=object)

    new = unused(docs.columns, "masked_text")
    with_mask = docs.withColumn(new, mask(_candidate_text(F.col("text"))))
    kept = [F.coalesce(new, "text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return with_mask.select(*kept)

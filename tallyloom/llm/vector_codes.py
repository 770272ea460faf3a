"""Vector codes by product quantisation, with codebooks from an exact Lloyd iteration over integers.

Components become floor(1024 x); a vector is cut into equal consecutive parts, and each part position has a codebook that
begins with that part of the vectors with the smallest ids. A round assigns every part to its nearest entry (squared
distance, ties to the lower index) and moves every entry to the componentwise floor of its parts' mean.

Rounds after the first compare as little as they must. Stored with every vector are the index and the exact distance of
each part's entry. Where that entry did not move, its distance still holds and only the entries that moved are compared with
it, one at an equal distance winning by a lower index; where it did move, all entries are compared. The results are those
of full scans. Sums and counts per entry come from the stored assignments, added up in each task before they are shuffled; the
driver holds the codebooks (parts x entries x components) and nothing that grows with the rows.

Defined cases: vectors that are null or have null or non-finite components are dropped. Rows without an id are coded, but
come last where codebooks begin; among equal ids the order of the components decides. Vectors that cannot be coded with the
others keep their row with null code and error and take no part in the training: those of another length than the
first (that with the smallest id), and those with a component beyond +-65,536, whose squares could leave 64 bits. A
length that is not a multiple of the number of parts raises ValueError. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored
from tallyloom.operators.lookup import Lookup, lookup_join

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST = 1 << 26
#: Up to this size of components all terms of a squared distance are whole numbers below 2**53.
_EXACT_IN_DOUBLE = 1 << 21
_ROWS_AT_A_TIME = 4096

State = "vec_id long, label int, parts array<int>, entries array<int>, distances array<long>"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and components (array<long>, null where they are too large) of the vectors that are not dropped."""
    present = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    fits = F.forall("embedding", lambda x: F.abs(x.cast("double")) < LARGEST // SCALE)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return vectors.where(present).select("vec_id", "label", F.when(fits, whole).alias("parts"))


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Codebooks (parts x entries x components) from the vectors with the smallest ids."""
    smallest = rows.where("parts is not null").orderBy(F.col("vec_id").asc_nulls_last(), "parts").limit(entries).collect()
    if not smallest:
        return np.zeros((parts, 0, 0), dtype=np.int64)
    length = len(smallest[0].parts)
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    chosen = np.array([row.parts for row in smallest if len(row.parts) == length], dtype=np.int64)
    return np.ascontiguousarray(chosen.reshape(len(chosen), parts, -1).transpose(1, 0, 2))


def distances(x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of `x` from the entries."""
    if not len(x) or not len(codebook):
        return np.zeros((len(x), len(codebook)), dtype=np.int64)
    if max(np.abs(x).max(), np.abs(codebook).max()) < _EXACT_IN_DOUBLE:
        a, b = x.astype(np.float64), codebook.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.empty((len(x), len(codebook)), dtype=np.int64)
    for j, entry in enumerate(codebook):
        apart = x - entry
        out[:, j] = (apart * apart).sum(1)
    return out


def scan(x: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and its distance by comparing all entries; argmin takes the first of equals."""
    d = distances(x, codebook)
    nearest = d.argmin(1)
    return nearest, d[np.arange(len(x)), nearest]


def assign(
    x: np.ndarray, codebook: np.ndarray, moved: np.ndarray, entry: np.ndarray, distance: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries after those in `moved` (indexes, ascending) changed, from what was nearest before."""
    entry, distance = entry.copy(), distance.copy()
    is_moved = np.zeros(len(codebook), dtype=bool)
    is_moved[moved] = True
    again = is_moved[entry]
    if again.any():
        entry[again], distance[again] = scan(x[again], codebook)
    fixed = np.flatnonzero(~again)
    if len(fixed) and len(moved):
        near, d = scan(x[fixed], codebook[moved])
        rival = moved[near]
        better = (d < distance[fixed]) | ((d == distance[fixed]) & (rival < entry[fixed]))
        entry[fixed[better]], distance[fixed[better]] = rival[better], d[better]
    return entry, distance


def _lists(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _list_array(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), type=kind))


def _by_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_AT_A_TIME):
            yield batch.slice(at, _ROWS_AT_A_TIME)


def _assigner(codebooks: np.ndarray, moved: list[np.ndarray] | None) -> Callable:
    """For mapInArrow: the rows with their entries under the codebooks. Without `moved` every part is scanned."""
    parts, _, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_rows(batches):
            x = _lists(batch, "parts", parts * width).astype(np.int64)
            entries = np.empty((len(x), parts), dtype=np.int64)
            found = np.empty((len(x), parts), dtype=np.int64)
            if moved is not None:
                old, old_distances = (_lists(batch, name, parts).astype(np.int64) for name in ("entries", "distances"))
            for p in range(parts):
                part = x[:, p * width : (p + 1) * width]
                if moved is None:
                    entries[:, p], found[:, p] = scan(part, codebooks[p])
                else:
                    entries[:, p], found[:, p] = assign(part, codebooks[p], moved[p], old[:, p], old_distances[:, p])
            columns = [batch.column(name) for name in ("vec_id", "label", "parts")]
            columns += [_list_array(entries, pa.int32()), _list_array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "parts", "entries", "distances"])

    return run


def _summed(parts: int, entries: int, width: int) -> Callable:
    """For mapInArrow: per part and entry the sums and number of its parts, one row for each in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), dtype=np.int64)
        counts = np.zeros(parts * entries, dtype=np.int64)
        for batch in _by_rows(batches):
            x = _lists(batch, "parts", parts * width).reshape(-1, width)
            cells = (_lists(batch, "entries", parts).astype(np.int64) + np.arange(parts) * entries).ravel()
            order = np.argsort(cells, kind="stable")
            starts = np.flatnonzero(np.diff(cells[order], prepend=-1))
            if len(starts):
                sums[cells[order][starts]] += np.add.reduceat(x[order].astype(np.int64), starts)
                counts += np.bincount(cells, minlength=parts * entries)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(counts[used]), _list_array(sums[used], pa.int64())], names=["cell", "n", "sums"]
            )

    return run


def updated(state: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks with every entry moved to the floor of its parts' mean; entries without parts stay."""
    parts, entries, width = codebooks.shape
    rows = state.select("parts", "entries").mapInArrow(_summed(parts, entries, width), "cell long, n long, sums array<long>")
    totals = rows.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    new = codebooks.copy().reshape(parts * entries, width)
    for row in totals.collect():  # at most parts x entries rows
        new[row.cell] = [row[f"s{i}"] // row.n for i in range(width)]
    return new.reshape(codebooks.shape)


def moved_entries(old: np.ndarray, new: np.ndarray) -> list[np.ndarray]:
    """For every part position the indexes of the entries that differ."""
    return [np.flatnonzero((a != b).any(1)) for a, b in zip(old, new)]


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def coded(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """The usable vectors with their code and error, and the final codebooks.

    Columns: vec_id, label, entries (array<int>), distances (array<long>), code, error; the last four are null for
    vectors that cannot be coded. Each round's assignments are written to the shared folder.
    """
    rows = stored(usable(vectors), "vectors")
    codebooks = first_codebooks(rows, parts, entries)
    length = codebooks.shape[0] * codebooks.shape[2]
    fits = F.coalesce(F.size("parts") == length, F.lit(False)) if codebooks.shape[1] else F.lit(False)
    state = rows.where(fits)
    moved = None
    for _ in range(rounds if codebooks.shape[1] else 0):
        state = stored(state.mapInArrow(_assigner(codebooks, moved), State), "assignments")
        new = updated(state, codebooks)
        moved, codebooks = moved_entries(codebooks, new), new
    nothing = (F.lit(None).cast("array<int>").alias("entries"), F.lit(None).cast("array<long>").alias("distances"))
    final = rows.where(~fits).select("vec_id", "label", *nothing)
    if codebooks.shape[1]:
        last = stored(state.mapInArrow(_assigner(codebooks, moved), State).drop("parts"), "assignments")
        final = last.unionByName(final)
    hexadecimal = F.array_join(F.transform("entries", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda total, d: total + d)
    return final.withColumns({"code": hexadecimal, "error": error}), codebooks


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds the sum of `error` over the rows of the same label (nulls together)."""
    named = codes.withColumn("label_key", F.coalesce(F.col("label").cast("string"), F.lit("none")))
    sums = named.groupBy("label_key").agg(F.sum("error").alias("label_error"))
    return lookup_join(named, Lookup(sums, "label_key", {"label_error": "label_error"}), "label_key").drop("label_key")

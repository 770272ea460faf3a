"""Joining a large frame with a smaller one: lookups (left), exclusions (left anti), restrictions (left semi).

The smaller side is broadcast only after its size has been measured. Beyond the limit the join is done by a shuffle, for
which the keys of the large side are sketched first (a bounded approximate top list): the rows of a key that would fill
a large part of a task are spread over many tasks, and only that key's rows of the other side are repeated for them. Rows
with a null key, which meet nothing, are spread alike, or, where they are many, not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import ColumnOrName, column

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
#: A frequent key is dealt out to so many tasks.
SALTS = 64
#: The most keys that are dealt out, and the counters of the sketch that finds them.
HOT_KEYS = 256
SKETCH_COUNTERS = 8192
#: From this share on, rows with a null key are read apart instead of being shuffled.
MANY_NULLS = 0.1
_CELL_OVERHEAD_BYTES = 32


class Lookup:
    """The part of a lookup table that a join needs: its key, the wanted columns and a row condition.

    Keys may repeat; every match gives a row, as a left join does.
    """

    def __init__(
        self,
        table: DataFrame,
        key: ColumnOrName,
        values: Mapping[str, ColumnOrName],
        where: Column | None = None,
    ):
        kept = table if where is None else table.where(where)
        self.values = list(values)
        self.frame = kept.select(
            column(key).alias("lookup_key"), *[column(source).alias(name) for name, source in values.items()]
        ).where(F.col("lookup_key").isNotNull())
        self.measured_bytes: int | None = None


def size_query(df: DataFrame) -> DataFrame:
    """One row with the size of all cells of `df` in bytes (column: bytes)."""
    row_bytes = reduce(
        lambda total, name: total + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)),
        df.columns,
        F.lit(_CELL_OVERHEAD_BYTES * len(df.columns)).cast("bigint"),
    )
    return df.select(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes"))


def size_in_bytes(df: DataFrame) -> int:
    """Measured size of a frame. Runs one aggregate over it."""
    return int(size_query(df).first()["bytes"])


def measure(*lookups: Lookup) -> None:
    """Measure the lookups that have not been measured yet, all in one job."""
    unmeasured = [one for one in lookups if one.measured_bytes is None]
    if unmeasured:
        sizes = [size_query(one.frame).select(F.lit(i).alias("i"), "bytes") for i, one in enumerate(unmeasured)]
        for row in reduce(DataFrame.unionByName, sizes).collect():
            unmeasured[row["i"]].measured_bytes = int(row["bytes"])


Pairs = Sequence[tuple[ColumnOrName, ColumnOrName]]


@dataclass(frozen=True)
class KeySketch:
    """Hashes of the frequent keys of a frame, and the share of its rows that lack a key."""

    hot: tuple[int, ...] = ()
    null_share: float = 0.0


def lookup_join(
    df: DataFrame,
    lookup: Lookup,
    on: str,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    salt_by: Sequence[str] | None = None,
    sketch: KeySketch | None = None,
) -> DataFrame:
    """`df` with the lookup's columns added; rows without a match keep nulls, several matches multiply rows.

    Measures the lookup on first use (one small job). If it is too large to broadcast, spread_join is used, with the
    given sketch or one made here.
    """
    clash = set(lookup.values) & set(df.columns)
    if clash:
        raise ValueError(f"lookup columns already present: {sorted(clash)}")
    measure(lookup)
    pairs = [(on, "lookup_key")]
    if lookup.measured_bytes <= broadcast_limit:
        joined = df.join(F.broadcast(lookup.frame), _condition(pairs), "left")
    else:
        joined = spread_join(df, lookup.frame, pairs, "left", salt_by=salt_by, sketch=sketch)
    return joined.drop("lookup_key")


def exclude(
    df: DataFrame,
    keys: DataFrame,
    on: Pairs,
    null_safe: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of `df` that no row of `keys` equals in all pairs of columns (left anti join).

    With `null_safe` nulls are equal to each other. Measures `keys` (one small job).
    """
    return _filter_join(df, keys, on, "left_anti", null_safe, broadcast_limit, salt_by)


def restrict(
    df: DataFrame,
    keys: DataFrame,
    on: Pairs,
    null_safe: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of `df` that some row of `keys` equals in all pairs of columns (left semi join).

    With `null_safe` nulls are equal to each other. Measures `keys` (one small job).
    """
    return _filter_join(df, keys, on, "left_semi", null_safe, broadcast_limit, salt_by)


def _filter_join(
    df: DataFrame, keys: DataFrame, on: Pairs, how: str, null_safe: bool, broadcast_limit: int, salt_by: Sequence[str] | None
) -> DataFrame:
    if size_in_bytes(keys) <= broadcast_limit:
        return df.join(F.broadcast(keys), _condition(on, null_safe), how)
    return spread_join(df, keys, on, how, null_safe, salt_by)


def _condition(on: Pairs, null_safe: bool = False) -> Column:
    same = [column(a).eqNullSafe(column(b)) if null_safe else column(a) == column(b) for a, b in on]
    return reduce(lambda one, other: one & other, same)


def _hash(columns: Iterable[ColumnOrName]) -> Column:
    return F.xxhash64(*[column(c) for c in columns])


def _lacking(columns: Iterable[ColumnOrName]) -> Column:
    return reduce(lambda one, more: one | more, [column(c).isNull() for c in columns])


def sketch_keys(
    df: DataFrame, *keys: Sequence[ColumnOrName], null_safe: bool = False, share: float | None = None, most: int = HOT_KEYS
) -> list[KeySketch]:
    """For each key (its columns) the hashes that make up about `share` of the rows or more, and the share of nulls.

    One aggregation for all keys, with sketches of bounded size that count a key at least as often as it occurs. The
    usual share is half of what a task gets. With `null_safe` a null is a key like any other.
    """
    share = 0.5 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if share is None else share
    hashes = [_hash(key) if null_safe else F.when(~_lacking(key), _hash(key)) for key in keys]
    lacking = [_lacking(key).alias(f"lacks{i}") for i, key in enumerate(keys)]
    hashed = df.select(*[one.alias(f"key{i}") for i, one in enumerate(hashes)], *lacking)
    found = hashed.agg(
        F.count("*").alias("n"),
        *[F.expr(f"approx_top_k(key{i}, {most}, {max(SKETCH_COUNTERS, most)})").alias(f"top{i}") for i in range(len(keys))],
        *[F.count_if(f"lacks{i}").alias(f"nulls{i}") for i in range(len(keys))],
    ).first()
    n = max(found["n"], 1)
    return [
        KeySketch(
            tuple(one["item"] for one in found[f"top{i}"] or [] if one["item"] is not None and one["count"] >= share * n),
            found[f"nulls{i}"] / n,
        )
        for i in range(len(keys))
    ]


def spread_join(
    df: DataFrame,
    other: DataFrame,
    on: Pairs,
    how: str,
    null_safe: bool = False,
    salt_by: Sequence[str] | None = None,
    sketch: KeySketch | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left, left anti or left semi join by shuffle, for a right side that is too large to broadcast.

    The rows of a frequent key are sent by (key, salt) to `salts` tasks, and its rows in `other` are repeated that often;
    all other rows of `other` are sent once. `salt_by` names columns that tell rows with the same key apart (default:
    all); exact copies share a salt, and adaptive skew handling splits such a partition.
    """
    left, right = [a for a, _ in on], [b for _, b in on]
    sketch = sketch or sketch_keys(df, left, null_safe=null_safe)[0]
    lacks = _lacking(left)
    apart = not null_safe and sketch.null_share >= MANY_NULLS
    meeting = df.where(~lacks) if apart else df
    salt = F.pmod(F.xxhash64(*[F.col(_quoted(c)) for c in (salt_by or df.columns)]), F.lit(salts)).cast("int")
    dealt = _hash(left).isin(*sketch.hot) if sketch.hot else F.lit(False)
    if not null_safe and not apart:
        dealt = dealt | lacks  # they meet nothing, whatever their salt
    salted = meeting.withColumn("row_salt", F.when(dealt, salt).otherwise(0))
    # The hint keeps the optimiser's own size estimate from broadcasting the rows after all.
    same = _condition(on, null_safe) & (F.col("row_salt") == F.col("other_salt"))
    joined = salted.join(repeated(other, right, sketch.hot, salts).hint("merge"), same, how).drop("row_salt", "other_salt")
    if not apart or how == "left_semi":
        return joined
    return joined.unionByName(df.where(lacks), allowMissingColumns=True)


def repeated(other: DataFrame, key: Sequence[ColumnOrName], hot: Sequence[int], salts: int = SALTS) -> DataFrame:
    """`other` with a column other_salt: a row for each salt for frequent keys, one row (salt 0) for all others."""
    if not hot:
        return other.withColumn("other_salt", F.lit(0))
    copies = F.when(_hash(key).isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return other.withColumn("other_salt", F.explode(copies))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"

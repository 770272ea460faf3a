"""Chat formatting: repair of role sequences at minimum cost, then rendering.

A legal conversation is an optional system turn, then user and assistant turns in alternation, user first and assistant
last. Dynamic programming over that automaton chooses, for each turn, to keep it, relabel it, merge it into the turn
before, or insert empty turns ahead of it, at the least total cost; equal costs go to the first action in the order
keep, relabel, merge, merge under another role, then fewer insertions. Turns are worked on in blocks of 256 turns:
a block is reduced to a small matrix of costs between states, the matrices of a conversation are combined, and
every block is then repaired by itself between its two known states. So no task holds a long conversation's texts.

Conversations of one block need no numbering. The turns of longer ones are numbered in order, whatever their turn numbers:
they are sorted in ranges that may end within a conversation, and the counts of earlier ranges are added.

Every returned row is a source turn or an inserted one; the `rendered` parts of a conversation, in order of
(block, place), are its formatted text.

Defined cases: roles are compared without case and outer blanks, with common other names; a null or unknown role can
become any role cheaply; null texts are empty; null turn numbers come first; turns with the same number are taken
in order of role and text, repeated rows one after the other; turns without a conversation id form one conversation;
columns besides `conv_id`, `turn`, `role` and `text` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import BROADCAST_LIMIT_BYTES, join_small, stored

BLOCK_TURNS = 256
#: Ranges are cut by so many characters of a text; the samples that find the cuts go to the driver.
_PREFIX_CHARS = 64
ROLES = ("system", "user", "assistant")
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "ai": "assistant", "model": "assistant", "gpt": "assistant", "developer": "system"}
START, SYSTEM, USER, ASSISTANT = range(4)
RELABEL, RELABEL_UNKNOWN, MERGE, INSERT = 4, 1, 2, 6
_FAR = 1 << 40
#: Bits of monotonically_increasing_id that number the rows of a partition.
_ROW_BITS = 33

#: States that may follow a state.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def known_role(role: str | None) -> int | None:
    """State number of a role, None if it is not known."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else None


def _fill(state: int, wanted: int) -> list[int] | None:
    """The fewest empty turns to insert after `state` so that a turn in state `wanted` may follow."""
    paths = [(state, [])]
    for _ in range(4):
        for at, path in paths:
            if wanted in NEXT[at]:
                return path
        paths = [(after, [*path, after]) for at, path in paths for after in NEXT[at] if after != SYSTEM]
    return None


def _choices(role: int | None, state: int) -> list[tuple[int, int, str, list[int]]]:
    """What may be done with a turn of a role after a state: (cost, state afterwards, action, insertions before)."""
    found = []
    for target in (SYSTEM, USER, ASSISTANT):
        change = 0 if target == role else RELABEL_UNKNOWN if role is None else RELABEL
        inserted = _fill(state, target)
        if inserted is not None:
            found.append((change + INSERT * len(inserted), target, "keep" if not change else "relabel", inserted))
    if state != START:
        change = 0 if state == role else RELABEL_UNKNOWN if role is None else RELABEL
        found.append((MERGE + change, state, "merge" if not change else "merge_relabel", []))
    rank = ("keep", "relabel", "merge", "merge_relabel")
    return sorted(found, key=lambda c: (c[0], rank.index(c[2]), len(c[3]), c[1]))


_CHOICES = {(role, state): _choices(role, state) for role in (None, SYSTEM, USER, ASSISTANT) for state in range(4)}


def closing(state: int) -> list[int]:
    """Empty turns that end a conversation legally after a state."""
    if state in (START, ASSISTANT):
        return []
    return [*(_fill(state, ASSISTANT) or []), ASSISTANT]


def block_costs(roles: list[str | None]) -> list[int]:
    """Least costs from each of the four states before the turns to each after them, row by row."""
    matrix = []
    numbers = [known_role(role) for role in roles]
    for entry in range(4):
        costs = [_FAR] * 4
        costs[entry] = 0
        for role in numbers:
            after = [_FAR] * 4
            for state in range(4):
                if costs[state] < _FAR:
                    for cost, target, *_ in _CHOICES[role, state]:
                        after[target] = min(after[target], costs[state] + cost)
            costs = after
        matrix += costs
    return matrix


def boundary_states(matrices: list[list[int]]) -> list[int]:
    """The state before each block and after the last one, on a path of least cost; the smallest states on ties."""
    left = [INSERT * len(closing(state)) for state in range(4)]
    remaining = [left]
    for matrix in reversed(matrices):
        left = [min(matrix[4 * a + b] + left[b] for b in range(4)) for a in range(4)]
        remaining.append(left)
    remaining.reverse()
    states = [START]
    for matrix, after in zip(matrices, remaining[1:], strict=True):
        at = states[-1]
        states.append(min(range(4), key=lambda b: (matrix[4 * at + b] + after[b], b)))
    return states


def repair_block(roles: list[str | None], entry: int, leave: int) -> list[tuple[int, str, list[int]]]:
    """Per turn: its state, the action and the states of the turns inserted before it, from one state to another."""
    numbers = [known_role(role) for role in roles]
    left = [_FAR] * 4
    left[leave] = 0
    table = [left]
    for role in reversed(numbers):
        left = [min((cost + table[-1][target] for cost, target, *_ in _CHOICES[role, state]), default=_FAR) for state in range(4)]
        table.append(left)
    table.reverse()
    state, found = entry, []
    for role, after in zip(numbers, table[1:], strict=True):
        _, state, action, inserted = min(_CHOICES[role, state], key=lambda c: c[0] + after[c[1]])
        found.append((state, action, inserted))
    return found


def _render(state: int, text: str, first: bool) -> str:
    return f"{'' if first else '<|end|>\n'}<|{ROLES[state - 1]}|>\n{text}"


def rendered_rows(turns: list[dict], entry: int, leave: int, last: bool) -> list[tuple]:
    """Rows of one block: (turn, role_before, role, action, rendered)."""
    rows: list[tuple] = []
    first = entry == START

    def insert(states: list[int]) -> None:
        nonlocal first
        for state in states:
            rows.append((None, None, ROLES[state - 1], "insert", _render(state, "", first)))
            first = False

    repairs = repair_block([turn["role"] for turn in turns], entry, leave)
    for turn, (state, action, inserted) in zip(turns, repairs, strict=True):
        insert(inserted)
        text = turn["text"] or ""
        part = f"\n\n{text}" if action.startswith("merge") else _render(state, text, first)
        rows.append((turn["turn"], turn["role"], ROLES[state - 1], action, part))
        first = False
    if last:
        insert(closing(leave))
        rows[-1] = (*rows[-1][:-1], rows[-1][-1] + "<|end|>\n")
    return rows


@F.pandas_udf(T.ArrayType(T.LongType()))
def _costs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for blocks in batches:
        yield pd.Series([block_costs([turn["role"] for turn in turns]) for turns in blocks])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _states(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for conversations in batches:
        yield pd.Series([boundary_states([list(matrix) for matrix in one]) for one in conversations])


def _numbered(turns: DataFrame, limit: int) -> DataFrame:
    """The turns with their block: their place in the conversation, by turn, role and text, divided by the block size."""
    prefix = F.substring("text", 1, _PREFIX_CHARS)
    # Equal turns may be parted; longer texts with an equal start stay in one range, as only the sort tells their order.
    lot = F.when(F.char_length(F.coalesce("text", F.lit(""))) <= _PREFIX_CHARS, F.monotonically_increasing_id()).otherwise(-1)
    ranges = turns.withColumn("lot", lot).repartitionByRange("conv_id", "turn", "role", prefix, "lot").drop("lot")
    ordered = ranges.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("id", F.monotonically_increasing_id())
    ordered = stored(ordered.withColumn("range", F.shiftrightunsigned("id", _ROW_BITS)), "ordered-turns")
    parts = ordered.groupBy("conv_id", "range").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low")
    shifts = stored(parts.select(F.col("conv_id").alias("of_conv"), F.col("range").alias("of_range"), before.alias("shift")), "ranges")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("range") == F.col("of_range"))
    block = F.floor((F.col("id") + F.col("shift")) / BLOCK_TURNS).cast("long")
    return join_small(ordered, shifts, same, "inner", limit).select("conv_id", block.alias("block"), "turn", "role", "text")


def _blocked(turns: DataFrame, limit: int) -> DataFrame:
    """conv_id, block, turn, role and text of every turn; no block has more than its turns."""
    turns = turns.select("conv_id", "turn", "role", "text")
    first = F.lit(0).cast("long").alias("block")
    long = turns.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_TURNS)
    long = stored(long.select(F.col("conv_id").alias("long_conv"), F.lit(True).alias("is_long")), "long-conversations")
    if long.isEmpty():
        return turns.select("conv_id", first, "turn", "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("long_conv"))
    short = join_small(turns, long, same, "left_anti", limit).select("conv_id", first, "turn", "role", "text")
    return short.union(_numbered(join_small(turns, long, same, "left_semi", limit), limit))


def repair(turns: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """conv_id, block, place, turn, role_before, role, action and rendered of every turn of the repaired conversations."""
    rows = _blocked(turns, limit).select("conv_id", "block", F.struct("turn", "role", "text").alias("t"))
    blocks = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    roles = F.transform("turns", lambda t: F.struct(t["role"].alias("role")))
    costs = blocks.select("conv_id", F.struct("block", _costs(roles).alias("costs")).alias("b"))
    whole = costs.groupBy("conv_id").agg(F.sort_array(F.collect_list("b")).alias("bs"))
    states = whole.select("conv_id", F.size("bs").alias("n_blocks"), "bs.block", _states(F.col("bs.costs")).alias("states"))
    spans = F.arrays_zip(
        F.col("block").alias("of_block"),
        F.slice("states", F.lit(1), F.col("n_blocks")).alias("entry"),
        F.slice("states", F.lit(2), F.col("n_blocks")).alias("leave"),
    )
    bounds = states.select(F.col("conv_id").alias("of_conv"), "n_blocks", F.explode(spans).alias("s")).select(
        "of_conv", "s.*", (F.col("s")["of_block"] == F.col("n_blocks") - 1).alias("last")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block"))
    joined = blocks.join(bounds.hint("merge"), same)

    @F.pandas_udf("array<struct<turn: long, role_before: string, role: string, action: string, rendered: string>>")
    def render(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        names = ("turn", "role_before", "role", "action", "rendered")
        for turns_of, entry, leave, last in batches:
            found = (rendered_rows(list(t), *b) for t, *b in zip(turns_of, entry, leave, last, strict=True))
            yield pd.Series([[dict(zip(names, row, strict=True)) for row in rows] for rows in found])

    done = joined.select("conv_id", "block", render("turns", "entry", "leave", "last").alias("done"))
    return done.select("conv_id", "block", F.posexplode("done").alias("place", "row")).select("conv_id", "block", "place", "row.*")


def formatted(repaired: DataFrame) -> DataFrame:
    """conv_id and its whole formatted text, for conversations that fit into a cell."""
    part: Column = F.struct("block", "place", "rendered")
    parts = repaired.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return parts.select("conv_id", F.array_join("parts.rendered", "").alias("text"))

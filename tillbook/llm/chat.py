"""Conversations repaired to legal turns at the lowest cost, and rendered.

A legal conversation is an optional system message, then user and assistant in turn, the
assistant last. Dynamic programming over that automaton chooses, for each turn, its role and
whether it starts a message, is merged into the one before, or needs an empty message in between.

The state after a turn is the role it was given, so a run of turns is a small table of costs from
state to state, and two runs in a row are the (min, +) product of theirs. Turns are sorted and
cut into segments of ``SEGMENT_TURNS``; only conversations of several segments need those tables,
which say in which state each segment begins and ends. So a conversation of any length is
repaired exactly, by many tasks, and none holds more than one segment. Texts don't leave the JVM.

Turns are ordered by ``turn`` (null first), then role and text. A null or unknown role may become
any at a low cost; known other names of roles count as theirs. Null texts are empty. Rows without
a ``conv_id`` are one conversation. Repeated rows are turns like others, and the cheapest repair
often merges them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.staging import stage

SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
ROLES = (SYSTEM, USER, ASSISTANT)
# States 0 to 3: nothing yet, or the role of the last message.
_START = 0
_STATE = {role: i + 1 for i, role in enumerate(ROLES)}
_NAME = ("", *ROLES)
_NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}

# Other names that roles go by.
ALIASES = {
    "human": USER, "prompter": USER, "customer": USER,
    "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT, "agent": ASSISTANT,
    "developer": SYSTEM,
}

INSERT_COST = 2
MERGE_COST = 1
RELABEL_COST = 3
NAME_COST = 1  # giving a role to a turn that has none

SEGMENT_TURNS = 1000
_NEVER = 1 << 40
_ROW_BITS = 33
_PLAN = T.ArrayType(
    T.StructType()
    .add("role", T.StringType())
    .add("merged", T.BooleanType())
    .add("inserted", T.StringType())
    .add("cost", T.LongType())
)


@lru_cache(maxsize=64)
def _moves(state: int, role: str | None) -> tuple[tuple[int, int, bool, int], ...]:
    """``(cost, next state, merged, inserted state or 0)``, cheapest and simplest first."""
    moves = []
    for new in (1, 2, 3):
        relabel = 0 if role == _NAME[new] else RELABEL_COST if role in ROLES else NAME_COST
        if new in _NEXT[state]:
            moves.append((relabel, new, False, 0))
        elif new == state:
            moves.append((relabel + MERGE_COST, new, True, 0))
        for between in _NEXT[state]:
            if new in _NEXT[between] and new not in _NEXT[state]:
                moves.append((relabel + INSERT_COST, new, False, between))
    return tuple(sorted(moves, key=lambda m: (m[0], m[3] > 0, m[2], m[1])))


@lru_cache(maxsize=8)
def _ending(state: int) -> tuple[int, tuple[int, ...]]:
    """Cost and empty messages that a legal end needs."""
    missing: list[int] = []
    while state != _STATE[ASSISTANT]:
        state = _NEXT[state][-1]
        missing.append(state)
    return INSERT_COST * len(missing), tuple(missing)


def cost_table(roles: list[str | None]) -> np.ndarray:
    """Lowest costs of a run of turns from each state to each state."""
    table = np.where(np.eye(4, dtype=bool), 0, _NEVER).astype(np.int64)
    for role in roles:
        step = np.full((4, 4), _NEVER, np.int64)
        for state in range(4):
            for cost, new, _, _ in _moves(state, role):
                step[state, new] = min(step[state, new], cost)
        table = np.minimum((table[:, :, None] + step[None, :, :]).min(axis=1), _NEVER)
    return table


def repair(roles: list[str | None], entry: int = _START, exit_state: int | None = None) -> list[tuple]:
    """``(role, merged, inserted role, cost)`` of each turn of a run from one state to another.

    Without ``exit_state`` the run may end in any state, at the cost of a legal end. Of equal
    repairs, the one that prefers plain turns to merges to insertions, from the end, is taken.
    """
    costs = [_NEVER] * 4
    costs[entry] = 0
    steps = []
    for role in roles:
        best: list[tuple | None] = [None] * 4
        for state in range(4):
            if costs[state] < _NEVER:
                for rank, (cost, new, merged, inserted) in enumerate(_moves(state, role)):
                    found = (costs[state] + cost, inserted > 0, merged, rank, state, cost, inserted)
                    if best[new] is None or found < best[new]:
                        best[new] = found
        costs = [b[0] if b else _NEVER for b in best]
        steps.append(best)
    if exit_state is None:
        exit_state = min(range(4), key=lambda s: (costs[s] + _ending(s)[0], s))
    plan = []
    for best in reversed(steps):
        _, _, merged, _, state, cost, inserted = best[exit_state]
        plan.append((_NAME[exit_state], merged, _NAME[inserted] or None, cost))
        exit_state = state
    return plan[::-1]


def _role(role: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair))
    name = F.lower(F.trim(role))
    return F.when(name.isin(*ROLES), name).otherwise(F.try_element_at(known, name))


def _segments(turns: DataFrame) -> DataFrame:
    """``conv_id, segment, turns``: sorted turns in order of place, SEGMENT_TURNS at most.

    Range partitions cut a long conversation; copies of a turn are cut by their place in the
    input.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("tie"),
        F.monotonically_increasing_id().alias("copy"),
    )
    keys = ["conv_id", "turn", "role", "tie", "copy"]
    placed = stage(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("slot")),
        "turns",
    )
    row = F.col("slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    number = F.shiftright("slot", _ROW_BITS) * (1 << _ROW_BITS) + F.floor(row / SEGMENT_TURNS)
    return (
        placed.select("*", number.cast("long").alias("segment"))
        .groupBy("conv_id", "segment")
        .agg(F.sort_array(F.collect_list(F.struct("slot", "turn", "role", "text"))).alias("turns"))
    )


@F.pandas_udf(T.ArrayType(T.LongType()))
def _table(roles: pd.Series) -> pd.Series:
    return pd.Series([cost_table(list(r)).ravel() for r in roles])


@F.pandas_udf(_PLAN)
def _plan(roles: pd.Series, entry: pd.Series, exit_state: pd.Series) -> pd.Series:
    names = ("role", "merged", "inserted", "cost")
    return pd.Series(
        [
            [dict(zip(names, t, strict=True)) for t in repair(list(r), int(a), None if b < 0 else int(b))]
            for r, a, b in zip(roles, entry, exit_state, strict=True)
        ]
    )


def _chain(tables: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit states and first place of each segment of one conversation."""
    tables = tables.sort_values("segment")
    steps = [np.array(t, np.int64).reshape(4, 4) for t in tables["table"]]
    reached = [np.array([0, _NEVER, _NEVER, _NEVER])]
    for step in steps:
        reached.append(np.minimum((reached[-1][:, None] + step).min(axis=0), _NEVER))
    last = min(range(4), key=lambda s: (reached[-1][s] + _ending(s)[0], s))
    states = [last]
    for before, step in zip(reached[-2::-1], steps[::-1], strict=True):
        states.append(int(np.argmin(before + step[:, states[-1]])))
    states.reverse()
    tables["entry"], tables["exit"] = states[:-1], states[1:]
    tables["offset"] = tables["n"].cumsum() - tables["n"]
    tables["last"] = tables["segment"] == tables["segment"].max()
    return tables[["conv", "nameless", "segment", "entry", "exit", "offset", "last"]]


def _states(segments: DataFrame) -> DataFrame:
    """The states of each segment of the conversations that have several."""
    long = (
        segments.groupBy("conv_id")
        .agg(F.min("segment").alias("low"), F.max("segment").alias("high"))
        .filter("low < high")
        .select(F.col("conv_id").alias("long_id"))
    )
    several = segments.join(long, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi")
    tables = several.select(
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"),
        F.col("conv_id").isNull().alias("nameless"),
        "segment",
        F.size("turns").cast("long").alias("n"),
        _table(_roles()).alias("table"),
    )
    return tables.groupBy("conv", "nameless").applyInPandas(
        _chain,
        "conv bigint, nameless boolean, segment bigint, entry bigint, exit bigint, offset bigint, last boolean",
    )


def _roles() -> Column:
    return F.transform("turns", lambda t: _role(t["role"]))


def repair_conversations(turns: DataFrame) -> DataFrame:
    """A row per turn of ``conv_id, turn, role, text``: its repair and its part of the rendering.

    ``place`` is its place in the conversation; ``rendered``, joined in that order, is the whole
    conversation. ``new_role`` is its role, ``merged`` whether it continues the message before,
    ``inserted`` the role of an empty message put before it, ``appended`` those put at the end.
    """
    segments = stage(_segments(turns), "segments")
    states = stage(_states(segments), "states").select(
        F.when(~F.col("nameless"), F.col("conv")).alias("of"),
        F.col("segment").alias("at"),
        *("entry", "exit", "offset", "last"),
    )
    joined = segments.join(
        states, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("segment") == F.col("at")), "left"
    ).select(
        "conv_id",
        "turns",
        F.coalesce("offset", F.lit(0)).alias("offset"),
        F.coalesce("last", F.lit(True)).alias("last"),
        _plan(_roles(), F.coalesce("entry", F.lit(0)), F.coalesce("exit", F.lit(-1))).alias("plan"),
    )
    exploded = joined.select(
        "conv_id",
        "offset",
        "last",
        F.size("turns").alias("n"),
        F.posexplode(F.arrays_zip("turns", "plan")).alias("i", "z"),
    )
    final = F.col("last") & (F.col("i") == F.col("n") - 1)
    role = F.col("z.plan.role")
    ending = F.create_map(
        *(
            F.lit(x)
            for name, state in _STATE.items()
            for x in (name, ",".join(_NAME[m] for m in _ending(state)[1]))
        )
    )
    rows = exploded.select(
        "conv_id",
        (F.col("offset") + F.col("i")).alias("place"),
        F.col("z.turns.turn").alias("turn"),
        F.col("z.turns.role").alias("role"),
        role.alias("new_role"),
        F.col("z.plan.merged").alias("merged"),
        F.col("z.plan.inserted").alias("inserted"),
        F.when(final, F.element_at(ending, role)).otherwise("").alias("appended"),
        F.col("z.plan.cost").alias("cost"),
        F.col("z.turns.text").alias("text"),
        final.alias("final"),
    )
    return rows.select(*(c for c in rows.columns if c not in ("text", "final")), _rendered())


def _message(role: Column, text: Column | str = "") -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), F.lit(text) if isinstance(text, str) else text)


def _rendered() -> Column:
    end = F.lit("<|end|>\n")
    opening = F.concat(
        F.when(F.col("place") > 0, end).otherwise(""),
        F.when(F.col("inserted").isNotNull(), F.concat(_message(F.col("inserted")), end)).otherwise(""),
        _message(F.col("new_role")),
    )
    appended = F.transform(
        F.filter(F.split("appended", ","), lambda r: r != ""), lambda r: F.concat(_message(r), end)
    )
    closing = F.when(F.col("final"), F.concat(end, F.array_join(appended, ""))).otherwise("")
    return F.concat(
        F.when(F.col("merged"), F.lit("\n\n")).otherwise(opening), F.col("text"), closing
    ).alias("rendered")


def op4(turns: DataFrame) -> DataFrame:
    """Every turn with its repair and rendering."""
    return repair_conversations(turns)

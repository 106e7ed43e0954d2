from __future__ import annotations

import itertools
import random
import re

import pytest

from tillbook.llm import chat

NAMES = [*chat.ROLES, None, "narrator"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(roles):
    """Every assignment of roles, and every merge and insertion that can follow it."""

    def ways(i, state, given):
        if i == len(given):
            return chat._ending(state)[0]
        new = chat._STATE[given[i]]
        costs = [chat.MERGE_COST + ways(i + 1, new, given)] if state == new else []
        if new in chat._NEXT[state]:
            costs.append(ways(i + 1, new, given))
        for between in chat._NEXT[state]:
            if new in chat._NEXT[between]:
                costs.append(chat.INSERT_COST + ways(i + 1, new, given))
        return min(costs, default=10**9)

    def relabel(old, new):
        if old == new:
            return 0
        return chat.RELABEL_COST if old in chat.ROLES else chat.NAME_COST

    return min(
        sum(map(relabel, roles, given)) + ways(0, 0, given)
        for given in itertools.product(chat.ROLES, repeat=len(roles))
    )


def test_against_every_repair():
    r = random.Random(1)
    for _ in range(300):
        roles = [r.choice(NAMES) for _ in range(r.randint(1, 6))]
        plan = chat.repair(roles)
        ending = chat._ending(chat._STATE[plan[-1][0]])[0]
        assert sum(p[3] for p in plan) + ending == cheapest(roles)


def messages(rendered):
    return re.findall(r"<\|(\w+)\|>\n(.*?)<\|end\|>\n", rendered, re.S)


def conversations():
    r = random.Random(2)
    rows = []
    for conv in range(40):
        for turn in range(r.randint(1, 25)):
            rows.append((conv, turn, r.choice([*NAMES, " User ", "GPT"]), f"t{conv}.{turn}"))
    rows += [(100, None, "user", "early"), (100, 1, None, None), (100, 1, "assistant", "")]
    rows += [(None, 1, "user", "no id"), (None, 2, "assistant", "none")]
    rows += [(101, 3, "user", "same")] * 4 + [(102, 1, "assistant", "x" * 20_000)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "'a' AS slot", "'b' AS place", "'c' AS turns", "'d' AS tie")


@pytest.mark.parametrize("segment", [1, 3, 1000])
def test_rendering(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT_TURNS", segment)
    rows = conversations()
    got = {}
    for r in chat.repair_conversations(frame(spark, rows)).collect():
        got.setdefault(r.conv_id, []).append(r)
    assert {c: len(v) for c, v in got.items()} == {
        c: sum(1 for x in rows if x[0] == c) for c in {x[0] for x in rows}
    }
    for turns in got.values():
        turns.sort(key=lambda r: r.place)
        assert [r.place for r in turns] == list(range(len(turns)))
        shown = messages("".join(r.rendered for r in turns))
        roles = [role for role, _ in shown]
        if roles[0] == "system":
            roles = roles[1:]
        assert roles == ["user", "assistant"] * (len(roles) // 2) and roles
        names = [chat.ALIASES.get((r.role or "").strip().lower(), (r.role or "").strip().lower()) for r in turns]
        known = [n if n in chat.ROLES else None for n in names]
        plan = chat.repair(known)
        ending = chat._ending(chat._STATE[plan[-1][0]])[0]
        total = sum(r.cost for r in turns) + chat.INSERT_COST * len([x for x in turns[-1].appended.split(",") if x])
        assert total == sum(p[3] for p in plan) + ending
    texts = "".join(t for _, t in messages("".join(r.rendered for r in got[3])))
    assert texts.replace("\n\n", "") == "".join(x[3] for x in rows if x[0] == 3)


def test_legal_conversation_is_kept(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")]
    got = chat.repair_conversations(frame(spark, rows)).orderBy("place").collect()
    assert [r.cost for r in got] == [0, 0, 0]
    assert "".join(r.rendered for r in got) == (
        "<|system|>\ns<|end|>\n<|user|>\nu<|end|>\n<|assistant|>\na<|end|>\n"
    )


def test_empty_table(spark):
    assert chat.op4(frame(spark, [])).collect() == []

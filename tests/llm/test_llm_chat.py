"""Role repair against an exhaustive search, conversations over several partitions, and awkward rows."""

import itertools
import random
import re

import pytest

from tamiz.llm import chat

COSTS = chat.Costs()
TURN = re.compile(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", re.S)


def legal(roles):
    rest = roles[1:] if roles[:1] == ["system"] else roles
    return all(r == ("user", "assistant")[i % 2] for i, r in enumerate(rest)) and len(rest) % 2 == 0


def cheapest(roles):
    """Least cost over all labels and merges, with every insertion that makes the result legal."""
    best = None
    for labels in itertools.product((1, 2, 3), repeat=len(roles)):
        for merges in itertools.product((False, True), repeat=len(roles)):
            if any(m and (i == 0 or labels[i] != labels[i - 1]) for i, m in enumerate(merges)):
                continue
            cost = sum(0 if a == b else COSTS.unknown if a == 0 else COSTS.relabel for a, b in zip(roles, labels, strict=True))
            cost += COSTS.merge * sum(merges)
            kept = [chat.NAMES[x] for x, m in zip(labels, merges, strict=True) if not m]
            if "system" in kept[1:]:
                continue
            out = []
            for role in kept:
                wanted = "user" if not out or out[-1] in ("system", "assistant") else "assistant"
                if role != "system" and role != wanted:
                    out.append(wanted)
                    cost += COSTS.insert
                out.append(role)
            while out and out[-1] != "assistant":
                out.append("user" if out[-1] == "system" else "assistant")
                cost += COSTS.insert
            assert legal(out)
            best = cost if best is None else min(best, cost)
    return best or 0


def test_cheapest_repairs():
    for n in range(5):
        for roles in itertools.product(range(4), repeat=n):
            roles = list(roles)
            ways = chat.trace(roles, chat.START, None, COSTS)
            end = ways[-1][0] if ways else chat.START
            assert sum(s.cost for _, s in ways) + chat.closing(end, COSTS)[0] == cheapest(roles)


def test_parts_are_solved_as_a_whole():
    rng = random.Random(2)
    for _ in range(200):
        roles = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
        cuts = sorted({0, len(roles), *(rng.randrange(len(roles) + 1) for _ in range(3))})
        parts = [roles[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        states = chat.solve([chat.table(p, COSTS) for p in parts], COSTS)
        cost = 0
        for part, (enter, leave) in zip(parts, states, strict=True):
            ways = chat.trace(part, enter, leave, COSTS)
            assert ways[-1][0] == leave
            cost += sum(s.cost for _, s in ways)
        ways = chat.trace(roles, chat.START, None, COSTS)
        whole = sum(s.cost for _, s in ways) + chat.closing(ways[-1][0], COSTS)[0]
        assert cost + chat.closing(states[-1][1], COSTS)[0] == whole


SCHEMA = "conv_id long, turn long, role string, text string, part int, place long, own long, rendered string"


def chats(df, partitions):
    """conv_id -> (rendered chat, cost)."""
    out = {}
    for r in sorted(partitions, key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.position)):
        text, cost = out.get(r.conv_id, ("", 0))
        out[r.conv_id] = (text + r.rendered, cost + r.cost)
    return out


def test_conversations_over_many_partitions(spark):
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "tool", None]), f"t{t}", 0, 0, 0, "") for t in range(400)]
    rows += [(c, t, rng.choice(["user", "assistant"]), f"c{c}t{t}", 0, 0, 0, "") for c in range(2, 30) for t in range(rng.randrange(1, 6))]
    got = chat.repair(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(got) == len(rows)
    for conv, (text, cost) in chats(spark, got).items():
        own = [r for r in rows if r[0] == conv]
        turns = TURN.findall(text)
        assert "".join(chat.OPEN.format(r) + t + chat.CLOSE for r, t in turns) == text
        assert legal([r for r, _ in turns])
        assert [x for _, t in turns if t for x in t.split(chat.JOINT)] == [r[3] for r in own]
        ways = chat.trace([chat.role_of(r[2]) for r in own], chat.START, None, COSTS)
        assert cost == sum(s.cost for _, s in ways) + chat.closing(ways[-1][0], COSTS)[0]


def test_positions_are_gapless_over_partitions(spark):
    """Without coalescing, a conversation of equal and null turns lies in many partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = [(1, [None, 4][t % 2], "user", f"t{t}", 0, 0, 0, "") for t in range(400)] + [(2, t, "user", "x", 0, 0, 0, "") for t in range(3)]
        got = chat.repair(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [sorted(r.position for r in got if r.conv_id == c) for c in (1, 2)] == [list(range(400)), [0, 1, 2]]
    first = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)
    assert [r.turn for r in first] == [None] * 200 + [4] * 200
    text = "".join(r.rendered for r in first)
    assert "".join(chat.OPEN.format(r) + t + chat.CLOSE for r, t in TURN.findall(text)) == text


def test_chat_edges(spark):
    rows = [(None, None, None, None, 0, 0, 0, ""), (None, 1, "assistant", "a", 0, 0, 0, ""), (5, 0, "USER ", "x", 0, 0, 0, "")]
    rows += [(5, 0, "USER ", "x", 0, 0, 0, ""), (6, 3, "gpt", "", 0, 0, 0, "")]
    got = chats(spark, chat.repair(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [r for r, _ in TURN.findall(got[None][0])] == ["user", "assistant"]
    assert TURN.findall(got[5][0]) == [("user", "x\n\nx"), ("assistant", "")]
    assert TURN.findall(got[6][0]) == [("user", ""), ("assistant", "")]
    assert chat.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_past_the_edge_of_a_role_name():
    assert chat.role_of(" Human") == chat.USER and chat.role_of("") == chat.START
    with pytest.raises(KeyError):
        chat.steps(chat.USER, COSTS)[chat.USER, chat.START]

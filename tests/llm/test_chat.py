import heapq
import random
import re

from tests.conftest import SF0001
from stride.llm.chat import ASSISTANT, LEGAL, ROLES, START, ChatParams, moves, op8_chat_format, repair

SCHEMA = "conv_id long, turn long, role string, text string, place long, state int"


def cheapest(roles, p):
    cost, _, _, end, _ = moves(p)
    best = {START: 0.0}
    for role in roles:
        no = ROLES.index(role) if role in ROLES[1:] else 5
        best = {a: min(c + cost[no, b, a] for b, c in best.items()) for a in range(1, 5)}
    return min(c + end[s] for s, c in best.items())


def legal(rendered):
    state = START
    for role in re.findall(r"<\|im_start\|>(\w+)\n", rendered):
        assert ROLES.index(role) in LEGAL[state]
        state = ROLES.index(role)
    return state == ASSISTANT


def whole(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.place)):
        out.setdefault(r.conv_id, []).append(r)
    return out


def test_costs_and_legality_with_long_and_hot_conversations(spark):
    rnd = random.Random(2)
    rows, want = [], {}
    for c in range(40):
        roles = [rnd.choice(["user", "assistant", "system", "tool", None, "bot"]) for _ in range(rnd.choice([1, 2, 3, 8, 30, 300]))]
        want[c] = cheapest(roles, ChatParams())
        rows += [(c, i, r, f"t{c}_{i}", 1, 2) for i, r in enumerate(roles)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for stretch in (5, 512):
        out = repair(df, ChatParams(stretch=stretch)).collect()
        assert len(out) == len(rows)
        for c, turns in whole(out).items():
            assert abs(sum(r.cost for r in turns) - want[c]) < 1e-9
            text = "".join(r.rendered for r in turns)
            assert legal(text) and text.count("<|im_start|>") == text.count("<|im_end|>")
        again = repair(df.repartition(7), ChatParams(stretch=stretch)).collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_clean_conversations_stay(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "tool", "t"), (1, 4, "assistant", "b"),
            (2, 0, "user", "u"), (2, 1, "user", "v"), (2, 2, "assistant", None), (3, 0, "user", "x"),
            (None, 0, "user", "lost"), (4, None, "User ", "p"), (4, None, "User ", "p"), (4, 1, "assistant", "q")]
    out = whole(repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    assert [r.action for r in out[1]] == ["keep"] * 5 and sum(r.cost for r in out[1]) == 0
    assert "".join(r.rendered for r in out[2]) == ("<|im_start|>user\nu\nv<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert [r.action for r in out[2]] == ["keep", "merge", "keep"]
    assert out[3][0].inserted_after == "assistant" and out[3][0].cost == 2.0
    assert [r.action for r in out[4]] == ["keep", "merge", "keep"] and set(out) == {1, 2, 3, 4}


def test_empty_table(spark):
    assert repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_query(spark):
    turns = spark.read.parquet(f"{SF0001}/conversations.parquet").collect()
    out = op8_chat_format(spark, SF0001).collect()
    assert len(out) == len(turns)
    roles = {}
    for t in sorted(turns, key=lambda t: (t.conv_id, t.turn)):
        roles.setdefault(t.conv_id, []).append(t.role)
    for c, rows in whole(out).items():
        assert legal("".join(r.rendered for r in rows))
        assert abs(sum(r.cost for r in rows) - cheapest(roles[c], ChatParams())) < 1e-9


def searched(roles, p):
    """Least cost by Dijkstra's search over (turns taken, state), one empty turn at a time; does not use moves()."""
    heap, done = [(0.0, 0, START)], set()
    while heap:
        cost, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(roles) and state == ASSISTANT:
            return cost
        for after in LEGAL[state]:
            heapq.heappush(heap, (cost + p.insert, i, after))
        if i < len(roles):
            for after in {*LEGAL[state], state} - {START}:
                change = 0.0 if roles[i] == ROLES[after] else p.relabel
                if after in LEGAL[state]:
                    heapq.heappush(heap, (cost + change, i + 1, after))
                if after == state:
                    heapq.heappush(heap, (cost + change + p.merge, i + 1, after))


def test_repair_is_of_minimum_cost(spark):
    rnd, names = random.Random(8), ["system", "user", "assistant", "tool", None]
    cases = [["system"], ["system", "system"], ["tool", "tool", "assistant"], ["tool"], ["system", "tool", "tool"]]
    cases += [[rnd.choice(names) for _ in range(rnd.randint(1, 12))] for _ in range(100)]
    assert [searched(c, ChatParams()) for c in cases[:3]] == [4.0, 5.0, 4.0]
    df = spark.createDataFrame([(c, i, r, "") for c, roles in enumerate(cases) for i, r in enumerate(roles)],
                               "conv_id long, turn long, role string, text string")
    out = whole(repair(df, ChatParams(stretch=4)).collect())
    for c, roles in enumerate(cases):
        assert abs(sum(r.cost for r in out[c]) - searched(roles, ChatParams())) < 1e-9, roles
        assert legal("".join(r.rendered for r in out[c]))
    assert [r.inserted_after for r in out[0]] == ["user,assistant"] and out[2][0].inserted_before == "user,assistant"

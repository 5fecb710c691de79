"""Chat formatting with minimum-cost role repair.

Legal sequences: an optional system turn, then user and assistant turns in
alternation, starting with user and ending with assistant; tool turns (one or
more) stand between assistant turns.  Dynamic programming over this automaton
chooses, for every turn of a conversation, the cheapest of

* keeping its role (cost 0);
* ``merge``: joining it to the turn before, which has the same role;
* ``relabel``: giving it another role;
* ``insert``: the shortest chain of empty turns (two at most) that leads to it, or to the end.

Of ways with equal cost, the smaller state number is taken at the end of each
stretch, then backwards inside it: results depend on the parameters, not on the plan.

Turn by turn the automaton has five states, so a stretch of turns is a 5 x 5
matrix of costs, and stretches compose.  Conversations are cut into stretches of
``stretch`` turns: each is reduced to its matrix by the task that holds it, the
matrices are composed level by level, and the chosen states travel back down the
same levels.  No task holds more than ``stretch`` rows of one conversation, even
when one conversation holds a third of all rows.

A stretch is found without ordering a whole conversation in one task: rows are
ranged by (conversation, turn, role, text) and numbered within their range, and
the ranges' sizes (as many rows as partitions) give each row its place.

Rendering is one row for each input turn, in order: the inserted empty turns, the
turn's own opening (unless merged), its text, and its closing (unless the next one
merges into it).  Concatenated by ``place`` they are the whole rendering, which
itself never stands in one row.

Edge cases: a null or unknown role must be relabelled; null text is empty; rows
without conv_id belong to no conversation and are left out; equal turn numbers
are ordered by role and text, null turns first; repeated rows are turns of their
own; an empty table gives an empty result; other columns are never read.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stride.llm.common import read_table, stored

#: States: what the sequence so far ends with.
START, SYSTEM, USER, ASSISTANT, TOOL = range(5)
ROLES = ["", "system", "user", "assistant", "tool"]
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER, TOOL), TOOL: (ASSISTANT, TOOL)}


@dataclass(frozen=True)
class ChatParams:
    merge: float = 1.0
    relabel: float = 3.0
    insert: float = 2.0
    stretch: int = 512
    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"


def chains(state: int) -> dict[int, tuple[int, ...]]:
    """For each state that can follow ``state``, the shortest way of states between them; of equals the smallest."""
    found, level = {}, [((), state)]
    while level:
        reached: dict[int, tuple[int, ...]] = {}
        for between, at in sorted(level):
            for after in LEGAL[at]:
                if after not in found:
                    reached.setdefault(after, between)
        found |= reached
        level = [(between + (after,), after) for after, between in reached.items()]
    return found


#: What may be inserted: nothing (number 0), or a chain of states.
CHAINS = sorted({c for s in range(5) for c in chains(s).values()}, key=lambda c: (len(c), c))
CHAIN_ROLES = [[ROLES[s] for s in c] for c in CHAINS]


def moves(p: ChatParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """cost[role, before, after] of taking one turn, the number of the inserted chain (0: none), whether it merges;
    and the same for ending: end_cost[state], end_insert[state]."""
    ways = [chains(state) for state in range(5)]
    cost = np.full((6, 5, 5), np.inf)   # role 5: unknown
    insert = np.zeros((6, 5, 5), np.int64)
    merge = np.zeros((6, 5, 5), bool)
    for role in range(6):
        for before in range(5):
            for after in (SYSTEM, USER, ASSISTANT, TOOL):
                change = 0.0 if role == after else p.relabel
                choices = []
                if after == before:
                    choices.append((change + p.merge, 0, 0, True))
                if after in ways[before]:
                    add = ways[before][after]
                    choices.append((change + p.insert * len(add), 1, CHAINS.index(add), False))
                if choices:
                    cost[role, before, after], _, insert[role, before, after], merge[role, before, after] = min(choices)
    end_cost, end_insert = np.full(5, np.inf), np.zeros(5, np.int64)
    for state in range(5):
        if state == ASSISTANT:
            end_cost[state] = 0.0
        else:
            add = (*ways[state][ASSISTANT], ASSISTANT)
            end_cost[state], end_insert[state] = p.insert * len(add), CHAINS.index(add)
    return cost, insert, merge, end_cost, end_insert


def compose(mats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost matrix of consecutive stretches (n x 5 x 5) and, for each prefix, the best state before its last one."""
    total = np.where(np.eye(5, dtype=bool), 0.0, np.inf)
    back = np.zeros((len(mats), 5, 5), np.int64)
    for i, m in enumerate(mats):
        through = total[:, :, None] + m[None]
        back[i] = through.argmin(axis=1)
        total = through.min(axis=1)
    return total, back


def trace(back: np.ndarray, first: int, last: int) -> np.ndarray:
    """States after each stretch on the best way from ``first`` to ``last``."""
    out = np.zeros(len(back), np.int64)
    state = last
    for i in range(len(back) - 1, -1, -1):
        out[i] = state
        state = back[i][first, state]
    return out


def placed(turns: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): turns with their place (from 0) in the conversation."""
    spark = turns.sparkSession
    by = ["conv_id", "turn", "role", "text"]
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select(*by).where("conv_id is not null")
    ranged = stored(rows.repartitionByRange(pieces, *by).sortWithinPartitions(*by)
                    .select(*by, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "chat-range")
    # how many rows of its conversation stand in earlier ranges: only for conversations that span ranges
    size = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("least"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = stored(size.select("conv_id", "part", "least", before.alias("before")), "chat-start")
    return ranged.join(start, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("least") + F.col("before")).alias("place"), "role", F.coalesce("text", F.lit("")).alias("text"))


COSTS = "conv_id long, no long, costs array<double>"


def _arrow(frame: dict, types: dict) -> pa.Table:
    return pa.table({k: pa.array(v, type=types[k]) for k, v in frame.items()})


def solve(turns: DataFrame, p: ChatParams) -> DataFrame:
    """(conv_id, place, role_no, before, state, last, text): the chosen state before and after each turn."""
    cost, _, _, end_cost, _ = moves(p)
    role = F.coalesce(F.array_position(F.array(*[F.lit(r) for r in ROLES[1:]]), F.lower(F.trim("role"))), F.lit(0))
    rows = stored(placed(turns).withColumn("role_no", F.when(role == 0, 5).otherwise(role).cast("int"))
                  .withColumn("no", F.floor(F.col("place") / p.stretch)), "chat-rows")
    types = {"conv_id": pa.int64(), "no": pa.int64(), "costs": pa.list_(pa.float64())}

    def reduce_rows(key, table):
        order = np.argsort(table.column("place").to_numpy(), kind="stable")
        total, _ = compose(cost[table.column("role_no").to_numpy()[order]])
        return _arrow({"conv_id": [key[0].as_py()], "no": [key[1].as_py()], "costs": [total.ravel()]}, types)

    def reduce_mats(key, table):
        order = np.argsort(table.column("no").to_numpy(), kind="stable")
        mats = np.array(table.column("costs").to_pylist()).reshape(-1, 5, 5)[order]
        return _arrow({"conv_id": [key[0].as_py()], "no": [key[1].as_py()], "costs": [compose(mats)[0].ravel()]}, types)

    # thin rows, much work: a fixed number of tasks, which adaptive execution does not fold into one
    pieces = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    thin = rows.select("conv_id", "no", "place", "role_no").repartition(pieces, "conv_id", "no")
    levels = [stored(thin.groupBy("conv_id", "no")
                     .applyInArrow(reduce_rows, COSTS), "chat-level")]
    while (levels[-1].agg(F.max("no")).first()[0] or 0) > 0:  # one level more for each factor ``stretch``
        up = levels[-1].select("conv_id", (F.floor(F.col("no") / p.stretch)).alias("up"), "no", "costs")
        levels.append(stored(up.groupBy("conv_id", "up").applyInArrow(reduce_mats, COSTS), "chat-level"))
    ends = [F.lit(float(x)) for x in end_cost]
    # the top: from the start to the cheapest end (the smallest state of equals)
    final = F.array(*[F.struct((F.get("costs", F.lit(START * 5 + s)) + ends[s]).alias("c"), F.lit(s).alias("s")) for s in range(5)])
    ways = levels[-1].select("conv_id", "no", F.lit(START).alias("first"), F.array_min(final)["s"].alias("last"))
    way = "conv_id long, no long, first int, last int"
    way_types = {"conv_id": pa.int64(), "no": pa.int64(), "first": pa.int32(), "last": pa.int32()}

    def open_mats(key, table):
        order = np.argsort(table.column("no").to_numpy(), kind="stable")
        no = table.column("no").to_numpy()[order]
        mats = np.array(table.column("costs").to_pylist()).reshape(-1, 5, 5)[order]
        first, last = table.column("first")[0].as_py(), table.column("last")[0].as_py()
        after = trace(compose(mats)[1], first, last)
        return _arrow({"conv_id": [key[0].as_py()] * len(no), "no": no, "first": [first, *after[:-1]], "last": after}, way_types)

    for level in reversed(levels[:-1]):
        below = level.withColumn("up", F.floor(F.col("no") / p.stretch))
        above = ways.withColumnRenamed("no", "up")
        ways = stored(below.join(above, ["conv_id", "up"]).groupBy("conv_id", "up").applyInArrow(open_mats, way), "chat-ways")
    made = "conv_id long, place long, role_no int, before int, state int, text string"
    made_types = {"conv_id": pa.int64(), "place": pa.int64(), "role_no": pa.int32(), "before": pa.int32(),
                  "state": pa.int32(), "text": pa.string()}

    def open_rows(key, table):
        order = np.argsort(table.column("place").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        role_no = table.column("role_no").to_numpy()
        first, last = table.column("first")[0].as_py(), table.column("last")[0].as_py()
        after = trace(compose(cost[role_no])[1], first, last)
        return _arrow({"conv_id": table.column("conv_id").to_pylist(), "place": table.column("place").to_numpy(),
                       "role_no": role_no, "before": [first, *after[:-1]], "state": after,
                       "text": table.column("text").to_pylist()}, made_types)

    ways = stored(ways, "chat-ways")
    return stored(rows.join(ways, ["conv_id", "no"]).groupBy("conv_id", "no").applyInArrow(open_rows, made), "chat-solved")


def repair(turns: DataFrame, p: ChatParams = ChatParams()) -> DataFrame:
    """One row for each turn of ``turns`` (conv_id, turn, role, text): place, role before and after repair, the
    action, the roles inserted before it or after the last turn (joined by commas), its cost, and the rendered piece."""
    cost, insert, merge, end_cost, end_insert = moves(p)
    solved = solve(turns, p)
    table = F.create_map(*[x for r in range(1, 6) for b in range(5) for a in range(1, 5) if np.isfinite(cost[r, b, a])
                           for x in (F.lit((r * 5 + b) * 5 + a),
                                     F.struct(F.lit(float(cost[r, b, a])).alias("cost"), F.lit(int(insert[r, b, a])).alias("add"),
                                              F.lit(bool(merge[r, b, a])).alias("merged")))])
    rows = solved.withColumn("m", F.element_at(table, (F.col("role_no") * 5 + F.col("before")) * 5 + F.col("state")))
    # a turn closes unless the next one merges into it: the next place's row says so
    nxt = rows.select("conv_id", (F.col("place") - 1).alias("place"), F.col("m.merged").alias("joined"))
    rows = rows.join(nxt, ["conv_id", "place"], "left")
    name = F.element_at(F.array(*[F.lit(r) for r in ROLES[1:]]), F.col("state"))
    opening = lambda r: F.concat(F.lit(p.opening.split("{role}")[0]), r, F.lit(p.opening.split("{role}")[1]))
    turns_of = lambda roles: "".join(p.opening.replace("{role}", r) + p.closing for r in roles)
    listed = lambda n, of: F.element_at(F.array(*[F.lit(of(c)) for c in CHAIN_ROLES]), n + 1)
    last = F.col("joined").isNull()
    at_end = F.when(last, F.element_at(F.array(*[F.lit(int(e)) for e in end_insert]), F.col("state") + 1)).otherwise(0)
    end = F.when(last, F.element_at(F.array(*[F.lit(float(c) if np.isfinite(c) else 0.0) for c in end_cost]), F.col("state") + 1)).otherwise(0.0)
    piece = F.concat(F.when(F.col("m.merged"), F.lit("\n")).otherwise(F.concat(listed(F.col("m.add"), turns_of), opening(name))), "text",
                     F.when(F.coalesce("joined", F.lit(False)), F.lit("")).otherwise(F.lit(p.closing)), listed(at_end, turns_of))
    relabelled = F.col("role_no") != F.col("state")
    action = F.when(F.col("m.merged") & relabelled, "merge+relabel").when(F.col("m.merged"), "merge") \
        .when(relabelled, "relabel").otherwise("keep")
    return rows.select("conv_id", "place", name.alias("role"), action.alias("action"),
                       listed(F.col("m.add"), ",".join).alias("inserted_before"), listed(at_end, ",".join).alias("inserted_after"),
                       (F.col("m.cost") + end).alias("cost"), piece.alias("rendered"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(read_table(spark, sf_dir, "conversations"))

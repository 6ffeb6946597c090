"""Minimum-cost role repair of conversations, and their rendering.

A legal conversation is a path of an automaton: a system turn may open it, user and assistant turns alternate, the
user first. Per turn a repair keeps it, joins it to the turn before (a merge), gives it another role (a relabel),
or puts empty turns before it; a conversation that ends in the wrong state gets empty turns at its end. Each choice
has a cost, and dynamic programming over the automaton's states finds the cheapest repair.

All conversations together form one long chain of items: a begin, its turns and an end for each. An item is a matrix of
costs from state to state, and matrices multiply (least sums), so the chain is cut into blocks of equal count: each
block's product is one item of a shorter chain, which is solved first and tells each block its first and last
state. No task sees more than a block, however long a conversation is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import Scratch, arrow_schema, growing, ranked, with_row_id

ROLES = ("system", "user", "assistant")
OPEN, DONE = "open", "done"  # before a conversation's first turn, after its end
STATES = (OPEN, *ROLES, DONE)
FOLLOWS = {OPEN: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
ENDS = ("user", "assistant")
COST = {"keep": 0, "merge": 1, "insert": 2, "relabel": 3, "merge_other": 4}
ORDER = ("keep", "merge", "relabel", "merge_other", "insert")  # of equal costs the repair with earlier choices wins
NEVER = 1 << 50
UNIT = 1 << 20  # costs are multiples; what is below tells equal costs apart
BLOCK_ITEMS = 4096
ROW = "__truegrain_row"
BEGIN_ITEM, END_ITEM = "\0begin", "\0end"

Move = tuple[int, str, tuple[str, ...]]  # cost, action, roles of the empty turns put before


def _weight(actions: list[str]) -> int:
    return sum(COST[a] * UNIT + ORDER.index(a) for a in actions)


def _insertions(state: str, most: int = 2) -> Iterator[tuple[tuple[str, ...], str]]:
    """Legal runs of empty turns from a state, and the state after each."""
    paths: list[tuple[tuple[str, ...], str]] = [((), state)]
    for _ in range(most + 1):
        yield from paths
        paths = [((*roles, r), r) for roles, last in paths for r in FOLLOWS.get(last, ())]


def moves(role: str) -> dict[tuple[int, int], Move]:
    """The cheapest move between two states that takes a turn of ``role``; any unknown role is given another."""
    best: dict[tuple[int, int], Move] = {}

    def offer(start: str, end: str, action: str, actions: list[str], before: tuple[str, ...] = ()) -> None:
        key, cost = (STATES.index(start), STATES.index(end)), _weight(actions)
        if key not in best or cost < best[key][0]:
            best[key] = (cost, action, before)

    if role == BEGIN_ITEM:
        for start in (OPEN, DONE):
            offer(start, OPEN, "begin", [])
    elif role == END_ITEM:
        for start in (OPEN, *ROLES):
            for before, last in _insertions(start):
                if last in ENDS or last == OPEN:  # a conversation without turns stays empty
                    offer(start, DONE, "end", ["insert"] * len(before), before)
    else:
        for start in (OPEN, *ROLES):
            if start != OPEN:
                offer(start, start, "merge", ["merge" if start == role else "merge_other"])
            for before, last in _insertions(start):
                for new in FOLLOWS.get(last, ()):
                    action = "keep" if new == role else "relabel"
                    offer(start, new, action, ["insert"] * len(before) + [action], before)
    return best


def matrix(role: str) -> np.ndarray:
    out = np.full((len(STATES), len(STATES)), NEVER, np.int64)
    for (start, end), (cost, _, _) in moves(role).items():
        out[start, end] = cost
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), NEVER)


def _path(items: list[np.ndarray], first: int, last: int | None) -> list[int]:
    """The states of a cheapest path from ``first``, one more than items; without ``last`` it ends where it is cheapest."""
    cost = np.full(len(STATES), NEVER, np.int64)
    cost[first] = 0
    came = []
    for item in items:
        through = cost[:, None] + item
        came.append(through.argmin(0))
        cost = np.minimum(through.min(0), NEVER)
    states = [int(cost.argmin()) if last is None else last]
    for back in reversed(came):
        states.append(int(back[states[-1]]))
    return states[::-1]


def _matrices(table: pa.Table) -> list[np.ndarray]:
    if "role" in table.column_names:
        known = {r: matrix(r) for r in set(table["role"].to_pylist())}
        return [known[r] for r in table["role"].to_pylist()]
    return [np.array(m, np.int64).reshape(len(STATES), -1) for m in table["costs"].to_pylist()]


def _solved(table: pa.Table, first: int, last: int | None) -> pa.Table:
    table = table.sort_by("place")
    states = _path(_matrices(table), first, last)
    return pa.table({"place": table["place"], "first": pa.array(states[:-1], pa.int32()), "last": pa.array(states[1:], pa.int32())})


def _shortened(table: pa.Table) -> pa.Table:
    whole = reduce(_product, _matrices(table.sort_by("place")))
    return pa.table({"place": table["block"].slice(0, 1), "costs": pa.array([whole.reshape(-1).tolist()], pa.list_(pa.int64()))})


def _between(table: pa.Table, ends: pa.Table) -> pa.Table:
    return _solved(table, ends["first"][0].as_py(), ends["last"][0].as_py())


def solve(scratch: Scratch, items: DataFrame, block_items: int) -> DataFrame:
    """(place, first, last): the states before and after each item on a cheapest path; items come as role or costs."""
    steps = "place long, first int, last int"
    blocked = items.withColumn("block", F.floor(F.col("place") / block_items).cast("long"))
    if items.count() <= block_items:
        whole = items.withColumn("block", F.lit(0))
        return whole.groupBy("block").applyInArrow(lambda t: _solved(t, STATES.index(OPEN), None), steps)
    blocks = scratch.store(blocked.groupBy("block").applyInArrow(_shortened, "place long, costs array<long>"))
    ends = scratch.store(solve(scratch, blocks, block_items))
    known = ends.select(F.col("place").alias("block"), "first", "last")
    return blocked.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_between, steps)


def _rendering(names: list[str], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[tuple[int, int], Move]] = {}
        for batch in batches:
            out: list[tuple] = []
            for kind, role, text, first, last in zip(*(batch.column(c).to_pylist() for c in ("item", "role", "text", "first", "last"))):
                if kind != 1:
                    role = BEGIN_ITEM if kind == 0 else END_ITEM
                cost, action, before = known.setdefault(role, moves(role))[first, last]
                new = STATES[last] if kind == 1 else None
                body = (text or "").replace("<|", "< |")
                rendered = "".join(f"<|{r}|>\n\n" for r in before)
                if new:
                    rendered += body + "\n" if action == "merge" else f"<|{new}|>\n{body}\n"
                out.append((new, action, list(before), cost // UNIT, rendered))
            kept = [batch.column(c) for c in names]
            columns = zip(*out) if out else ((),) * 5
            arrays = [*kept, *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[len(names) :]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return render


def repair(turns: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per turn: conv_id, turn, place, role, action, inserted, cost and rendered.

    ``place`` orders all rows; the ``rendered`` pieces of a conversation in that order are its text, "<|role|>", a line
    break, the words, a line break for each turn. ``role`` is the repaired one, ``action`` keep, merge or relabel, and
    ``inserted`` names the roles of empty turns put before. Empty turns at the end come as a row of action "end" with
    null turn and role. Turns are ordered by turn, nulls first, then by file and place in it; repeated rows are separate turns. Turns of null conv_id are
    one conversation. A role is trimmed and lower-cased; null or unknown ones are given a legal role at the cost
    of a relabel. Null text is empty. "<|" inside a text becomes "< |", so that texts can't open turns.
    """
    scratch = Scratch(turns.sparkSession, "chat-format")
    rows = with_row_id(turns, ROW).select(ROW, "conv_id", "turn", "role", "text")
    role = F.coalesce(F.lower(F.trim(F.col("role").cast("string"))), F.lit(""))
    listed = rows.select("conv_id", F.lit(1).alias("item"), "turn", ROW, F.regexp_replace(role, "\0", "").alias("role"))
    borders = listed.select("conv_id").distinct().withColumn("turn", F.lit(None).cast(turns.schema["turn"].dataType))
    borders = borders.withColumn(ROW, F.lit(None).cast("string"))
    for item, name in ((0, BEGIN_ITEM), (2, END_ITEM)):
        listed = listed.unionByName(borders.withColumn("item", F.lit(item)).withColumn("role", F.lit(name)))
    chain = scratch.store(ranked(scratch, listed, F.col("conv_id"), F.col("item"), F.col("turn"), F.col(ROW), name="place"))
    states = scratch.store(solve(scratch, chain.select("place", "role"), block_items))
    told = scratch.store(chain.join(growing(states), "place").where("item > 0"))
    texts = rows.select(F.col(ROW).alias("__of"), F.col("text").cast("string").alias("text"))
    # Ends have no row; they get names of their own, so that they don't meet as one null key.
    keyed = told.withColumn("__of", F.coalesce(ROW, F.concat(F.lit("end "), F.col("place")))).join(growing(texts), "__of", "left")
    kept = ["conv_id", "turn", "place"]
    types = ", ".join(f"{c} {told.schema[c].dataType.simpleString()}" for c in kept)
    ddl = f"{types}, role string, action string, inserted array<string>, cost long, rendered string"
    out = keyed.select("conv_id", "turn", "place", "item", "role", "text", "first", "last")
    made = out.mapInArrow(_rendering(kept, arrow_schema(ddl)), ddl)
    return made.where("action <> 'end' OR cost > 0")

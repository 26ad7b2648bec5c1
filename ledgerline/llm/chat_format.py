"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in
turn, beginning with user: an automaton whose state is the role of the open
turn. Every input turn is either emitted under a role (its own, or relabelled),
merged into the open turn, or emitted after empty turns inserted to make it
legal. Dynamic programming over the automaton finds the cheapest repair.

What a turn costs depends on its role alone, so a run of turns is a matrix of
cheapest costs between states, and runs combine by (min, +) products. Rows are
range-partitioned and sorted by (conversation, turn); a partition repairs the
conversations that lie within it at once. Its first and last one, which may go
on elsewhere, and those of more than ``ROW_CHARS`` characters are handed on in
pieces, cut again at multiples of ``ROW_CHARS`` from the conversation's start,
and put together by (conversation, part). A conversation that has one part is
repaired then. The parts of a longer one are chained by their matrices on the
driver (16 numbers for every ``ROW_CHARS`` characters of such conversations),
and each part is repaired between its known states. So a conversation that
holds a third of all rows is repaired exactly, in many tasks, and neither rows
nor parts depend on how the table was partitioned. A conversation of up to
``ROW_CHARS`` characters is one row; a longer one has a row for each part,
whose ``rendered`` texts concatenate in order of ``part``.

Defined results: a null or unknown role counts as a role to be relabelled; a
null text is empty; equal or null turn numbers are ordered (nulls last) by
role, the text's first ``PREFIX_CHARS`` characters and its hash; rows without a conversation id form one conversation of null
id; repeated rows are repeated turns; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import partitions, stored

ROLES = ("system", "user", "assistant")
START = 3  # state before the first turn; the other states are the roles' numbers
LEGAL = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
FINAL = (1, 2)  # a conversation may end after a user or an assistant turn
MERGE, RELABEL, INSERT = 1.0, 2.0, 1.5
JOINER = "\n\n"
PREFIX_CHARS = 64
ROW_CHARS = 16_000_000  # of a row: a cell of Arrow holds 2 GB
_FAR = float("inf")


@lru_cache(maxsize=None)
def moves(role: int) -> tuple[tuple[tuple[float, str, tuple[int, ...]], ...], ...]:
    """For a turn of ``role`` (3: unknown): per state before and after, the
    cheapest (cost, action, roles of the empty turns inserted before it)."""
    def best(before: int, after: int):
        changed = 0.0 if after == role else RELABEL
        found = []
        if before == after and before != START:
            found.append((MERGE + changed, "merge", ()))
        if after != START:
            word = "keep" if after == role else "relabel"
            todo = [(before, ())]
            while todo:
                state, inserted = todo.pop()
                if after in LEGAL[state]:
                    found.append((INSERT * len(inserted) + changed, word, inserted))
                if len(inserted) < 2:
                    todo += [(s, (*inserted, s)) for s in LEGAL[state]]
        return min(found, key=lambda f: (f[0], len(f[2]), f[1], f[2]), default=(_FAR, "", ()))

    return tuple(tuple(best(q, x) for x in range(4)) for q in range(4))


def role_number(role: str | None) -> int:
    return ROLES.index(role) if role in ROLES else 3


def matrix(roles: list[int]) -> list[list[float]]:
    """Cheapest cost of the run of turns between any two states."""
    cost = [[0.0 if q == x else _FAR for x in range(4)] for q in range(4)]
    for r in roles:
        m = moves(r)
        cost = [[min(row[k] + m[k][x][0] for k in range(4)) for x in range(4)] for row in cost]
    return cost


def repair(roles: list[int], entry: int = START, exits=FINAL) -> tuple[float, list[tuple[int, str, tuple[int, ...]]]]:
    """Cost and, per turn, (role given, action, empty turns inserted before)."""
    cost, back = [0.0 if q == entry else _FAR for q in range(4)], []
    for r in roles:
        m = moves(r)
        came = [min(range(4), key=lambda k, x=x: (cost[k] + m[k][x][0], k)) for x in range(4)]
        cost = [cost[came[x]] + m[came[x]][x][0] for x in range(4)]
        back.append((m, came))
    state = min(exits, key=lambda x: (cost[x], x))
    total, steps = cost[state], []
    for m, came in reversed(back):
        before = came[state]
        steps.append((state, *m[before][state][1:]))
        state = before
    return total, steps[::-1]


def opening(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


CLOSING = "<|end|>\n"


def render(steps, texts: list[str], entry: int = START, last: bool = True) -> str:
    """The repaired turns as text; a part closes the turn left open before it."""
    out, open_ = [], entry != START
    for (role, action, inserted), text in zip(steps, texts, strict=True):
        if action == "merge":
            out.append(JOINER)
        else:
            for r in inserted:
                out += [CLOSING] * open_ + [opening(r)]
                open_ = True
            out += [CLOSING] * open_ + [opening(role)]
            open_ = True
        out.append(text)
    return "".join(out) + (CLOSING if last and open_ else "")


_RESULT = [("part", pa.int32()), ("n_turns", pa.int64()), ("n_out", pa.int64()), ("merged", pa.int64()),
           ("relabelled", pa.int64()), ("inserted", pa.int64()), ("cost", pa.float64()), ("rendered", pa.string())]
_DDL = ("part int, n_turns long, n_out long, merged long, relabelled long, inserted long, cost double, rendered string")


def result(roles: list[str | None], texts: list[str], part=0, entry=START, exits=FINAL, last=True) -> tuple:
    numbers = [role_number(r) for r in roles]
    cost, steps = repair(numbers, entry, exits)
    merged = sum(a == "merge" for _, a, _ in steps)
    inserted = sum(len(i) for *_, i in steps)
    return (part, len(steps), len(steps) - merged + inserted, merged,
            sum(r != n for (r, *_), n in zip(steps, numbers, strict=True)), inserted, cost,
            render(steps, texts, entry, last))


def repair_conversations(df: DataFrame, id_col="conv_id", turn_col="turn", role_col="role",
                         text_col="text", row_chars: int = ROW_CHARS) -> DataFrame:
    """One row per conversation (or per part of one that is longer than
    ``row_chars``, each turn counting one more than its text): id, part,
    n_turns, n_out, merged, relabelled, inserted, cost, rendered."""
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"prefix": F.substring("text", 1, PREFIX_CHARS), "hash": F.xxhash64("text")})
    order = [F.col("id").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("role"), F.col("prefix"), F.col("hash")]
    # The last key deals out repeated rows, whose order makes no difference.
    rows = (rows.repartitionByRange(partitions(df.sparkSession), *order, F.monotonically_increasing_id())
            .sortWithinPartitions(*order, "text").select("id", "role", "text"))

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, kind, done, held = TaskContext.get().partitionId(), None, [], 0
        conv, roles, texts, size, cut_before, first, pieces = None, [], [], 0, False, True, 0

        def out():
            names = ["id", "piece", "size", "roles", "texts", *[n for n, _ in _RESULT]]
            kinds = [kind, pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), *[k for _, k in _RESULT]]
            return pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

        def close(edge: bool):
            """The conversation at hand, or what is left of it."""
            nonlocal pieces
            if edge or cut_before:
                done.append((conv, pid << 32 | pieces, size, list(roles), list(texts), *[None] * len(_RESULT)))
                pieces += 1
            else:
                done.append((conv, None, None, None, None, *result(roles, texts)))

        for batch in batches:
            kind = batch.schema.field("id").type
            for new, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if roles and (new != conv or size >= row_chars):
                    close(first or new == conv)
                    held += size
                    cut_before = new == conv
                    first = first and cut_before
                    roles, texts, size = [], [], 0
                    if held > 4_000_000 or len(done) >= 5_000:
                        yield out()
                        done, held = [], 0
                conv = new
                roles.append(role)
                texts.append(text)
                size += len(text) + 1
        if roles:
            close(True)
            yield out()

    schema = f"id {id_type}, piece long, size long, roles array<string>, texts array<string>, {_DDL}"
    passed = stored(rows.mapInArrow(first_pass, schema), "chat-parts")
    pieces = passed.where("piece is not null")
    place = Window.partitionBy("id").orderBy("piece")
    placed = pieces.select("piece", (F.sum("size").over(place) - F.col("size")).alias("before"),
                           (F.sum("size").over(Window.partitionBy("id")) > row_chars).alias("long"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces to their conversation's parts."""
        for batch in batches:
            for i in range(batch.num_rows):
                conv, piece, at, long_, roles, texts = (batch.column(c)[i].as_py() for c in range(6))
                start, part = 0, at // row_chars
                for t in range(len(texts) + 1):
                    here = at // row_chars
                    if t == len(texts) or here != part:
                        if t > start:
                            yield pa.record_batch([
                                pa.array([conv], batch.schema.field(0).type), pa.array([part]), pa.array([piece]),
                                pa.array([long_]), pa.array([roles[start:t]], pa.list_(pa.string())),
                                pa.array([texts[start:t]], pa.list_(pa.string()))],
                                names=["id", "part", "piece", "long", "roles", "texts"])
                        start, part = t, here
                    if t < len(texts):
                        at += len(texts[t]) + 1

    parts = (pieces.join(placed, "piece").select("id", "piece", "before", "long", "roles", "texts")
             .mapInArrow(cut, f"id {id_type}, part long, piece long, long boolean, roles array<string>, texts array<string>")
             .groupBy("id", "part").agg(F.array_sort(F.collect_list(F.struct("piece", "roles", "texts"))).alias("p"),
                                        F.first("long").alias("long")))
    # At most row_chars characters and a turn.
    parts = stored(parts.select("id", "part", "long", F.flatten(F.transform("p", lambda p: p["roles"])).alias("roles"),
                                F.flatten(F.transform("p", lambda p: p["texts"])).alias("texts")), "chat-joined")

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [[c for row in matrix([role_number(r) for r in roles]) for c in row] for roles in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(flat, pa.list_(pa.float64()))],
                                  names=["id", "part", "matrix"])

    edges = (parts.where("long").select("id", "part", "roles").mapInArrow(costs, f"id {id_type}, part long, matrix array<double>")
             .orderBy(F.col("id").asc_nulls_first(), "part").collect())
    places = chained([(r["id"], r["part"], [r["matrix"][4 * q: 4 * q + 4] for q in range(4)]) for r in edges])

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                conv, part, roles, texts = (batch.column(c)[i].as_py() for c in range(4))
                number, entry, leave, last = places.get((conv, part), (0, START, None, True))
                got = result(roles, texts, number, entry, FINAL if leave is None else (leave,), last)
                yield pa.record_batch([pa.array([conv], batch.schema.field(0).type),
                                       *[pa.array([v], k) for v, (_, k) in zip(got, _RESULT, strict=True)]],
                                      names=["id", *[n for n, _ in _RESULT]])

    whole = passed.where("piece is null").select("id", *[n for n, _ in _RESULT])
    return whole.unionByName(parts.select("id", "part", "roles", "texts").mapInArrow(second_pass, f"id {id_type}, {_DDL}"))


def chained(edges: list[tuple]) -> dict[tuple, tuple[int, int, int, bool]]:
    """For parts (id, part, matrix), sorted: (id, part) to number of the part,
    states before and after it, and whether it is the conversation's last."""
    out, at = {}, 0
    while at < len(edges):
        to = at
        while to < len(edges) and edges[to][0] == edges[at][0]:
            to += 1
        costs = [[0.0 if q == START else _FAR for q in range(4)]]
        for _, _, m in edges[at:to]:
            costs.append([min(costs[-1][k] + m[k][x] for k in range(4)) for x in range(4)])
        state = min(FINAL, key=lambda x: (costs[-1][x], x))
        for i in range(to - 1, at - 1, -1):
            conv, pid, m = edges[i]
            before = min(range(4), key=lambda k: (costs[i - at][k] + m[k][state], k))
            out[(conv, pid)] = (i - at, before, state, i == to - 1)
            state = before
        at = to
    return out

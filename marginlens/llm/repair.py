"""Conversation structure repair: the cheapest edits that give alternating turns.

A repaired conversation is empty, or an optional system turn followed by pairs
of user and assistant.  Its states are therefore four: nothing yet, after the
system turn, after a user turn, after an assistant turn.  Each row of a
conversation moves between them by an edit (with inserted turns before it),
and the cheapest edits are found by Hirschberg's divide and conquer: the
forward and the backward cost vectors of the four states meet in the middle,
the crossing is chosen, and each half is solved again with its ends fixed, so
memory stays linear.

Of equally cheap edit strings the ASCII-least is taken.  Inserted turns count
with the row after them, so strings that reach different states at a row
differ and none is a prefix of another.  A forward vector therefore carries,
beside its costs, the order of its states' least strings, and a crossing is
chosen by that order without keeping any string.

Rows are ordered by Spark's range partitioning, so a conversation may span many
partitions.  A stretch of rows acts on the states as a matrix (cost and order
of each pair of states); the stretches at the edges of partitions are joined
by the same divide and conquer over these matrices, and each partition then
solves its rows with the ends found.  Only small columns take part; texts are
fetched at the end, once per turn that stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlens.llm.scratch import cut

#: White space, and what ends a turn.
WHITE, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Costs of the edits, and of leaving a truncated turn in.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 60
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Where a turn of initial s, u, a or another leads from each state (None: not allowed).
NEXT = {NOTHING: {0: SYSTEM, 1: USER}, SYSTEM: {1: USER}, USER: {2: ASSISTANT}, ASSISTANT: {1: USER}}
#: Inserted turns that lead from a state to another.
INSERTS = {NOTHING: {NOTHING: 0, USER: 1, ASSISTANT: 2}, SYSTEM: {SYSTEM: 0, USER: 1, ASSISTANT: 2},
           USER: {USER: 0, ASSISTANT: 1}, ASSISTANT: {ASSISTANT: 0, USER: 1}}
#: A row's code: its initial, then flags.
BLANK, CUT_OFF, REPEATED = 4, 8, 16

Matrix = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]


def row_edits(code: int) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest (cost, edits) of a row between two states, least edits first."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for p, reached in INSERTS.items():
        for m, inserted in reached.items():
            moves = [(m, DELETE, "D")]
            if not code & (BLANK | REPEATED):
                late = TRUNCATED if code & CUT_OFF else 0
                moves += [(q, late, "K") for i, q in NEXT[m].items() if i == code & 3]
                moves += [(q, late + REROLE, "R") for i, q in NEXT[m].items() if i in (1, 2)]
            for q, cost, letter in moves:
                found = (cost + inserted * INSERT, "I" * inserted + letter)
                best[p, q] = min(best.get((p, q), (FAR, "")), found)
    return best


def row_matrix(code: int) -> Matrix:
    """A row as a matrix: cost from state to state, and the order of the edits of each first state."""
    edits = EDITS[code]
    cost = tuple(tuple(edits.get((p, q), (FAR, ""))[0] for q in range(4)) for p in range(4))
    order = []
    for p in range(4):
        strings = sorted(edits[p, q][1] for q in range(4) if (p, q) in edits)
        order.append(tuple(strings.index(edits[p, q][1]) if (p, q) in edits else 4 for q in range(4)))
    return cost, tuple(order)


#: Edits and matrix of each code.
EDITS = {code: row_edits(code) for code in range(32)}
ROWS = {code: row_matrix(code) for code in EDITS}


def forward(items: Sequence[Matrix], start: int) -> tuple[list[int], list[int]]:
    """Costs of reaching each state, and the order of their least strings."""
    cost, rank = [FAR] * 4, [4] * 4
    cost[start] = rank[start] = 0
    for by, order in items:
        now, keys = [FAR] * 4, [(5, 5)] * 4
        for q in range(4):
            for p in range(4):
                c = cost[p] + by[p][q]
                if c < FAR and (c < now[q] or c == now[q] and (rank[p], order[p][q]) < keys[q]):
                    now[q], keys[q] = c, (rank[p], order[p][q])
        places = sorted(k for q, k in enumerate(keys) if now[q] < FAR)
        cost, rank = now, [places.index(k) if now[q] < FAR else 4 for q, k in enumerate(keys)]
    return cost, rank


def backward(items: Sequence[Matrix], last: Sequence[int]) -> list[int]:
    """Costs of reaching the end from each state, given those after the last row."""
    cost = list(last)
    for by, _ in reversed(items):
        cost = [min(min(by[p][q] + cost[q] for q in range(4)), FAR) for p in range(4)]
    return cost


#: Cost of ending in each state: only nothing and an assistant turn end a conversation.
LAST = [0, 2 * INSERT, INSERT, 0]


def crossings(items: Sequence[Matrix], start: int, last: Sequence[int]) -> list[int]:
    """The state after each row on the cheapest way, the ASCII-least of equal ones."""
    if not items:
        return []
    states = [0] * len(items)
    todo = [(0, len(items), start, tuple(last))]
    while todo:
        lo, hi, first, ends = todo.pop()
        mid = max(lo + 1, (lo + hi) // 2)
        cost, rank = forward(items[lo:mid], first)
        rest = backward(items[mid:hi], ends)
        q = min(range(4), key=lambda i: (min(cost[i] + rest[i], FAR), rank[i]))
        states[mid - 1] = q
        if mid - lo > 1:
            todo.append((lo, mid, first, tuple(0 if i == q else FAR for i in range(4))))
        if mid < hi:
            todo.append((mid, hi, q, ends))
    return states


def whole(codes: bytes) -> Matrix:
    """A stretch of rows as one matrix."""
    items = [ROWS[c] for c in codes]
    rows = [forward(items, p) for p in range(4)]
    return tuple(tuple(c) for c, _ in rows), tuple(tuple(r) for _, r in rows)


def solve(codes: bytes, start: int = NOTHING, end: int = -1) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """Each row's edits, and the state after the row itself; ``end`` -1: the conversation ends here."""
    last = LAST if end < 0 else [0 if i == end else FAR for i in range(4)]
    states = crossings([ROWS[c] for c in codes], start, last)
    before = [start, *states]
    edits = [EDITS[c][p, q][1] for c, p, q in zip(codes, before, states)]
    if end < 0 and states:
        edits[-1] += "I" * (LAST[states[-1]] // INSERT)
    return tuple(edits), tuple(states)


def roles(edits: str, before: int, after: int) -> list[str]:
    """The role that each letter of a row's edits gives (deleted and kept rows: empty)."""
    out, state = [], before
    for letter in edits:
        if letter in "IR":
            state = ASSISTANT if state == USER else USER
            out.append("assistant" if state == ASSISTANT else "user")
        else:  # the row itself; inserts that follow start from where it leads
            state = after
            out.append("")
    return out


def edit_cost(edits: str, code: int) -> int:
    late = TRUNCATED if code & CUT_OFF and "D" not in edits else 0
    return late + INSERT * edits.count("I") + REROLE * edits.count("R") + DELETE * edits.count("D")


# --- Spark -------------------------------------------------------------------

def turn_key() -> list[Column]:
    """128 bits of a row's conversation, role and text."""
    return [F.xxhash64(F.lit(i), "conv_id", "role", "text").alias(name) for i, name in enumerate(("key_a", "key_b"))]


def ordered_rows(turns: DataFrame) -> DataFrame:
    """Rows without texts in conversation order: ``place`` grows along a
    conversation, its upper bits name the range it lies in."""
    text, initial = F.col("text"), F.substring("role", 1, 1)
    code = (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
            + F.when(~text.rlike("[^ \\t\\n\\x0B\\f\\r]"), BLANK)
            .when(~F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1).isin(*ENDS), CUT_OFF).otherwise(0))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "head", "key_a", "key_b", "salt"]
    rows = turns.select("conv_id", "turn", "role", F.substring(text, 1, 32).alias("head"), *turn_key(),
                        code.cast("int").alias("code"), F.monotonically_increasing_id().alias("salt"))
    return cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.monotonically_increasing_id().alias("place"), "conv_id", "role", "key_a", "key_b", "code"))


def coded_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with repeated turns marked, sorted within each range."""
    said = rows.filter(F.col("code").bitwiseAND(BLANK) == 0)
    first = said.groupBy("key_a", "key_b").agg(F.min("place").alias("place"))
    both = rows.withColumn("first", F.lit(0)).unionByName(
        first.select("place", F.lit(1).alias("first")), allowMissingColumns=True)
    sorted_ = both.withColumn("part", F.shiftright("place", 33)).repartition("part").sortWithinPartitions("place", "first")
    names = ["part", "place", "conv_id", "role", "key_a", "key_b", "code"]
    schema = sorted_.select(*names).schema

    def marked(table: pa.Table) -> pa.Table:
        first = table["first"].to_numpy()
        own = np.flatnonzero(first == 0)
        out = table.take(pa.array(own)).select(names)
        code, follows = out["code"].to_numpy(), np.append(first, 0)[own + 1] == 1
        again = np.where((code & BLANK == 0) & ~follows, REPEATED, 0)
        return out.set_column(names.index("code"), "code", pa.array((code | again).astype(np.int32)))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last row, whose mark may follow
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            starts = np.flatnonzero(held["first"].to_numpy() == 0)
            if len(starts) and starts[-1]:
                yield from marked(held.slice(0, int(starts[-1]))).to_batches()
                held = held.slice(int(starts[-1]))
        if held is not None and held.num_rows:
            yield from marked(held).to_batches()

    return cut(sorted_.mapInArrow(mark, schema))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Range by range: its rows, and where each conversation begins in them (and their end)."""

    def cut_up(held: list[pa.Table]) -> tuple[pa.Table, np.ndarray]:
        table = pa.concat_tables(held).combine_chunks()
        conv = table["conv_id"]
        differs = pc.fill_null(pc.not_equal(conv.slice(1), conv.slice(0, len(conv) - 1)), False).to_numpy()
        none = pc.is_null(conv).to_numpy()
        begins = np.flatnonzero(differs | (none[1:] != none[:-1])) + 1
        return table, np.concatenate([[0], begins, [len(conv)]])

    held: list[pa.Table] = []
    for batch in batches:
        part = batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi > lo:
                if held and held[0]["part"][0].as_py() != part[lo]:
                    yield cut_up(held)
                    held = []
                held.append(pa.Table.from_batches([batch.slice(lo, hi - lo)]))
    if held:
        yield cut_up(held)


def _conv_type(df: DataFrame) -> str:
    return next(f for f in df.schema.fields if f.name == "conv_id").dataType.simpleString()


#: No state: the conversation lies within its range.
WITHIN = -2


def open_ends(coded: DataFrame) -> DataFrame:
    """The states before and after the first (``head``) and the last (``tail``)
    conversation of each range; -1: the conversation ends there.  One row a range."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in _ranges(batches):
            last = len(at) - 2
            codes, ks = table["code"].to_numpy().astype(np.uint8), sorted({0, last})
            made = [whole(codes[at[k]:at[k + 1]].tobytes()) for k in ks]
            yield pa.RecordBatch.from_arrays(
                [table["part"].take(pa.array([at[k] for k in ks])).combine_chunks(),
                 table["conv_id"].take(pa.array([at[k] for k in ks])).combine_chunks(),
                 pa.array([k == 0 for k in ks]), pa.array([k == last for k in ks]),
                 pa.array([[c for row in cost for c in row] for cost, _ in made], pa.list_(pa.int64())),
                 pa.array([[c for row in rank for c in row] for _, rank in made], pa.list_(pa.int32()))],
                names=["part", "conv_id", "head", "tail", "cost", "rank"])

    def ends(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part", ignore_index=True)

        def square(flat) -> tuple:
            return tuple(tuple(int(c) for c in flat[4 * p:4 * p + 4]) for p in range(4))

        states = crossings([(square(c), square(r)) for c, r in zip(frame["cost"], frame["rank"])], NOTHING, LAST)
        return pd.DataFrame({"part": frame["part"], "head": frame["head"], "tail": frame["tail"],
                             "start": [NOTHING, *states[:-1]], "end": [*states[:-1], -1]})

    found = coded.mapInArrow(edges, f"part long, conv_id {_conv_type(coded)}, head boolean, tail boolean, cost array<long>, rank array<int>")
    solved = found.groupBy("conv_id").applyInPandas(ends, "part long, head boolean, tail boolean, start int, end int")
    return cut(solved.groupBy("part").agg(*[
        F.max(F.when(F.col(side), F.col(state))).alias(f"{side}_{state}") for side in ("head", "tail") for state in ("start", "end")]))


def plan_repairs(turns: DataFrame) -> DataFrame:
    """Edits and totals of all conversations, as a written table with two kinds of rows.

    ``kind`` 'turn': a turn that stays or is inserted, ``place, step`` its
    order, ``edit`` K, R or I, ``role`` the new role, ``key_a, key_b`` the row
    it comes from (inserted: NULL).  ``kind`` 'stretch': the part of a
    conversation that lies in one range, ``place`` its first row, with
    ``audit``, ``cost``, ``counts`` (blank, duplicate, truncated, illegal) and
    the first and last initial ``ends``.
    """
    coded = coded_rows(ordered_rows(turns))
    sides = ["head_start", "head_end", "tail_start", "tail_end"]
    states = open_ends(coded)  # one row for each range of the sort, so the ranges bound the broadcast
    rows = coded.join(F.broadcast(states), "part", "left").select(*coded.columns, *[F.coalesce(c, F.lit(WITHIN)).alias(c) for c in sides])
    schema = (f"kind string, conv_id {_conv_type(coded)}, place long, step int, edit string, role string, key_a long, key_b long, "
              "audit string, cost long, counts array<long>, ends array<int>")
    names = [field.split()[0] for field in schema.split(", ")]
    types = dict(step=pa.int32(), edit=pa.string(), role=pa.string(), key_a=pa.int64(), key_b=pa.int64(), audit=pa.string(),
                 cost=pa.int64(), counts=pa.list_(pa.int64()), ends=pa.list_(pa.int32()))
    legal = np.zeros((4, 4), bool)
    legal[0, 1] = legal[1, 2] = legal[2, 1] = True

    def batch(table: pa.Table, kind: str, at: list[int], columns: dict[str, list]) -> pa.RecordBatch:
        rows = pa.array(at, pa.int64())
        made = {"kind": pa.array([kind] * len(at), pa.string())}
        made |= {c: table[c].take(rows).combine_chunks() for c in ("conv_id", "place")}
        made |= {c: pa.array(columns[c], t) if c in columns else pa.nulls(len(at), t) for c, t in types.items()}
        return pa.RecordBatch.from_arrays([made[c] for c in names], names=names)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solved: dict[tuple, tuple] = {}  # of short stretches, which repeat
        for table, at in _ranges(batches):
            codes = table["code"].to_numpy().astype(np.uint8)
            ends = [table[c][0].as_py() for c in sides]
            last = len(at) - 2
            turn: dict[str, list] = {c: [] for c in ("at", "step", "edit", "role")}
            sums: dict[str, list] = {c: [] for c in ("audit", "cost", "counts", "ends")}
            for k in range(last + 1):
                lo, hi = int(at[k]), int(at[k + 1])
                start, end = NOTHING, -1
                if k == 0 and ends[0] != WITHIN:
                    start, end = ends[:2]
                elif k == last and ends[2] != WITHIN:
                    start, end = ends[2:]
                part = codes[lo:hi]
                asked = (part.tobytes(), start, end)
                if asked not in solved:
                    if len(solved) > 20_000:
                        solved.clear()
                    solved[asked] = solve(*asked)
                edits, after = solved[asked] if hi - lo <= 64 else solved.pop(asked)
                before, cost = start, 0
                for i, letters, state in zip(range(lo, hi), edits, after):
                    cost += edit_cost(letters, int(codes[i]))
                    for step, (letter, role) in enumerate(zip(letters, roles(letters, before, state))):
                        if letter != "D":
                            for name, value in (("at", i), ("step", step), ("edit", letter), ("role", role)):
                                turn[name].append(value)
                    before = state
                initial = part & 3
                sums["audit"].append("".join(edits))
                sums["cost"].append(cost)
                sums["counts"].append([int((part & BLANK > 0).sum()), int((part & REPEATED > 0).sum()),
                                       int((part & (CUT_OFF | REPEATED) == CUT_OFF).sum()),
                                       int((~legal[initial[:-1], initial[1:]]).sum())])
                sums["ends"].append([int(initial[0]), int(initial[-1])])
            rows, put = turn.pop("at"), np.array(turn["edit"], dtype=object) == "I"
            taken = table.select(["role", "key_a", "key_b"]).take(pa.array(rows, pa.int64()))
            turn["role"] = [new or own for new, own in zip(turn["role"], taken["role"].to_pylist())]
            for c in ("key_a", "key_b"):
                turn[c] = pa.array(taken[c].to_numpy(), pa.int64(), mask=put)
            yield batch(table, "turn", rows, turn)
            yield batch(table, "stretch", at[:-1].tolist(), sums)

    return cut(rows.mapInArrow(plan, schema))


def audits(plan: DataFrame) -> DataFrame:
    """``conv_id, blank, duplicate, truncated, illegal, cost, audit`` of :func:`plan_repairs`' table."""
    s = F.col("s")

    def total(value) -> Column:
        return F.aggregate(F.transform(s, value), F.lit(0).cast("long"), lambda a, b: a + b)

    def counted(i: int) -> Column:
        return total(lambda x: F.get(x["counts"], F.lit(i)))

    count = [counted(i) for i in range(4)]
    seams = F.size(F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i < F.size(s)) & ~F.concat(
        F.get(F.get(s, i - 1)["ends"], F.lit(1)).cast("string"), F.get(F.get(s, i)["ends"], F.lit(0)).cast("string")).isin("01", "12", "21")))
    fields = F.struct("place", "audit", "cost", "counts", "ends")
    return (
        plan.filter("kind = 'stretch'").groupBy("conv_id").agg(F.sort_array(F.collect_list(fields)).alias("s"))
        .select("conv_id", count[0].alias("blank"), count[1].alias("duplicate"), count[2].alias("truncated"),
                (count[3] + seams).alias("illegal"),
                total(lambda x: x["cost"]).alias("cost"),
                F.array_join(F.transform(s, lambda x: x["audit"]), "").alias("audit"))
    )


def repaired_turns(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """``conv_id, place, step, edit, role, text``: the turns of the repaired
    conversations, in the order of ``place, step``.

    A turn that stays is the first of its role and text, so its text is
    fetched by these; copies are merged before the shuffle.
    """
    key, names = ["key_a", "key_b"], ["conv_id", "place", "step", "edit", "role"]
    texts = turns.select(*turn_key(), "text").dropDuplicates(key)
    stays, put = plan.filter("kind = 'turn' AND edit != 'I'"), plan.filter("kind = 'turn' AND edit = 'I'")
    return stays.join(texts, key).select(*names, "text").unionByName(put.select(*names, F.lit("").alias("text")))


def repair_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The audits and the repaired turns of ``turns`` (``conv_id, turn, role, text``).

    Rows are taken by turn, NULL turns first, then by role, the text's first 32
    characters and a hash of it.  A row's first fault counts: blank (nothing
    but white space), duplicate (role and text seen earlier in the
    conversation), truncated (the last character that is not white space ends
    no sentence).  Keeping a row costs 0, giving it the role user or assistant
    3, deleting it 4, inserting an empty turn 3, leaving a truncated row in 3;
    blank rows and duplicates must go.

    NULL roles and texts count as one space, so such texts are blank; roles
    whose first letter is not s, u or a (an empty one included) can't be kept
    as they are.  Rows of a NULL ``conv_id`` are one conversation.  Repeated
    rows are duplicates.  Other columns are ignored; an empty table gives two
    empty tables.  A conversation may hold any share of all rows: no step but
    the joining of its audit string brings its rows together.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    plan = plan_repairs(rows)
    return audits(plan), repaired_turns(rows, plan)


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``role:text`` lines, joined by newlines.

    A digest reads its conversation in order, so each is one stream: rows are
    sorted by Spark (which spills) and hashed as they pass.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, name, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            ids, done = batch.column(0).to_pylist(), []
            for conv_id, role, text in zip(ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if state is None or conv_id != name:
                    if state is not None:
                        done.append((name, state.hexdigest()))
                    state, name = hashlib.sha256(), conv_id
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8"))
            yield _pairs(done, kind)
        if state is not None:
            yield _pairs([(name, state.hexdigest())], kind)

    lines = repaired.select("conv_id", "role", "text", "place", "step").repartition("conv_id").sortWithinPartitions("conv_id", "place", "step")
    return lines.mapInArrow(hashed, f"conv_id {_conv_type(repaired)}, repaired_sha256 string")


def _pairs(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())],
                                      names=["conv_id", "repaired_sha256"])


def damaged(turns: DataFrame) -> DataFrame:
    """The query's fixed damage, by crc32 of ``conv_id:turn`` modulo 20."""
    space = F.lit(" ")
    code = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("code")).filter("code != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = damaged(table)
    found, repaired = repair_conversations(rows)
    span = rows.groupBy("conv_id").agg(F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count_distinct("turn").alias("n"))
    out = table.select("conv_id").distinct().select(F.col("conv_id").alias("id"))
    for part in (span, found, digests(repaired)):
        renamed = part.withColumnRenamed("conv_id", "other")
        out = out.join(renamed, F.col("id").eqNullSafe(F.col("other")), "left").drop("other")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        F.col("id").alias("conv_id"), F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n"), F.lit(0)).cast("long").alias("gaps"), *zero,
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: The same repairs as a recursive query, row by row, that carries every state's best edits.
OP13_SQL = r"""
WITH RECURSIVE numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS code
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM numbered WHERE code <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM hurt
), marked AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN bare = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), leads(m, initial, q) AS (VALUES ('n', 's', 's'), ('n', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), puts(p, m, edits, said) AS (VALUES
  ('n', 'n', '', CAST([] AS VARCHAR[])), ('n', 'u', 'I', ['user:']), ('n', 'a', 'II', ['user:', 'assistant:']),
  ('s', 's', '', []), ('s', 'u', 'I', ['user:']), ('s', 'a', 'II', ['user:', 'assistant:']),
  ('u', 'u', '', []), ('u', 'a', 'I', ['assistant:']), ('a', 'a', '', []), ('a', 'u', 'I', ['user:'])
), moves AS (
  SELECT p, m AS q, 'D' AS edit, '' AS initial, edits || 'D' AS edits, said, 3 * length(edits) + 4 AS cost FROM puts
  UNION ALL
  SELECT p, q, 'K', initial, edits || 'K', said, 3 * length(edits) FROM puts JOIN leads USING (m)
  UNION ALL
  SELECT p, q, 'R', initial, edits || 'R', said, 3 * length(edits) + 3 FROM puts JOIN leads USING (m) WHERE initial <> 's'
), ways AS (
  SELECT conv_id, 0::BIGINT AS i, 'n' AS q, {'cost': 0::BIGINT, 'audit': '', 'said': CAST([] AS VARCHAR[])} AS best
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT w.conv_id, r.i, v.q, min({
    'cost': CAST(w.best.cost + v.cost + CASE WHEN r.fault = 'truncated' AND v.edit <> 'D' THEN 3 ELSE 0 END AS BIGINT),
    'audit': w.best.audit || v.edits,
    'said': list_concat(w.best.said, v.said, CASE v.edit WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [r.role || ':' || r.text]
            ELSE [CASE v.initial WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text] END)})
  FROM ways w JOIN marked r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
  JOIN moves v ON v.p = w.q AND (v.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate') AND (v.edit = 'R' OR v.initial = r.initial))
  GROUP BY w.conv_id, r.i, v.q
), totals AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), ends AS (
  SELECT w.conv_id, min({'cost': w.best.cost + 3 * length(p.edits), 'audit': w.best.audit || p.edits, 'said': list_concat(w.best.said, p.said)}) AS best
  FROM ways w LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM w.conv_id JOIN puts p ON p.p = w.q AND (p.m = 'a' OR w.q = 'n' AND p.m = 'n')
  WHERE w.i = coalesce(t.n, 0) GROUP BY w.conv_id
)
SELECT e.conv_id, coalesce(t.gaps, 0)::BIGINT AS gaps, coalesce(t.blank, 0)::BIGINT AS blank, coalesce(t.duplicate, 0)::BIGINT AS duplicate,
  coalesce(t.truncated, 0)::BIGINT AS truncated, coalesce(t.illegal, 0)::BIGINT AS illegal, e.best.cost::BIGINT AS cost, e.best.audit AS audit,
  sha256(array_to_string(e.best.said, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
"""

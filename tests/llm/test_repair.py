"""Conversation repair against every possible edit string, and against its SQL."""

import hashlib
import itertools
import random
from collections import defaultdict

from marginlens.llm import repair
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, place int, code string"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_repair(rows):
    """All edit strings of at most two inserted turns in a place, the best by (cost, string)."""
    marks = faults(rows)
    found = {("", ""): (0, "", [])}  # (state, edits): every string is kept
    for (role, text), mark in [*zip(rows, marks), ((None, None), None)]:
        put = dict(found)
        for _ in range(2):
            for (state, edits), (cost, _, said) in list(put.items()):
                for new in ("user", "assistant"):
                    if new[0] in NEXT[state]:
                        put.setdefault((new[0], edits + "I"), (cost + 3, edits + "I", said + [new + ":"]))
        if role is None:
            found = put
            break
        found = {}
        for (state, edits), (cost, _, said) in put.items():
            found[state, edits + "D"] = (cost + 4, edits + "D", said)
            if mark not in ("blank", "duplicate"):
                late = 3 if mark == "truncated" else 0
                if role[:1] and role[:1] in NEXT[state]:
                    found[role[0], edits + "K"] = (cost + late, edits + "K", said + [f"{role}:{text}"])
                for new in ("user", "assistant"):
                    if new[0] in NEXT[state]:
                        found[new[0], edits + "R"] = (cost + late + 3, edits + "R", said + [f"{new}:{text}"])
    cost, audit, said = min((v for (state, _), v in found.items() if state in ("", "a")), key=lambda v: v[:2])
    return marks, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()


def code_of(role, mark):
    return {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + {"": 0, "blank": 4, "duplicate": 16, "truncated": 8}[mark]


def some_rows(rng, n):
    return [(rng.choice(["system", "user", "assistant", "tool", "user", "assistant"]), rng.choice(["a.", "b", "c!", " ", "d.\n", "e?"])) for _ in range(n)]


def test_divide_and_conquer_finds_the_least_of_all_edit_strings():
    rng = random.Random(3)
    for case in range(1500):
        rows = some_rows(rng, rng.randint(0, 5))
        marks, cost, audit, _ = every_repair(rows)
        codes = bytes(code_of(role, mark) for (role, _), mark in zip(rows, marks))
        edits, _ = repair.solve(codes)
        assert "".join(edits) == audit
        assert sum(map(repair.edit_cost, edits, codes)) == cost
        for k in range(1, len(codes)):  # cut into stretches, joined by their matrices
            parts = [codes[:k], codes[k:]]
            states = repair.crossings([repair.whole(p) for p in parts], repair.NOTHING, repair.LAST)
            halves = repair.solve(parts[0], repair.NOTHING, states[0])[0] + repair.solve(parts[1], states[0])[0]
            assert "".join(halves) == audit


def test_long_conversations_stay_linear():
    rng = random.Random(5)
    codes = bytes(rng.choice([0, 1, 2, 9, 10, 4, 17, 3]) for _ in range(20_000))
    edits, states = repair.solve(codes)
    cost = sum(map(repair.edit_cost, edits, codes))
    assert len(edits) == len(states) == len(codes)
    assert cost == min(c + e for c, e in zip(repair.forward([repair.ROWS[c] for c in codes], 0)[0], repair.LAST))


def results(spark, rows):
    found, turns = repair.repair_conversations(spark.createDataFrame(rows, SCHEMA))
    audits = {r.conv_id: r for r in found.collect()}
    said = defaultdict(list)
    for r in turns.orderBy("place", "step").collect():
        said[r.conv_id].append(f"{r.role}:{r.text}")
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digests(turns).collect()}
    assert digests == {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in said.items()}
    return audits, digests


def test_conversations_that_span_ranges(spark):
    """One conversation holds most rows, so that it lies in many ranges."""
    rng = random.Random(7)
    rows = []
    for conv in [1] * 1200 + [2, 3, 4, 5, 6] * 20:
        role, text = some_rows(rng, 1)[0]
        if rng.random() < 0.8:
            text = f"{rng.random()}."
        rows.append((conv, len(rows), role, text, 7, "c"))
    audits, digests = results(spark, rows)
    for conv in {r[0] for r in rows}:
        own = [(r[2], r[3]) for r in rows if r[0] == conv]
        marks = faults(own)
        codes = bytes(code_of(role, mark) for (role, _), mark in zip(own, marks))
        edits, _ = repair.solve(codes)
        got = audits[conv]
        assert got.audit == "".join(edits) and got.cost == sum(map(repair.edit_cost, edits, codes))
        assert [got.blank, got.duplicate, got.truncated] == [marks.count(m) for m in ("blank", "duplicate", "truncated")]
        pairs = ["".join(a[0] for a, _ in two) for two in itertools.pairwise(own)]
        assert got.illegal == sum(p not in ("su", "ua", "au") for p in pairs)
    short = [c for c in (2, 3, 4) if len([r for r in rows if r[0] == c]) < 30]
    assert short and all(c in digests for c in short)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "a.", 1, "x"), (1, None, "system", "first.", 1, "x"), (1, 1, None, "b.", 1, "x"),  # NULL turn first, NULL role
        (2, 0, "user", None, 1, "x"), (2, 1, "", "x.", 1, "x"),  # NULL text is blank; an empty role can't stay
        (None, 3, "user", "n.", 1, "x"), (None, 4, "assistant", "m.", 1, "x"),
        (3, 0, "user", "same.", 1, "x"), (3, 0, "user", "same.", 1, "x"), (3, 1, "assistant", "y" * 300_000 + ".", 1, "x"),
    ]
    audits, digests = results(spark, rows)
    for conv, own in {1: [("system", "first."), ("user", "a."), (" ", "b.")], 2: [("user", " "), ("", "x.")],
                      None: [("user", "n."), ("assistant", "m.")],
                      3: [("user", "same."), ("user", "same."), ("assistant", "y" * 300_000 + ".")]}.items():
        marks, cost, audit, sha = every_repair(own)
        got = audits[conv]
        assert (got.cost, got.audit) == (cost, audit)
        assert digests.get(conv, hashlib.sha256(b"").hexdigest()) == sha
        assert got.duplicate == marks.count("duplicate") and got.blank == marks.count("blank")
    found, turns = repair.repair_conversations(spark.createDataFrame([], SCHEMA))
    assert found.collect() == [] and turns.collect() == [] and repair.digests(turns).collect() == []


def test_damage_and_dropped_conversations(spark, tmp_path):
    table = spark.range(400).select(F.when(F.col("id") < 300, (F.col("id") / 2).cast("long")).otherwise(F.col("id")).alias("conv_id"), (F.col("id") % 2).alias("turn"),
                                    F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("Hm. Yes!").alias("text"))
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in repair.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert len(got) == 250  # conversations that lost all rows included
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = {r[0]: r for r in con.execute(f"SELECT {', '.join(names)} FROM ({repair.OP13_SQL})").fetchall()}
    assert {c: tuple(r[n] for n in names) for c, r in got.items()} == want
    assert any(r.audit == "" for r in got.values())

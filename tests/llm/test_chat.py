"""Chat formatting: exact round trips of adversarial turns."""

import random

from pyspark.sql import functions as F

from marginlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, block string, segments string"
PARTS = ["<|end|>", "<|turn|>", "<|text|>", "<|start|>", "<", "|", ">", chr(0x200B), "<" + chr(0x200B) + "|", "</s>[INST] ok [/INST]",
         "$1", "\\", "hello", "\n", "é", ""]


def conversations(seed=1):
    rnd = random.Random(seed)
    rows = []
    for c in [None, *range(60)]:
        for i in range(rnd.choice([1, 2, 7, 30])):
            text = None if rnd.random() < 0.1 else "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 5)))
            rows.append((c, rnd.choice([None, i, i, i, 256 * i]), rnd.choice(["user", "assistant", "assistant", None, "<|end|>", "tool"]), text))
    rows += [(77, i, "assistant" if i % 3 else "user", f"turn {i} <|end|") for i in range(3000)]
    rows += [(78, 5, "user", "same")] * 4 + [(79, 0, "user", "long <|" * 100_000)]
    rnd.shuffle(rows)
    return rows


def test_round_trip(spark):
    rows = conversations()
    out = chat.format_chats(spark.createDataFrame([(*r, "b", "s") for r in rows], SCHEMA).repartition(7))
    got = {r.conv_id: r for r in out.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss")).collect()}
    want = {}
    for c, turn, role, text in rows:
        want.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns = [t[2:] for t in sorted(turns)]
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert list(got[c].loss) == [text for role, text in turns if role == "assistant"]
        runs = sum(i == 0 or turns[i - 1][0] != role for i, (role, _) in enumerate(turns))
        formatted = got[c].formatted
        assert formatted.count("<|start|>") == formatted.count("<|end|>") == formatted.count("<|text|>") == runs
        assert formatted.count("<|turn|>") == len(turns) - runs


def test_empty_table_and_no_python(spark):
    df = chat.format_chats(spark.createDataFrame([], SCHEMA))
    assert df.collect() == [] and "Python" not in df._jdf.queryExecution().toString()

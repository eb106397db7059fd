"""Chat formatting: conversations as one string each, with Spark expressions only.

A run of turns by one role becomes

    <|start|>role<|text|>text<|turn|>text<|end|>

Inside roles and texts every ``<`` followed by zero-width spaces and ``|``
gets one zero-width space more, so that no control string can occur there;
taking one away again restores them.

Turns are collected in blocks of bounded turn ranges, each block is sorted and
merged by array aggregation, and the blocks of a conversation are stitched in
order.  A conversation that holds a third of all turns is thus merged by many
tasks, and only its finished segments meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings and the escape character.
START, TEXT, TURN, END = "<|start|>", "<|text|>", "<|turn|>", "<|end|>"
ZWSP = chr(0x200B)

#: Turn numbers of a block.
BLOCK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"<({ZWSP}*)\\|", f"<{ZWSP}$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"<{ZWSP}({ZWSP}*)\\|", "<$1|")


def _open(role: Column, before: Column) -> Column:
    """What stands between a text and the one before; ``before`` is that one's role or NULL."""
    start = F.concat(F.lit(START), escape(role), F.lit(TEXT))
    return F.when(before.isNull(), start).when(before == role, F.lit(TURN)).otherwise(F.concat(F.lit(END), start))


def _merged(turns: Column, trained: list[str]) -> Column:
    """Body and loss spans of sorted turns, without what stands before the first text."""
    empty = F.array().cast("array<struct<start:int,length:int>>")
    state = F.struct(F.lit(None).cast("string").alias("role"), F.array().cast("array<string>").alias("parts"),
                     F.lit(0).alias("at"), empty.alias("loss"))

    def step(acc: Column, turn: Column) -> Column:
        head = F.when(acc["role"].isNull(), F.lit("")).otherwise(_open(turn["role"], acc["role"]))
        text = escape(turn["text"])
        start = acc["at"] + F.length(head)
        span = F.array(F.struct(start.alias("start"), F.length(text).alias("length")))
        return F.struct(
            turn["role"].alias("role"), F.concat(acc["parts"], F.array(head, text)).alias("parts"),
            (start + F.length(text)).alias("at"),
            F.when(turn["role"].isin(*trained), F.concat(acc["loss"], span)).otherwise(acc["loss"]).alias("loss"))

    return F.aggregate(turns, state, step, lambda acc: F.struct(
        F.get(turns, F.lit(0))["role"].alias("first"), acc["role"].alias("last"),
        F.array_join(acc["parts"], "").alias("body"), acc["loss"].alias("loss")))


def format_chats(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, segments, formatted`` for rows ``conv_id, turn, role, text``.

    ``segments`` is an array of ``text`` and ``loss``, the spans (start,
    length, in code points of that segment) of the escaped texts of
    ``trained`` roles; ``formatted`` is the segments' texts one after another.

    Turns are sorted by (turn, role, text), so ties have a fixed order and
    repeated rows are turns of their own.  NULL turns come first, NULL roles
    and texts count as empty, rows of a NULL ``conv_id`` are one conversation.
    Other columns, whatever their names, are ignored; an empty table gives an
    empty table.
    """
    rows = turns.select(
        "conv_id", F.floor(F.col("turn") / BLOCK).alias("block"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = (
        rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
        .select("conv_id", "block", _merged(F.col("turns"), list(trained)).alias("m"))
    )
    b = F.col("blocks")

    def segment(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(b, i - 1)["m"]["last"])
        head = _open(x["m"]["first"], before)
        text = F.concat(head, x["m"]["body"], F.when(i == F.size(b) - 1, F.lit(END)).otherwise(F.lit("")))
        loss = F.transform(x["m"]["loss"], lambda s: F.struct(
            (s["start"] + F.length(head)).alias("start"), s["length"].alias("length")))
        return F.struct(text.alias("text"), loss.alias("loss"))

    return (
        blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "m"))).alias("blocks"))
        .select("conv_id", F.transform("blocks", segment).alias("segments"))
        .select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))
    )


def _literal(control: str) -> str:
    return control.replace("|", "\\|")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of ``role, text``."""
    runs = F.filter(F.split(formatted, _literal(END), -1), lambda run: run != "")

    def turns(run: Column) -> Column:
        parts = F.split(F.substring(run, len(START) + 1, 1 << 30), _literal(TEXT), 2)
        role = unescape(F.get(parts, F.lit(0)))
        return F.transform(F.split(F.get(parts, F.lit(1)), _literal(TURN), -1),
                           lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(runs, turns))


def read_loss(segments: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.flatten(F.transform(segments, lambda s: F.transform(
        s["loss"], lambda span: unescape(F.substring(s["text"], span["start"] + 1, span["length"])))))


def op6_chat_formatting(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    out = format_chats(turns.unionByName(own))
    read, loss = read_turns(F.col("formatted")), F.array_join("loss", "")
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select("conv_id", "formatted", read.alias("turns"), read_loss(F.col("segments")).alias("loss")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), w AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    length(regexp_replace(text, '<(' || chr(8203) || '*)\|', '<' || chr(8203) || '\1|', 'g')) AS text_chars,
    length(regexp_replace(role, '<(' || chr(8203) || '*)\|', '<' || chr(8203) || '\1|', 'g')) AS role_chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN before = role THEN length('<|turn|>')
       ELSE role_chars + length('<|start|>') + length('<|text|>') + length('<|end|>') END) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""

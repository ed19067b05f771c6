"""Operator 2: collapse of cumulative snapshots, then chat formatting.

Logs hold a conversation again and again as it grows. Every turn gets the hash of all
turns up to it: a running sum of hashes of (position, role, text), two of 64 bits each
and summed as decimals, so it can be added up in blocks. A conversation whose whole hash
is among the hashes of the strict prefixes of others goes by an anti-join; of equal
conversations the least id stays. What stays is rendered, in parts of ``PART`` turns.

Only ids, positions and hashes are numbered and compared, with the first ``BEGIN``
characters of a text; whole texts only where turns of one conversation, turn number and
role share these. Texts are read once more, for the conversations that stay. Positions come from ranges (``common.numbered``) and
sums from blocks of ``PART`` turns, so a conversation of any length is split over tasks.
A first turn that a third of all conversations share is one row per task.

DataFrame functions only. A row without ``conv_id`` belongs to no conversation and is left out.
Turns are ordered by ``turn`` (null last), then role, then text; a repeated row is one
turn; a null role is ``unknown``, a null text empty. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import numbered, pick, shuffle_width, stored, table

PART = 1024
BEGIN, TIED_ROWS = 64, 10_000

#: How a turn is written.
OPEN, BREAK, CLOSE = "<|", "|>\n", "\n<|end|>\n"


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    return pick(conversations, conv_id=conv_id, turn=turn, role=role, text=text).where("conv_id is not null").select(
        "conv_id", F.col("turn").isNull().alias("late"), "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(BREAK), text, F.lit(CLOSE))


def ties(rows: DataFrame) -> DataFrame | None:
    """Where turns differ only behind their first characters: ``tie``, their order by the
    whole text; None if there are none."""
    group = ["conv_id", "late", "turn", "role"]
    begun = rows.withColumn("begin", F.xxhash64(F.substring("text", 1, BEGIN)))
    ends = [end(F.xxhash64("text", F.lit(seed))).alias(f"_{name}{seed}") for seed in (1, 2) for name, end in (("low", F.min), ("high", F.max))]
    tied = stored(begun.groupBy(*group, "begin").agg(*ends).where("_low1 < _high1 or _low2 < _high2").select(*group, "begin"), "tied")
    if tied.isEmpty():
        return None
    other = tied.toDF(*[f"_{c}" for c in tied.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "turn" else F.col(c) == F.col(f"_{c}") for c in tied.columns]
    texts = stored(begun.join(other, same, "left_semi").select(*group, "text").distinct(), "tied-texts")
    # Few ranges, as their bounds are drawn from whole texts, 300 for each range.
    ranges = min(shuffle_width(rows.sparkSession), 1 + texts.count() // TIED_ROWS)
    return stored(
        numbered(texts, "conv_id", ["late", "turn", "role", "text"], "tie", ranges)
        .select(*[F.col(c).alias(f"_{c}") for c in group], F.md5("text").alias("_mark"), "tie"), "ties")


def prefixes(rows: DataFrame) -> DataFrame:
    """Per turn: its position from 1, the hash of all turns up to it, and the turns of
    its conversation."""
    key = F.md5("text").alias("mark")
    light = rows.select("conv_id", "late", "turn", "role", key, F.substring("text", 1, BEGIN).alias("begin")).distinct()
    tied = ties(rows)
    if tied is None:
        light = light.withColumn("tie", F.lit(0).cast("long"))
    else:
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "turn" else F.col(c) == F.col(f"_{c}") for c in ("conv_id", "late", "turn", "role", "mark")]
        light = light.join(tied, same, "left").select(*light.columns, F.coalesce("tie", F.lit(0)).alias("tie"))
    placed = stored(numbered(light, "conv_id", ["late", "turn", "role", "begin", "tie"], "at"), "turns")
    term = lambda seed: F.xxhash64("at", "role", "mark", F.lit(seed)).cast("decimal(20,0)")
    placed = placed.withColumns({"block": F.floor(F.col("at") / PART), "a": term(1), "b": term(2)})
    along = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv_id")
    before = placed.groupBy("conv_id", "block").agg(F.sum("a").alias("sa"), F.sum("b").alias("sb"), F.count(F.lit(1)).alias("n")).select(
        "conv_id", "block", F.coalesce(F.sum("sa").over(along), F.lit(0)).alias("pa"),
        F.coalesce(F.sum("sb").over(along), F.lit(0)).alias("pb"), F.sum("n").over(every).alias("n_turns"))
    inside = Window.partitionBy("conv_id", "block").orderBy("at")
    run = lambda c, p: (F.sum(c).over(inside) + F.col(p)).cast("decimal(38,0)")
    return placed.join(before, ["conv_id", "block"]).select(
        "conv_id", "late", "turn", "role", "mark", "block", (F.col("at") + 1).alias("k"),
        run("a", "pa").alias("ha"), run("b", "pb").alias("hb"), "n_turns")


def maximal(turned: DataFrame) -> DataFrame:
    """Conversations that no longer one begins with: least id of equal ones, turns, and
    how many are equal."""
    whole = turned.where("k = n_turns").select("conv_id", "k", "ha", "hb")
    inner = turned.where("k < n_turns").select("k", "ha", "hb").distinct()
    return (
        whole.join(inner, ["k", "ha", "hb"], "left_anti")
        .groupBy("k", "ha", "hb").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
        .select("conv_id", F.col("k").alias("n_turns"), "n_copies")
    )


def collapsed(conversations: DataFrame, **columns: str) -> DataFrame:
    """Per conversation that stays and part of it: ``conv_id``, ``part`` from 0,
    ``n_turns`` and ``n_copies`` of the whole, and ``text``."""
    rows = turns(conversations, **columns)
    turned = stored(prefixes(rows), "prefixes")
    stay = stored(maximal(turned), "maximal")
    key = F.struct("late", "turn", "role", "text")
    short = rows.join(stay.where(F.col("n_turns") <= PART), "conv_id").withColumn("part", F.lit(0).cast("long"))
    # Long conversations: every turn takes its block from its position.
    long = rows.join(stay.where(F.col("n_turns") > PART), "conv_id").withColumn("mark", F.md5("text"))
    blocks = turned.where(F.col("n_turns") > PART).select(
        "conv_id", F.col("turn").alias("_turn"), F.col("role").alias("_role"), F.col("mark").alias("_mark"), F.col("block").alias("part"))
    same = (F.col("turn").eqNullSafe(F.col("_turn"))) & (F.col("role") == F.col("_role")) & (F.col("mark") == F.col("_mark"))
    long = long.join(blocks.withColumnRenamed("conv_id", "_conv"), (F.col("conv_id") == F.col("_conv")) & same)
    columns_ = ["conv_id", "part", "n_turns", "n_copies", "late", "turn", "role", "text"]
    return (
        short.select(*columns_).unionByName(long.select(*columns_))
        .groupBy("conv_id", "part", "n_turns", "n_copies").agg(F.sort_array(F.collect_set(key)).alias("said"))
        .select("conv_id", "part", "n_turns", "n_copies",
                F.array_join(F.transform("said", lambda t: rendered(t["role"], t["text"])), "").alias("text"))
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapsed(table(spark, sf_dir, "conversations"))


OP2_SQL = """
with turns as (
  select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls last, role, text) as k from turns
), written as (
  select conv_id, k, string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '')
    over (partition by conv_id order by k) as said,
    -- lengths make the joined text stand for one list of turns only
    string_agg(length(role) || ':' || length(text) || ':' || role || text, '') over (partition by conv_id order by k) as mark,
    count(*) over (partition by conv_id) as n
  from placed
), whole as (
  select conv_id, n, said, mark from written where k = n
)
select min(conv_id) as conv_id, cast(0 as bigint) as part, n as n_turns, count(*) as n_copies, said as text
from whole
where mark not in (select mark from written where k < n)
group by n, said, mark
"""

r"""Operator 7, chat formatting: a dialogue rendered once for each participant, with that speaker as the assistant.

Turns stand in the order of turn number, then role, then text. In a participant's rendering the own turns are headed
`assistant`, all others `user name=<role>`; the mask covers the own turns' text and end mark, so only these are learned.
`system` takes no part in the dialogue: its turns are headed `system` in every rendering, and it has none of its own. Where a role or
text holds `<|`, or a backslash, these get a backslash before or between (`<\|`, `\\`), so no text passes for a mark; line ends in a
role are spaces.
Turns are gathered in pieces of bounded size, by blocks of turn numbers: a dialogue of up to 64 turns is one piece, a
longer one several, with the character offset of each in the whole. No dialogue is ever gathered as one row, and offsets come
from the pieces' sizes, summed in two steps.

Defined results: a dialogue of system turns alone has no rendering; a null role is the participant `unknown`, a null text is empty, a null turn comes first; repeated rows
are repeated turns; other columns are kept out; rows with a null conv_id are one dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varspan.llm.common import written
from varspan.sources.text import ranked

#: Turn numbers in a block, turns in a piece of it (turn numbers may repeat), and blocks whose sizes are summed up together.
TURNS, PIECE, SPAN = 64, 256, 1024
START, END = "<|start|>", "<|end|>\n"
SYSTEM = "system"


def escaped(text: Column) -> Column:
    """A text in which no mark stands; unescaped by taking away the backslash after `<` and one of two backslashes."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def rotate(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, perspective, block, piece, n_turns, start, text, mask (array of start and end in this piece), n_masked."""
    c = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), escaped(F.translate(F.coalesce(F.col(role_col), F.lit("unknown")), "\r\n", "  ")).alias("role"), escaped(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    c = c.withColumn("block", F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-1)))
    # places in a block by ranks of a range sort: turns that are null or share a number go over many tasks
    c = ranked(c.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))), "conv", "block", "turn", "role", "text")
    first = written(c.groupBy("conv", "block").agg(F.min("rank").alias("first")))
    c = c.join(first, ["conv", "block"]).withColumn("k", (F.col("rank") - F.col("first")).cast("int")).withColumn("piece", F.floor(F.col("k") / PIECE)).drop("conv", "rank", "first")
    pieces = c.groupBy("conv_id", "block", "piece").agg(F.array_sort(F.collect_list(F.struct("k", "role", "text"))).alias("turns"))
    speakers = c.select("conv_id", F.col("role").alias("perspective")).where(F.col("perspective") != SYSTEM).distinct()
    pair = pieces.join(speakers.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    own = lambda t: t["role"] == F.col("perspective")
    head = lambda t: F.concat(F.lit(START), F.when(own(t), F.lit("assistant")).when(t["role"] == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), t["role"])), F.lit("\n"))
    body = lambda t: F.concat(t["text"], F.lit(END))
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("mask"))

    def step(s, t):
        lo = s["at"] + F.length(head(t))
        hi = lo + F.length(body(t))
        return F.struct(hi.alias("at"), F.when(own(t), F.concat(s["mask"], F.array(F.struct(lo.alias("start"), hi.alias("end"))))).otherwise(s["mask"]).alias("mask"))

    done = pair.select("conv_id", "perspective", "block", "piece", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: F.concat(head(t), body(t))), "").alias("text"), F.aggregate("turns", state, step).alias("s"))
    # a null conv_id is a dialogue too; keys of the joins below are never null
    key = F.struct(F.col("conv_id").isNull().alias("null"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id")).alias("key")
    done = written(done.select(key, F.floor(F.col("block") / SPAN).alias("span"), "*"))
    # offsets from sizes alone: sums within spans of blocks, and of the spans before
    place = ["key", "perspective", "span"]
    sizes = done.select(*place, "block", "piece", F.col("s.at").alias("size"))
    inside = Window.partitionBy(*place).orderBy("block", "piece")
    before = Window.partitionBy("key", "perspective").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = sizes.groupBy(*place).agg(F.sum("size").alias("size")).select(*place, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    starts = sizes.select(*place, "block", "piece", (F.sum("size").over(inside) - F.col("size")).alias("own")).join(spans, place)
    done = done.join(starts.select(*place, "block", "piece", (F.col("base") + F.col("own")).alias("start")), [*place, "block", "piece"])
    masked = F.aggregate("s.mask", F.lit(0).cast("long"), lambda n, m: n + m["end"] - m["start"])
    return done.select("conv_id", "perspective", "block", "piece", "n_turns", "start", "text", F.col("s.mask").alias("mask"), masked.alias("n_masked"))


def query(conversations: DataFrame) -> DataFrame:
    spans = F.array_join(F.transform("mask", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"))), ",")
    return rotate(conversations).withColumn("mask", spans)


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, replace(replace(translate(coalesce(role, 'unknown'), concat(chr(13), chr(10)), '  '), '\', '\\'), '<|', '<\|') AS role,
    replace(replace(coalesce(text, ''), '\', '\\'), '<|', '<\|') AS text,
    coalesce(CAST(floor(turn / 64.0) AS BIGINT), -1) AS block FROM conversations),
k AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, block ORDER BY turn NULLS FIRST, role, text) - 1) AS k FROM c),
r AS (
  SELECT k.conv_id, p.perspective, k.block, k.k // 256 AS piece, k.k, k.role = p.perspective AS own,
    concat('<|start|>', CASE WHEN k.role = p.perspective THEN 'assistant' WHEN k.role = 'system' THEN 'system' ELSE concat('user name=', k.role) END, chr(10)) AS head,
    concat(k.text, '<|end|>', chr(10)) AS body
  FROM k JOIN (SELECT DISTINCT conv_id, role AS perspective FROM c WHERE role <> 'system') p ON p.conv_id IS NOT DISTINCT FROM k.conv_id),
s AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, block, piece ORDER BY k) AS hi FROM r),
g AS (
  SELECT conv_id, perspective, block, piece, count(*) AS n_turns, string_agg(concat(head, body), '' ORDER BY k) AS text,
    coalesce(string_agg(CASE WHEN own THEN concat(CAST(CAST(hi - length(body) AS BIGINT) AS VARCHAR), '-', CAST(CAST(hi AS BIGINT) AS VARCHAR)) END, ',' ORDER BY k), '') AS mask,
    CAST(sum(CASE WHEN own THEN length(body) ELSE 0 END) AS BIGINT) AS n_masked, CAST(max(hi) AS BIGINT) AS size
  FROM s GROUP BY ALL)
SELECT conv_id, perspective, block, piece, n_turns, CAST(coalesce(sum(size) OVER (PARTITION BY conv_id, perspective ORDER BY block, piece
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, text, mask, n_masked FROM g
"""

"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation several times, each snapshot a few turns
longer. A rolling hash of the turns so far (xor of 64-bit hashes of place and
content, under two seeds) is kept at every turn. A conversation whose whole
hash is the hash of an inner prefix of another one is a snapshot; an
anti-join on (turns, hash) drops it. Of equal conversations the one with the
smallest id stays. What is left is rendered with a chat template.

Only ids, turn numbers and digests are shuffled to find snapshots; prefix
hashes and whole conversations are pre-aggregated, so a first turn or a
conversation that a third of all logs share is one row after its map task.
Texts of the maximal conversations alone are shuffled, once, to be rendered;
a rendered conversation is one row, so its turns meet in one task, as a
stream through a sorted window or as that row.

Turns are ordered by number, null numbers last, ties by content. A null role
or text differs from an empty one and is rendered as empty. Rows with a null
conversation id form one conversation. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

#: Chat template of a turn.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def _content() -> Column:
    """Digest of role and text; null and empty differ, and so do ('ab', 'c') and ('a', 'bc')."""
    role = F.coalesce(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role")), F.lit("-"))
    text = F.coalesce(F.concat(F.lit("="), F.col("text")), F.lit("-"))
    return F.md5(F.concat(role, text).cast("binary"))


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text")
    ).withColumn("content", _content())


def prefixes(turns: DataFrame) -> DataFrame:
    """conv, place, a, b (rolling hashes), inner (a later turn follows), a row per turn."""
    order = Window.partitionBy("conv").orderBy(F.col("turn").isNull(), "turn", "content")
    placed = turns.select("conv", "turn", "content").select(
        "conv", "turn", "content", F.row_number().over(order).alias("place"), F.lead(F.lit(1)).over(order).isNotNull().alias("inner")
    )
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        "conv", "place", "inner",
        F.bit_xor(F.xxhash64(F.lit(1), "place", "content")).over(run).alias("a"),
        F.bit_xor(F.xxhash64(F.lit(2), "content", "place")).over(run).alias("b"),
    )


def maximal(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, n_turns, n_equal (logged conversations equal to it): the ones that prefix no longer one."""
    found = stored(prefixes(_turns(conversations, conv_col, turn_col, role_col, text_col)), "chat_prefixes")
    whole = found.where(~F.col("inner")).groupBy("place", "a", "b").agg(F.min("conv").alias("conv"), F.count("*").alias("n_equal"))
    longer = found.where("inner").select("place", "a", "b").distinct()
    return whole.join(longer, ["place", "a", "b"], "left_anti").select("conv", F.col("place").cast("long").alias("n_turns"), "n_equal")


def format_chats(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_col, n_turns, n_equal, text: the maximal conversations, rendered."""
    kept = stored(maximal(conversations, conv_col, turn_col, role_col, text_col), "chat_maximal")
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    rendered = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit(MIDDLE), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    own = turns.withColumnRenamed("conv", "own")
    joined = own.join(kept, F.col("own").eqNullSafe(F.col("conv"))).select("conv", "n_turns", "n_equal", F.struct(F.col("turn").isNull().alias("late"), "turn", "content", rendered.alias("shown")).alias("t"))
    grouped = joined.groupBy("conv", "n_turns", "n_equal").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return grouped.select(F.col("conv").alias(conv_col), "n_turns", "n_equal", F.array_join(F.transform("t", lambda t: t["shown"]), "").alias("text"))


#: DuckDB SQL of ``format_chats`` over conversations.
CHATS_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text,
         md5(COALESCE(length(role)::VARCHAR || ':' || role, '-') || COALESCE('=' || text, '-')) AS content FROM conversations),
placed AS (
  SELECT *, row_number() OVER o AS place, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         md5(string_agg(content, ',') OVER (PARTITION BY conv_id ORDER BY turn IS NULL, turn, content ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS h
  FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn IS NULL, turn, content)),
whole AS (
  SELECT h, place, min(conv_id) AS conv_id, count(*) AS n_equal FROM placed WHERE place = n_turns GROUP BY h, place),
kept AS (
  SELECT * FROM whole w WHERE NOT EXISTS (SELECT 1 FROM placed p WHERE p.h = w.h AND p.place = w.place AND p.place < p.n_turns))
SELECT k.conv_id, k.place::BIGINT AS n_turns, k.n_equal::BIGINT AS n_equal,
       string_agg('<|' || COALESCE(p.role, '') || '|>' || chr(10) || COALESCE(p.text, '') || '<|end|>' || chr(10), '' ORDER BY p.place) AS text
FROM kept k JOIN placed p ON p.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY ALL
"""

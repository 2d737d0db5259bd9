"""Filter interaction audit by a Gray-code walk over the subsets of filters.

1. Every text gets a mask of the filters that it fails, a bit a filter; the
   duplicate filter compares the ids of equal texts table-wide.
2. Rows are counted in cells: a cell is a part (source) and a mask. Copies of
   a text are collapsed in the map tasks, so a text that holds a third of all
   rows is a few rows a task, and no group is gathered.
3. Per part, a walk visits all subsets of filters in Gray-code order and
   toggles one filter a step. Each cell keeps a counter of its active
   failures; a cell leaves the running survivors when its counter rises from
   0 and returns when it falls to 0. The survivors of all subsets (32 for
   five filters) are stored.
4. What a step of an order removes is the difference of two stored states.

Words are maximal runs of characters other than space, tab, line feed,
vertical tab, form feed and carriage return. Null text is empty, a null
source is the part of the empty source. A null id is not larger than any
other, so such rows are no duplicates, nor make others duplicates; rows that
repeat id and text are copies of the same document, and the smallest id's
rows all stay. A document with several label rows is good or toxic if one of
them says so; without label it is neither. Other columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import text_or_empty
from ledgerlens.session import ship_package

WORD = r"[^\x20\x09-\x0D]+"
#: The filter that compares documents, not one text.
DUPLICATE = "E"
COUNTS = ("n", "good", "toxic")


def text_filters(text: str) -> dict[str, Column]:
    """Failure conditions on a text column, by letter."""
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(F.col(text), F.lit("[A-Z]")) > 2 * F.length(text),
        "D": F.col(text).rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """id, part, digest, mask (without the duplicate filter), n: equal rows as one."""
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text_or_empty(text_col).alias("t"))
    bits = [F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_filters("t").values())]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask + b
    return text.select("id", "part", F.sha2("t", 256).alias("digest"), mask.alias("mask")).groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the filters that they fail."""
    rows = failures(docs, id_col, text_col, part_col)
    flags = labels.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(good_col) == 1).cast("int")).alias("good"), F.max((F.col(toxic_col) == 1).cast("int")).alias("toxic"))
    flagged = rows.join(flags, "id", "left").select("id", "part", "digest", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # rows of equal text, part and labels; (id, n) is unique in them
    alike = flagged.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    smallest = alike.groupBy("digest").agg(F.min("first.id").alias("smallest"))
    kept = F.col("nameless") + F.when(F.col("first.id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    duplicate = 1 << len(text_filters("t"))
    split = F.array(F.struct(F.col("mask"), F.col("kept").alias("n")), F.struct((F.col("mask") + duplicate).alias("mask"), (F.col("n") - F.col("kept")).alias("n")))
    masked = alike.join(smallest, "digest").withColumn("kept", kept).select("part", "good", "toxic", F.explode(split).alias("c"))
    n = F.col("c.n")
    return masked.groupBy("part", F.col("c.mask").alias("mask")).agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def walk(masks: np.ndarray, counts: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every subset of filters: row s has the column sums of ``counts`` over the masks that share no bit with s."""
    active = np.zeros(len(masks), np.int64)
    running = counts.sum(axis=0)
    states = np.zeros((1 << filters, counts.shape[1]), np.int64)
    states[0] = running
    for step in range(1, 1 << filters):
        subset = step ^ (step >> 1)
        toggled = step & -step
        touched = np.flatnonzero(masks & toggled)
        if subset & toggled:
            running = running - counts[touched[active[touched] == 0]].sum(axis=0)
            active[touched] += 1
        else:
            active[touched] -= 1
            running = running + counts[touched[active[touched] == 0]].sum(axis=0)
        states[subset] = running
    return states


def survivors(cells: DataFrame, filters: int) -> DataFrame:
    """part, subset, kept, good, toxic: a row per part and subset of filters."""
    ship_package(cells.sparkSession)

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        states = walk(part["mask"].to_numpy(np.int64), part[list(COUNTS)].to_numpy(np.int64), filters)
        return pd.DataFrame({"part": key[0], "subset": np.arange(len(states)), "kept": states[:, 0], "good": states[:, 1], "toxic": states[:, 2]})

    return cells.groupBy("part").applyInPandas(run, "part string, subset long, kept long, good long, toxic long")


def audit(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """A row per part, order of the filters and step: what the step keeps, removes and leaves to nobody else."""
    ship_package(cells.sparkSession)
    bit = {x: 1 << k for k, x in enumerate(letters)}
    orders = ["".join(o) for o in itertools.permutations(letters)]
    names = [o for o in orders for _ in letters]
    own = np.array([bit[x] for o in orders for x in o])
    before = np.array([sum(bit[x] for x in o[:k]) for o in orders for k in range(len(o))])

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        masks, counts = part["mask"].to_numpy(np.int64), part[list(COUNTS)].to_numpy(np.int64)
        states = walk(masks, counts, len(letters))
        lost = states[before] - states[before | own]
        fails = {b: counts[masks & b > 0, 0].sum() for b in bit.values()}
        alone = {b: counts[masks == b, 0].sum() for b in bit.values()}
        everywhere = {b: lost[own == b, 0].sum() for b in bit.values()}
        return pd.DataFrame({
            "part": key[0], "filter_order": names, "step": np.tile(np.arange(1, len(letters) + 1), len(orders)),
            "kept": states[before | own, 0], "removed": lost[:, 0], "redundant": [fails[b] for b in own] - lost[:, 0],
            "unique_fails": [alone[b] for b in own], "good_lost": lost[:, 1], "toxic_lost": lost[:, 2], "shapley": [everywhere[b] for b in own],
        })

    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return cells.groupBy("part").applyInPandas(run, schema)


#: DuckDB SQL of ``audit`` over documents and labels.
AUDIT_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
flags AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM words LEFT JOIN flags USING (doc_id)),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(x, b)),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b | b.b | c.b | d.b | e.b = 31),
steps AS (
  SELECT filter_order, s::INT AS step, bits[s] AS own, list_sum(list_prepend(0, bits[1:s - 1]))::INT AS before
  FROM orders, range(1, 6) r(s)),
counted AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (mask & (before | own) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & own > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""

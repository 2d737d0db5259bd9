"""Sharding along a Hilbert curve over several metadata dimensions.

1. *Quantising.* Each dimension gets 2**BITS cells. A category (source,
   language) is cut by the rank of its value among the distinct ones, nulls
   first, so cells keep the order of values and file statistics can prune;
   the size in bytes is cut by half octaves.
2. *Curve.* The cells' index on the Hilbert curve orders the documents, equal
   texts of one cell next to each other (checksum, then id). The order is a
   range partitioning: a cell that holds a third of all rows is split over
   tasks by the further keys, the last of which is a row number.
3. *Cutting.* Rows are numbered in their task, with a running sum of sizes;
   one row a task gives the numbers of the tasks before it. Runs of the order
   become shards by one law: ``rows`` (counts at most one apart) or ``bytes``
   (a document goes where its middle byte falls, so a shard is off by at most
   one document).

``assign`` moves narrow rows only. ``write`` lays whole rows out as files,
folder by folder, each file a short piece of the curve; ``ranges`` says what a
shard holds of every dimension.

Null text has no bytes and checksum 0; the size is the number of bytes plus
1, so every row counts. Null ids come first among equal keys; repeated rows
get places of their own, in any order. Extra columns are ignored by
``assign`` and kept by ``write``, whatever their names (``shard`` and
``slot`` get a leading underscore where the input has them). An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import free_name, stored, text_or_empty
from ledgerlens.session import ship_package

SHARDS, BITS = 16, 6
CATEGORIES = ("source", "lang")
LAWS = ("rows", "bytes")


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of cell numbers (rows x dimensions).

    From the highest bit down, each level turns and mirrors the lower bits
    into the frame of its orthant; the turned coordinates, Gray-coded, are
    interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in x:
            swap = np.where(axis & bit, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(axis & bit, low, swap)
            axis ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn
    out = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            out = out << 1 | (axis >> level & 1)
    return out


def ordered(rows: DataFrame, keys: list[str], size: str, name: str) -> tuple[DataFrame, int, int]:
    """The rows in global order of ``keys``, written: their columns, ``pos`` (from 0) and ``sum`` (sizes before a row); row count and total size.

    Range partitions are numbered each in its own task; the driver gets one
    row a partition, the count and the total that come before the next one.
    """
    spark = rows.sparkSession
    ship_package(spark)
    tie = free_name(rows, "tie")
    # equal rows can be split, too
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie).drop(tie)
    part, nth, ahead = (free_name(rows, x) for x in ("part", "nth", "ahead"))
    schema = T.StructType([*rows.schema, *(T.StructField(c, T.LongType()) for c in (part, nth, ahead))])
    at = rows.columns.index(size)

    def number(batches):
        where, count, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            sizes = batch.column(at).to_numpy().astype(np.int64)
            ends = total + np.cumsum(sizes)
            more = [pa.array(np.full(n, where, np.int64)), pa.array(np.arange(count, count + n)), pa.array(ends - sizes)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)
            count, total = count + n, int(ends[-1]) if n else total

    table = stored(dealt.mapInArrow(number, schema), name)
    counted = table.groupBy(part).agg(F.max(nth).alias("n"), F.max(F.col(ahead) + F.col(size)).alias("s")).collect()
    starts, n, total = [], 0, 0
    for r in sorted(counted, key=lambda r: r[part]):
        starts.append((r[part], n, total))
        n, total = n + r["n"] + 1, total + r["s"]
    first, before = free_name(table, "first"), free_name(table, "before")
    # a row per partition of the order, as the driver holds them already
    offsets = F.broadcast(spark.createDataFrame(starts, f"`{part}` long, `{first}` long, `{before}` long"))
    placed = table.join(offsets, part).withColumns({"pos": F.col(nth) + F.col(first), "sum": F.col(ahead) + F.col(before)})
    return placed.select(*rows.columns, "pos", "sum"), n, total


def rank_cells(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """value, cell: the distinct values of a category, cut into 2**bits runs of their order."""
    values = rows.select(F.col(column).alias("value")).distinct().withColumn("one", F.lit(1).cast("long"))
    placed, n, _ = ordered(values, ["value"], "one", "hilbert_values")
    return placed.select("value", F.floor(F.col("pos") * (1 << bits) / max(n, 1)).cast("int").alias("cell"))


def size_cell(size: Column, bits: int) -> Column:
    """Half octaves of the size, the last cell open."""
    return F.least(F.floor(F.log2(size.cast("double")) * 2), F.lit((1 << bits) - 1)).cast("int")


def on_curve(docs: DataFrame, id_col: str, text_col: str, categories: tuple[str, ...], bits: int, keep: bool) -> DataFrame:
    """id, size, crc, d0, d1, ... (dimensions), curve; ``row`` (the whole input row) with ``keep``."""
    text = text_or_empty(text_col)
    facts = [F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc")]
    facts += [F.col(c).cast("string").alias(f"d{k}") for k, c in enumerate(categories)]
    rows = docs.select(*facts, *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if keep else []))
    rows = rows if keep else stored(rows, "hilbert_rows")
    cells = rows
    for k in range(len(categories)):
        # a row per distinct value; the planner broadcasts it only below its size threshold
        values = rank_cells(rows, f"d{k}", bits).withColumnsRenamed({"value": f"v{k}", "cell": f"c{k}"})
        cells = cells.join(values, F.col(f"d{k}").eqNullSafe(F.col(f"v{k}")), "left").drop(f"v{k}")
    numbers = [f"c{k}" for k in range(len(categories))]
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def curve(cell: pd.DataFrame) -> pd.Series:
        return pd.Series(curve_index(cell.to_numpy(), bits))

    at = F.struct(*(F.col(c) for c in numbers), size_cell(F.col("size"), bits).alias("s"))
    return cells.withColumn("curve", curve(at)).drop(*numbers)


def placed(docs: DataFrame, id_col: str, text_col: str, law: str, shards: int, categories: tuple[str, ...], bits: int, keep: bool) -> DataFrame:
    if law not in LAWS:
        raise ValueError(f"law must be one of {LAWS}, not {law!r}")
    table, n, total = ordered(on_curve(docs, id_col, text_col, categories, bits, keep), ["curve", "crc", "id"], "size", "hilbert_order")
    if law == "rows":
        shard = F.expr(f"(pos * {shards}L) div {max(n, 1)}L")
        cut = table.withColumn("shard", shard.cast("int"))
        # the first place of a shard is shard * n / shards, rounded up
        return cut.withColumn("slot", F.col("pos") - F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L"))
    # a shard's share is total / shards; the middle of a document decides
    cut = table.withColumn("shard", F.least(F.expr(f"((sum * 2L + size) * {shards}L) div {max(2 * total, 1)}L"), F.lit(shards - 1)).cast("int"))
    first = F.broadcast(cut.groupBy("shard").agg(F.min("pos").alias("start")))  # a row per shard
    return cut.join(first, "shard").withColumn("slot", F.col("pos") - F.col("start")).drop("start")


def assign(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", law: str = "rows", shards: int = SHARDS,
    categories: tuple[str, ...] = CATEGORIES, bits: int = BITS,
) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard (null: cut runs move when a shard is added), curve."""
    out = placed(docs, id_col, text_col, law, shards, categories, bits, keep=False)
    return out.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(law).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def write(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", law: str = "rows", shards: int = SHARDS,
    categories: tuple[str, ...] = CATEGORIES, bits: int = BITS,
) -> DataFrame:
    """Write whole rows to a folder per shard, files along the curve, and return them with ``shard`` and ``slot``."""
    out = placed(docs, id_col, text_col, law, shards, categories, bits, keep=True)
    shard, slot = free_name(docs, "shard"), free_name(docs, "slot")
    columns = [F.col("row")[c].alias(c) for c in docs.columns]
    table = out.select(*columns, F.col("shard").alias(shard), F.col("slot").alias(slot))
    # a scan of the ordered table keeps its pieces together, so a task writes to few shards
    table.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
    return docs.sparkSession.read.schema(table.schema).parquet(path)


def ranges(table: DataFrame, columns: tuple[str, ...] = CATEGORIES, shard_col: str = "shard") -> DataFrame:
    """A row per shard: rows, and the smallest and largest value of each column."""
    ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return table.groupBy(shard_col).agg(F.count("*").alias("rows"), *ends)


def _curve_sql(names: list[str], bits: int) -> tuple[list[str], str]:
    """Select steps that turn cell columns into the curve's frame, and the index expression."""
    steps = []
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for x in names:
            first = f"CASE WHEN {x} & {bit} > 0 THEN xor({names[0]}, {low}) ELSE xor({names[0]}, xor({names[0]}, {x}) & {low}) END"
            other = f"CASE WHEN {x} & {bit} > 0 THEN {x} ELSE xor({x}, xor({names[0]}, {x}) & {low}) END"
            steps.append(f"{first} AS {names[0]}" + ("" if x == names[0] else f", {other} AS {x}"))
    for a, b in zip(names, names[1:]):
        steps.append(f"xor({b}, {a}) AS {b}")
    turn = "0"
    for level in range(bits - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN {names[-1]} & {1 << level} > 0 THEN {(1 << level) - 1} ELSE 0 END)"
    steps.append(f"{turn} AS turn, " + ", ".join(f"xor({x}, {turn}) AS {x}" for x in names))
    digits = [f"({x} >> {level} & 1)" for level in range(bits - 1, -1, -1) for x in names]
    return steps, " + ".join(f"({d} << {len(digits) - 1 - k})" for k, d in enumerate(digits))


def _assign_sql(bits: int = BITS, shards: int = SHARDS) -> str:
    steps, index = _curve_sql(["x", "y", "z"], bits)
    chain, last = "", "cells"
    for k, step in enumerate(steps):
        more = ", 0 AS turn" if k == 0 else ""
        chain += f"s{k} AS (SELECT * REPLACE ({step}) FROM (SELECT *{more} FROM {last})),\n"
        last = f"s{k}"
    return rf"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS codes FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i)) t),
sized AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS t, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size FROM documents),
summed AS (
  SELECT doc_id, source, lang, size,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT)),
                         lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM sized, crc_table),
sources AS (SELECT source, floor((row_number() OVER (ORDER BY source NULLS FIRST) - 1) * {1 << bits} / count(*) OVER ())::BIGINT AS x FROM (SELECT DISTINCT source FROM sized)),
langs AS (SELECT lang, floor((row_number() OVER (ORDER BY lang NULLS FIRST) - 1) * {1 << bits} / count(*) OVER ())::BIGINT AS y FROM (SELECT DISTINCT lang FROM sized)),
cells AS (
  SELECT d.doc_id, size, text_crc32, x, y, least(floor(log2(size::DOUBLE) * 2), {(1 << bits) - 1})::BIGINT AS z
  FROM summed d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source JOIN langs l ON d.lang IS NOT DISTINCT FROM l.lang),
{chain}placed AS (
  SELECT *, row_number() OVER (ORDER BY curve, text_crc32, doc_id NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT doc_id, size, text_crc32, ({index})::BIGINT AS curve FROM {last}))
SELECT doc_id, size, text_crc32, 'rows' AS law, (pos * {shards} // n)::INTEGER AS shard,
       (pos - (pos * {shards} // n * n + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INTEGER AS grown_shard, curve
FROM placed
"""


#: DuckDB SQL of ``assign`` over documents.
ASSIGN_SQL = _assign_sql()

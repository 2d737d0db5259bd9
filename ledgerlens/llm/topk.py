"""Exact top-k inner products from a bit-sliced index.

Vectors are quantised to integers and stored in blocks of rows. In a block
each attribute becomes bit slices: bitmaps over the block's rows, one per
binary digit. For a query, attribute x weight is shift-and-add of slices;
carry-save adders on the bitmaps (xor, and, or) sum all of them into the
slices of the score. The top rows are then chosen from the most significant
score slice downward: rows that must be in, and rows that still tie. The
boundary rows that tie to the last slice are resolved exactly by id. The few
rows chosen get their integer scores, and a ranking by query merges blocks.

Weights are written in signed digits (non-adjacent form), a third of which
are set on average; a digit of -1 uses complemented slices. Attributes are
shifted to start at 0. The constants this adds are the same for all rows of a
block, so no order changes.

Rows are dealt evenly into groups of at most ``GROUP`` rows, queries into as
many groups as it takes to have ``UNITS`` units of work a core. A unit reads
the blocks of one row group, builds their slices once, and then lets the query
blocks of its query group pass: a stated query set against all rows, in
blocks. Rows are sent once where there are as many row groups as units (large
tables); queries are sent once to each row group. What a task holds is bounded
by group and block sizes; nothing grows on the driver.

Scores are exact integers of any size in a task; a row of the result whose
score needs more than 64 bits, and a component of 2**63 or more after scaling,
are errors. Vectors that are null, or hold a null or non-finite component, and
rows without an id take no part. Vectors of another dimension than the query's
are no candidates. A candidate row with the query's id is the query's own. An
id that several rows share queries once, with the smallest vector; each of its
rows is a candidate. Other columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import bounded_batches, stored
from ledgerlens.session import ship_package

#: Components in a block of rows, queries in a block, rows in a group, units of work a core.
COMPONENTS, QUERIES, GROUP, UNITS = 1 << 22, 256, 1 << 17, 2
WORD = (1 << 64) - 1


class BitSlices:
    """Bit-sliced index of a block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, dims = vectors.shape
        low = vectors.min() if vectors.size else np.int64(0)
        # differences of 64-bit integers fit 64 bits without a sign
        shifted = (vectors.astype(np.uint64) - np.uint64(int(low) & WORD)).T
        self.bits = max(1, int(shifted.max()).bit_length() if shifted.size else 1)
        self.largest = int(np.abs(vectors).max()) if vectors.size else 0
        words = -(-n // 64)
        plain = np.zeros((dims, self.bits, words), np.uint64)
        flags = np.zeros((dims, words * 64), bool)
        for j in range(self.bits):
            flags[:, :n] = (shifted >> np.uint64(j)) & np.uint64(1)
            plain[:, j] = np.packbits(flags, axis=1, bitorder="little").view(np.uint64)
        # plain slices, then their complements for digits of -1
        self.slices = np.concatenate([plain, ~plain]).reshape(2 * dims * self.bits, words)
        self.dims = dims
        self.rows = self.bitmap(np.ones(n, bool))

    @staticmethod
    def bitmap(flags: np.ndarray) -> np.ndarray:
        out = np.zeros(-(-len(flags) // 64) * 64, bool)
        out[: len(flags)] = flags
        return np.packbits(out, bitorder="little").view(np.uint64)

    def places(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    def scores(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices of the score, least significant first."""
        size, down = np.abs(weights).astype(np.uint64), weights < 0
        half = size >> np.uint64(1)
        more, odd = size + half, half ^ (size + half)
        digits = ((more & odd, down), (half & odd, ~down))
        at = np.arange(self.dims) * self.bits
        columns: list[list[np.ndarray]] = []
        for a in range(int(max((int(d.max(initial=0)) for d, _ in digits))).bit_length()):
            used = np.concatenate([(at + negative * self.dims * self.bits)[(d >> np.uint64(a)) & np.uint64(1) == 1] for d, negative in digits])
            for j in range(self.bits if len(used) else 0):
                while len(columns) <= a + j:
                    columns.append([])
                columns[a + j].append(self.slices[used + j])
        out, p = [], 0
        while p < len(columns):
            rest = np.concatenate(columns[p]) if columns[p] else np.zeros((1, self.slices.shape[1]), np.uint64)
            carried = columns[p + 1] if p + 1 < len(columns) else []
            while len(rest) > 1:
                n = len(rest) // 3
                if n:
                    a, b, c = rest[:n], rest[n : 2 * n], rest[2 * n : 3 * n]
                    half = a ^ b
                    carry = (a & b) | (half & c)
                    rest = np.concatenate([half ^ c, rest[3 * n :]])
                else:
                    carry = rest[:1] & rest[1:]
                    rest = rest[:1] ^ rest[1:]
                carried.append(carry)
            if carried and p + 1 == len(columns):
                columns.append(carried)
            out.append(rest[0])
            p += 1
        return out

    def exact(self, at: np.ndarray, weights: np.ndarray) -> list[int]:
        """Scores of some rows."""
        if self.dims * self.largest * int(np.abs(weights).max(initial=0)) < 1 << 63:
            return (self.vectors[at] @ weights).tolist()
        return [sum(map(int.__mul__, v, weights.tolist())) for v in self.vectors[at].tolist()]

    def top(self, own: int, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(-score, id) of the k best rows, best first, ties to the smaller id; not the query's own."""
        tied = self.rows & ~self.bitmap(self.ids == own)
        chosen = np.zeros_like(tied)
        for digit in reversed(self.scores(weights)):
            with_one = tied & digit
            n = int(np.bitwise_count(chosen).sum() + np.bitwise_count(with_one).sum())
            if n >= k:
                tied = with_one
            else:
                chosen |= with_one
                tied &= ~digit
            if n == k:
                break
        sure, rest = self.places(chosen), self.places(tied)
        rest = rest[np.argsort(self.ids[rest], kind="stable")[: max(0, k - len(sure))]]
        at = np.concatenate([sure, rest])
        return sorted((-s, int(i)) for s, i in zip(self.exact(at, weights), self.ids[at], strict=True))


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, v (integers): the rows that take part."""
    x = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform("x", lambda x: x * scale)
    small = F.transform("y", lambda y: F.when(F.abs(y) < float(1 << 63), F.floor(y)).otherwise(F.raise_error(F.lit("a scaled component needs more than 64 bits")).cast("long")))
    taking_part = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull() & fine)
    return taking_part.select("id", scaled.alias("y")).select("id", small.alias("v"))


def block_rows(dims: int) -> int:
    """Rows in a block: the fewer, the longer the vectors, so that bitmaps are long and a block's memory is bounded."""
    return min(GROUP, max(1024, COMPONENTS // max(1, dims)))


def blocks(rows: DataFrame, size: Callable[[int], int], name: str) -> DataFrame:
    """Rows packed into blocks of one dimension, ``size`` (by dimension) rows each: part (the task that packed it), dims, ids, data."""
    ship_package(rows.sparkSession)

    def run(batches):
        part = TaskContext.get().partitionId()
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}

        def block(dims):
            rows = waiting.pop(dims)
            ids = np.array([i for i, _ in rows], np.int64)
            data = np.stack([v for _, v in rows]) if dims else np.zeros((len(rows), 0), np.int64)
            largest = int(np.abs(data).max()) if data.size else 0
            # as narrow as the block allows; the width tells which
            data = data.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if largest <= np.iinfo(t).max))
            columns = [pa.array([part], pa.int32()), pa.array([dims], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "dims", "ids", "data"])

        for batch in batches:
            flat = batch.column(1).values.to_numpy(zero_copy_only=False)
            edge = batch.column(1).offsets.to_numpy()
            for i, id_ in enumerate(batch.column(0).to_pylist()):
                v = flat[edge[i] : edge[i + 1]].astype(np.int64)
                waiting.setdefault(len(v), []).append((id_, v))
                if len(waiting[len(v)]) >= size(len(v)):
                    yield block(len(v))
        for dims in list(waiting):
            yield block(dims)

    return stored(rows.mapInArrow(run, "part int, dims int, ids binary, data binary"), name)


def unpacked(dims: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    width = len(data) // (len(ids) * dims) if dims else 8
    return ids, np.frombuffer(data, f"i{width}").reshape(len(ids), dims).astype(np.int64)


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, id, score for the rows whose id is divisible by ``every``, against all other rows."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = stored(quantised(vectors, id_col, vector_col, scale), "top_rows")
    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    names = [f"query_{id_col}" if id_col == "query_id" else "query_id", id_col, "score"]
    groups = max(1, -(-rows.count() // GROUP))
    # few row groups are shared by several query groups, so that there is work for all cores
    asked = max(1, -(-UNITS * spark.sparkContext.defaultParallelism // groups))
    against = blocks(rows.repartition(groups), block_rows, "top_blocks").select(F.pmod("part", F.lit(groups)).alias("r"), F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("q"), F.lit(0).alias("kind"), "dims", "ids", "data")
    asking = blocks(queries.repartition(asked), lambda _: QUERIES, "top_queries").select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("r"), F.pmod("part", F.lit(asked)).alias("q"), F.lit(1).alias("kind"), "dims", "ids", "data")
    # in a unit the rows' blocks come first
    units = against.union(asking).repartition(groups * asked, "r", "q").sortWithinPartitions("r", "q", "kind")

    def run(batches):
        unit, indexes = None, {}
        for batch in batches:
            for r, q, kind, dims, ids, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (r, q) != unit:
                    unit, indexes = (r, q), {}
                if kind == 0:
                    indexes.setdefault(dims, []).append(BitSlices(*unpacked(dims, ids, data)))
                    continue
                out = []
                for own, weights in zip(*unpacked(dims, ids, data), strict=True):
                    found = sorted(pair for index in indexes.get(dims, []) for pair in index.top(int(own), weights, k))
                    out += [(int(own), i, -s) for s, i in found[:k]]
                if any(not -(1 << 63) <= s < 1 << 63 for _, _, s in out):
                    raise OverflowError("a score needs more than 64 bits")
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(3)], names=["query", "id", "score"])

    best = units.mapInArrow(run, "query long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias(names[0]), "rank", F.col("id").alias(id_col), "score")


#: DuckDB SQL of ``top_k`` over embeddings.
TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

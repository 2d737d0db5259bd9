"""Exact quartiles and IQR fences without gathering values on one task.

``exact`` mode follows the linear-interpolation definition (pandas
``quantile``, DuckDB ``quantile_cont``) but never builds a global
value->count map the way Spark's ``percentile`` aggregate does, and never
merges per-task sketches on one reducer the way ``percentile_approx`` does
(at 100 TB that is hundreds of thousands of sketches). It looks for the order
statistics around ``p * (n - 1)`` through histograms (``count``, ``min``,
``max`` per bucket, partial-aggregated map-side):

1. buckets on a monotonic log scale (256 per power of two, so a bucket spans
   0.27% of its value); a few thousand rows, at most ~550k for any double
   range. A running count finds the bucket of each order statistic.
2. the bucket's ``[min, max]`` is cut into ``SUB_BUCKETS`` equal ones, over
   the values inside it only, until the bucket that holds the order statistic
   has one value. A round narrows the range by ``SUB_BUCKETS`` at least, so a
   double needs four rounds at most and money one.

The driver gets one row a round, the buckets of the sought order statistics.

``approx`` reads the values once: a KLL sketch a map task, merged in a tree
(``FAN_IN`` at a time), so no reducer meets the sketches of all tasks. Its
ranks are off by about 2 / ``SKETCH_SIZE`` of the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_SIZE = 4000
# Sketches that one merge takes in, and the groups that the levels of the tree leave.
FAN_IN = 64
LEVELS = (FAN_IN**2, FAN_IN)
BUCKETS_PER_OCTAVE = 256
SUB_BUCKETS = 1 << 16
_OFFSET = 1 << 30


def bucket_key(x: Column) -> Column:
    """Monotonic (non-decreasing in ``x``) BIGINT bucket: negatives < 0 < positives."""
    level = F.floor(F.log2(F.abs(x)) * BUCKETS_PER_OCTAVE).cast("long")
    return F.when(x > 0, F.lit(_OFFSET) + level).when(x < 0, -(F.lit(_OFFSET) + level)).otherwise(F.lit(0).cast("long"))


def _histogram(keyed: DataFrame) -> DataFrame:
    """g, b, c, mn, mx and ``last``, the 0-based position in g of a bucket's last value."""
    hist = keyed.groupBy("g", "b").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx"))
    # buckets, not values: a small running count per g
    w = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.withColumn("last", F.sum("c").over(w) - 1)


def _bucket(g: int, rank: Column) -> Column:
    """(values before it, min, max) of the bucket of ``g`` that holds position ``rank``."""
    return F.min_by(F.struct((F.col("last") - F.col("c") + 1).alias("before"), "mn", "mx"), F.when((F.col("g") == g) & (F.col("last") >= rank), F.col("b")))


def order_statistics(vals: DataFrame, probs: tuple[float, ...]) -> tuple[int, dict[int, float]]:
    """n and the values at positions floor and ceil of ``p * (n - 1)`` of column ``x``."""
    first = _histogram(vals.select("x", F.lit(0).alias("g"), bucket_key(F.col("x")).alias("b")))
    first = first.withColumn("n", F.sum("c").over(Window.partitionBy("g")))
    ends = [rank(F.lit(p) * (F.col("n") - 1)) for p in probs for rank in (F.floor, F.ceil)]
    row = first.agg(F.max("n").alias("n"), *[_bucket(0, r).alias(f"t{i}") for i, r in enumerate(ends)]).first()
    n = row["n"] or 0
    if not n:
        return 0, {}
    positions = [rank(p * (n - 1)) for p in probs for rank in (math.floor, math.ceil)]
    # position -> (position inside the bucket, min, max)
    found = {k: (k - row[f"t{i}"]["before"], row[f"t{i}"]["mn"], row[f"t{i}"]["mx"]) for i, k in enumerate(positions)}
    while wide := sorted({(lo, hi) for _, lo, hi in found.values() if lo < hi}):
        x = F.col("x")

        def inside(g: int, lo: float, hi: float) -> Column:
            return F.when(x.between(lo, hi), F.struct(F.lit(g).alias("g"), F.floor((x - lo) / (hi - lo) * SUB_BUCKETS).alias("b")))

        some = F.array_compact(F.array(*[inside(g, lo, hi) for g, (lo, hi) in enumerate(wide)]))
        near = vals.where(x.between(wide[0][0], max(hi for _, hi in wide))).select("x", F.explode(some).alias("k"))
        left = [k for k, (_, lo, hi) in found.items() if lo < hi]
        hist = _histogram(near.select("x", "k.g", "k.b"))
        row = hist.agg(*[_bucket(wide.index(found[k][1:]), F.lit(found[k][0])).alias(f"t{k}") for k in left]).first()
        for k in left:
            t = row[f"t{k}"]
            found[k] = (found[k][0] - t["before"], t["mn"], t["mx"])
    return n, {k: lo for k, (_, lo, _) in found.items()}


def exact_quantiles(df: DataFrame, col: str, probs: tuple[float, ...]) -> DataFrame:
    """One-row DataFrame with columns ``q0, q1, ...``: exact quantiles of ``col`` (nulls ignored; NULL without values)."""
    vals = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    n, at = order_statistics(vals, probs)
    out = []
    for p in probs:
        pos = p * (n - 1)
        lo, hi = at.get(math.floor(pos)), at.get(math.ceil(pos))
        out.append(lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos)))
    return df.sparkSession.createDataFrame([tuple(out)], ", ".join(f"q{i} double" for i in range(len(probs))))


def merged_sketch(values: DataFrame) -> DataFrame:
    """One row, ``sketch``: the KLL sketch of column ``x``, merged level by level."""
    task = F.spark_partition_id()
    # a group a map task: the rows of a task make one sketch there, before anything moves
    level = values.where("x is not null").groupBy(task.alias("task")).agg(F.kll_sketch_agg_double("x", F.lit(SKETCH_SIZE)).alias("sketch"))
    for groups in LEVELS:
        level = level.groupBy((F.col("task") % groups).alias("task")).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"))
    return level.agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"))


def quartiles(df: DataFrame, col: str, mode: str = "exact") -> DataFrame:
    """One-row DataFrame ``q1, q3``."""
    if mode == "approx":
        sketch = merged_sketch(df.select(F.col(col).cast("double").alias("x")))
        some = F.kll_sketch_get_n_double("sketch") > 0
        return sketch.select(*[F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(p).cast("double"))).alias(q) for q, p in (("q1", 0.25), ("q3", 0.75))])
    return exact_quantiles(df, col, (0.25, 0.75)).select(F.col("q0").alias("q1"), F.col("q1").alias("q3"))


def iqr_fences(df: DataFrame, col: str, k: float = 1.5, mode: str = "exact") -> DataFrame:
    """One-row DataFrame ``q1, q3, iqr, lower, upper`` for ``col``."""
    q = quartiles(df, col, mode)
    iqr = F.col("q3") - F.col("q1")
    return q.select(
        "q1",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - F.lit(k) * iqr).alias("lower"),
        (F.col("q3") + F.lit(k) * iqr).alias("upper"),
    )

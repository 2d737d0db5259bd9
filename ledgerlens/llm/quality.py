"""Quality selection by importance resampling.

Two generative models over hashed n-grams are counted: one of target text
(labelled documents of good quality), one of the raw text (all documents).
A document's importance weight is the ratio of its probabilities under the
two; adding seeded Gumbel noise to its logarithm and keeping the top k samples
k documents without replacement in proportion to the weights.

n-grams are words and pairs of adjacent words (case and punctuation kept),
hashed into ``BUCKETS``. The target model may use a bounded sample of
labelled rows (``target_docs``); the raw model counts every document. Counts
leave a task as at most one row a bucket. The k-th key is found by counting
keys by 16-bit digits from the top, so nothing is sorted in one task.

Null text is empty and has weight 1 (log weight 0). Rows with equal id and
text have equal keys; ties at the k-th key are all kept. Labels of unknown
documents are ignored, without any target label all weights are 1. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit
from ledgerlens.llm.common import stored, strings
from ledgerlens.session import ship_package

BUCKETS = 1 << 16
TARGET_DOCS = 5_000


def ngram_buckets(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a slice of texts, and the row of each."""
    points, begins = textkit.joined(texts)
    start, end = textkit.pretokens(points, with_space=False)
    words = textkit.span_hashes(points, start, end)
    row = np.searchsorted(begins, start, side="right") - 1
    pairs = textkit.mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    within = row[:-1] == row[1:]
    return np.concatenate([words, pairs[within]]) % np.uint64(buckets), np.concatenate([row, row[:-1][within]])


def log_ratio(docs: DataFrame, target_ids: DataFrame, id_col: str, text_col: str, buckets: int) -> np.ndarray:
    """log p_target - log p_raw of every bucket. ``target_ids``: a bounded table with column ``target``."""
    ship_package(docs.sparkSession)

    def count(batches):
        totals = np.zeros((2, buckets), np.int64)
        for batch in batches:
            texts, wanted = strings(batch.column(0)), np.array(batch.column(1).to_pylist(), bool)
            for a, b in textkit.slices(texts):
                grams, row = ngram_buckets(texts[a:b], buckets)
                totals[0] += np.bincount(grams, minlength=buckets)
                totals[1] += np.bincount(grams[wanted[a:b][row]], minlength=buckets)
        used = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[0, used]), pa.array(totals[1, used])], names=["bucket", "raw", "target"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    flagged = rows.join(F.broadcast(target_ids), F.col("id") == F.col("target"), "left").select("t", F.col("target").isNotNull().alias("wanted"))
    counts = flagged.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    totals = np.ones((2, buckets))  # add-one smoothing
    for r in counts.collect():  # at most a row a bucket
        totals[:, r["bucket"]] += r["raw"], r["target"]
    if totals[1].sum() == buckets:
        return np.zeros(buckets)
    return np.log(totals[1] / totals[1].sum()) - np.log(totals[0] / totals[0].sum())


def sortable(x: np.ndarray) -> np.ndarray:
    """Longs of the same order as doubles: their bits, turned below the sign for negative ones."""
    bits = (x + 0.0).view(np.int64)  # -0.0 becomes 0.0
    return bits ^ ((bits >> np.int64(63)) & np.int64(2**63 - 1))


def kth_largest(rows: DataFrame, key: str, k: int) -> int | None:
    """The k-th largest value of a long column, from counts by 16-bit digits; None if there are fewer rows."""
    prefix, left = None, k
    for shift in (48, 32, 16, 0):
        inside = rows if prefix is None else rows.where(F.shiftright(key, shift + 16) == prefix)
        found = sorted(((r["d"], r["n"]) for r in inside.groupBy(F.shiftright(key, shift).alias("d")).agg(F.count("*").alias("n")).collect()), reverse=True)
        for d, n in found:
            if n >= left:
                prefix = d
                break
            left -= n
        else:
            return None
    return prefix


def resample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: Column | None = None,
    share: float | None = None, seed: int = 5, buckets: int = BUCKETS, target_docs: int = TARGET_DOCS,
) -> DataFrame:
    """id, log_weight, key, selected: a row per document.

    ``target`` marks the label rows of target text (by default quality 1 and
    not toxic); ``share`` is the part of all documents to select (by default
    the part of quality 1 among the labels).
    """
    target = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) if target is None else target
    good = F.coalesce(target, F.lit(False))
    if share is None:
        share = labels.agg(F.avg((F.col("quality") == 1).cast("double")).alias("s")).first()["s"]
        share = 1.0 if share is None else share
    wanted = labels.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).alias("target")).distinct()
    sample = stored(wanted.orderBy(F.xxhash64(F.lit(seed), "target")).limit(target_docs), "quality_targets")
    ratio = log_ratio(docs, sample, id_col, text_col, buckets)

    def weigh(batches):
        for batch in batches:
            texts = strings(batch.column(2))
            out = np.zeros(len(texts))
            for a, b in textkit.slices(texts):
                grams, row = ngram_buckets(texts[a:b], buckets)
                out[a:b] = np.bincount(row, ratio[grams], b - a)
            key = out - np.log(-np.log(batch.column(1).to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), pa.array(key), pa.array(sortable(key))], names=["id", "log_weight", "key", "sorted"])

    unit = (F.pmod(F.xxhash64(F.lit(seed), id_col, text_col), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    rows = docs.select(F.col(id_col).alias("id"), unit.alias("u"), F.col(text_col).alias("t"))
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = stored(rows.mapInArrow(weigh, f"id {id_type}, log_weight double, key double, sorted long"), "quality_scores")
    k = round(share * scored.count())
    least = kth_largest(scored, "sorted", k) if k else None
    chosen = F.lit(k > 0) if least is None else F.col("sorted") >= least
    return scored.select(F.col("id").alias(id_col), "log_weight", "key", chosen.alias("selected"))

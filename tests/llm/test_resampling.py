"""Importance resampling against a plain-Python version over whole tables."""

import math
from collections import Counter

import numpy as np
import regex
import xxhash
from helpers import frame, odd_rows

from ledgerlens.llm import quality

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
LABELS = "doc_id long, quality int, toxic int"


def mixed(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ x >> shift) * factor & MASK
    return x


def word_hash(word):
    total = 0
    for k, c in enumerate(word):
        x = (ord(c) + 1) * 0xD6E8FEB86659FD93 & MASK
        total += (x ^ x >> 32) * pow(BASE, k, 1 << 64)
    return mixed((total + len(word)) & MASK)


def grams(text, buckets):
    words = [word_hash(w) for w in WORDS.findall(text or "")]
    return Counter(h % buckets for h in [*words, *(mixed((a * BASE + b) & MASK) for a, b in zip(words, words[1:]))])


def uniform(seed, i, text):
    h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    if i is not None:
        h = xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), h)
    if text is not None:
        h = xxhash.xxh64_intdigest(text.encode(), h)
    return (h % (1 << 40) + 0.5) / (1 << 40)


def brute(rows, labels, seed=5, buckets=quality.BUCKETS):
    """(id, log weight, key, selected) of all rows (id, text)."""
    wanted = {i for i, q, toxic in labels if i is not None and q == 1 and not toxic}
    counted = [grams(t, buckets) for _, t in rows]
    raw, target = Counter(), Counter()
    for (i, _), c in zip(rows, counted):
        raw.update(c)
        if i in wanted:
            target.update(c)
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    out = []
    for (i, t), c in zip(rows, counted):
        weight = sum(n * (math.log((target[g] + 1) / n_target) - math.log((raw[g] + 1) / n_raw)) for g, n in c.items()) if target else 0.0
        out.append((i, weight, weight - math.log(-math.log(uniform(seed, i, t)))))
    known = [q == 1 for _, q, _ in labels if q is not None]
    k = round((sum(known) / len(known) if known else 1.0) * len(rows))
    least = sorted((r[2] for r in out), reverse=True)[k - 1] if k else math.inf
    return [(*r, r[2] >= least - 1e-9) for r in out]


def compared(rows):
    return Counter((i, round(w, 6), round(key, 6), bool(s)) for i, w, key, s in rows)


def test_the_chosen_set_equals_brute_force_on_the_supplied_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert compared(map(tuple, quality.resample(docs, labels).collect())) == compared(want)
    assert 0 < sum(r[3] for r in want) < len(want)


def test_the_chosen_set_equals_brute_force_with_nulls_ties_and_repeats(spark):
    rows = odd_rows()
    for labels in ([], [(1, 1, 0), (1, 1, 0), (2, 0, 0), (None, 1, None), (3, 1, None), (4, 0, 1), (999, 1, 1)], [(100, 1, 0), (2, 0, 0)]):
        got = quality.resample(frame(spark, rows), spark.createDataFrame(labels, LABELS), buckets=509).collect()
        assert compared(map(tuple, got)) == compared(brute([r[:2] for r in rows], labels, buckets=509))


def test_keys_keep_the_order_of_doubles():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 500), rng.normal(0, 1e-12, 500), rng.normal(0, 1e12, 500), [0.0, -0.0, 5e-324, -5e-324]])
    key = quality.sortable(x)
    assert (key[np.argsort(x, kind="stable")] == np.sort(key)).all() and len(np.unique(key)) == len(np.unique(x))
    assert quality.sortable(np.array([0.1]))[0] < quality.sortable(np.array([0.1 + 1e-15]))[0]

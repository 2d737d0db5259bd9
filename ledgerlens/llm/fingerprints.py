"""Document fingerprints from prefix polynomial hashes.

``Prefix`` holds, for one text, prefix sums of c_i * B**i under two prime
moduli. Any span's hash is a difference of two prefix entries, so equality of
any two spans is one comparison, and the longest common extension of two
positions is a binary search over it. The fingerprint is the length and the
whole text's hash under both moduli; the likeness of two fingerprinted texts
is the share of the longer one that both have in the same order (1 for equal
texts). It begins with the longest common extensions forwards from the starts
and backwards from the ends (alone: ``ends_edited``, ``ends_next``) and goes
on after the first edit: what lies between these two extensions is realigned
on hashes of spans of ``SPAN`` code points, the k-th occurrence of a span in
one text with its k-th in the other; the heaviest chain of aligned runs that
keeps the order of both texts counts, each run extended as far as the texts
are equal. Equal text shorter than ``SPAN``
between two edits, moved text and, in periodic text, up to a span an edit
count as different.

``neighbour_fingerprints`` compares each text with an edited one and with the
next document by ascending id. Texts are shuffled once: the order is cut into
ranges at keys that a narrow pass over (id, text digest) finds, the first
document of a range is also sent to the range before it, and each range is
read as a sorted stream, one text after the other.

Null text is empty. Two empty texts have likeness 1, an empty and another 0.
Null ids come last; equal ids are ordered by text digest, equal rows are
neighbours of each other. One document is its own neighbour. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import textkit
from ledgerlens.llm.common import stored, strings
from ledgerlens.session import ship_package

#: Primes below 2**31, so a product of two residues fits 64 bits; a base for each.
MODULI = (2147483647, 2147483629)
BASES = (911382323, 972663749)
_POWERS = [np.ones(1, np.int64) for _ in MODULI]
#: Code points of the spans that realign two texts after an edit.
SPAN = 16
_BACK = [np.ones(1, np.int64)]


def powers(k: int, n: int) -> np.ndarray:
    """BASES[k]**i modulo MODULI[k] for i < n at least."""
    while len(_POWERS[k]) < n:
        have = _POWERS[k]
        _POWERS[k] = np.concatenate([have, have * pow(BASES[k], len(have), MODULI[k]) % MODULI[k]])
    return _POWERS[k]


def powers_back(n: int) -> np.ndarray:
    """Inverses of powers(0, n)."""
    inverse = pow(BASES[0], -1, MODULI[0])
    while len(_BACK[0]) < n:
        _BACK[0] = np.concatenate([_BACK[0], _BACK[0] * pow(inverse, len(_BACK[0]), MODULI[0]) % MODULI[0]])
    return _BACK[0]


def aligned(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (p, q, n) with a[p : p + n] == b[q : q + n] in the order of p: the k-th occurrence of a value meets the k-th in b."""
    side = np.uint64(1 << 32)
    z = np.sort(np.concatenate([(a.astype(np.uint64) << np.uint64(33)) | np.arange(len(a), dtype=np.uint64), (b.astype(np.uint64) << np.uint64(33)) | side | np.arange(len(b), dtype=np.uint64)]))
    value, second = z >> np.uint64(33), (z & side) > 0
    same = value[1:] == value[:-1]
    cut = np.flatnonzero(same & (second[1:] != second[:-1])) + 1
    if not len(cut):
        return []
    first = np.append(0, np.flatnonzero(~same) + 1)
    group = np.searchsorted(first, cut, "right") - 1
    begin, end = first[group], np.append(first, len(z))[group + 1]
    n = np.minimum(cut - begin, end - cut)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = (z & np.uint64((1 << 32) - 1)).astype(np.int64)
    p, q = place[np.repeat(begin, n) + nth], place[np.repeat(cut, n) + nth]
    order = np.argsort(p)
    p, q = p[order], q[order]
    edges = np.append(np.append(0, np.flatnonzero((np.diff(p) != 1) | (np.diff(q) != 1)) + 1), len(p))
    return list(zip(p[edges[:-1]].tolist(), q[edges[:-1]].tolist(), np.diff(edges).tolist(), strict=True))


def chain(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The heaviest runs that follow each other in both texts; runs are in the order of p."""
    ends, best, at, came = [0], [0], [-1], []
    for r, (_, q, n) in enumerate(runs):
        k = bisect_right(ends, q) - 1
        came.append(at[k])
        weight, end = best[k] + n, q + n
        k = bisect_right(ends, end)
        if best[k - 1] >= weight:
            continue
        if ends[k - 1] == end:
            k -= 1
        stop = bisect_right(best, weight, k)
        ends[k:stop], best[k:stop], at[k:stop] = [end], [weight], [r]
    out, r = [], at[-1]
    while r >= 0:
        out.append(runs[r])
        r = came[r]
    return out[::-1]


class Prefix:
    """Prefix sums of a text's code points times powers of the base."""

    def __init__(self, sums: list[np.ndarray]):
        self.sums, self.n = sums, len(sums[0]) - 1
        self._spans: np.ndarray | None = None

    @classmethod
    def of(cls, text: str) -> Prefix:
        points = textkit.code_points(text).astype(np.int64) + 1
        sums = []
        for k, p in enumerate(MODULI):
            s = np.zeros(len(points) + 1, np.int64)
            np.cumsum(points * powers(k, len(points))[: len(points)] % p, out=s[1:])
            sums.append(s)
        return cls(sums)

    def joined(self, n: int, other: Prefix, m: int) -> Prefix:
        """Of this text's first n code points followed by the first m of another."""
        out = []
        for k, p in enumerate(MODULI):
            shift = int(powers(k, n + 1)[n])
            # differences again, so sums stay below 2**31 a code point
            part = np.diff(other.sums[k][: m + 1]) * shift % p
            out.append(np.concatenate([self.sums[k][: n + 1], self.sums[k][n] + np.cumsum(part)]))
        return Prefix(out)

    def span(self, k: int, start: int, end: int) -> int:
        return int(self.sums[k][end] - self.sums[k][start]) % MODULI[k]

    def same(self, i: int, other: Prefix, j: int, length: int) -> bool:
        """Whether this text's span at i equals another's at j."""
        for k, p in enumerate(MODULI):
            a, b = self.span(k, i, i + length), other.span(k, j, j + length)
            shift = int(powers(k, abs(i - j) + 1)[abs(i - j)])
            a, b = (a, b * shift % p) if j < i else (a * shift % p, b)
            if a != b:
                return False
        return True

    def extension(self, i: int, other: Prefix, j: int) -> int:
        """Length of the longest common extension forwards from i and j."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.same(i + low, other, j + low, mid - low):
                low = mid
            else:
                high = mid - 1
        return low

    def extension_back(self, i: int, other: Prefix, j: int) -> int:
        """Length of the longest common extension backwards from the ends i and j."""
        low, high = 0, min(i, j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.same(i - mid, other, j - mid, mid - low):
                low = mid
            else:
                high = mid - 1
        return low

    def fingerprint(self) -> str:
        return f"{self.n:x}-" + "".join(f"{self.span(k, 0, self.n):08x}" for k in range(len(MODULI)))

    def spans(self) -> np.ndarray:
        """Hash of every span of SPAN code points, whatever its place."""
        if self._spans is None:
            p, n = MODULI[0], max(0, self.n - SPAN + 1)
            self._spans = (self.sums[0][SPAN:] - self.sums[0][:n]) % p * powers_back(n)[:n] % p
        return self._spans

    def ends(self, other: Prefix) -> tuple[int, int]:
        """Common extensions forwards from the starts, and backwards from the ends of what these leave."""
        shorter = min(self.n, other.n)
        front = self.extension(0, other, 0)
        return front, min(self.extension_back(self.n, other, other.n), shorter - front) if front < shorter else 0

    def between(self, other: Prefix, front: int, back: int) -> int:
        """Code points that both texts share in order between their first ``front`` and their last ``back``."""
        a, b = self.n - back, other.n - back
        if min(a, b) - front < SPAN:
            return 0
        total, i, j = 0, front, front
        for p, q, n in chain(aligned(self.spans()[front : a - SPAN + 1], other.spans()[front : b - SPAN + 1])):
            # runs of spans overlap by less than a span where text was inserted or deleted
            late = max(0, i - front - p, j - front - q)
            p, q, n = p + front + late, q + front + late, n + SPAN - 1 - late
            if n <= 0:
                continue
            if not self.same(p, other, q, n):
                n = min(n, self.extension(p, other, q))
            if p > i and q > j and self.same(p - 1, other, q - 1, 1):
                total += min(p - i, q - j, self.extension_back(p, other, q))
            if p + n < a and q + n < b and self.same(p + n, other, q + n, 1):
                n = min(a - p, b - q, n + self.extension(p + n, other, q + n))
            total, i, j = total + n, p + n, q + n
        return total

    def alike(self, other: Prefix) -> tuple[float, float]:
        """Shares of the longer text: the common extensions from both ends, and these with what is shared between them."""
        longer = max(self.n, other.n)
        if not longer:
            return 1.0, 1.0
        front, back = self.ends(other)
        return (front + back) / longer, (front + back + self.between(other, front, back)) / longer

def edited(text: str, following: str) -> tuple[str, int, int]:
    """The text with its last half replaced by the start of the following one; kept and taken lengths."""
    half = len(text) // 2
    taken = min(half, len(following))
    return text[: len(text) - half] + following[:taken], len(text) - half, taken


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, ends_edited, ends_next, a row per input row.

    ``ranges`` (four a shuffle partition by default) is also the number of
    keys that the driver gets and that go to the tasks.
    """
    spark = docs.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * parts
    rows = docs.select(
        F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("i"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"), F.coalesce(F.col(text_col), F.lit("")).alias("t")
    )
    order = ["missing", "i", "tie"]
    keys = stored(rows.select(order), "fingerprint_keys")
    found = keys.repartitionByRange(ranges, *order).groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*order)).alias("k")).collect()
    bounds = sorted((r["k"]["missing"], r["k"]["i"] or 0, r["k"]["tie"]) for r in found)

    id_type = docs.schema[id_col].dataType
    dealt = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("halo", T.BooleanType()), *(rows.schema[n] for n in (*order, "t"))])

    def deal(batches):
        for batch in batches:
            missing, ids, ties = (batch.column(k).to_pylist() for k in range(3))
            take, at, halo = [], [], []
            for n, key in enumerate(zip(missing, (i or 0 for i in ids), ties, strict=True)):
                b = bisect_right(bounds, key) - 1
                take.append(n)
                at.append(b)
                halo.append(False)
                if key == bounds[b]:
                    take.append(n)
                    at.append((b - 1) % len(bounds))
                    halo.append(True)
            chosen = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(halo, pa.bool_()), *chosen.columns], names=dealt.names)

    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "ends_edited", "ends_next"]
    kinds = [id_type, T.LongType(), T.StringType(), T.StringType(), T.StringType(), *[T.DoubleType()] * 4]

    def compare(batches):
        last = None  # range, id, text, prefix of the row that waits for the one after it
        for batch in batches:
            at, halo, ids = (batch.column(k).to_pylist() for k in (0, 1, 3))
            out: list[list] = [[] for _ in names]
            for n, text in enumerate(strings(batch.column(5))):
                if halo[n] and (last is None or last[0] != at[n]):
                    continue
                prefix = Prefix.of(text)
                if last is not None:
                    _, i, before, own = last
                    new, kept, taken = edited(before, text)
                    other = own.joined(kept, prefix, taken)
                    (ends, near), (ends_next, near_next) = own.alike(other), own.alike(prefix)
                    values = (i, own.n, hashlib.sha256(new.encode()).hexdigest(), own.fingerprint(), other.fingerprint(), near, near_next, ends, ends_next)
                    for column, v in zip(out, values, strict=True):
                        column.append(v)
                last = None if halo[n] else (at[n], ids[n], text, prefix)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field(3).type), pa.array(out[1], pa.int64()), *(pa.array(c, pa.string()) for c in out[2:5]), *(pa.array(c, pa.float64()) for c in out[5:])],
                names=names,
            )

    ordered = rows.mapInArrow(deal, dealt).repartition(parts, "range").sortWithinPartitions("range", "halo", *order)
    return ordered.mapInArrow(compare, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))

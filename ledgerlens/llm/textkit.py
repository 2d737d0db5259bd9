"""Vectorised text helpers that the Arrow-batched operators share.

Everything here works on a slice of a batch (about ``SLICE_CHARS`` code
points, or one longer text), so memory in a Python worker is bounded by the
longest text and not by the batch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

SLICE_CHARS = 400_000
#: Stands between two texts in a slice's array of code points.
SEPARATOR = 0x110000
BREAK, LETTER, NUMBER, SPACE, OTHER = range(5)
#: Code points with Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """(begin, end) row ranges of about ``chars`` code points each."""
    begin = total = 0
    for i, t in enumerate(texts):
        if i > begin and total + len(t) > chars:
            yield begin, i
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with SEPARATOR before each and at the end, and where each text begins."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(lengths + 1) - lengths
    out = np.full(int(lengths.sum()) + len(texts) + 1, SEPARATOR, dtype=np.uint32)
    keep = np.ones(len(out), dtype=bool)
    keep[begins - 1] = False
    keep[-1] = False
    out[keep] = code_points("".join(texts))
    return out, begins


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point: letter (L*), number (N*), white space, other; BREAK for SEPARATOR."""
    kind = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(SEPARATOR)), dtype=np.uint8, count=SEPARATOR)
    table = np.append(table, np.uint8(BREAK))
    table[list(WHITE_SPACE)] = SPACE
    return table


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """Lower-case code point of each one; U+0130, which expands, is left to the caller."""
    table = np.arange(SEPARATOR + 1, dtype=np.uint32)
    for c in range(0x20000):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    return table


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i up to n."""
    while len(_POWERS[0]) <= n:
        for k, base in enumerate((_BASE, _UNBASE)):
            have = _POWERS[k]
            step = np.uint64(pow(int(base), len(have), 1 << 64))
            _POWERS[k] = np.concatenate([have, have * step])
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of code points, from one prefix array modulo 2**64."""
    up, down = _powers(len(points))
    prefix = np.zeros(len(points) + 1, np.uint64)
    spread = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    spread ^= spread >> np.uint64(32)
    np.cumsum(spread * up[: len(points)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def word_spans(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the words: runs of letters and numbers of any script."""
    kind = classes()[points]
    word = (kind == LETTER) | (kind == NUMBER)
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1  # a slice begins and ends with SEPARATOR
    return edge[0::2], edge[1::2]


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word of all texts, and the first word of each text (one more at the end)."""
    points, begins = joined(texts)
    points = lower_table()[points]
    start, end = word_spans(points)
    first = np.append(np.searchsorted(start, begins), len(start))
    return span_hashes(points, start, end), first


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text; a text of fewer words is one shingle; none without words."""
    words, first = hashed_words(texts)
    out = []
    factors = [np.uint64(pow(int(_BASE), 2 * k + 1, 1 << 64)) for k in range(n)]
    for a, b in zip(first[:-1], first[1:], strict=True):
        m = int(b - a)
        if not m:
            out.append(np.zeros(0, np.uint64))
            continue
        k = min(n, m)
        total = np.zeros(m - k + 1, np.uint64)
        for j in range(k):
            total += words[a + j : b - k + 1 + j] * factors[j]
        out.append(np.unique(mix(total + np.uint64(k))))
    return out


def pretokens(points: np.ndarray, with_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the pieces that the public byte-pair patterns cut a text into.

    Both patterns take contractions ('s 't 're 've 'm 'll 'd) first, then
    runs of letters, of numbers and of other characters. ``with_space``: one
    space joins the run after it, white space gives pieces of its own, and
    numbers form runs; else white space is dropped and each number stands
    alone.
    """
    kind = classes()[points]
    cut = kind[1:] != kind[:-1]
    if not with_space:
        cut |= kind[1:] == NUMBER
    bound = np.zeros(len(points) + 1, bool)
    bound[1 : len(points)] = cut
    bound[0] = bound[-1] = True
    quote = np.flatnonzero((points[:-1] == 0x27) & (kind[:-1] == OTHER))
    quote = quote[(kind[quote - 1] != OTHER) & (kind[quote + 1] == LETTER)]
    if with_space:
        quote = quote[points[quote - 1] != 0x20]
    if len(quote):
        one = points[quote + 1]
        two = points[np.minimum(quote + 2, len(points) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        q = quote[short]
        bound[q + 1], bound[q + 2] = False, True
        q = quote[long & ~short]
        bound[q + 1], bound[q + 3] = False, True
    if with_space:
        # the last character of a run of white space before other text stands apart; a space joins that text
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != BREAK))
        bound[last] = True
        bound[last[points[last] == 0x20] + 1] = False
    edge = np.flatnonzero(bound)
    start, end = edge[:-1], edge[1:]
    keep = kind[start] != BREAK
    if not with_space:
        keep &= kind[start] != SPACE
    return start[keep], end[keep]

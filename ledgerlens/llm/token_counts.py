"""Token counts by heap-and-linked-list byte-pair merging.

``count_tokens`` gives, for every text, the number of tokens of a public
byte-level BPE vocabulary with word ends. No identifiers are made: a word
starts as one symbol per byte, a heap gives the adjacent pair of lowest rank
again and again, merged symbols leave a linked list, and the count is the
number of initial symbols less the number of merges.

Words repeat, so a task merges each distinct word once: words of a slice are
hashed (64 bits) and counts are kept by hash in a bounded cache that reused
Python workers carry from task to task. No shuffle, one scan.

Null text counts as empty, an empty text has 0 tokens, repeated rows give
repeated results, other columns are ignored, an empty table gives an empty
result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlens.llm import textkit
from ledgerlens.llm.common import strings
from ledgerlens.session import ship_package

#: Most words whose counts a worker keeps; beyond it the cache starts anew.
CACHE_WORDS = 1_500_000


def byte_symbols() -> list[str]:
    """The printable character of each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0x100
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class MergeCounter:
    """Counts of a vocabulary file: merges by rank, and special strings of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranks = {tuple(m): i for i, m in enumerate(spec["model"]["merges"])}
        self.end = spec["model"].get("end_of_word_suffix") or ""
        self.symbols = byte_symbols()
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.cache: dict[int, int] = {}

    def word(self, word: str) -> int:
        """Tokens of one word."""
        sym = [self.symbols[b] for b in word.encode()]
        sym[-1] += self.end
        n, ranks = len(sym), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if sym[i] is None or j >= n or ranks.get((sym[i], sym[j])) != rank:
                continue  # a merge has changed this pair since
            sym[i] += sym[j]
            sym[j] = None
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((sym[i], sym[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (k := before[i]) >= 0 and (r := ranks.get((sym[k], sym[i]))) is not None:
                heapq.heappush(heap, (r, k))
        return n - merges

    def texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, t in enumerate(texts):
            pieces = [t]
            if self.special and self.special.search(t):
                pieces = self.special.split(t)
                out[i] = len(pieces) - 1
            for p in pieces:
                if not p.isascii():
                    p = unicodedata.normalize("NFC", p).replace("İ", "i̇")
                parts.append(p)
                owner.append(i)
        for a, b in textkit.slices(parts):
            points, begins = textkit.joined(parts[a:b])
            points = textkit.lower_table()[points]
            start, end = textkit.pretokens(points, with_space=False)
            if not len(start):
                continue
            keys, at, which = np.unique(textkit.span_hashes(points, start, end), return_index=True, return_inverse=True)
            counts = np.empty(len(keys), np.int64)
            for k, key in enumerate(keys.tolist()):
                n = self.cache.get(key)
                if n is None:
                    s, e = start[at[k]], end[at[k]]
                    n = self.word(points[s:e].tobytes().decode("utf-32-le"))
                    if len(self.cache) >= CACHE_WORDS:
                        self.cache.clear()
                    self.cache[key] = n
                counts[k] = n
            row = np.searchsorted(begins, start, side="right") - 1
            np.add.at(out, np.asarray(owner[a:b])[np.arange(b - a)], np.bincount(row, counts[which], b - a).astype(np.int64))
        return out


@lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), a row per input row.

    ``vocabulary`` is the path of a tokenizer file that every executor has.
    """
    ship_package(docs.sparkSession)

    def run(batches):
        count = counter(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            n = count.texts(strings(texts))
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n), pa.array(n > limit)], names=names)

    names = [id_col, "n_bytes", "n_tokens", "over_limit"]
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
    ])
    return docs.select(id_col, text_col).mapInArrow(run, schema)

"""Best-fit packing by linear grouping.

``pack`` cuts tokenised documents into pieces of at most ``capacity`` tokens
and places them in as few sequences as it can:

1. *Pieces* (one scan, Arrow batches): ids of each text, then the end id; a
   longer document is cut into full pieces, the remainder first. Every piece
   is stored with its place among the pieces of its length in its partition.
2. *Histogram*: pieces by length. There are at most ``capacity`` lengths, so
   it is bounded at any input size; the plan is made from it alone.
3. *Linear grouping*: large lengths, sorted, fall into ``groups`` groups of
   equal cardinality, each rounded up to its longest length. Configurations
   of these few sizes are chosen one after the other: the one that fills a
   sequence best with what is left, as often as it can be used.
4. *Substitution*: the actual lengths of each group take its slots, in runs
   of equal length; *best fit* then places small pieces, longest first, into
   the fullest sequences that still have room, or into new ones.
5. *Assignment*: the plan is a list of runs (length, first place, sequence).
   A piece's place among all pieces of its length comes from per-partition
   counts, so no length is ever gathered, however common.

Null text is empty and gives one piece holding the end id. Repeated rows are
packed as rows of their own. Ties between equal lengths go by place. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import textkit
from ledgerlens.llm.common import bounded_batches, stored, strings
from ledgerlens.session import ship_package

CAPACITY = 2048
#: Lengths above capacity / SMALL_SHARE are large.
SMALL_SHARE = 8
GROUPS = 64
#: Most distinct pieces of text whose ids a worker keeps.
CACHE_WORDS = 250_000


class PieceIds:
    """Ids of texts under a byte-level vocabulary, each distinct word encoded once.

    ``json_path`` is the vocabulary for the tokenizers library; ``rank_path``
    the same vocabulary as ranks, which encodes single words faster. Texts
    with a special string go to the library whole.
    """

    def __init__(self, json_path: str, rank_path: str):
        import public_tokenizers
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        with open(json_path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.json_path, self.whole = json_path, None
        self.clear()

    def clear(self):
        self.index: dict[int, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.begin = np.zeros(CACHE_WORDS + 1, np.int64)

    def add(self, key: int, ids: list[int]) -> int:
        at = self.index[key] = len(self.index)
        end = self.begin[at + 1] = self.begin[at] + len(ids)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(ids), len(self.flat)), np.uint32)])
        self.flat[self.begin[at] : end] = ids
        return at

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text (a slice)."""
        odd = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        points, begins = textkit.joined(["" if i in odd else t for i, t in enumerate(texts)] if odd else texts)
        start, end = textkit.pretokens(points, with_space=True)
        keys, at, which = np.unique(textkit.span_hashes(points, start, end), return_index=True, return_inverse=True)
        if len(self.index) + len(keys) > CACHE_WORDS:
            self.clear()
        if len(keys) > CACHE_WORDS:  # a slice is one longer text at most
            return [self.library(t) for t in texts]
        slot = np.empty(len(keys), np.int64)
        for k, key in enumerate(keys.tolist()):
            s = self.index.get(key)
            if s is None:
                word = points[start[at[k]] : end[at[k]]].tobytes().decode("utf-32-le")
                s = self.add(key, self.words.encode_ordinary(word))
            slot[k] = s
        slot = slot[which]
        n = self.begin[slot + 1] - self.begin[slot]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.begin[slot] - (ends - n), n) + np.arange(total)]
        edge = np.concatenate([[0], ends])[np.append(np.searchsorted(start, begins), len(start))]
        return [self.library(t) if i in odd else ids[edge[i] : edge[i + 1]] for i, t in enumerate(texts)]

    def library(self, text: str) -> np.ndarray:
        if self.whole is None:  # few workers meet such a text
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.json_path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def piece_ids(json_path: str, rank_path: str) -> PieceIds:
    return PieceIds(json_path, rank_path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(begin, end) of the pieces of n tokens: full ones, the remainder first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((a, a + capacity) for a in range(first, n, capacity))]


def pieces(docs: DataFrame, json_path: str, rank_path: str, id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """A row per piece, with its partition and its place among that partition's pieces of its length."""
    ship_package(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    names = [id_col, "piece", "start", "length", "ids_crc32", "part", "nth"]

    def run(batches):
        encode = piece_ids(json_path, rank_path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            column, rows = batch.column(1), []
            # only the texts of a slice become Python strings
            sizes = [range(n or 0) for n in pc.utf8_length(column).to_pylist()]
            for a, b in textkit.slices(sizes):
                for i, ids in enumerate(encode.texts(strings(column.slice(a, b - a))), a):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, (s, e) in enumerate(cuts(len(ids), capacity)):
                        rows.append((i, k, s, e - s, zlib.crc32(ids[s:e].tobytes()), part, seen[e - s]))
                        seen[e - s] += 1
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:5]), pa.array(columns[5], pa.int32()), pa.array(columns[6], pa.int64())],
                names=names,
            )

    kinds = [docs.schema[id_col].dataType, T.IntegerType(), T.LongType(), T.LongType(), T.LongType(), T.IntegerType(), T.LongType()]
    return docs.select(id_col, text_col).mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


class Plan:
    """Sequences for a histogram of lengths; runs are (length, first place, sequence, pieces a sequence, offset)."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS):
        self.capacity, self.sequences = capacity, 0
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.given = dict.fromkeys(histogram, 0)
        self.open: list[tuple[int, int, int]] = []  # first sequence, number of sequences, tokens in each
        small = capacity // SMALL_SHARE
        if histogram.get(capacity):
            self.place(capacity, self.new(histogram[capacity]), histogram[capacity], 1, 0)
        self.large({n: c for n, c in histogram.items() if small < n < capacity}, groups)
        self.best_fit({n: c for n, c in histogram.items() if n <= min(small, capacity - 1)})

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def place(self, length: int, first: int, items: int, each: int, offset: int) -> None:
        self.runs.append((length, self.given[length], first, each, offset))
        self.given[length] += items

    def large(self, left: dict[int, int], groups: int) -> None:
        queue: list[list[list[int]]] = []  # per group, [length, count] from the longest down
        share, room = -(-sum(left.values()) // groups), 0
        for n in sorted(left, reverse=True):
            c = left[n]
            while c:
                if not room:
                    queue.append([])
                    room = share
                take = min(c, room)
                queue[-1].append([n, take])
                c, room = c - take, room - take
        size = [g[0][0] for g in queue]
        stock = [sum(c for _, c in g) for g in queue]
        while any(stock):
            use = self.configuration(size, stock)
            times = min(stock[g] // use.count(g) for g in set(use))
            for g in use:
                stock[g] -= times
            self.substitute([self.draw(queue[g], times) for g in use], times)

    def configuration(self, size: list[int], stock: list[int]) -> list[int]:
        """Groups that fill a sequence best, the largest size left among them."""
        first = next(g for g in range(len(size)) if stock[g])
        room = self.capacity - size[first]
        best: list[tuple[int, ...] | None] = [None] * (room + 1)  # by tokens filled
        best[0] = ()
        for g in range(first, len(size)):
            limit = stock[g] - (g == first)
            if limit <= 0 or size[g] > room:
                continue
            for filled in range(size[g], room + 1):
                below = best[filled - size[g]]
                if best[filled] is None and below is not None and below.count(g) < limit:
                    best[filled] = (*below, g)
        filled = max(i for i, x in enumerate(best) if x is not None)
        return [first, *best[filled]]

    @staticmethod
    def draw(queue: list[list[int]], n: int) -> list[list[int]]:
        """The next n pieces of a group, as [length, count]."""
        out = []
        while n:
            length, c = queue[0]
            take = min(c, n)
            out.append([length, take])
            n -= take
            if take == c:
                queue.pop(0)
            else:
                queue[0][1] -= take
        return out

    def substitute(self, slots: list[list[list[int]]], times: int) -> None:
        """Actual lengths into the slots of a configuration, in runs over which no slot's length changes."""
        while times:
            n = min(slot[0][1] for slot in slots)
            first, offset = self.new(n), 0
            for slot in slots:
                length = slot[0][0]
                self.place(length, first, n, 1, offset)
                offset += length
                slot[0][1] -= n
                if not slot[0][1]:
                    slot.pop(0)
            self.open.append((first, n, offset))
            times -= n

    def best_fit(self, left: dict[int, int]) -> None:
        by_room: dict[int, list[tuple[int, int, int]]] = {}
        for run in self.open:
            by_room.setdefault(self.capacity - run[2], []).append(run)
        for length in sorted(left, reverse=True):
            items = left[length]
            for room in range(length, self.capacity):
                if not items:
                    break
                each, runs = room // length, by_room.pop(room, [])
                for k, run in enumerate(runs):
                    if not items:
                        by_room.setdefault(room, []).extend(runs[k:])
                        break
                    items -= self.fill(by_room, run, length, each, items)
            while items:
                each = self.capacity // length
                n = max(1, items // each)
                items -= self.fill(by_room, (self.new(n), n, 0), length, each, items)

    def fill(self, by_room: dict, run: tuple[int, int, int], length: int, each: int, items: int) -> int:
        """Place up to ``each`` pieces in every sequence of a run; returns how many were placed."""
        first, n, offset = run
        full = min(n, items // each)
        placed = full * each
        if full:
            self.place(length, first, placed, each, offset)
            by_room.setdefault(self.capacity - offset - each * length, []).append((first, full, offset + each * length))
        if full < n:
            rest = min(items - placed, each - 1)
            if rest:
                self.place(length, first + full, rest, rest, offset)
                by_room.setdefault(self.capacity - offset - rest * length, []).append((first + full, 1, offset + rest * length))
                placed, full = placed + rest, full + 1
            if full < n:
                by_room.setdefault(self.capacity - offset, []).append((first + full, n - full, offset))
        return placed


def pack(
    docs: DataFrame,
    json_path: str,
    rank_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    groups: int = GROUPS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row per piece."""
    cut = stored(pieces(docs, json_path, rank_path, id_col, text_col, capacity, end_id), "pieces")
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece_offsets")
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(sorted(Plan(histogram, capacity, groups).runs), dtype=np.int64).reshape(-1, 5)
    names = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    lengths = np.searchsorted(runs[:, 0], np.arange(capacity + 2))  # where each length's runs begin

    def assign(batches):
        for batch in batches:
            length, place = (batch.column(i).to_numpy() for i in (3, 5))
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                mine = length == n
                begin = lengths[n]
                at[mine] = begin + np.searchsorted(runs[begin : lengths[n + 1], 1], place[mine], side="right") - 1
            nth = place - runs[at, 1]
            sequence, offset = runs[at, 2] + nth // runs[at, 3], runs[at, 4] + nth % runs[at, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=names)

    placed = cut.join(offsets.drop("n"), ["length", "part"]).withColumn("place", F.col("nth") + F.col("before"))
    schema = T.StructType([*(cut.schema[n] for n in names[:5]), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return placed.select(*names[:5], "place").mapInArrow(assign, schema)

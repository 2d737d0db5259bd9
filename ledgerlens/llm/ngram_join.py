"""N-gram Jaccard self-join: MinHash banding, then full n-gram sets.

1. *Signatures* (one scan, Arrow batches): the set of hashed five-word
   shingles of each text, a digest of the set, its MinHash values cut into
   bands, and their low bytes. Texts with equal sets are copies and count as
   one text from here on.
2. *Banding*: rows a band and number of bands are chosen for a target recall
   at the threshold. Band hashes are shuffled; a bucket's members are paired
   with its smallest and its largest member, two pairs a member. Signature
   bytes drop pairs that are far from the threshold (``SIGMAS`` standard
   errors below it). The other members of a bucket that these pairs leave in
   more than one group are then compared with each other, every pair, in
   blocks; so a bucket of one group stays linear, and no pair that shares a
   bucket is passed over.
3. *Verification*: the candidate groups that these pairs connect are checked
   on full n-gram sets, every pair of texts of a group. Texts of other
   documents are left out where they are read, before any shuffle. The set of
   each text is made once and stored as its difference from one set of the
   group, where that is smaller. A group is cut into blocks of about ``BLOCK``
   texts and ``BLOCK_BYTES`` of differences, and each pair of blocks is one
   unit of work: it gets differences, not texts, and has the sizes of all
   intersections from their products. A unit returns the number of links of
   each text and a spanning forest of the links, never the pairs.
4. *Classes*: connected components of the verified links.

Words are runs of letters and numbers, lower-cased. A text of one to four
words has one shingle; texts without words are copies only if equal. Null
text is empty. Equal rows are copies. A class has the smallest id of its
rows; null ids are ignored for it unless all are null. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit
from ledgerlens.llm.common import bounded_batches, free_name, stored, strings, text_or_empty
from ledgerlens.llm.components import connected
from ledgerlens.session import ship_package

N, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 192
SIGMAS = 5
#: Texts of a block, and bytes of their differences.
BLOCK, BLOCK_BYTES = 500, 8 << 20
#: Members of a crowded bucket in a block.
CROWD = 1000
#: Columns of the shingle matrix that a unit holds at a time.
COLUMNS = 4096
#: Most rows of the filter that is sent to all tasks, 64 bits each.
WORDS = 1 << 19


def banding(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose bands reach the recall at the threshold within max_hashes."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes):
        chance = threshold**rows
        bands = math.ceil(math.log1p(-recall) / math.log1p(-chance)) if chance < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def minhash(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest value of each multiplicative hash over a set."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 2048):
        np.minimum(low, (factors[:, None] * shingles[None, a : a + 2048]).min(axis=1), out=low)
    return low


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """id, digest (of the text), key (of the shingle set), node (short key), bands, bytes: a row per document."""
    ship_package(docs.sparkSession)
    names = ["id", "digest", "key", "node", "bands", "bytes"]

    def run(batches):
        seeds = textkit.mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        factors = np.array([pow(0x100000001B3, i, 1 << 64) for i in range(rows)], np.uint64)
        for batch in batches:
            texts, digests = strings(batch.column(2)), batch.column(1).to_pylist()
            keys, nodes, hashes, marks = [], [], [], []
            for a, b in textkit.slices(texts):
                for digest, own in zip(digests[a:b], textkit.shingle_sets(texts[a:b], n), strict=True):
                    if not len(own):
                        keys.append(bytes.fromhex(digest))
                        hashes.append([])
                        marks.append(b"")
                    else:
                        keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                        low = minhash(own, seeds)
                        band = (low.reshape(bands, rows) * factors).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
                        hashes.append(textkit.mix(band).view(np.int64))
                        marks.append((low >> np.uint64(40)).astype(np.uint8).tobytes())
                    nodes.append(int.from_bytes(keys[-1][:8], "little", signed=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(nodes, pa.int64()), pa.array(hashes, pa.list_(pa.int64())), pa.array(marks, pa.binary())], names=names
            )

    text = text_or_empty(text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows_in = docs.select(F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("digest"), text.alias("t"))
    return rows_in.mapInArrow(run, f"id {id_type}, digest string, key binary, node long, bands array<long>, bytes binary")


def least_equal(hashes: int, threshold: float) -> float:
    """Equal signature bytes of a pair that may reach the threshold."""
    return (threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / hashes)) * hashes


def candidates(signed: DataFrame, hashes: int, threshold: float) -> DataFrame:
    """node, label: groups of nodes connected by pairs that share a band with near enough signatures."""
    banded = signed.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    met = stored(banded.join(buckets, "band").select("band", "node", "low", "high").distinct(), "ngram_met")
    # a table, so that the join of a leader's many pairs with its signature can be split
    marks = stored(signed.where(F.size("bands") > 0).groupBy("node").agg(F.first("bytes").alias("bytes")), "ngram_marks")
    led = near_leaders(met, marks, hashes, threshold)
    groups = connected(led)
    more = near_others(met, marks, groups, hashes, threshold)
    return connected(led.union(more)) if more is not None and more.head(1) else groups


def near_leaders(met: DataFrame, marks: DataFrame, hashes: int, threshold: float) -> DataFrame:
    """a, b: members of a bucket that are near its smallest or its largest one, two pairs a member."""
    led = met.select("node", F.explode(F.array("low", "high")).alias("lead")).where("node <> lead")
    pairs = stored(led.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct(), "ngram_pairs")
    both = pairs.join(marks.withColumnsRenamed({"node": "a", "bytes": "x"}), "a").join(marks.withColumnsRenamed({"node": "b", "bytes": "y"}), "b")
    least = least_equal(hashes, threshold)

    def near(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, hashes) for k in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((x == y).sum(axis=1) >= least)], names=["a", "b", "near"])

    return stored(both.select("a", "b", "x", "y").mapInArrow(near, "a long, b long, near boolean").where("near").select("a", "b"), "ngram_candidates")


def near_forest(nodes: np.ndarray, labels: np.ndarray, blocks: np.ndarray | None, marks: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Near pairs that connect the groups (labels) of a unit; pairs within a group or a block are left out."""
    _, group = np.unique(labels, return_inverse=True)
    out = []
    for r in range(len(nodes) - 1):
        open_ = group[r + 1 :] != group[r]
        if blocks is not None:
            open_ &= blocks[r + 1 :] != blocks[r]
        rest = np.flatnonzero(open_) + r + 1
        near = rest[(marks[rest] == marks[r]).sum(axis=1) >= least] if len(rest) else rest
        for k in near:
            if group[k] != group[r]:
                out.append((int(nodes[r]), int(nodes[k])))
                group[group == group[k]] = group[r]
    return out


def near_others(met: DataFrame, marks: DataFrame, groups: DataFrame, hashes: int, threshold: float) -> DataFrame | None:
    """a, b: near pairs of a bucket's other members, where these are in more than one group; None if they never are.

    Every pair of such a bucket is compared, in blocks of about ``CROWD``
    members; a unit of work returns a forest.
    """
    inner = met.where("node <> low and node <> high").join(groups, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    mixed = inner.groupBy("band").agg(F.ceil(F.count("*") / CROWD).cast("int").alias("blocks"), F.min("label").alias("first"), F.max("label").alias("last"))
    mixed = stored(mixed.where("first < last").select("band", "blocks"), "ngram_mixed")
    if not mixed.head(1):
        return None
    member = inner.join(mixed, "band").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    units = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "label", "node"
    )
    least = least_equal(hashes, threshold)

    def pairs(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        unit = pa.Table.from_batches(waiting)
        marked = np.frombuffer(b"".join(unit.column("bytes").to_pylist()), np.uint8).reshape(-1, hashes)
        blocks = unit.column("block").to_numpy() if unit.column("i")[0] != unit.column("j")[0] else None
        found = near_forest(unit.column("node").to_numpy(), unit.column("label").to_numpy(), blocks, marked, least)
        return pa.RecordBatch.from_arrays([pa.array([min(p) for p in found], pa.int64()), pa.array([max(p) for p in found], pa.int64())], names=["a", "b"])

    def run(batches):
        last, waiting = None, []  # the unit being read, its rows so far
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                unit = tuple(key[:, a].tolist())
                if unit != last and waiting:
                    yield pairs(waiting)
                    waiting = []
                last = unit
                waiting.append(batch.slice(a, b - a))
        if waiting:
            yield pairs(waiting)

    sorted_units = units.join(marks, "node").select("band", "i", "j", "block", "label", "node", "bytes").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return stored(sorted_units.mapInArrow(run, "a long, b long").distinct(), "ngram_others")


def difference(own: np.ndarray, base: np.ndarray) -> tuple[bool, int, np.ndarray, np.ndarray]:
    """Whether a sorted set is stored by its difference from ``base``, base's product with what is stored, and this: what the set has more and less."""
    common = np.intersect1d(own, base, assume_unique=True)
    if len(own) + len(base) - 2 * len(common) < len(own):
        less = np.setdiff1d(base, common, assume_unique=True)
        return True, -len(less), np.setdiff1d(own, common, assume_unique=True), less
    return False, len(common), own, base[:0]


def shared_within(like: np.ndarray, dot: np.ndarray, base: int, more: list[np.ndarray], less: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sets stored by ``difference``, from products of blocks of the matrix of differences.

    A set is like * base + d, d having 1 for what it has more and -1 for what
    it has less, so the product of two sets is like * like' * |base| + like *
    dot' + dot * like' + d * d'. The diagonal is not filled in.
    """
    like = like.astype(np.float64)
    common = base * np.outer(like, like) + np.outer(like, dot) + np.outer(dot, like)
    row = np.concatenate([np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (more, less)])
    value = np.repeat(np.array([1, -1], np.float32), [sum(map(len, more)), sum(map(len, less))])
    _, which, times = np.unique(np.concatenate([*more, *less]), return_inverse=True, return_counts=True)
    shared = times[which] > 1
    row, which, value = row[shared], which[shared], value[shared]
    columns, which = np.unique(which, return_inverse=True)
    order = np.argsort(which, kind="stable")
    row, which, value = row[order], which[order], value[order]
    for first in range(0, len(columns), COLUMNS):
        a, b = np.searchsorted(which, (first, first + COLUMNS))
        part = np.zeros((len(like), min(COLUMNS, len(columns) - first)), np.float32)
        part[row[a:b], which[a:b] - first] = value[a:b]
        common += part @ part.T
    return common


def reaching(size: np.ndarray, common: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold."""
    # compared as whole numbers times the threshold, so that exact ties count
    return common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9


def forest(linked: np.ndarray) -> np.ndarray:
    """Root of each row in the graph of a symmetric matrix."""
    root = np.full(len(linked), -1)
    for r in range(len(linked)):
        if root[r] < 0:
            wave = np.zeros(len(linked), bool)
            wave[r] = True
            while wave.any():
                root[wave] = r
                wave = linked[wave].any(axis=0) & (root < 0)
    return root


def packed_sets(column: pa.Array) -> list[np.ndarray]:
    """A column of packed shingle hashes."""
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def likely_members(whole: DataFrame, member: DataFrame) -> DataFrame:
    """Rows whose digest may be one of member's: all that are, and few others, so that a join after it need not shuffle every text.

    A bit is set for each digest, and the rows of 64 bits (at most ``WORDS``)
    are broadcast; the more digests there are, the more other rows pass.
    """
    mark = F.xxhash64("digest")
    place = (F.pmod(mark, F.lit(WORDS)).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(mark, 32), F.lit(64)).cast("int")).alias("bit"))
    marks = member.select(*place).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    placed = whole.select("*", *place)
    return placed.join(F.broadcast(marks), (placed["word"] == marks["word"]) & (placed["bit"].bitwiseAND(marks["bits"]) != 0), "left_semi").select(*whole.columns)


def differences(docs: DataFrame, signed: DataFrame, groups: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """label, key, size, base, like, dot, more, less: the n-gram set of each text of a candidate group, once, by its difference from one set of the group."""
    texts = signed.where(F.size("bands") > 0).groupBy("key", "node").agg(F.min("digest").alias("digest"))
    member = stored(texts.join(groups, "node").select("label", "key", "digest"), "ngram_members")
    whole = docs.select(F.md5(text_or_empty(text_col).cast("binary")).alias("digest"), text_or_empty(text_col).alias("t"))
    # a key has one digest here, so a text of each digest is a text of each key
    once = likely_members(whole, member).groupBy("digest").agg(F.first("t").alias("t")).join(member, "digest").select("key", "label", "t")

    def shingled(batches):
        for batch in batches:
            column = batch.column(2)
            for a, b in textkit.slices([range(x) for x in pc.utf8_length(column).to_pylist()]):
                own = [s.tobytes() for s in textkit.shingle_sets(strings(column.slice(a, b - a)), n)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), batch.column(0).slice(a, b - a), pa.array(own, pa.binary())], names=["label", "key", "own"])

    sets = stored(once.mapInArrow(shingled, "label long, key binary, own binary"), "ngram_grams")
    heads = sets.groupBy("label").agg(F.min("key").alias("key"))
    # both sides are tables, so that a large group's join can be split
    bases = stored(sets.join(heads, ["label", "key"], "left_semi").select("label", F.col("own").alias("base")), "ngram_bases")

    def compared(batches):
        for batch in batches:
            own, base = packed_sets(batch.column(2)), packed_sets(batch.column(3))
            like, dot, more, less = zip(*map(difference, own, base), strict=True) if own else ((),) * 4
            columns = [pa.array(x, pa.int32()) for x in (map(len, own), map(len, base))] + [pa.array(like, pa.bool_()), pa.array(dot, pa.int32())]
            columns += [pa.array([s.tobytes() for s in x], pa.binary()) for x in (more, less)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["label", "key", "size", "base", "like", "dot", "more", "less"])

    both = sets.join(bases, "label").select("label", "key", "own", "base")
    return stored(both.mapInArrow(compared, "label long, key binary, size int, base int, like boolean, dot int, more binary, less binary"), "ngram_differences")


def verified(docs: DataFrame, signed: DataFrame, groups: DataFrame, id_col: str, text_col: str, n: int, threshold: float) -> DataFrame:
    """a, b, links: per text and unit of work, a link of the spanning forest and the number of its links."""
    member = differences(docs, signed, groups, id_col, text_col, n)
    weight = F.length("more") + F.length("less")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(weight) / BLOCK_BYTES)).cast("int")
    size = member.groupBy("label").agg(blocks.alias("blocks"))
    member = member.join(size, "label").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    units = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "size", "base", "like", "dot", "more", "less"
    )

    def check(unit: pa.Table) -> pa.Table:
        like, dot, own = (unit.column(c).to_numpy() for c in ("like", "dot", "size"))
        common = shared_within(like, dot.astype(np.float64), unit.column("base")[0].as_py(), packed_sets(unit.column("more")), packed_sets(unit.column("less")))
        linked = reaching(own.astype(np.float64), common, threshold)
        np.fill_diagonal(linked, False)
        if unit.column("i")[0] != unit.column("j")[0]:
            block = unit.column("block").to_numpy()
            linked &= block[:, None] != block[None, :]
        links, keys, root = linked.sum(axis=1), unit.column("key").to_pylist(), forest(linked)
        some = np.flatnonzero(links)
        return pa.table({"a": pa.array([keys[k] for k in some], pa.binary()), "b": pa.array([keys[root[k]] for k in some], pa.binary()), "links": pa.array(links[some], pa.int64())})

    return stored(units.groupBy("label", "i", "j").applyInArrow(check, "a binary, b binary, links long"), "ngram_links")


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES
) -> tuple[DataFrame, DataFrame]:
    """Signatures of all documents, and per shingle set: key, class_id, class_digest, n_copies, n_links.

    ``class_digest`` is the text digest of one text of the class: the one of
    the row with the smallest id.
    """
    bounded_batches(docs.sparkSession)
    bands, rows = banding(threshold, recall, max_hashes)
    signed = stored(signatures(docs, id_col, text_col, n, bands, rows), "ngram_signatures")
    groups = candidates(signed, bands * rows, threshold)
    found = verified(docs, signed, groups, id_col, text_col, n, threshold)
    links = found.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("n_links"))
    labels = connected(found.select("a", "b")).withColumnRenamed("node", "key")
    first = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "digest")).alias("first")
    sets = stored(signed.groupBy("key").agg(first, F.count("*").alias("n_copies")).join(labels, "key", "left").withColumn("label", F.coalesce("label", "key")), "ngram_sets")
    heads = sets.groupBy("label").agg(F.min("first").alias("head"))
    classes = sets.join(heads, "label").join(links, "key", "left")
    return signed, stored(
        classes.select("key", F.col("head.id").alias("class_id"), F.col("head.digest").alias("class_digest"), "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")),
        "ngram_classes",
    )


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """id, class_id, n_links (other texts that reach the threshold), n_copies (rows with the same n-gram set, itself too)."""
    signed, classes = join(docs, id_col, text_col, **rule)
    return signed.select("id", "key").join(classes, "key").select(F.col("id").alias(id_col), "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """One row of each class, the one with the smallest id, with all input columns."""
    _, classes = join(docs, id_col, text_col, **rule)
    row = free_name(docs, "row")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), F.md5(text_or_empty(text_col).cast("binary")).alias("digest"))
    one = rows.groupBy("digest").agg(F.min_by(row, F.struct(F.col(row)[id_col].isNull(), F.col(row)[id_col])).alias(row))
    heads = classes.select(F.col("class_digest").alias("digest")).distinct()
    return one.join(heads, "digest", "left_semi").select(*(F.col(row)[c].alias(c) for c in docs.columns))

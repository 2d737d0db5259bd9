"""Spelling variants by PartEnum signatures of letter multisets.

Words that differ by one inserted, deleted or replaced letter have letter
multisets of Hamming distance at most two, as vectors with a digit for every
(letter, nth occurrence): two at most for words of equal length, one for
lengths one apart. Digits are dealt to ``distance + 2`` partitions; for each
choice of ``distance`` partitions to leave out, the digits of the others are a
signature. Near vectors agree in at least one signature, so an equi-join on
signatures loses no pair.

As many words share a multiset, a signature also takes the half of the word
that the edit does not touch (first or last), which keeps buckets small and
loses nothing either: an edit falls into one half, and signatures are made
for both. A bucket of more than ``crowd`` words is split by the rest of the
word without one letter, for each letter; words one edit apart share such a
rest, so the split is exact, too. Candidates are verified by edit distance.

Counting reads every whole text once; words are pre-aggregated in their map
tasks. A word has one row from there on, so no word is hot. The form of a word
is its near word with the largest count; roots follow the forms by pointer
doubling, each round written.

Null text has no words; a null id counts as an empty string in the checksum.
Upper-case letters beyond A-Z stay as they are. Repeated rows count again.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored
from ledgerlens.session import ship_package

LETTERS = r"[A-Za-zÀ-ÿ]"
LENGTH, COUNT, TYPO, RATIO, CROWD = 6, 5, 199, 5, 400
#: What a word does in a bucket: it meets words of its length, the ones a letter longer, or the ones a letter shorter.
ALIKE, SHORTER, LONGER = range(3)


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, count: int = COUNT, typo: int = TYPO) -> DataFrame:
    """word, n: words of at least ``length`` letters that occur ``count`` times."""
    # a run loses a letter at most, so shorter ones give no word
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text_col, F.lit(f"{LETTERS}{{{length},}}"), F.lit(0))).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("run"))
    marked = runs.select("id", low.alias("w")).select("w", F.crc32(F.concat("id", F.lit(":"), "w").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("w")).cast("int")
    word = F.when(F.col("h") % typo == 0, F.concat(F.substring(F.col("w"), F.lit(1), at), F.substring(F.col("w"), at + 2, F.length("w")))).otherwise(F.col("w"))
    counted = marked.select(word.alias("word")).where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= count)


def partitions(word: str, parts: int) -> list[str]:
    """The digits of a word's letter multiset, (letter, nth) in order, dealt to partitions."""
    out = [""] * parts
    letters = sorted(word)
    nth = 0
    for k, c in enumerate(letters):
        nth = nth + 1 if k and letters[k - 1] == c else 1
        digit = f"{c}{nth}"
        out[xxhash.xxh32_intdigest(digit) % parts] += digit
    return out


def signatures(word: str) -> Iterator[tuple[int, str]]:
    """(role, signature) of a word in all its buckets."""
    for role, distance, other in ((ALIKE, 2, 0), (SHORTER, 1, 1), (LONGER, 1, -1)):
        # buckets of two lengths are named after the shorter one
        short = len(word) + min(other, 0)
        parts = partitions(word, distance + 2)
        half = short // 2
        ends = (f"<{word[:half]}", f">{word[len(word) - short + half:]}")
        kind = f"{distance}:{short}:"
        for kept in itertools.combinations(range(distance + 2), 2):
            vector = "|".join(f"{k}{parts[k]}" for k in kept)
            for end in ends:
                yield role, f"{kind}{vector}{end}"


def rests(word: str, role: int) -> list[str]:
    """The word without one letter, for each letter, with its place where both words have it; a shorter word as it is."""
    if role == SHORTER:
        return [word]
    return [word[:k] + ("?" if role == ALIKE else "") + word[k + 1 :] for k in range(len(word))]


def signed(vocabulary: DataFrame) -> DataFrame:
    """sig, role, word, n: a row per signature of each word."""
    ship_package(vocabulary.sparkSession)

    def run(batches):
        for batch in batches:
            sigs, roles, at = [], [], []
            for k, w in enumerate(batch.column(0).to_pylist()):
                for role, sig in signatures(w):
                    sigs.append(xxhash.xxh64_intdigest(sig))
                    roles.append(role)
                    at.append(k)
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(np.array(sigs, np.uint64).view(np.int64)), pa.array(roles, pa.int8()), batch.column(0).take(take), batch.column(1).take(take)], names=["sig", "role", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(run, "sig long, role byte, word string, n long")


def split_crowds(rows: DataFrame, crowd: int) -> DataFrame:
    """The rows, those of buckets of more than ``crowd`` of them under finer signatures."""
    large = stored(rows.groupBy("sig").agg(F.count("*").alias("size")).where(F.col("size") > crowd).select("sig"), "spelling_crowds")
    if not large.head(1):
        return rows

    def run(batches):
        for batch in batches:
            sigs, at = [], []
            for k, (sig, role, w) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                for rest in rests(w, role):
                    sigs.append(xxhash.xxh64_intdigest(rest, sig & (1 << 64) - 1))
                    at.append(k)
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(np.array(sigs, np.uint64).view(np.int64)), *(batch.column(c).take(take) for c in (1, 2, 3))], names=["sig", "role", "word", "n"])

    finer = rows.join(large, "sig", "left_semi").select("sig", "role", "word", "n").mapInArrow(run, "sig long, role byte, word string, n long")
    return rows.join(large, "sig", "left_anti").unionByName(finer)


def near_pairs(vocabulary: DataFrame, crowd: int = CROWD) -> DataFrame:
    """a, a_n, b, b_n: every pair of words one edit apart, once, with their counts."""
    rows = split_crowds(stored(signed(vocabulary), "spelling_signatures"), crowd)
    left = rows.where(F.col("role") != LONGER).withColumnsRenamed({"word": "a", "n": "a_n"})
    right = rows.where(F.col("role") != SHORTER).withColumnsRenamed({"word": "b", "n": "b_n", "role": "other"})
    same = (F.col("role") == ALIKE) & (F.col("other") == ALIKE) & (F.col("a") < F.col("b"))
    longer = (F.col("role") == SHORTER) & (F.col("other") == LONGER)
    met = left.join(right, "sig").where((same | longer) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root of the words (word, form) that have a form: the last word that the forms lead to."""
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        # a form's count is larger than the word's, so there is no circle
        up = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        done = stored(links.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling_roots")
        links = done.select("word", "root")
        if not done.where("moved").head(1):
            return links


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, count: int = COUNT, typo: int = TYPO,
    ratio: int = RATIO, crowd: int = CROWD,
) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row per word."""
    vocabulary = stored(words(docs, id_col, text_col, length, count, typo), "spelling_words")
    pairs = stored(near_pairs(vocabulary, crowd), "spelling_pairs")
    both = pairs.union(pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("minus"), F.col("b").alias("word"))).alias("best")
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    joined = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n"),
    )
    found = stored(joined, "spelling_forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: DuckDB SQL of ``variants`` over documents.
VARIANTS_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS codes FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i)) t),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
lowered AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM runs WHERE length(run) >= 6 GROUP BY ALL),
summed AS (
  SELECT w, n,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(id || ':' || w)), '..'), lambda h: ('0x' || h)::BIGINT)),
                         lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM lowered, crc_table),
typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
rests AS (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)),
pairs AS (
  SELECT a.word AS word, b.word AS near, b.n AS near_n FROM rests a JOIN rests b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM rests a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM rests a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END::BIGINT AS form_n
  FROM words w LEFT JOIN best USING (word)),
paths AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT p.word, f.form FROM paths p JOIN forms f ON f.word = p.root WHERE f.form IS NOT NULL),
ends AS (SELECT p.word, p.root FROM paths p JOIN forms f ON f.word = p.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

"""Language identification by cross-parsing entropy.

A suffix automaton of a labelled sample is built for each language. A text is
cross-parsed against each automaton: from every phrase start the longest
match that occurs in the sample is taken as one phrase. The language that
needs the fewest phrases, normalised by the length parsed, wins; the score is
1 - phrases(best) / phrases(second), 0 for a tie and near 1 for a clear case.

Learning reads only text and label of the rows it is given. The sample is
bounded by documented parameters: ``sample_docs`` distinct texts a language,
chosen by a seeded hash of the whole text among all rows, ``sample_chars``
letters in all. Texts that fit their share of the letters are learned whole;
of longer ones a slice at a seeded place anywhere in the text. One small model
goes to the tasks. Every letter of the sample has a code of its own: the
``TABLE_LETTERS`` most frequent ones are columns of a table of transitions,
the others (large alphabets) are looked up in a sorted list. Prediction reads
every whole text once, without a shuffle; texts are parsed in blocks of
``BLOCK`` letters side by side, so one very long text costs no more steps than
a short one; a block starts a phrase.

Null text, or text without a letter, gets ``und`` and score 0; so does every
text if no label was learned. Ties go to the first language in code-point
order. Repeated rows, extra columns and empty tables need no special care.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import textkit
from ledgerlens.llm.common import bounded_batches, free_name, strings
from ledgerlens.session import ship_package

UNKNOWN = "und"
SAMPLE_DOCS, SAMPLE_CHARS, DOC_CHARS = 200, 40_000, 2_000
BLOCK = 512
#: Code points that a worker parses at a time; its arrays take about 50 bytes for each.
SLICE_CHARS = 400_000
#: Codes of a text: 0 a letter that no sample has, 1 any run of other characters, 2 and up letters.
GAP, TABLE_LETTERS = 1, 126


def letter_codes(samples: list[str]) -> np.ndarray:
    """Code of every code point, by the letter's rank in the samples."""
    table = np.where(textkit.classes() == textkit.LETTER, 0, GAP).astype(np.uint32)
    counts = Counter(c for s in samples for c in s.lower() if c.isalpha())
    for i, c in enumerate(sorted(counts, key=lambda c: (-counts[c], c))):
        table[ord(c)] = 2 + i
    return table


def encode(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts (gaps squeezed), where each begins (and the end), and whether it has a letter."""
    points, begins = textkit.joined(texts)
    points = textkit.lower_table()[points]
    codes = table[points]
    keep = (codes != GAP) | np.append(True, codes[:-1] != GAP)
    keep &= points != textkit.SEPARATOR
    letters = np.cumsum(np.append(0, codes != GAP))
    place = np.cumsum(np.append(0, keep))
    ends = np.append(begins[1:] - 1, len(points) - 1)
    return codes[keep], np.append(place[begins], place[-1]), letters[ends] > letters[begins]


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence, state 0 the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class Model:
    """Tables of all languages: ``moves[state * width + code]`` with 0 for none, ``roots[language, code]``.

    Moves by a code of ``width`` or more are in ``rare_moves``, under the
    sorted ``rare_keys`` (state and code).
    """

    def __init__(self, samples: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS):
        self.languages = sorted(samples)
        self.codes = letter_codes([s for x in samples.values() for s in x])
        letters = int(self.codes.max()) + 1
        self.width = min(letters, 2 + TABLE_LETTERS)
        tables, first, rare = [np.zeros((1, self.width), np.int32)], 1, []
        self.roots = np.zeros((len(self.languages), letters), np.int32)
        for k, language in enumerate(self.languages):
            codes = encode(samples[language], self.codes)[0][:sample_chars]
            states = automaton(codes.tolist())
            moves = np.zeros((len(states), self.width), np.int32)
            for s, to in enumerate(states):
                for c, t in to.items():
                    if c >= self.width:
                        rare.append(((s + first) << 32 | c, t + first))
                    elif c:
                        moves[s, c] = t + first
            for c, t in states[0].items():
                if c:
                    self.roots[k, c] = t + first
            tables.append(moves)
            first += len(states)
        self.moves = np.concatenate(tables).ravel()
        self.rare_keys, self.rare_moves = (np.array(x, np.int64) for x in zip(*sorted(rare))) if rare else (np.zeros(0, np.int64),) * 2

    def rare(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Moves by letters that have no column."""
        key = state.astype(np.int64) << 32 | code.astype(np.int64)[:, None]
        at = np.minimum(np.searchsorted(self.rare_keys, key), len(self.rare_keys) - 1)
        return np.where(self.rare_keys[at] == key, self.rare_moves[at], 0)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text under each language, and whether it has a letter."""
        codes, begins, letters = encode(texts, self.codes)
        size = np.diff(begins)
        blocks = -(-size // BLOCK)
        row = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = begins[row] + nth * BLOCK
        length = np.minimum(BLOCK, begins[row + 1] - start)
        order = np.argsort(-length, kind="stable")
        row, start, length = row[order], start[order], length[order]
        running = np.searchsorted(-length, -np.arange(1, BLOCK + 1), side="right")
        roots = self.roots.T.copy()
        state = np.zeros((len(row), len(self.languages)), np.int32)
        count = np.zeros(state.shape, np.int32)
        for t in range(int(length.max(initial=0))):
            n = running[t]
            c = codes[start[:n] + t]
            column = np.minimum(c, self.width - 1) if len(self.rare_keys) else c
            to = self.moves.take(state[:n].astype(np.int64) * self.width + column[:, None])
            if len(self.rare_keys):
                odd = np.flatnonzero(c >= self.width)
                to[odd] = self.rare(state[odd], c[odd])
            missed = to == 0
            count[:n] += missed
            np.copyto(to, roots.take(c, axis=0), where=missed)
            state[:n] = to
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        np.add.at(total, row, count)
        return total, letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total, letters = self.phrases(texts)
        best = total.argmin(axis=1)
        ranked = np.sort(total, axis=1)
        second = ranked[:, 1] if len(self.languages) > 1 else np.full(len(texts), np.iinfo(np.int64).max)
        score = np.where(letters, 1 - ranked[:, 0] / np.maximum(second, 1), 0.0)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)], score


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True for the rows that learning may not see; a null id counts as such."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))


def shares(lengths: list[int], budget: int) -> int:
    """The length up to which all texts can be taken within the budget: the short ones whole, the others cut to it."""
    left, share = budget, max(lengths, default=0)
    for done, size in enumerate(sorted(lengths)):
        share = left // (len(lengths) - done)
        if size > share:
            return max(share, 1)
        left -= size
    return max(share, *lengths) if lengths else 0


def learn(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, seed: int = 11,
) -> Model:
    """Model from a bounded sample: the driver gets at most 4 * sample_docs slices of DOC_CHARS characters a language."""
    rows = labelled.select(F.col(text_col).alias("t"), F.col(label_col).alias("l")).where("l is not null and t is not null")
    # a row per language
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({})
    # the whole text decides whether it is drawn, and where its slice begins
    hashed = rows.select("l", "t", F.xxhash64(F.lit(seed), "t").alias("h"))
    place = F.pmod(F.xxhash64(F.lit(seed + 1), "h"), F.greatest(F.length("t") - DOC_CHARS, F.lit(0)) + 1).cast("int")
    drawn = hashed.select("l", F.pmod("h", F.lit(1 << 31)).alias("u"), F.substring(F.col("t"), place + 1, F.lit(DOC_CHARS)).alias("t"))
    share = {k: int(min(1.0, 3 * sample_docs / n) * (1 << 31)) for k, n in sizes.items()}
    limit = F.create_map(*(F.lit(x) for k, v in share.items() for x in (k, v)))[F.col("l")]
    # copies have the same draw and slice: one of them at most is wanted
    sample = drawn.where(F.col("u") < limit).distinct().orderBy("u").limit(4 * sample_docs * len(sizes))
    texts: dict[str, list[str]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["u"], r["t"])):
        mine = texts.setdefault(r["l"], [])
        if len(mine) < sample_docs:
            mine.append(r["t"])
    for k, mine in texts.items():
        length = shares([len(t) for t in mine], sample_chars)
        texts[k] = [t[len(t) // 2 - length // 2 :][:length] if len(t) > length else t for t in mine]
    return Model(texts, sample_chars)


def identify(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """The input columns and the prediction (names that clash get a leading underscore)."""
    spark = docs.sparkSession
    ship_package(spark)
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample
    pred_col, score_col = free_name(docs, pred_col), free_name(docs, score_col)
    schema = T.StructType([*docs.schema, T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for batch in batches:
            column, names, scores = batch.column(at), [], []
            # only the texts of a slice become Python strings
            sizes = [range(n or 0) for n in pc.utf8_length(column).to_pylist()]
            for a, b in textkit.slices(sizes, SLICE_CHARS):
                n, s = m.predict(strings(column.slice(a, b - a)))
                names += n
                scores.append(s)
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score)], names=schema.names)

    return docs.mapInArrow(run, schema)


def predictions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **sample) -> DataFrame:
    """Learn from the rows outside the held-out fold and predict every row: id, held_out, lang_pred, score."""
    model = learn(docs.where(~held_out(id_col)), id_col, text_col, label_col, **sample)
    out = identify(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")), model, "t")
    return out.select(F.col("i").alias(id_col), held_out("i").alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.0, ties: bool = True) -> DataFrame:
    """Rows whose language is told, with their columns as they were; without ``ties``, a score of 0 tells none."""
    out = identify(docs, model, text_col, "lang_pred", "lang_score")
    pred, score = out.columns[-2:]
    return out.where((F.col(pred) != UNKNOWN) & (F.col(score) >= min_score) & (F.lit(ties) | (F.col(score) > 0))).select(*(f"`{c}`" for c in docs.columns))

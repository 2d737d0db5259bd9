"""Token counts, packing, fingerprints and language against the library, brute force and held-out labels."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from helpers import frame, odd_rows

from ledgerlens.llm import fingerprints, language, packing, textkit, token_counts

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
ODD = ["", "a<|endoftext|>b's", "<|endoftext|>", "it's we'll '' 's 'x  \n\n a", "İΣς ÀÉ ½²", "a　b\x85c", "12345 x9", " 'll", "\n", "été"]


def test_pretokens_match_the_public_patterns():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("ab 's'tre'll'' \n\t12é.,漢²½　d"), rng.integers(0, 40))) for _ in range(500)]
    small = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    for pattern, with_space in ((P.PATTERN, True), (small, False)):
        points, _ = textkit.joined(texts)
        start, end = textkit.pretokens(points, with_space)
        assert ["".join(map(chr, points[a:b])) for a, b in zip(start, end)] == [w for t in texts for w in regex.findall(pattern, t)]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"], None, None) for r in docs.limit(60).collect()] + [(1000 + i, t, None, None) for i, t in enumerate(ODD)] + odd_rows()
    got = token_counts.count_tokens(frame(spark, rows), P.path("word_bpe_49k.json")).collect()
    want = []
    for i, t, *_ in rows:
        n = len(whole.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert Counter(map(tuple, got)) == Counter(want)
    assert token_counts.count_tokens(frame(spark, []), P.path("word_bpe_49k.json")).count() == 0


def test_vocabulary_has_every_byte():
    count = token_counts.counter(P.path("word_bpe_49k.json"))
    vocabulary = __import__("json").load(open(P.path("word_bpe_49k.json"), encoding="utf-8"))["model"]["vocab"]
    assert all(s in vocabulary and s + count.end in vocabulary for s in count.symbols)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"], None, None) for r in docs.collect()] + [(1000 + i, t, None, None) for i, t in enumerate(ODD)]
    rows += [(2000, None, None, None), (2001, "", None, None), (2002, "word " * 30_000, None, None), *[(2003, "the same", None, None)] * 50]
    paths = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
    got = packing.pack(frame(spark, rows), *paths).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or min(2048, len(ids))
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    used = defaultdict(list)
    for r in got:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(used) <= 1.08 * -(-sum(r["length"] for r in got) // 2048)
    assert packing.pack(frame(spark, []), *paths).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    histogram = dict(Counter((rng.pareto(1.2, 3000) * 150 + 1).clip(1, 2048).astype(int).tolist()))
    plan = packing.Plan(histogram)
    placed, fill = Counter(), Counter()
    for length, _, first, each, _ in plan.runs:
        placed[length] += 0
    assert set(placed) == set(histogram) and plan.given == histogram
    runs = sorted(plan.runs)
    for k, (length, place, first, each, _) in enumerate(runs):
        end = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == length else histogram[length]
        for n in range(end - place):
            fill[first + n // each] += length
    assert max(fill.values()) <= 2048 and len(fill) == plan.sequences
    assert plan.sequences <= 1.05 * -(-sum(n * c for n, c in histogram.items()) // 2048) + 2


def extension(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def likeness(a, b):
    if not a and not b:
        return 1.0
    front = extension(a, b)
    back = min(extension(a[::-1], b[::-1]), min(len(a), len(b)) - front)
    return (front + back) / max(len(a), len(b))


def test_prefix_hashes_answer_spans():
    a, b = fingerprints.Prefix.of("hello world"), fingerprints.Prefix.of("say hello world!")
    assert a.extension(0, b, 4) == 11 and a.extension_back(11, b, 15) == 11
    assert a.same(3, b, 7, 5) and not a.same(0, b, 0, 3)
    assert fingerprints.Prefix.of("abc").joined(2, fingerprints.Prefix.of("xyz"), 3).fingerprint() == fingerprints.Prefix.of("abxyz").fingerprint()


def test_fingerprints_against_brute_force(spark):
    rows = odd_rows()
    got = fingerprints.neighbour_fingerprints(frame(spark, rows), ranges=7).collect()
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    order = sorted(((i is None, i or 0, md5(t), i, t or "") for i, t, *_ in rows))
    want = Counter()
    for k, (*_, i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][-1]
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        want[i, len(t), hashlib.sha256(new.encode()).hexdigest(), round(likeness(t, new), 9), round(likeness(t, after), 9)] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["ends_edited"], 9), round(r["ends_next"], 9)) for r in got) == want
    by_text = defaultdict(set)
    texts = defaultdict(set)
    for i, t, *_ in rows:
        texts[i].add(t or "")
    for r in got:
        if len(texts[r["doc_id"]]) == 1:
            by_text[next(iter(texts[r["doc_id"]]))].add(r["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values()) and len({next(iter(f)) for f in by_text.values()}) == len(by_text)
    assert fingerprints.neighbour_fingerprints(frame(spark, [])).count() == 0
    assert fingerprints.neighbour_fingerprints(frame(spark, [(1, "abcd", None, None)])).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_shared_part_goes_on_after_an_edit(spark):
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(list("abcdefgh é漢😀"), 10_000))
    prefix = fingerprints.Prefix.of

    def edit(t, places):
        """A character changed, deleted or some inserted at each place; the characters of t that stay."""
        parts, at, stay = [], 0, 0
        for k, p in enumerate(places):
            parts += [t[at:p], ("#", "", "#new words#")[k % 3]]
            stay += p - at
            at = p + (k % 3 < 2)
        return "".join([*parts, t[at:]]), stay + len(t) - at

    for places in ([0], [0, 9_000], [0, 9_999], [0, 200, 400, 5_000, 5_100, 9_990], range(3, 9_900, 41)):
        # in a periodic text less than a span an edit may be lost
        for whole, lost in ((text, 0), ("word " * 2_000, fingerprints.SPAN)):
            new, stay = edit(whole, places)
            ends, near = prefix(whole).alike(prefix(new))
            # letters beside an edit may be equal by chance
            assert ends <= near <= 1 and stay - lost * len(places) - 0.5 <= near * max(len(whole), len(new)) <= stay + 5 * len(places), places
    ends = "#" + text[1:-1] + "#"
    got = {r["doc_id"]: r for r in fingerprints.neighbour_fingerprints(frame(spark, [(1, text, None, None), (2, ends, None, None), (3, "x" * 500, None, None)])).collect()}
    assert got[1]["ends_next"] == 0 and got[1]["near_next"] == 0.9998 and got[2]["near_next"] == 0
    # moved text keeps its longer part
    assert prefix(text).alike(prefix("#" + text[6_000:] + text[:6_000]))[1] == pytest.approx(0.6, abs=0.01)


def test_cross_parsing_against_brute_force():
    samples = {"x": ["abracadabra banana", "cabana"], "y": ["zyx wvu zzyx"]}
    model = language.Model(samples)
    texts = ["abra banana zyx", "zyx zyx", "qqq", "123 !", "ban" * 400]
    total, letters = model.phrases(texts)

    def squeezed(text):
        return regex.sub(r"\P{L}+", " ", text.lower())

    for t, counts in zip(texts, total):
        for k, name in enumerate(sorted(samples)):
            whole = "\0".join([squeezed(" ".join(samples[name]))])
            joined = language.encode(samples[name], model.codes)[0].tolist()
            codes = language.encode([t], model.codes)[0].tolist()
            n = 0
            for a in range(0, len(codes), language.BLOCK):
                block = codes[a : a + language.BLOCK]
                at = 0
                while at < len(block):
                    size = 1
                    while at + size <= len(block) and 0 not in block[at : at + size] and any(joined[j : j + size] == block[at : at + size] for j in range(len(joined))):
                        size += 1
                    at += max(1, size - 1)
                    n += 1
            assert counts[k] == n, (t, name, whole)
    assert letters.tolist() == [True, True, True, False, True]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    fold = got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (got.held_out == fold).all() and got.score.between(0, 1).all()
    mine = got[got.held_out]
    assert (mine.lang_pred == mine.lang).mean() > 0.95


def test_language_of_odd_documents(spark):
    out = language.predictions(frame(spark, odd_rows())).collect()
    assert len(out) == len(odd_rows())
    for r in out:
        if r["doc_id"] in (100, 101, 103):
            assert r["lang_pred"] == "und" and r["score"] == 0
    assert language.predictions(frame(spark, [])).count() == 0
    unlabelled = language.predictions(frame(spark, [(1, "text", None, None)])).first()
    assert unlabelled["lang_pred"] == "und"
    docs = frame(spark, odd_rows())
    kept = language.keep_identified(docs, language.learn(docs))
    assert kept.columns == docs.columns and kept.count() == len(odd_rows()) - 3


def common_subsequence(a, b):
    """Length of the longest common subsequence, a column of the table as bits of an integer."""
    places, ones = defaultdict(int), (1 << len(a)) - 1
    for k, c in enumerate(a):
        places[c] |= 1 << k
    row = ones
    for c in b:
        hit = row & places[c]
        row = ((row + hit) | (row - hit)) & ones
    return len(a) - row.bit_count()


def test_likeness_of_all_supplied_documents_lies_between_ends_and_common_subsequence(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    order = sorted(texts)
    got = {r["doc_id"]: r for r in fingerprints.neighbour_fingerprints(docs).collect()}
    assert sorted(got) == order
    for i, after in zip(order, order[1:] + order[:1]):
        t, other = texts[i], texts[after]
        half = len(t) // 2
        for near, ends, new in (("near_edited", "ends_edited", t[: len(t) - half] + other[:half]), ("near_next", "ends_next", other)):
            longer = max(len(t), len(new))
            assert got[i][ends] == pytest.approx(likeness(t, new))
            assert got[i][ends] <= got[i][near] <= common_subsequence(t, new) / longer + 1e-12 if longer else got[i][near] == 1

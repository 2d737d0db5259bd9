"""Private data, mixing, resampling, joins, top-k and chats against brute force and SQL."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import regex
from helpers import frame, odd_rows
from oracle_harness import compare, duck

from ledgerlens.llm import chat, components, mixing, ngram_join, privacy, quality, queries, topk

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), duck(SF), queries.SQL[name])["values_match"]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            bad = {
                "email": False,
                "ip": any(int(x) > 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": not (13 <= len(digits) <= 19 and luhn(digits)),
                "phone": not 9 <= len(digits) <= 15,
            }[kind]
            if not bad:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_against_brute_force(spark):
    rng = random.Random(3)
    parts = ["a@b.c", "@", ".", "-", " ", "é", "😀", "1.2.3.4", "255", "4111111111111111", "4111 1111-1111 1111", "+1 (499) 555-6503", "+", "0", "9", "_", "x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)] + [None, "1" * 5000, "+1" + "(" * 5000]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in privacy.find(frame(spark, rows)).collect()}
    for i, t, *_ in rows:
        want = base(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [s for s in got[i]["spans"].split(",") if s and not s.startswith("term")] == want
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k) for s in want) for k in PATTERNS]


def test_long_runs_are_searched_in_linear_time(spark):
    texts = ["a" * 300_000, "1" * 300_000, "a." * 100_000 + "@", "1 " * 100_000]
    got = privacy.find(frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()
    assert all(r["spans"] == "" for r in got)


def test_disclosing_terms_are_added_and_taken_out(spark):
    # "zorblax" stands near one address only; "the" stands everywhere
    rows = [(i, f"the note of zorblax the man boss@corp.example the end {i}", None, None) for i in range(5)]
    rows += [(10 + i, f"the note about somebody else the end {i}", None, None) for i in range(20)]
    docs = frame(spark, rows)
    found = {r["doc_id"]: r for r in privacy.find(docs).collect()}
    at = rows[0][1].index("zorblax")
    assert f"term:{at}:{at + 7}" in found[0]["spans"] and found[0]["n_term"] >= 1
    the = rows[0][1].index("the", 5)
    assert f"term:{the}:{the + 3}" not in found[0]["spans"]
    assert all(found[10 + i]["spans"] == "" for i in range(20))
    clean = privacy.sanitise(docs)
    assert clean.columns == docs.columns
    out = {r["doc_id"]: r for r in clean.collect()}
    assert "zorblax" not in out[0]["text"] and "[EMAIL]" in out[0]["text"] and out[0]["n_chars"] == len(out[0]["text"])
    assert out[12]["text"] == rows[7][1] and out[12]["row"] == "x"


def test_terms_disclose_past_neighbours_and_far_from_the_mention(spark):
    far = " ".join(["the"] * 60)
    texts = [f"Zorblax, z@x.org, +1 499 555 6503 {far} Quuxan and zorblax {i}" for i in range(4)]
    # the far term alone, without the mention near it, and an entity of too few documents
    texts += [f"card 4111 1111 1111 1111 the {far} rareterm"] + [f"the {far} z{i}" for i in range(20)]
    # one term stands beside the phone only, with the e-mail's span between
    texts += [f"Phonix, y{i}@x.org, +1 499 555 6504 the" for i in range(3)]
    docs = frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    found = {r["doc_id"]: r for r in privacy.find(docs).collect()}
    for i, t in enumerate(texts):
        want = {m.span() for m in re.finditer("[Zz]orblax|Quuxan|Phonix|\\band\\b", t)}
        assert {tuple(map(int, s.split(":")[1:])) for s in found[i]["spans"].split(",") if s.startswith("term")} == want, t
    out = {r["doc_id"]: r["text"] for r in privacy.sanitise(docs).collect()}
    assert out[0] == f", [EMAIL], [PHONE] {far}    0" and out[25] == ", [EMAIL], [PHONE] the" and out[4].endswith("rareterm")


def test_terms_are_generalised_to_their_class(spark):
    rows = [(i, f"Zorblax of NATO runs q7x and sells boxes to z@x.org {i}", None, None) for i in range(4)] + [(10 + i, f"of runs and sells to {i}", None, None) for i in range(20)]
    out = {r["doc_id"]: r["text"] for r in privacy.sanitise(frame(spark, rows), remove_at=2.0).collect()}
    assert out[0] == "[NAME] of [ACRONYM] runs [CODE] and sells [WORD] to [EMAIL] 0" and out[10] == rows[4][1]


def test_private_data_of_odd_documents(spark):
    docs = frame(spark, odd_rows())
    assert privacy.find(docs).count() == len(odd_rows())
    clean = privacy.sanitise(docs)
    assert Counter(map(str, clean.collect())) == Counter(map(str, docs.collect()))
    assert privacy.find(frame(spark, [])).count() == 0 and privacy.sanitise(frame(spark, [])).count() == 0


def water(sizes, weights, share, cap):
    """Reference filling by rounds."""
    left, free, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        level = left / sum(weights[i] for i in free)
        over = {i for i in free if level * weights[i] >= cap * sizes[i]}
        if not over:
            for i in free:
                out[i] = level * weights[i]
            break
        for i in over:
            out[i] = cap * sizes[i]
            left -= out[i]
        free -= over
    return out


def test_targets_are_those_of_water_filling(spark):
    rng = random.Random(2)
    for n in (1, 2, 3, 9):
        sizes = [rng.choice([0, 1, 10, 1000]) * rng.randint(1, 9) for _ in range(n)]
        sized = spark.createDataFrame([(f"={i:02}", f"{i:02}", s) for i, s in enumerate(sizes)], "key string, source string, size long")
        got = {r["key"]: r["target"] for r in mixing.targets(sized).collect()}
        want = water(sizes, [(5, 2, 1)[i % 3] for i in range(n)], 1.5, 2)
        assert [got[f"={i:02}"] for i in range(n)] == pytest.approx(want)


def test_mixture_meets_its_targets(spark):
    docs = frame(spark, odd_rows())
    rows = mixing.shares(docs).collect()
    assert len(rows) == len(odd_rows())
    words = Counter()
    for _, t, _, s in odd_rows():
        words[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["source_size"] for r in rows} == set(words.values())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.shares(docs).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in mixed.collect()) == sum(r["taken"] for r in rows)
    assert mixing.shares(frame(spark, [])).count() == 0 and mixing.mix(frame(spark, [])).count() == 0


def test_sources_come_near_their_targets(spark):
    rows = mixing.shares(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    for (_, target), part in rows.groupby(["source_size", "target"]):
        assert abs(part.taken.sum() - target) <= min(0.03 * target, part["size"].max())


def test_a_very_long_document_at_the_stop_leaves_no_gap(spark):
    sizes = [1000, *[5] * 2000]
    docs = frame(spark, [(i, " ".join(["w"] * n), "en", s) for s in "abc" for i, n in enumerate(sizes)])
    for seed in "12":
        rows = mixing.shares(docs, seed=seed).toPandas()
        for target, part in rows.groupby("target"):
            # the long document is passed over where it would exceed the rest
            assert abs(part.taken.sum() - target) <= 5
            assert (part.taken <= 2 * part["size"]).all()


def test_kth_largest(spark):
    values = [5, -3, 2**40, 7, 7, -(2**50), 0]
    df = spark.createDataFrame([(v,) for v in values], "k long")
    for k, v in enumerate(sorted(values, reverse=True), 1):
        assert quality.kth_largest(df, "k", k) == v
    assert quality.kth_largest(df, "k", 8) is None


def test_resampling_keeps_good_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality.resample(docs, labels)
    seen = out.join(labels, "doc_id").toPandas()
    assert out.count() == docs.count()
    assert seen[(seen.quality == 1) & (seen.toxic == 0)].selected.mean() > 0.85
    assert seen[seen.quality == 0].selected.mean() < 0.1
    assert sorted(map(str, out.collect())) == sorted(map(str, quality.resample(docs, labels).collect()))


def test_resampling_odd_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (None, 1, None), (3, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        out = quality.resample(frame(spark, odd_rows()), labels).collect()
        assert len(out) == len(odd_rows())
        assert all(r["log_weight"] == 0 for r in out if r["doc_id"] in (100, 101))
    assert all(r["selected"] and r["log_weight"] == 0 for r in quality.resample(frame(spark, odd_rows()), none).collect())
    assert quality.resample(frame(spark, []), some).count() == 0


def test_banding_reaches_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.99), (0.9, 0.999)):
        bands, rows = ngram_join.banding(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= ngram_join.MAX_HASHES


def classes_of(rows):
    """Class ids and link counts by all pairs."""
    sets = []
    for _, t, *_ in rows:
        w = regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else t or "")
    distinct = list(dict.fromkeys(sets))
    top = {s: s for s in distinct}

    def find(s):
        while top[s] is not s:
            s = top[s]
        return s

    links = Counter()
    for a, b in itertools.combinations(distinct, 2):
        if isinstance(a, frozenset) and isinstance(b, frozenset) and 5 * len(a & b) >= 4 * len(a | b):
            links[a] += 1
            links[b] += 1
            top[find(a)] = find(b)
    first = {}
    for (i, *_), s in zip(rows, sets):
        r = find(s)
        first[r] = min([x for x in (first.get(r), i) if x is not None], default=None)
    out = Counter((i, first[find(s)], links[s], sets.count(s)) for (i, *_), s in zip(rows, sets))
    return out, Counter(first.values())


def test_join_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)  # groups of several blocks
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, n = [], itertools.count(1000)
    for copies, edits in ((30, 1), (12, 3), (5, 8), (2, 2), (1, 0)):
        text = [word() for _ in range(80)]
        for _ in range(copies):
            new = list(text)
            for _ in range(rng.randint(0, edits)):
                new[rng.randrange(80)] = word()
            rows.append((next(n), " ".join(new), None, None))
    rows += [(1500 + i, f"{word()} {word()}", None, None) for i in range(3)] + odd_rows()
    docs = frame(spark, rows)
    got = Counter((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in ngram_join.similar(docs).collect())
    want, heads = classes_of(rows)
    assert got == want
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == heads


def test_pairs_of_a_crowded_bucket_are_found(spark, monkeypatch):
    # one bucket: its leaders (1 and 99) are like no other member, three pairs in the middle are alike
    rng = np.random.default_rng(2)
    marks = {n: rng.integers(0, 256, 186, np.uint8).tobytes() for n in (1, 10, 20, 30, 99)}
    rows = [(n, [7], marks[n]) for n in (1, 99)] + [(n + k, [7], marks[n]) for n in (10, 20, 30) for k in range(2)]
    signed = spark.createDataFrame(rows, "node long, bands array<long>, bytes binary")
    for crowd in (1000, 2):  # one block, several
        monkeypatch.setattr(ngram_join, "CROWD", crowd)
        got = {r["node"]: r["label"] for r in ngram_join.candidates(signed, 186, 0.8).collect()}
        assert got == {10: 10, 11: 10, 20: 20, 21: 20, 30: 30, 31: 30}


@pytest.mark.parametrize("words", [ngram_join.WORDS, 1])
def test_only_texts_of_candidate_groups_are_shuffled(spark, monkeypatch, words):
    # 400 texts of one group each and five near copies, with more copies of two of these; one word of 64 bits lets others pass
    monkeypatch.setattr(ngram_join, "WORDS", words)
    rng = random.Random(11)
    text = lambda: [f"{rng.getrandbits(40):x}" for _ in range(60)]
    near = text()
    alike = [" ".join([*near[:k], "other", *near[k + 1 :]]) for k in (0, 1, 58, 59)] + [" ".join(near)]
    rows = [(i, " ".join(text()), None, None) for i in range(400)] + [(1000 + i, t, None, None) for i, t in enumerate([*alike, *alike[:2]])]
    docs, plans, store = frame(spark, rows), {}, ngram_join.stored

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(ngram_join, "stored", seen)
    got = Counter((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in ngram_join.similar(docs).collect())
    assert got == classes_of(rows)[0]
    # whole texts are filtered in place before anything deals them out
    assert "Join LeftSemi" in plans["ngram_grams"].partition("Aggregate [digest")[2]
    digests = [(hashlib.md5(r[1].encode()).hexdigest(), r[1]) for r in rows]
    member = spark.createDataFrame([(d,) for d, t in digests if t in alike], "digest string")
    passed = Counter(r["t"] for r in ngram_join.likely_members(spark.createDataFrame(digests, "digest string, t string"), member).collect())
    assert all(passed[t] == sum(t == r[1] for r in rows) for t in alike)
    assert len(passed) - len(alike) < (5 if words > 1 else 120)


def test_intersections_from_differences():
    # near copies of the base, sets that share little or nothing with it, the base itself
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    far = [np.unique(rng.integers(0, 1 << 63, 40 * k).astype(np.uint64)) for k in (1, 4, 9)]
    near = [np.union1d(np.delete(base, rng.choice(len(base), k, replace=False)), far[0][:k]) for k in (0, 1, 20, 35)]
    sets = [base, *near, *far, np.union1d(far[2], base[:50]), np.union1d(far[1], base[:250]), base[:2]]
    like, dot, more, less = zip(*(ngram_join.difference(s, base) for s in sets))
    assert 0 < sum(like) < len(sets)
    assert sum(map(len, more)) + sum(map(len, less)) < sum(map(len, sets))
    for columns in (4096, 7):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(ngram_join, "COLUMNS", columns)
            common = ngram_join.shared_within(np.array(like), np.array(dot, float), len(base), list(more), list(less))
        for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2):
            assert common[i, j] == common[j, i] == len(np.intersect1d(a, b))


def test_join_of_no_documents(spark):
    assert ngram_join.similar(frame(spark, [])).count() == 0 and ngram_join.keep_one(frame(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40) if i not in (7, 20)] + [(50, 50)]
    got = {r["node"]: r["label"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 if i <= 7 else 8 if i <= 20 else 21 for i in range(41)}


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, (rng.integers(-3, 4, 6) / 8).tolist()) for i in range(300)]
    vectors += [(300, None), (301, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [9.0] * 6), (40, vectors[40][1]), (304, [1.0, 2.0])]
    vectors += [(400 + i, [0.5] * 6) for i in range(60)]  # ties
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = Counter(map(tuple, topk.top_k(df, k=20, every=20).select("query_id", "rank", "vec_id", "score").collect()))
    fine = [(i, np.floor(np.array(v) * 64).astype(int)) for i, v in vectors if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = Counter()
    for q in sorted({i for i, _ in fine if i % 20 == 0}):
        mine = min((v.tolist() for i, v in fine if i == q))
        scored = sorted((-int(v @ np.array(mine)), i) for i, v in fine if i != q and len(v) == len(mine))[:20]
        for rank, (s, i) in enumerate(scored, 1):
            want[q, rank, i, -s] += 1
    assert got == want
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_snapshots_collapse(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "bot", "hello")]
    turns += [(2, 0, "user", "hi"), (2, 1, "bot", "hello"), (2, 2, "user", "bye")]
    turns += [(3, 5, "user", "hi"), (3, 6, "bot", "hello"), (3, 9, "user", "bye")]  # equal to 2
    turns += [(4, 0, "user", "hi"), (4, 1, "bot", "hello!")]
    turns += [(5, 0, "user", None), (6, 0, "user", ""), (7, None, None, "x"), (7, 0, "user", "first"), (None, 0, "user", "no id")]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, conv string")
    got = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert set(got) == {2, 4, 5, 6, 7, None} and got[2]["n_equal"] == 2 and got[2]["n_turns"] == 3
    assert got[2]["text"] == "<|user|>\nhi<|end|>\n<|bot|>\nhello<|end|>\n<|user|>\nbye<|end|>\n"
    assert got[7]["text"] == "<|user|>\nfirst<|end|>\n<||>\nx<|end|>\n"
    assert chat.format_chats(df.where("false")).count() == 0

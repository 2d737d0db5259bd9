"""Language samples of whole texts, exact large scores, and disclosing terms of the supplied documents."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import frame
from oracle_harness import duck
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlens.llm import language, privacy, topk

SF = "/root/testdata/sf0.001"


# --- language


def test_shares_fill_the_budget():
    assert language.shares([5, 5, 5], 100) >= 5
    assert language.shares([10, 1000, 1000], 210) == 100
    assert language.shares([], 10) == 0


def test_learning_reads_past_the_start_of_a_text(spark):
    # every text starts alike for longer than a slice; only what follows tells the language
    rng, start = random.Random(1), "abc " * 2000
    words = {"x": ["tuvi", "tuvo", "vitu"], "y": ["krel", "lerk", "kerl"]}
    rows = [(i, start + " ".join(rng.choice(words[k]) for _ in range(4000)), k, "a") for i in range(40) for k in ("xy"[i % 2],)]
    model = language.learn(frame(spark, rows))
    names, score = model.predict(["tuvi vitu tuvo", "kerl krel"])
    assert names == ["x", "y"] and (score > 0.3).all()


def test_letters_of_large_alphabets_have_codes_of_their_own():
    rng = random.Random(2)
    han = [chr(0x4E00 + k) for k in range(900)]
    # the same letters in another order
    pairs = {"x": list(zip(han[::2], han[1::2])), "y": list(zip(han[1::2], han[::2]))}
    text = {k: ["".join("".join(rng.choice(v)) for _ in range(3000)) for _ in range(2)] for k, v in pairs.items()}
    model = language.Model({k: v[:1] for k, v in text.items()})
    assert model.width == 2 + language.TABLE_LETTERS and len(model.rare_keys) > 0 and len(set(model.codes[[ord(c) for c in han]])) == 900
    names, _ = model.predict([text["x"][1], text["y"][1]])
    assert names == ["x", "y"]
    # phrases by brute force, all letters
    for j, name in enumerate(model.languages):
        joined = text[name][0]
        for t in (text["x"][1][:400], text["y"][1][:400]):
            count, at, size = 0, 0, 0
            while at + size < len(t):
                if t[at : at + size + 1] in joined:
                    size += 1
                else:
                    count, at, size = count + 1, at + max(size, 1), 0
            assert abs(model.phrases([t])[0][0, j] - count) <= 1


# --- top-k


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x") for i, v in rows], "vec_id long, embedding array<double>, score string, r string")


def test_large_components_are_not_clamped(spark):
    rows = [(0, [3.0e6, 1.0]), (1, [2.5e6, 0.0]), (2, [4.0e6, 0.0]), (3, [-4.0e6, 7.0])]
    got = [(r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(vectors(spark, rows)).orderBy("rank").collect()]
    assert got == [(1, 2, 49152000000000000), (2, 1, 30720000000000000), (3, 3, 192000000 * -256000000 + 64 * 448)]


def test_scores_near_the_limit_are_exact(spark):
    big = float(1 << 50)
    rows = [(0, [big, 1.0, -1.0]), (1, [1.0, 0.0, 2.0]), (2, [1.0, 0.015625, 2.0]), (3, [-1.0, 5.0, 0.0]), (4, [0.5, big / 64, 3.0])]
    got = {r["vec_id"]: (r["rank"], r["score"]) for r in topk.top_k(vectors(spark, rows)).collect()}
    q = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    want = sorted((-sum(a * b for a, b in zip(q[0], q[i])), i) for i in (1, 2, 3, 4))
    assert got == {i: (k, -s) for k, (s, i) in enumerate(want, 1)}


def test_scores_beyond_64_bits_are_errors(spark):
    for rows in ([(0, [2.0**40]), (1, [2.0**40])], [(0, [1.0]), (1, [2.0**60])]):
        with pytest.raises(PySparkException):
            topk.top_k(vectors(spark, rows)).collect()


def test_several_groups_of_rows_and_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP", 70)
    rng = np.random.default_rng(3)
    data = [(i, (rng.integers(-9, 10, 5) / 4).tolist()) for i in range(400)]
    got = Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(vectors(spark, data)).collect())
    v = {i: np.floor(np.array(x) * 64).astype(int) for i, x in data}
    want = Counter()
    for q in range(0, 400, 20):
        for rank, (s, i) in enumerate(sorted((-int(v[i] @ v[q]), i) for i in v if i != q)[:20], 1):
            want[q, rank, i, -s] += 1
    assert got == want


# --- disclosing terms


def entities(text):
    out, spans = set(), []
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}",
        "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and (not 13 <= len(digits) <= 19 or doubled % 10) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append(m.span())
            value, wider = {"email": (m[0].lower(), m[0].lower().split("@")[-1]), "ip": (m[0], m[0].rpartition(".")[0]), "card": (digits, digits[:6]), "phone": (digits, digits[:5])}[kind]
            out |= {(kind, 0, value), (kind, 1, wider)}
    for a, b in spans:
        text = text[:a] + " " * (b - a) + text[b:]
    return out, text


def brute_terms(docs):
    """Marked places of each document, by PMI / IC over all pairs of entity and term."""
    told, rest, have, mention = {}, {}, defaultdict(set), defaultdict(set)
    term = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
    for i, t in docs.items():
        found, rest[i] = entities(t or "")
        for e in found:
            mention[e].add(i)
        for m in term.finditer(rest[i]):
            if re.search(r"[^\W\d_]", m[0]):
                have[m[0].lower()].add(i)
    n = len(docs)

    def part(o, e):
        return o * math.log(o / e) if o > 0 else 0.0

    for e, with_e in mention.items():
        for t in {t for t in have if have[t] & with_e}:
            k, a, b = len(have[t] & with_e), len(with_e), len(have[t])
            ic = math.log(n / a)
            ratio = math.log(k * n / ((b + 0.25) * a)) / ic if ic else 0.0
            g2 = 2 * (part(k, a * b / n) + part(a - k, a * (n - b) / n) + part(b - k, (n - a) * b / n) + part(n - a - b + k, (n - a) * (n - b) / n))
            if ratio >= 0.8 and g2 >= 10.83:
                for i in with_e & have[t]:
                    told.setdefault(i, set()).add(t)
    return {i: sorted(m.span() for m in term.finditer(rest[i]) if m[0].lower() in told[i]) for i in told}


def test_terms_of_the_supplied_documents_against_brute_force(spark):
    docs = dict(duck(SF).execute("SELECT doc_id, text FROM documents").fetchall())
    want = brute_terms(docs)
    got = {}
    for r in privacy.find(spark.read.parquet(f"{SF}/documents.parquet")).collect():
        places = [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("term:")]
        assert len(places) == r["n_term"]
        if places:
            got[r["doc_id"]] = places
    assert got == want and sum(map(len, want.values())) > 1000


def test_many_spans_and_terms_of_one_text_are_no_product(spark):
    rng = random.Random(4)
    log = " ".join(f"user{i}@host{i}.org w{i}x" for i in range(4000))
    numbers = ",".join(str(rng.randint(10, 10**6)) for _ in range(60_000))
    rows = [(1, log, "en", "a"), (2, numbers, "en", "a"), *((10 + i, f"plain words {i}", "en", "a") for i in range(600))]
    found = {r["doc_id"]: r for r in privacy.find(frame(spark, rows)).collect()}
    assert found[1]["n_email"] == 4000 and found[1]["n_term"] == 4000
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(frame(spark, rows)).collect()}
    assert clean[1] == " ".join("[EMAIL] " for _ in range(4000)) and clean[10] == "plain words 0"


def test_long_vectors_fill_several_blocks(spark):
    dims, n = 8192, 2500
    assert topk.block_rows(64) == 1 << 16 and topk.block_rows(dims) == 1024
    x = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: (F.pmod(F.hash("vec_id", i), F.lit(9)) - 4) / 64)
    data = spark.range(n).withColumnRenamed("id", "vec_id").withColumn("embedding", F.when(F.col("vec_id") % 500 < 499, x).otherwise(F.slice(x, 1, 3)))
    found = topk.top_k(data, k=3, every=250)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found.collect()}
    whole = {r["vec_id"]: np.array(r["embedding"]) * 64 for r in data.where("size(embedding) = 8192").toLocalIterator()}
    ids = np.array(sorted(whole))
    matrix = np.stack([whole[i] for i in ids])
    want = {}
    for q in range(0, n, 250):
        scores = matrix @ whole[q]
        best = sorted((-int(s), int(i)) for s, i in zip(scores, ids) if i != q)[:3]
        want |= {(q, rank): (i, -s) for rank, (s, i) in enumerate(best, 1)}
    assert got == want

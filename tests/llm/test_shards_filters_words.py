"""Hilbert sharding, the filter audit and spelling variants against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import frame, odd_rows

from ledgerlens.llm import filter_audit, hilbert, spelling
from ledgerlens.session import scratch_path

CLASHES = "shard slot curve pos sum part mask word form root n crc c0 d0 step kept role sig"


def clashing(spark, rows):
    df = frame(spark, rows)
    return df.selectExpr("*", *(f"'x' AS `{c}`" for c in CLASHES.split() if c not in df.columns))


# --- sharding


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_steps_to_a_neighbour(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = hilbert.curve_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all() and not path[0].any()


def sizes(rows):
    return {i: len((t or "").encode()) + 1 for i, t, *_ in rows}


@pytest.mark.parametrize("law", hilbert.LAWS)
def test_shards_of_odd_rows(spark, law):
    rows = odd_rows()
    got = hilbert.assign(clashing(spark, rows), law=law).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert {(r["law"], r["grown_shard"]) for r in got} == {(law, None)}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in order] == sorted(r["curve"] for r in got)
    if law == "rows":
        counts = [len(slots[k]) for k in range(16)]
        assert max(counts) - min(counts) <= 1
    else:
        share, load = sum(r["size"] for r in got) / 16, Counter()
        for r in got:
            load[r["shard"]] += r["size"]
        assert all(load[k] <= share + max(r["size"] for r in got) for k in range(16))


def test_sizes_are_near_equal_by_bytes(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(0, 400), rng.choice(["en", "fr", None]), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    load = Counter()
    for r in hilbert.assign(frame(spark, rows), law="bytes", shards=5).collect():
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) <= 2 * 401


def test_a_hot_cell_and_equal_rows_are_split(spark):
    rows = [(1, "same text", "en", "a")] * 500 + [(i, "same text", "en", "a") for i in range(500)]
    got = hilbert.assign(frame(spark, rows)).collect()
    assert set(Counter(r["shard"] for r in got).values()) == {62, 63}
    assert len({(r["shard"], r["slot"]) for r in got}) == 1000


def test_files_are_pruned_in_every_dimension(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 300), rng.choice("abcdefgh"), f"s{rng.randint(10, 29)}") for i in range(2000)]
    docs = clashing(spark, rows)
    table = hilbert.write(docs, scratch_path(spark, f"hilbert_test_{random.random()}"))
    assert table.columns[: len(docs.columns)] == docs.columns and table.drop("_shard", "_slot").exceptAll(docs).count() == 0 == docs.exceptAll(table.drop("_shard", "_slot")).count()
    spans = hilbert.ranges(table, ("source", "lang"), "_shard").collect()
    assert sum(r["rows"] for r in spans) == 2000
    for column, values in (("source", {r[3] for r in rows}), ("lang", {r[2] for r in rows})):
        read = [sum(r[f"min_{column}"] <= v <= r[f"max_{column}"] for r in spans) for v in values]
        assert sum(read) / len(read) <= 9  # of 16; all of them in any other order


def test_shards_of_an_empty_table(spark):
    assert hilbert.assign(frame(spark, [])).count() == 0 and hilbert.assign(frame(spark, []), law="bytes").count() == 0


# --- filters


def brute_audit(rows, labels):
    good, bad = ({i for i, q, t in labels if (q, t)[k] == 1} for k in (0, 1))
    smallest = {}
    for i, t, *_ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    docs = defaultdict(list)
    for i, t, _, source in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > smallest[t],
        }
        docs[source or ""].append((frozenset(k for k in fails if fails[k]), i in good, i in bad))
    out = {}
    for part, mine in docs.items():
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in alive if f in d[0]]
                alive = [d for d in alive if f not in d[0]]
                shapley[f] += len(gone)
                fails = sum(f in d[0] for d in mine)
                out[part, order, step] = [len(alive), len(gone), fails - len(gone), sum(d[0] == {f} for d in mine), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS mask", "'x' AS n")


def test_audit_against_brute_force(spark):
    rng = random.Random(7)
    many = " ".join(f"w{k}" for k in range(250))
    texts = [many, many + " #", "word " * 260, "SHOUT " * 210, "short", many.upper(), many.upper() + " $ %", None, ""]
    rows = [(rng.randint(0, 150), rng.choice(texts), "en", rng.choice(["a", "b", "", None])) for _ in range(200)] + odd_rows()
    rows += [(1000 + k, many, "en", "hot") for k in range(100)] + [(None, many, "en", "hot")] * 2
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(150) for _ in range(rng.choice([1, 1, 2]))]
    got = filter_audit.audit(filter_audit.cells(clashing(spark, rows), labelled(spark, labels))).collect()
    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in got} == brute_audit(rows, labels)


def test_walk_has_the_survivors_of_every_subset():
    rng = np.random.default_rng(8)
    masks, counts = np.arange(16), rng.integers(0, 9, (16, 2))
    states = filter_audit.walk(masks, counts, 4)
    assert all((states[s] == counts[masks & s == 0].sum(axis=0)).all() for s in range(16))


def test_survivors_agree_with_the_audit(spark):
    cells = filter_audit.cells(frame(spark, odd_rows()), labelled(spark, [(1, 1, 0), (2, 0, 1)]))
    states = {(r["part"], r["subset"]): r["kept"] for r in filter_audit.survivors(cells, 5).collect()}
    last = {r["part"]: r["kept"] for r in filter_audit.audit(cells).where("step = 5").collect()}
    assert all(states[p, 31] == k for p, k in last.items())


def test_audit_of_empty_tables(spark):
    assert filter_audit.audit(filter_audit.cells(frame(spark, []), labelled(spark, [(1, 1, 1)]))).count() == 0
    one = filter_audit.audit(filter_audit.cells(frame(spark, [(1, "a", "en", "s")]), labelled(spark, [])))
    assert one.count() == 600


# --- words


def brute_words(rows):
    counts = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    close = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and near(w, v)] for w in counts}
    form = {}
    for w, found in close.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(close[w]), counts[form[w]] if form[w] else None) for w in counts}


def spelled(rng, n):
    """Texts of words of few letters, many of them one edit apart, with counts that differ by factors."""
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(25)]
    out = []
    for w in base:
        for times in (200, 30, 5):
            out += [w] * times
            k, c = rng.randrange(len(w)), rng.choice("abÀ")
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
    rng.shuffle(out)
    return [(i, " ".join(out[i::n]).title() if i % 2 else ", ".join(out[i::n]), "en", "a") for i in range(n)]


@pytest.mark.parametrize("crowd", [spelling.CROWD, 2])
def test_variants_against_brute_force(spark, crowd):
    rows = spelled(random.Random(9), 60) + odd_rows() * 2 + [(None, "straßen " * 40 + "strassen " * 6 + "strasen " * 6, None, None)]
    got = spelling.variants(clashing(spark, rows), crowd=crowd).collect()
    want = brute_words(rows)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want
    assert len(got) == len(want) and sum(v[0] is not None for v in want.values()) > 20 and any(v[1] not in (w, v[0]) for w, v in want.items())


def test_every_edit_shares_a_signature():
    rng = random.Random(10)
    for _ in range(3000):
        w = "".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 12)))
        k, c = rng.randrange(len(w)), rng.choice("abcdeéz")
        for v in (w[:k] + c + w[k + 1 :], w[:k] + c + w[k:]):
            if v != w:
                mine, other = list(spelling.signatures(w)), list(spelling.signatures(v))
                roles = (spelling.ALIKE, spelling.ALIKE) if len(v) == len(w) else (spelling.SHORTER, spelling.LONGER)
                assert {s for r, s in mine if r == roles[0]} & {s for r, s in other if r == roles[1]}, (w, v)


def test_long_texts_and_empty_tables_of_words(spark):
    rows = [(1, "a" * 200_000 + " " + "letters " * 50_000, "en", "a"), (2, None, None, None), (3, "", "en", "a")]
    got = {r["word"]: r["n"] for r in spelling.variants(frame(spark, rows)).collect()}
    assert got == {w: v[2] for w, v in brute_words(rows).items()}
    assert spelling.variants(frame(spark, [])).count() == 0

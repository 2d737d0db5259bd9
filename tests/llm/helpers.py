"""Small fixtures for the operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, id string, t string, u long, digest string, label string, spans string, added string, target string, size string, stop string"


def frame(spark, rows):
    """Documents (doc_id, text, lang, source) with extra columns whose names the operators use themselves."""
    full = [(i, t, lang, s, None if t is None else len(t), "x", "x", "x", "x", 1, "x", "x", "x", "x", "x", "x", "x") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "été", "straße", "漢字", "it's", "don't", "42", "!!", "😀"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30))), rng.choice(["en", "fr"]), rng.choice(["a", "b", "c", None])) for i in range(40)]
    rows += [(100, None, "en", "a"), (101, "", None, "b"), (None, "no id here", "en", None), (102, "word " * 30_000, "fr", "a"), (103, "  \n\t ", "en", "c")]
    return [*rows, rows[3], rows[3], (3, "another text under the same id", "fr", "b")]

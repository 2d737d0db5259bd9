"""The corpus pipeline on a small table."""

import re
import zlib

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from helpers import frame, odd_rows  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], SF).cache())
        assert steps[-1].columns == columns
    start, told, single, private, mixed = steps
    assert told.count() <= start.count() and single.count() <= told.count() == told.select("doc_id").distinct().count()
    assert private.count() == single.count()
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    assert not any(re.search(email, r["text"]) for r in private.collect())
    words = private.selectExpr(r"sum(size(regexp_extract_all(text, '\\S+', 0))) n").first()["n"]
    assert abs(mixed.selectExpr(r"sum(size(regexp_extract_all(text, '\\S+', 0))) n").first()["n"] / words - 1.5) < 0.2
    packed = corpus_pipeline.STAGES[-1][1](spark, mixed, SF)
    assert packed.where("piece = 0").count() == mixed.count()


def test_ties_are_not_identified(spark):
    rows = [(i, ("the cat sat on the mat", "le chat est sur la table")[i % 2], ("en", "fr")[i % 2], "a") for i in range(40)]
    rows += [(100, "кошка сидит", "en", "a"), (101, "猫", "fr", "a")]
    # the held-out ones are not learned from
    rows = [r for r in rows if r[0] < 100 or zlib.crc32(str(r[0]).encode()) % 5 == 0] + [(i, "кошка", None, "a") for i in range(200, 203)]
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, frame(spark, rows), "").collect()}
    assert kept == set(range(40))


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0


def test_stages_take_odd_and_empty_tables(spark):
    for rows in (odd_rows(), []):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
        assert docs.columns == frame(spark, rows).columns
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0) == bool(rows)

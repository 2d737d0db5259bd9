"""Incremental CSV ingest (Structured Streaming, availableNow): only new drops are loaded."""

import gzip
import os

from ledgerlens import schema as S
from ledgerlens.sources import files
from ledgerlens.streaming import ingest

HDR = ",".join(f.name for f in S.RAW_CSV.fields)


def _drop(path, rows):
    with open(path, "w") as fh:
        fh.write(HDR + "\n")
        for oid, amt in rows:
            fh.write(f"{oid},n,e,p,prod,Fashion,10.00,1,0,0,{amt},UPI,North,Delhi,2024-01-02,Delivered,s\n")


def test_two_runs_pick_up_only_new_files(spark, tmp_path):
    src, table, ckpt = tmp_path / "drops", str(tmp_path / "raw"), str(tmp_path / "ckpt")
    src.mkdir()
    _drop(src / "a.csv", [("O1", "5.00"), ("O2", "bad")])
    ingest.start_ingest(spark, str(src), table, ckpt).awaitTermination()
    assert ingest.read_ingested(spark, table).count() == 2
    _drop(src / "b.csv", [("O3", "7.50")])
    ingest.start_ingest(spark, str(src), table, ckpt).awaitTermination()
    rows = {r.order_id: r for r in ingest.read_ingested(spark, table).collect()}
    assert set(rows) == {"O1", "O2", "O3"}
    assert rows["O2"].total_amount is None  # coerced like the batch reader
    assert rows["O3"].load_seq > rows["O1"].load_seq  # arrival order spans batches


def test_replayed_batch_replaces_its_own_output(spark, tmp_path):
    # a micro-batch re-run after a failure must not append duplicates
    src = tmp_path / "drops"
    src.mkdir()
    _drop(src / "a.csv", [("O1", "5.00"), ("O2", "6.00")])
    batch = spark.read.format("binaryFile").load(str(src)).select("path")
    table = str(tmp_path / "raw")
    write = ingest._write_batch(table)
    write(batch, 0)
    write(batch, 0)  # replay of batch 0
    assert ingest.read_ingested(spark, table).count() == 2


def test_columns_are_bound_by_each_files_header(spark, tmp_path):
    src, table = tmp_path / "drops", str(tmp_path / "raw")
    src.mkdir()
    _drop(src / "a.csv", [("O1", "5.00")])
    names = HDR.split(",")
    values = dict(zip(names, "O2,n,e,p,prod,Fashion,10.00,1,0,0,6.00,UPI,South,Pune,2024-01-02,Delivered,s".split(",")))
    swapped = [{"city": "region", "region": "city"}.get(n, n) for n in names]
    (src / "b.csv").write_text(",".join(swapped) + "\n" + ",".join(values[n] for n in swapped) + "\n")
    ingest.start_ingest(spark, str(src), table, str(tmp_path / "ckpt")).awaitTermination()
    rows = {r.order_id: (r.region, r.city) for r in ingest.read_ingested(spark, table).collect()}
    assert rows == {"O1": ("North", "Delhi"), "O2": ("South", "Pune")}


def test_an_older_small_file_comes_first(spark, tmp_path):
    src, table = tmp_path / "drops", str(tmp_path / "raw")
    src.mkdir()
    _drop(src / "z_old.csv", [("OLD", "1.00")])
    _drop(src / "a_new.csv", [(f"N{i}", "2.00") for i in range(3000)])
    os.utime(src / "z_old.csv", (1_000_000, 1_000_000))
    os.utime(src / "a_new.csv", (2_000_000, 2_000_000))
    ingest.start_ingest(spark, str(src), table, str(tmp_path / "ckpt")).awaitTermination()
    got = {r.order_id: r.load_seq for r in ingest.read_ingested(spark, table).collect()}
    assert len(set(got.values())) == 3001 and got["OLD"] == min(got.values())
    assert [got[f"N{i}"] for i in range(3000)] == sorted(got[f"N{i}"] for i in range(3000))


def test_stream_and_batch_number_the_same_files_alike(spark, tmp_path):
    src, table = tmp_path / "drops", str(tmp_path / "raw")
    src.mkdir()
    for k in range(3):
        _drop(src / f"{k}.csv", [(f"O{k}-{i}", "3.00") for i in range(50)])
    ingest.start_ingest(spark, str(src), table, str(tmp_path / "ckpt")).awaitTermination()
    streamed = {r.order_id: r.load_seq for r in ingest.read_ingested(spark, table).collect()}
    assert streamed == {r.order_id: r.load_seq for r in files.read_raw_csv(spark, str(src)).collect()}


def test_compressed_files_are_loaded_alike_one_a_task(spark, tmp_path):
    got = {}
    for kind in ("plain", "gz"):
        src, table = tmp_path / kind, str(tmp_path / f"raw_{kind}")
        src.mkdir()
        for k in range(24):
            _drop(src / f"{k:02d}.csv", [(f"O{k}-{i}", "3.00") for i in range(50)])
            if kind == "gz":
                (src / f"{k:02d}.csv.gz").write_bytes(gzip.compress((src / f"{k:02d}.csv").read_bytes()))
                (src / f"{k:02d}.csv").unlink()
            os.utime(next(src.glob(f"{k:02d}.*")), (1_000_000 + k, 1_000_000 + k))
        ingest.start_ingest(spark, str(src), table, str(tmp_path / f"ckpt_{kind}")).awaitTermination()
        rows = ingest.read_ingested(spark, table)
        got[kind] = [tuple(r) for r in rows.drop("loaded_at", "load_seq").orderBy("load_seq").collect()]
    assert got["gz"] == got["plain"] and len(got["gz"]) == 24 * 50
    assert len(list((tmp_path / "raw_gz" / "batch_id=0").glob("part-*.parquet"))) == 24
    assert spark.conf.get(ingest.LEAST_TASKS, None) is None

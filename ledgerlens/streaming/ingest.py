"""Incremental load of raw CSV drops into the raw table (S1-S3 as a stream).

The reference re-runs its load script on a schedule; the Spark form is a
Structured Streaming file source with an ``availableNow`` trigger: each run
picks up only the files that arrived since the last run (tracked in the
checkpoint), and appends them to the raw table. The stream carries the names
of new files only; a micro-batch reads them with the batch reader, so columns
are bound by each file's header, rows are numbered in file order and values
are coerced exactly as in the batch load (S1, S2).

Each micro-batch is written to its own ``batch_id=<n>`` partition with
overwrite semantics, so a batch replayed after a failure replaces its own
output instead of appending duplicates. ``load_seq`` continues after the
highest file number that an earlier batch used, so arrival order spans
batches.

Cleaning itself stays a batch job: its IQR fences are global over all rows,
which an incremental job could not keep exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens import schema as S
from ledgerlens.session import set_conf
from ledgerlens.sources import files


# Tasks that read files, at least; Spark's own default is the number of cores.
LEAST_TASKS = "spark.sql.files.minPartitionNum"


def first_seq(highest: int | None) -> int:
    """First ``load_seq`` of a batch: the next file number after the highest value written so far."""
    return 0 if highest is None else ((highest >> files.POSITION_BITS) + 1) << files.POSITION_BITS


def _highest(spark: SparkSession, table_path: str, batch_id: int) -> int | None:
    """Highest ``load_seq`` of the batches before this one (their Parquet footers hold it)."""
    if not files._exists(spark, f"{table_path.rstrip('/')}/batch_id=*"):
        return None
    return spark.read.parquet(table_path).where(F.col("batch_id") < batch_id).agg(F.max("load_seq").alias("m")).first()["m"]


def _write_batch(table_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # at most maxFilesPerTrigger names
        paths = sorted(r["path"] for r in batch.select("path").distinct().collect())
        if not paths:
            return
        spark = batch.sparkSession
        base = first_seq(_highest(spark, table_path, batch_id))
        rows = files.read_mixed_csv(spark, paths)
        numbered = rows.withColumn("load_seq", F.col("load_seq") + F.lit(base)).withColumn("loaded_at", F.localtimestamp())
        # a task for each file that cannot be split: packed by size, a few tasks would read several while others wait
        tasks = max(sum(p.endswith(files.UNSPLIT) for p in paths), int(spark.conf.get(LEAST_TASKS, None) or spark.sparkContext.defaultParallelism))
        with set_conf(spark, LEAST_TASKS, str(tasks)):
            files.coerce_raw(numbered).write.mode("overwrite").option("compression", files.CODEC).parquet(f"{table_path.rstrip('/')}/batch_id={batch_id}")

    return write


def new_files(spark: SparkSession, source_dir: str, files_per_trigger: int) -> DataFrame:
    """Stream of the names of the files that arrive in a folder (contents are not read)."""
    named = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return named.option("maxFilesPerTrigger", files_per_trigger).load(source_dir).select("path")


def start_ingest(spark: SparkSession, source_dir: str, table_path: str, checkpoint: str, available_now: bool = True, files_per_trigger: int = 64) -> StreamingQuery:
    """Start the CSV -> raw table stream; ``available_now`` processes what is there and stops."""
    writer = new_files(spark, source_dir, files_per_trigger).writeStream.foreachBatch(_write_batch(table_path)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()


def read_ingested(spark: SparkSession, table_path: str) -> DataFrame:
    """The raw table written by the stream (all batches)."""
    return spark.read.parquet(table_path).drop("batch_id")

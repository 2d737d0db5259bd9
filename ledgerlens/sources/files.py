"""File sources and sinks.

* S1/S2: raw CSV with a header, every field read as text, then coerced with
  ``try_*`` casts so unparsable values become NULL (ANSI casts would throw).
* S3/S7: dataset writes with a declared schema that replace a table; the
  cleaned table is partitioned by (year, month) so month/date filters prune
  files. A replacement is written to a folder of its own inside the table's,
  counted (S8), and only then marked as valid, so the old rows stay readable
  until the new ones are verified, and a failed write changes nothing.
* S4-S6: table scans; S6 pushes the status filter into the Parquet reader.
* S8: the row count of a written table read back, compared with the count
  observed while writing (``Observation``, no extra pass over the input).
* S9: CSV output of a scored table.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.session import scratch_path


# Bits of ``monotonically_increasing_id`` that number the rows of a task.
TASK_BITS = 33
# Bits of ``load_seq`` that place a row in its file (files up to 1 TB); the file's rank stands in front of them.
POSITION_BITS = 40
# Most files whose ranks (a path and a number each) are broadcast; more are joined by shuffle.
BROADCAST_FILES = 200_000


# Ends of the names of files that one task reads from start to end, as Spark cannot split them.
UNSPLIT = (".gz", ".deflate", ".lz4", ".snappy", ".zst")

# Of written tables: smaller than Parquet's default by a quarter or so.
CODEC = "zstd"
# A table's folder holds one folder a version, and in it this empty file once its rows are verified. The folder is named
# like a partition of a column that only it has, so a plain read of a table's folder finds the rows of a single version
# and fails, in place of mixing them, while there are two. Earlier tables have the value alone as name.
VERSION, VERIFIED = "version-", "_VERIFIED"
ANY_VERSION = f"{{{VERSION},version_*={VERSION}}}*"


class MissingInput(FileNotFoundError):
    pass


class UnverifiedWrite(RuntimeError):
    pass


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of a Hadoop glob (any cluster filesystem), sorted."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(f.getPath().toString() for f in found or [])


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    """Hadoop FileSystem check (any cluster filesystem); ``path`` may be a glob."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = fs.globStatus(p)
    return matches is not None and len(matches) > 0


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder."""
    fs, p = _hadoop(spark, path)
    return fs.getContentSummary(p).getLength()


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw CSV as text columns, bound by header name, with ``load_seq`` in file order.

    Fails if the input or a column is missing, and (``enforceSchema`` off) if
    a file's header differs from the first one's.
    """
    paths = [path] if isinstance(path, str) else path
    if absent := [p for p in paths if not _exists(spark, p)]:
        raise MissingInput(f"raw sales input not found: {', '.join(absent)}")
    rows = _by_header(spark, paths)
    return _in_file_order(rows, _file_ranks(spark, paths)).select(*[f.name for f in S.RAW_CSV.fields], "load_seq")


def csv_header(spark: SparkSession, paths: list[str]) -> list[str]:
    """Column names of the (first) file; all columns of the feed must be there."""
    names = spark.read.option("header", True).csv(paths).columns
    if absent := [f.name for f in S.RAW_CSV.fields if f.name not in names]:
        raise MissingInput(f"columns not found in {', '.join(paths)}: {', '.join(absent)}")
    return names


def _by_header(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of files with one header, all columns as text, with the place of each row's split."""
    schema = ", ".join(f"`{n}` string" for n in csv_header(spark, paths))
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").csv(paths)
    split = [F.col(f"_metadata.{a}").alias(f"_{a}") for a in ("file_path", "file_block_start")]
    return rows.select(*[f.name for f in S.RAW_CSV.fields], *split, F.monotonically_increasing_id().alias("_nth"))


def read_mixed_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """S1 for a bounded list of files, each bound by its own header (one short job a file reads it)."""
    kinds: dict[tuple, list[str]] = {}
    for p in paths:
        kinds.setdefault(tuple(csv_header(spark, [p])), []).append(p)
    rows = None
    for same in kinds.values():
        part = _by_header(spark, same)
        rows = part if rows is None else rows.unionByName(part)
    return _in_file_order(rows, _file_ranks(spark, paths)).select(*[f.name for f in S.RAW_CSV.fields], "load_seq")


def _file_ranks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """_file_path, _rank: files by modification time and path, from the listing (contents are not read)."""
    listed = spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.file_modification_time").alias("_time")
    )
    # a row per file
    ranked = listed.select("_file_path", (F.row_number().over(Window.orderBy("_time", "_file_path")) - 1).cast("long").alias("_rank"))
    return F.broadcast(ranked) if listed.count() <= BROADCAST_FILES else ranked


def _place(block_start: Column, nth: Column) -> Column:
    """Ascending place of a row in its file: first byte of its split plus its number in the task.

    A split has more bytes than rows, and one that is not its file's last
    fills a task alone (Spark packs only what fits a whole split), so numbers
    of different splits do not meet.
    """
    return block_start + nth.bitwiseAND((1 << TASK_BITS) - 1)


def _in_file_order(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """Add ``load_seq``: files by rank, rows by their place; the rows stay where they were read."""
    seq = F.shiftleft("_rank", POSITION_BITS) + _place(F.col("_file_block_start"), F.col("_nth"))
    return rows.join(ranks, "_file_path", "left").withColumn("load_seq", seq)


def _try_number(c: str, t: str):
    return F.expr(f"try_cast({c} AS {t})")


def coerce_raw(df: DataFrame) -> DataFrame:
    """Typed raw rows; bad dates/numbers become NULL. Adds ``load_seq`` (file order) and ``loaded_at``."""
    typed = {
        "unit_price": _try_number("unit_price", "decimal(12,2)"),
        # "2.0" is a whole number too
        "quantity": F.expr("if(try_cast(quantity as decimal(20,4)) % 1 = 0, try_cast(try_cast(quantity as decimal(20,4)) as int), null)"),
        "discount_pct": _try_number("discount_pct", "decimal(5,2)"),
        "discount_amt": _try_number("discount_amt", "decimal(12,2)"),
        "total_amount": _try_number("total_amount", "decimal(12,2)"),
        "sale_date": F.coalesce(F.try_to_date("sale_date", "yyyy-MM-dd"), F.to_date(F.try_to_timestamp("sale_date"))),
    }
    out = df.withColumns(typed)
    if "load_seq" not in out.columns:
        # arrival order = file split order then row order within the split
        out = out.withColumn("load_seq", F.monotonically_increasing_id())
    if "loaded_at" not in out.columns:
        out = out.withColumn("loaded_at", F.localtimestamp())
    return out.select(*[f.name for f in S.RAW_SALES.fields])


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of a table's verified versions, oldest first."""
    marks = _glob(spark, f"{path.rstrip('/')}/{ANY_VERSION}/{VERIFIED}")
    return sorted((m[: -len(VERIFIED) - 1] for m in marks), key=lambda v: v.rsplit(VERSION, 1)[1])


def table_path(spark: SparkSession, path: str) -> str:
    """Folder of a table's current rows: its latest verified version, or ``path`` itself if it has none."""
    found = versions(spark, path)
    if not found and _exists(spark, f"{path.rstrip('/')}/{ANY_VERSION}"):
        raise UnverifiedWrite(f"{path}: no verified version")
    return (found or [path])[-1]


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Replace a table and return its number of rows.

    The rows go to a new version; when as many are read back as were observed
    while writing, the version is marked, which is the one step that readers
    see. The version before stays for jobs that read it; older ones and
    unmarked rests of failed writes are removed. One writer a table at a time.
    """
    spark = df.sparkSession
    base = path.rstrip("/")
    old = versions(spark, base)
    number = int(old[-1].rsplit(VERSION, 1)[1].split("-")[0]) + 1 if old else 0
    new = f"{base}/version_{number}={VERSION}{number:08d}-{uuid.uuid4().hex[:8]}"
    obs = Observation("write_rows")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("compression", CODEC).parquet(new)
    written = int(obs.get["rows"])
    back = spark.read.schema(df.schema).parquet(new).count()
    if back != written:
        raise UnverifiedWrite(f"{base}: {written} rows written, {back} read back")
    fs, mark = _hadoop(spark, f"{new}/{VERIFIED}")
    fs.create(mark, True).close()
    keep = {os.path.basename(v) for v in old[-1:]} | {os.path.basename(new)}
    for v in _glob(spark, f"{base}/{ANY_VERSION}"):
        if os.path.basename(v) not in keep:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(v), True)
    return written


def write_raw(df: DataFrame, path: str) -> int:
    """S3: replace the raw table (declared schema), its rows numbered (``row_id``) in the task that writes them."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.RAW_SALES.fields]
    return write_table(df.select(*cols, F.monotonically_increasing_id().alias("row_id")), path)


def by_month(df: DataFrame) -> DataFrame:
    """Rows brought together by the month of their ``sale_date``, whose first day is added as ``_month``.

    A ``rebalance`` lets each task write few files per month while AQE splits
    any month that is too large for one task (a plain ``repartition`` would
    put a whole month on one task).
    """
    return df.withColumn("_month", F.trunc("sale_date", "MM")).hint("rebalance", "_month")


def write_cleaned(df: DataFrame, path: str, arranged: bool = False) -> int:
    """Replace the cleaned table, partitioned by (year, month).

    ``arranged``: the rows went through ``by_month`` already, best before
    columns were derived from them, which then need not move.
    """
    typed = df.withColumns(
        {
            "unit_price": F.col("unit_price").cast(S.MONEY),
            "discount_pct": F.col("discount_pct").cast(S.PCT),
            "discount_amt": F.col("discount_amt").cast(S.MONEY),
            "total_amount": F.col("total_amount").cast(S.MONEY),
            "quantity": F.col("quantity").cast("int"),
        }
    )
    return write_table(typed if arranged else typed.hint("rebalance", "year", "month"), path, partition_by=("year", "month"))


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a fresh table in the shared scratch folder and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}")
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw table with ``row_id``, the unique number that each row got when it was written."""
    return read_table(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of a written table (its current version)."""
    return spark.read.parquet(table_path(spark, path))


def read_delivered(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned rows with status Delivered (filter pushed to the Parquet scan)."""
    return read_table(spark, path).where(F.col("order_status") == S.STATUS_DELIVERED)


def verify_count(spark: SparkSession, path: str, expected: int) -> DataFrame:
    """One row (table, written_rows, read_back_rows, ok)."""
    n = read_table(spark, path).count()
    return spark.createDataFrame(
        [(os.path.basename(path.rstrip("/")), expected, n, n == expected)],
        "table string, written_rows long, read_back_rows long, ok boolean",
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV output."""
    df.write.mode("overwrite").option("header", True).csv(path)

"""Shared Spark helpers of the operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read again: lineage ends at the table."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}_{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Most bytes of rows in one Arrow batch of operators that read whole texts (a longer row is a batch of its own).
ARROW_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's bound on Arrow batches: JVM and Python worker each hold copies of a batch."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(key).removesuffix("b"))
    if now <= 0 or now > ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def strings(column: pa.Array) -> list[str]:
    """A text column as Python strings, null as empty."""
    return [x or "" for x in column.to_pylist()]


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the input does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish

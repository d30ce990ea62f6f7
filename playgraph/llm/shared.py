"""Shared scratch space, small column helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import drop_encoders

BATCH_BYTES = 8 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor sees.

    Only a local session without that setting gets a folder of its own; a
    cluster session without it is refused, since a machine-local folder would
    hide one executor's files from the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def lean_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB: tasks of these operators hold whole texts, and long ones would fill the default 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark.conf.get(key).rstrip("b")
    if not size.isdigit() or int(size) > BATCH_BYTES or int(size) <= 0:
        spark.conf.set(key, str(BATCH_BYTES))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    lean_batches(spark)
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give the pages that this Python process has freed back to the system (a reused worker would keep its peak for good)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run, encoders: bool = False):
    """``run`` (Arrow batches to Arrow batches) in a worker that first drops what other operators left there and last what it freed.

    Spark hands the same Python workers to one operator after the other; token
    encoders with their caches stay only where ``encoders`` are used.
    """

    def lean_run(batches):
        if not encoders:
            drop_encoders()
            release_memory()
        try:
            yield from run(batches)
        finally:
            release_memory()

    return lean_run


def texts_of(column, rows: int = 500):
    """The Python strings of an Arrow column, a few rows at a time (a batch of long texts is never held twice)."""
    for a in range(0, len(column), rows):
        yield from column.slice(a, rows).to_pylist()


def small_batches(batches, rows: int = 500):
    """Arrow batches cut to a few rows, where rows hold texts or sets."""
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def octets(col: Column) -> Column:
    """UTF-8 length of a text, 0 for null."""
    return F.coalesce(F.octet_length(col), F.lit(0))


def partitions_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Enough partitions for ``rows_per_task``, never fewer than the session's shuffle width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task), 1)

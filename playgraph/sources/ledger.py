"""Batches that count once: rows are written under a batch name, then the name is committed.

A table folder holds its rows in ``batch=<name>`` partitions; the folder
``<table>_commits`` gets one file per batch after its rows are complete.  Readers
take the rows of committed batches only, so a batch that fails half-way is
invisible, and one that is written again replaces its own rows: each row counts
once, however often its batch is retried.  What is collected is one short name
per batch.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch"
COMMITS = "rows bigint, committed_at timestamp, batch string"


def read_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """The folder's rows; a folder that does not exist (yet) gives the typed empty frame."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stream_batch(checkpoint: str, batch_id: int) -> str:
    """The batch name of a stream's micro-batch: two streams into one table never share names."""
    return f"s{zlib.crc32(checkpoint.encode()):08x}-{batch_id}"


def append_batch(df: DataFrame, path: str, batch: str | None = None, partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> str:
    """Write ``df`` as one batch (default: a new name) and commit it; returns the name.

    A batch already committed is left as it is, so retries after the commit
    cost one read of the commits.  Batch names must start with a letter.
    """
    spark, name = df.sparkSession, batch or f"b{uuid.uuid4().hex}"
    if batch and name in committed(spark, path):
        return name
    rows = df.withColumn(BATCH, F.lit(name))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by, BATCH).format(fmt).save(path)
    written = read_or_empty(spark, path, _ddl(rows), fmt)
    commit(spark, path, name, written.filter(F.col(BATCH) == name).count())
    return name


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def commit(spark: SparkSession, path: str, batch: str, rows: int) -> None:
    """Make a batch visible: one file with one row, which appears whole."""
    row = spark.createDataFrame([(batch, rows)], "batch string, rows bigint").withColumn("committed_at", F.current_timestamp())
    row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(commits_path(path))


def commits_path(path: str) -> str:
    return path.rstrip("/") + "_commits"


def committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches that count, in order."""
    rows = read_or_empty(spark, commits_path(path), COMMITS).groupBy("batch").agg(F.min("committed_at").alias("at"))
    return [r.batch for r in rows.orderBy("at", "batch").collect()]


def read_batches(spark: SparkSession, path: str, schema: str, batches: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Rows of the committed batches (or of ``batches``) without the batch column; other batches' folders are pruned."""
    names = committed(spark, path) if batches is None else batches
    rows = read_or_empty(spark, path, f"{schema}, {BATCH} string", fmt)
    return rows.filter(F.col(BATCH).isin(names) if names else F.lit(False)).drop(BATCH)


def retire(spark: SparkSession, path: str, batches: list[str], partitions: list[str] | None = None) -> None:
    """Delete batches that a compacted table holds: their commits first, then their rows.

    ``partitions`` are the folders above ``batch=`` (as ``kind=user``); none for
    an unpartitioned table.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    bases = [commits_path(path), *([path.rstrip("/")] if not partitions else [f"{path.rstrip('/')}/{p}" for p in partitions])]
    for base in bases:
        for name in batches:
            folder = hadoop(f"{base}/{BATCH}={name}")
            folder.getFileSystem(conf).delete(folder, True)

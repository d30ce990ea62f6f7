"""Spark session settings and lineage cuts.

On a cluster the session comes from ``spark-submit`` with its own settings;
``build_session`` fills in only what is unset.  The one exception is the
session time zone: dates of the results are UTC by definition, so it is always
set to UTC.  Stored tables go to ``spark.checkpoint.dir`` (a shared folder the
cluster names); a local temporary folder is used only in local mode, as in
tests, and a cluster session without that setting is refused.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}
ALWAYS = {"spark.sql.session.timeZone": "UTC"}


def scale_conf(
    input_bytes: int, total_cores: int, executor_core_mem_bytes: int = 4 << 30, shuffled_share: float = 0.1
) -> dict:
    """Partition sizing for a job over ``input_bytes`` of Parquet.

    * Scan splits of 256 MB (fewer, larger tasks; one row group per split
      at typical writer settings).
    * Initial shuffle partitions by what is shuffled, not by what is stored:
      the queries move a few narrow columns (``shuffled_share`` of the input's
      bytes), in partitions of an eighth of a core's memory, never fewer than
      2 waves of the cluster's cores; AQE then coalesces small ones and splits
      skewed ones at run time.
    * Skew: a partition is skewed above 5x the median and 256 MB.

    At 100 TB on 1000 executors x 8 cores with 4 GB a core this gives about
    20,000 shuffle partitions of 512 MB.
    """
    per_partition = min(512 << 20, max(16 << 20, executor_core_mem_bytes // 8))
    partitions = max(2 * total_cores, -(-int(input_bytes * shuffled_share) // per_partition))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(per_partition, 128 << 20)),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }


def build_session(master: str | None = None, app: str = "playgraph", conf: dict | None = None) -> SparkSession:
    """A session with ``conf`` (the caller's wish, always set), UTC, and DEFAULTS for what submit left unset."""
    given = SparkConf()  # spark-defaults and spark-submit settings
    active = SparkSession.getActiveSession()
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        if not given.contains(k) and (active is None or active.conf.get(k, None) is None):
            b = b.config(k, v)
    for k, v in {**ALWAYS, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir`` as the cluster sets it.

    Without that setting a local session gets a temporary folder (the same
    one for its whole life); a cluster session is refused, because files in a
    machine-local folder are invisible to other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    target = tempfile.mkdtemp(prefix="playgraph-ckpt-")
    spark.conf.set("spark.checkpoint.dir", target)
    return target


def materialize(df: DataFrame, name: str, root: str | None = None, sort_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``root`` (default: a fresh run folder in
    the checkpoint directory) and return a DataFrame reading it back."""
    spark = df.sparkSession
    base = root or os.path.join(ensure_checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    path = os.path.join(base, name)
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Incremental benchmark summary over an append-only timing log.

The timing log only grows (one ``label: ms`` line per timed span) and the
summary is rewritten after every pass.  As a Structured Streaming job:

    readStream.text(log dir) -> parse -> groupBy(label): sum, count
        -> complete output -> foreachBatch: rewrite both report sections

State is one row per label (a bounded set of workload names), kept in the
checkpoint folder, which must be a stable path of the deployment: a restarted
or relocated driver resumes from it without re-reading old log files.  Both
report sections of a pass go to one of a few folders in turn, and readers follow
the newest complete one (``current_summary``), so they never mix two passes and
old passes take no room.  Totals are kept as exact parts (``functions.exact``),
so the averages do not depend on how lines fell into micro-batches.  Malformed
lines go to a rejects table instead of ending the summary.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playgraph.functions.exact import average_of, sum_parts
from playgraph.operators import runlog
from playgraph.sources import text
from playgraph.sources.ledger import read_or_empty

KEPT_PASSES = 3  # folders of report passes: one being read, one newer, one being written


def label_totals(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """label, the exact parts of its total, runs (running totals), and the rejects stream."""
    parsed, rejects = text.parse_run_log(lines)
    return parsed.groupBy("label").agg(*sum_parts("duration_ms", "t"), F.count(F.lit(1)).alias("runs")), rejects


def _write_summary(out_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        avg = batch.select("label", average_of("t").alias("avg_ms"), "runs").persist()
        try:
            slot = batch_id % KEPT_PASSES
            target = f"{out_dir.rstrip('/')}/pass={slot}"
            runlog.averages_text(avg).write.mode("overwrite").parquet(f"{target}/averages")
            runlog.comparison_from_averages(avg).write.mode("overwrite").parquet(f"{target}/comparison")
            done = spark.createDataFrame([(batch_id,)], "pass_id bigint")
            done.coalesce(1).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/passes/slot={slot}")
        finally:
            avg.unpersist()

    return write


def current_summary(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """(averages, comparison) of the newest complete pass; both empty before the first."""
    base = out_dir.rstrip("/")
    newest = read_or_empty(spark, f"{base}/passes", "pass_id bigint, slot int").agg(F.max("pass_id")).first()[0]
    if newest is None:
        none = spark.createDataFrame([], "label string, avg_ms double, runs bigint")
        return runlog.averages_text(none), runlog.comparison_from_averages(none)
    slot = newest % KEPT_PASSES
    return spark.read.parquet(f"{base}/pass={slot}/averages"), spark.read.parquet(f"{base}/pass={slot}/comparison")


def _write_rejects(out_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch: a batch written again after a failure replaces itself.
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/rejects/batch={batch_id}")

    return write


def start_summary(
    spark: SparkSession,
    log_dir: str,
    out_dir: str,
    checkpoint: str,
    available_now: bool = False,
    processing_time: str = "10 seconds",
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the summary stream and the rejects stream; returns both queries."""
    if not checkpoint:
        raise ValueError("start_summary needs a stable checkpoint path; a restart resumes from it")
    lines = spark.readStream.option("maxFileAge", "36500d").text(log_dir)  # the default ignores files a week older than the newest
    totals, rejects = label_totals(lines)
    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    summary = (
        totals.writeStream.outputMode("complete")
        .foreachBatch(_write_summary(out_dir))
        .option("checkpointLocation", os.path.join(checkpoint, "summary"))
        .trigger(**trigger)
        .start()
    )
    bad = (
        rejects.writeStream.outputMode("append")
        .foreachBatch(_write_rejects(out_dir))
        .option("checkpointLocation", os.path.join(checkpoint, "rejects"))
        .trigger(**trigger)
        .start()
    )
    return summary, bad

"""Streaming ingest of fetched documents into the snapshot table.

A fetcher drops JSON documents anywhere under a landing folder (a new file
per fetch), named by kind: ``{id}.json`` (user), ``games_{id}.json``,
``friends_{id}.json`` and ``news_{id}.json``.  A page of a larger fetch is named
``news_{id}_f{fetched, epoch seconds}_p{page, from 1}of{pages}.json``.  Each
micro-batch appends ``(kind, key, page, pages, payload, fetched_at)`` rows to the
Parquet snapshot table with the batch writer (``append_snapshots``), so streamed
and appended rows are equally visible; readers take the newest row per (kind,
key) (``latest_snapshots``) or all pages of the newest complete fetch
(``latest_page_sets``), which is what overwriting a file per key did.  The raw
document is kept as a string so any document shape (news is opaque) lands
unchanged.  Files whose name gives no key go to a rejects table.  A micro-batch
that is run again after a failure writes its rows and rejects once.

The checkpoint must be a stable path of the deployment: it is what a restart
resumes from, so none is made up here.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playgraph.operators.snapshots import append_snapshots
from playgraph.sources.ledger import append_batch, stream_batch

KEY_PATTERN = r"^(games_|friends_|news_)?([0-9]+)(?:_f([0-9]+)_p([0-9]+)of([0-9]+))?\.json$"
# File-name prefix -> snapshot kind (no prefix: user profile).
PREFIX_KIND = {"games_": "game", "friends_": "friend", "news_": "news", "": "user"}


def _write(table_dir: str, rejects_dir: str, checkpoint: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        name = stream_batch(checkpoint, batch_id)
        batch = batch.persist()
        try:
            append_snapshots(batch.filter(F.col("key").isNotNull()), table_dir, name)
            bad = batch.filter(F.col("key").isNull()).select("path", "payload", "fetched_at")
            if not bad.isEmpty():
                append_batch(bad, rejects_dir, name)
        finally:
            batch.unpersist()

    return write


def start_ingest(
    spark: SparkSession,
    landing_dir: str,
    table_dir: str,
    checkpoint: str,
    available_now: bool = False,
    processing_time: str = "30 seconds",
    max_files: int = 10_000,
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Append every new landing file as one snapshot row; rejects go to ``<table_dir>_rejects``.

    A micro-batch takes at most ``max_files`` files, the rest follow in the
    next.  With ``archive_dir`` finished files leave the landing folder, which
    keeps its listing short.
    """
    if not checkpoint:
        raise ValueError("start_ingest needs a stable checkpoint path; a restart resumes from it")
    # wholetext: one row per file, the document as written by the fetcher.
    # maxFileAge: by default files a week older than the newest are ignored.
    options = {"wholetext": "true", "recursiveFileLookup": "true", "maxFilesPerTrigger": max_files, "maxFileAge": "36500d"}
    reader = spark.readStream.options(**options)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    files = reader.text(landing_dir)
    meta = F.col("_metadata")


    def part(i):
        return F.regexp_extract(meta["file_name"], KEY_PATTERN, i)

    prefix = part(1)
    kind = None
    for p, k in PREFIX_KIND.items():
        kind = F.when(prefix == p, F.lit(k)) if kind is None else kind.when(prefix == p, F.lit(k))
    rows = files.select(
        kind.alias("kind"),
        part(2).try_cast("bigint").alias("key"),
        (part(4).try_cast("bigint") - 1).alias("page"),
        part(5).try_cast("int").alias("pages"),
        F.col("value").alias("payload"),
        F.coalesce(F.timestamp_seconds(part(3).try_cast("bigint")), meta["file_modification_time"]).cast("timestamp_ntz").alias("fetched_at"),
        meta["file_path"].alias("path"),
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(_write(table_dir, table_dir.rstrip("/") + "_rejects", checkpoint))
        .option("checkpointLocation", os.path.join(checkpoint, "ingest"))
        .trigger(**trigger)
        .start()
    )

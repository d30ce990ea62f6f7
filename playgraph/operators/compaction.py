"""Compaction of the snapshot log, and reads that fetch payloads late.

``compact`` turns the committed batches into a table bucketed and sorted by
(kind, key) that keeps, per key, the newest complete fetch and whatever newer
rows still wait for pages.  Reads take that table and the batches since: only
the new rows are shuffled, to the table's own buckets.

``located_hits`` finds the fresh rows by narrow columns and their place (file,
row number) first and reads payloads of the files that hold a hit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.operators.snapshots import STORED, fresh_keys, read_snapshots, recent_snapshots
from playgraph.plans.batch import materialize
from playgraph.sources.ledger import BATCH, committed, read_batches, read_or_empty, retire

BASES = "name string, location string, buckets int, batches array<string>, made_at timestamp"
BUCKET_BYTES = 256 << 20
#: Files and hits named in the driver or broadcast; beyond them the whole folder is scanned and hits are joined by a shuffle.
MAX_FILES, MAX_HITS = 50_000, 100_000


def _bases_path(path: str) -> str:
    return path.rstrip("/") + "_bases"


def newest_base(spark: SparkSession, path: str):
    """The row of the newest compacted table (name, location, buckets, batches), or None."""
    return read_or_empty(spark, _bases_path(path), BASES).orderBy(F.desc("made_at"), "name").first()


def _base_rows(spark: SparkSession, base) -> DataFrame:
    """The compacted table; a session that does not know it yet registers its files with their buckets."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{base.name}` ({STORED}) USING parquet "
        f"CLUSTERED BY (kind, key) SORTED BY (kind, key, fetched_at) INTO {base.buckets} BUCKETS LOCATION '{base.location}'"
    )
    return spark.table(f"`{base.name}`")


def snapshot_log(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest compacted table and of the batches since, dealt to its buckets; documents without a key are left out."""
    base = newest_base(spark, path)
    if base is None:
        return read_snapshots(spark, path).filter(F.col("key").isNotNull())
    since = [b for b in committed(spark, path) if b not in set(base.batches)]
    rows = _base_rows(spark, base)  # as it is stored: the union keeps the partitioning of a bare scan only
    if not since:
        return rows
    new = read_batches(spark, path, STORED, since).filter(F.col("key").isNotNull()).select(rows.columns)
    return rows.unionByName(new.repartition(base.buckets, "kind", "key"))


def _dated(log: DataFrame) -> DataFrame:
    """One row per page of every fetch, with ``__newest``, the time of the key's newest complete fetch (or null).

    Windows over (kind, key) rather than a join: they ask for nothing but the
    log's own partitioning.  A key's rows in the log are its last complete fetch
    and what came since.
    """
    pages = log.groupBy("kind", "key", "fetched_at", "page").agg(F.max("payload").alias("payload"), F.max("pages").alias("pages"))
    fetch = Window.partitionBy("kind", "key", "fetched_at")
    counted = pages.withColumn("__n", F.count(F.lit(1)).over(fetch)).withColumn("__of", F.max("pages").over(fetch))
    complete = F.when(F.col("__of").isNull() | (F.col("__n") >= F.col("__of")), F.col("fetched_at"))
    return counted.withColumn("__newest", F.max(complete).over(Window.partitionBy("kind", "key"))).drop("__n", "__of")


def latest_compacted(spark: SparkSession, path: str) -> DataFrame:
    """kind, key, page, payload, fetched_at of every key's newest complete fetch; the compacted side is not shuffled."""
    rows = _dated(snapshot_log(spark, path)).filter(F.col("fetched_at") == F.col("__newest"))
    return rows.select("kind", "key", "page", "payload", "fetched_at")


def compact(spark: SparkSession, path: str, buckets: int | None = None) -> str:
    """Write a new compacted table of everything committed so far and make it current; returns its name.

    Documents without a key cannot be asked for and are left out.  Without
    ``buckets`` there is one for every 256 MB of payload.  A run that fails
    leaves the current table as it is; the batches stay until ``retire_compacted``.
    """
    batches = committed(spark, path)
    base = newest_base(spark, path)
    log = snapshot_log(spark, path)
    if buckets is None:
        size = log.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
        buckets = max(base.buckets if base else 1, -(-size // BUCKET_BYTES))
    name = f"snapshots_{uuid.uuid4().hex}"
    location = f"{path.rstrip('/')}_base/{name}"
    # Rows newer than the newest complete fetch wait for their pages.
    kept = _dated(log).filter(F.col("__newest").isNull() | (F.col("fetched_at") >= F.col("__newest")))
    rows = kept.select("key", "page", "pages", "payload", "fetched_at", "kind").repartition(buckets, "kind", "key")
    rows.write.bucketBy(buckets, "kind", "key").sortBy("kind", "key", "fetched_at").format("parquet").option("path", location).saveAsTable(name)
    entry = spark.createDataFrame([(name, location, buckets, batches)], "name string, location string, buckets int, batches array<string>")
    entry.withColumn("made_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(_bases_path(path))
    return name


def retire_compacted(spark: SparkSession, path: str) -> list[str]:
    """Delete the batches that the current compacted table holds; returns their names."""
    base = newest_base(spark, path)
    gone = [b for b in committed(spark, path) if base is not None and b in set(base.batches)]
    kinds = [r.kind for r in read_or_empty(spark, path, f"{STORED}, {BATCH} string").select("kind").distinct().collect()] if gone else []
    retire(spark, path, gone, [f"kind={k}" for k in kinds])
    return gone


def located_hits(spark: SparkSession, path: str, wanted: DataFrame, now: Column, ttl_seconds: float | dict = S.CACHE_TTL_SECONDS) -> DataFrame:
    """kind, key, payload of wanted documents served from fresh rows of the stored log (as ``cache_hits``).

    The first pass reads kind, key, time and place of recent rows; the second
    reads payloads, of hit files only, for the places found.
    """
    names = committed(spark, path)
    rows = read_or_empty(spark, path, f"{STORED}, {BATCH} string").filter(F.col(BATCH).isin(names) if names else F.lit(False))
    if not names:
        return rows.select("kind", "key", "payload")
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    recent = recent_snapshots(rows.select("kind", "key", "fetched_at", *place), now, ttl_seconds)
    asked = wanted.select("kind", "key").join(fresh_keys(recent, now, ttl_seconds), ["kind", "key"]).distinct()
    hits = recent.join(asked, ["kind", "key", "fetched_at"]).select("kind", "key", "__file", "__row")
    hits = materialize(hits, "hits")
    files = [r[0] for r in hits.select("__file").distinct().limit(MAX_FILES + 1).collect()]
    source = rows
    if files and len(files) <= MAX_FILES:
        source = spark.read.schema(f"{STORED}, {BATCH} string").option("basePath", path).parquet(*files)
    payloads = recent_snapshots(source, now, ttl_seconds).select("payload", *place)
    found = payloads.join(F.broadcast(hits) if hits.count() <= MAX_HITS else hits, ["__file", "__row"])
    newest = found.groupBy("kind", "key").agg(F.max("payload").alias("payload"))
    return wanted.select("kind", "key").join(newest, ["kind", "key"])

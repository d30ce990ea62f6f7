"""Freshness as a stream: a key goes on the refresh list when its ttl ends.

Keyed state holds the newest fetch time of each (kind, key); a timer at that
time plus the ttl tells when the document stops being fresh.  Time is event
time: the clock is the newest ``fetched_at`` of the input, which rows of kind
``clock`` move on when nothing is fetched.  Every change comes out as a row
(kind, key, at, fresh); the newest row per key is its state, and the wanted keys
whose state is not fresh are the refresh list (``stream_refresh_list``).

State is one timestamp per key, in the checkpoint; a restart resumes from it.
Rows go to a table in batches that count once.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from playgraph import schema as S
from playgraph.sources.ledger import append_batch, read_batches, stream_batch

CHANGES = "kind string, key bigint, at_ms bigint, fresh boolean"
CLOCK = "clock"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Expiry(StatefulProcessor):
    """Newest fetch per key; a row when the key gets fresh and one when its ttl has ended."""

    def __init__(self, ttl_ms: dict[str, int], default_ms: int):
        self.ttl_ms, self.default_ms = ttl_ms, default_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kind, number = key
        newest = max(r.ms for r in rows)
        if kind == CLOCK:
            return
        held = self.newest.get()[0] if self.newest.exists() else None
        if held is not None and newest <= held:
            return
        self.newest.update((newest,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        due = newest + self.ttl_ms.get(kind, self.default_ms)
        if due > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(due)
            yield Row(kind=kind, key=number, at_ms=newest, fresh=True)
        else:
            yield Row(kind=kind, key=number, at_ms=due, fresh=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield Row(kind=key[0], key=key[1], at_ms=expiredTimerInfo.getExpiryTimeInMs(), fresh=False)

    def close(self) -> None:
        pass


def freshness_changes(fetches: DataFrame, ttl_seconds: float | dict = S.CACHE_TTL_SECONDS) -> DataFrame:
    """kind, key, at_ms, fresh: every change of a key's freshness, from a stream of (kind, key, fetched_at).

    Kinds the cache does not know, and documents without a key, have no
    freshness and are left out; a late or repeated fetch changes nothing.
    """
    ttl = ttl_seconds if isinstance(ttl_seconds, dict) else {}
    default = S.CACHE_TTL_SECONDS if isinstance(ttl_seconds, dict) else float(ttl_seconds)
    at = F.col("fetched_at").cast("timestamp")
    rows = fetches.filter(F.col("kind").isin(*S.CACHED_KINDS, CLOCK) & F.col("key").isNotNull() & F.col("fetched_at").isNotNull())
    # Whole milliseconds, rounded up: a document is never called stale before its ttl has ended.
    # A row without an event time neither moves the watermark nor is late.
    moves = F.when(F.col("kind") == CLOCK, at)
    rows = rows.select("kind", "key", F.ceil(F.unix_micros(at) / 1000).alias("ms"), moves.alias("at")).withWatermark("at", "0 seconds")
    processor = Expiry({k: int(v * 1000) for k, v in ttl.items()}, int(default * 1000))
    return rows.groupBy("kind", "key").transformWithState(processor, CHANGES, "Update", "EventTime")


def start_freshness(spark: SparkSession, fetches: DataFrame, table_dir: str, checkpoint: str, ttl_seconds: float | dict = S.CACHE_TTL_SECONDS) -> StreamingQuery:
    """Write the changes of a stream of fetches to ``table_dir`` (available now; schedule it, or loop)."""
    if not checkpoint:
        raise ValueError("start_freshness needs a stable checkpoint path; a restart resumes from it")
    spark.conf.set(STATE_STORE, ROCKSDB)  # timers need it

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, table_dir, stream_batch(checkpoint, batch_id))

    changes = freshness_changes(fetches, ttl_seconds)
    writer = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", os.path.join(checkpoint, "freshness"))
    return writer.trigger(availableNow=True).start()


def stream_refresh_list(spark: SparkSession, wanted: DataFrame, table_dir: str) -> DataFrame:
    """kind, key of every wanted document that is not fresh at the stream's clock."""
    changes = read_batches(spark, table_dir, CHANGES)
    # A fetch and the end of an older ttl may share a time; the fetch counts.
    state = changes.groupBy("kind", "key").agg(F.max(F.struct("at_ms", "fresh")).alias("s")).filter("s.fresh")
    return wanted.select("kind", "key").join(state.select("kind", "key"), ["kind", "key"], "left_anti")


def clock_row(spark: SparkSession, now: Column) -> DataFrame:
    """A row that moves the stream's clock to ``now``."""
    return spark.range(1).select(F.lit(CLOCK).alias("kind"), F.lit(0).cast("bigint").alias("key"), now.alias("fetched_at"))

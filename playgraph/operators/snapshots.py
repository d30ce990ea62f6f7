"""Document snapshots: latest per key, freshness, and the refresh list.

The snapshot table is an append-only log ``(kind, key, payload,
fetched_at)``; writing a newer document supersedes the old one, so reads
take the latest row per (kind, key).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.functions.timecols import age_seconds
from playgraph.sources.ledger import append_batch, read_batches

# The benchmark's no-cache mode: only profiles are re-fetched ("latest"
# ttl); libraries and friend lists keep the normal ttl.
NO_CACHE_TTL = {"user": S.LATEST_TTL_SECONDS}


def latest_snapshots(snapshot: DataFrame, keys: Sequence[str] = ("kind", "key")) -> DataFrame:
    """kind, key, fetched_at, payload: the newest document per (kind, key), or per other ``keys``.

    ``max(struct(fetched_at, payload))`` is an aggregate with a map-side
    partial step, so a key with a huge history is reduced before the shuffle.
    """
    best = F.max(F.struct("fetched_at", "payload")).alias("s")
    return snapshot.groupBy(*keys).agg(best).select(
        *keys, F.col("s.fetched_at").alias("fetched_at"), F.col("s.payload").alias("payload")
    )


def _ttl(ttl_seconds) -> Column:
    """A ttl column: one number for every kind, or a {kind: seconds} map
    (kinds not named keep the default ttl)."""
    if isinstance(ttl_seconds, dict):
        expr = F.lit(float(S.CACHE_TTL_SECONDS))
        for kind, secs in ttl_seconds.items():
            expr = F.when(F.col("kind") == kind, F.lit(float(secs))).otherwise(expr)
        return expr
    return F.lit(float(ttl_seconds))


def newest_times(snapshot: DataFrame) -> DataFrame:
    """kind, key, fetched_at of the newest document per (kind, key).

    Reads no payload; the one fixed-width maximum is a hash aggregate with a
    map-side partial step.
    """
    return snapshot.groupBy("kind", "key").agg(F.max("fetched_at").alias("fetched_at"))


def snapshot_freshness(
    latest: DataFrame,
    now: Column,
    ttl_seconds: float | dict = S.CACHE_TTL_SECONDS,
    kinds: Sequence[str] = S.CACHED_KINDS,
) -> DataFrame:
    """latest's columns + age_seconds, is_fresh (strict ``age < ttl``;
    kinds the cache does not know are never fresh).  ``ttl_seconds`` may be
    a per-kind map, e.g. ``NO_CACHE_TTL`` for the benchmark's no-cache mode."""
    age = age_seconds(now, F.col("fetched_at"))
    return latest.select(
        "*",
        age.alias("age_seconds"),
        (F.col("kind").isin(*kinds) & (age < _ttl(ttl_seconds))).alias("is_fresh"),
    )


def recent_snapshots(
    snapshot: DataFrame,
    now: Column,
    ttl_seconds: float | dict = S.CACHE_TTL_SECONDS,
    kinds: Sequence[str] = S.CACHED_KINDS,
) -> DataFrame:
    """Rows that may be fresh: of a known kind and not older than the longest ttl (both tests reach the scan)."""
    longest = max([float(v) for v in ttl_seconds.values()] + [S.CACHE_TTL_SECONDS]) if isinstance(ttl_seconds, dict) else float(ttl_seconds)
    oldest = now - F.expr(f"INTERVAL '{math.ceil(longest)}' SECOND")
    return snapshot.filter(F.col("kind").isin(*kinds) & (F.col("fetched_at") >= oldest))


def fresh_keys(
    snapshot: DataFrame,
    now: Column,
    ttl_seconds: float | dict = S.CACHE_TTL_SECONDS,
    kinds: Sequence[str] = S.CACHED_KINDS,
) -> DataFrame:
    """kind, key, fetched_at of the documents that are fresh.

    A key is fresh exactly when one of its rows is younger than the ttl, so old
    rows and unknown kinds leave at the scan: ``fetched_at`` is compared with a
    constant (the longest ttl back from ``now``) that Parquet statistics can
    use, and the exact test per kind follows.
    """
    recent = recent_snapshots(snapshot, now, ttl_seconds, kinds)
    return snapshot_freshness(newest_times(recent), now, ttl_seconds, kinds).filter("is_fresh").select("kind", "key", "fetched_at")


def refresh_list(
    wanted: DataFrame,
    snapshot: DataFrame,
    now: Column,
    ttl_seconds: float | dict = S.CACHE_TTL_SECONDS,
) -> DataFrame:
    """kind, key of every wanted document without a fresh snapshot (the
    fetch list for an external fetcher).  Hits are the ``left_semi``."""
    fresh = fresh_keys(snapshot, now, ttl_seconds)
    return wanted.select("kind", "key").join(fresh.select("kind", "key"), ["kind", "key"], "left_anti")


def cache_hits(wanted: DataFrame, snapshot: DataFrame, now: Column, ttl_seconds: float | dict = S.CACHE_TTL_SECONDS) -> DataFrame:
    """kind, key, payload of wanted documents served from fresh snapshots; payloads are read of recent rows only."""
    hits = wanted.select("kind", "key").join(fresh_keys(snapshot, now, ttl_seconds), ["kind", "key"])
    docs = recent_snapshots(snapshot, now, ttl_seconds).join(hits.distinct(), ["kind", "key", "fetched_at"])
    newest = docs.groupBy("kind", "key").agg(F.max("payload").alias("payload"))
    return wanted.select("kind", "key").join(newest, ["kind", "key"])


def wanted_documents(accounts: DataFrame, kinds: Sequence[str] = S.CACHED_KINDS) -> DataFrame:
    """kind, key for every account and kind (an explode, not a join)."""
    return accounts.select(
        F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"), F.col("account_id").alias("key")
    )


STORED = "key bigint, page bigint, pages int, payload string, fetched_at timestamp_ntz, kind string"


def append_snapshots(docs: DataFrame, path: str, batch: str | None = None) -> str:
    """Append fetched documents as one batch, partitioned by kind (prunes per-kind reads); returns the batch name.

    The one way into the table, for batch jobs and the streaming ingest alike.
    ``docs`` has kind, key, payload, fetched_at and, for documents of several
    pages, ``page``; ``pages`` tells how many pages the fetch has when they come
    in more than one batch.  A batch of the same name is written once.
    """
    def given(name, kind):
        return (F.col(name) if name in docs.columns else F.lit(None)).cast(kind).alias(name)

    rows = docs.select("kind", "key", given("page", "bigint"), given("pages", "int"), "payload", "fetched_at")
    return append_batch(rows, path, batch, partition_by=("kind",))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """kind, key, page, pages, payload, fetched_at of all committed batches (a missing table is empty)."""
    return read_batches(spark, path, STORED).select("kind", "key", "page", "pages", "payload", "fetched_at")


def _newest_sets(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the newest complete fetch per ``keys``; only the narrow columns are grouped before the join."""
    fetches = rows.groupBy(*keys, "fetched_at").agg(F.count_distinct(F.coalesce("page", F.lit(0))).alias("n"), F.max("pages").alias("pages"))
    complete = fetches.filter(F.col("pages").isNull() | (F.col("n") >= F.col("pages")))
    newest = complete.groupBy(*keys).agg(F.max("fetched_at").alias("fetched_at"))
    found = rows.join(newest, [*keys, "fetched_at"])
    # A page that was written twice (two batches of one fetch) counts once.
    return found.groupBy(*keys, "fetched_at", "page").agg(F.max("payload").alias("payload"))


def latest_page_sets(snapshot: DataFrame) -> DataFrame:
    """kind, key, page, payload, fetched_at: all pages of the newest complete fetch of every (kind, key).

    A fetch is what shares kind, key and ``fetched_at``; it is complete when it
    has as many pages as its ``pages`` says (null: all that its batch holds).
    Pages become visible together, and pages that a newer fetch no longer has
    are gone.  Documents with a null key are those of one key.
    """
    cols = ["kind", "key", "page", "payload", "fetched_at"]
    sets = _newest_sets(snapshot.filter(F.col("key").isNotNull()), ["kind", "key"]).select(cols)
    unnamed = _newest_sets(snapshot.filter(F.col("key").isNull()), ["kind"])
    return sets.unionByName(unnamed.withColumn("key", F.lit(None).cast("bigint")).select(cols))

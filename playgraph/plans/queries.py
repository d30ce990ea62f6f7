"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the parquet test tables, maps them to the canonical tables
(``sources.testmap``) and runs one public operator over all accounts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.operators import library as lib_ops
from playgraph.operators import compaction, network, news, opaque, profile as profile_ops, recommend as rec, refresh, runlog, snapshots, status
from playgraph.functions.formats import fixed_decimals
from playgraph.plans.batch import materialize
from playgraph.session import ensure_checkpoint_dir
from playgraph.sources import containers, documents, testmap, text
from playgraph.sources.tables import Tables

ONE_ACCOUNT = 42  # the account of the single-account query


class Canonical:
    """Canonical tables derived from one scale factor's test tables.

    Library and owned pairs both start from one stored pair table, so a query
    reads and joins the order lines once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)

    @cached_property
    def pairs(self) -> DataFrame:
        return materialize(testmap.played(self.t), "played")

    @cached_property
    def library(self) -> DataFrame:
        return testmap.library(self.t, pairs=self.pairs)

    @cached_property
    def owned(self) -> DataFrame:
        return self.pairs.select("account_id", "appid")

    @cached_property
    def friend_edge(self) -> DataFrame:
        return testmap.friend_edge(self.t)

    @cached_property
    def profile(self) -> DataFrame:
        return testmap.profile(self.t)

    @cached_property
    def accounts(self) -> DataFrame:
        return testmap.accounts(self.t)

    @cached_property
    def snapshot(self) -> DataFrame:
        return testmap.snapshot(self.t)

    @cached_property
    def run_log(self) -> DataFrame:
        parsed, _ = text.parse_run_log(testmap.run_log_lines(self.t))
        return parsed


def _c(spark: SparkSession, sf_dir: str) -> Canonical:
    return Canonical(spark, sf_dir)


# --- recommendations ---------------------------------------------------------

def recommend_one(spark, sf_dir):
    """One account: its friends are found first, and only their orders and its own are read further."""
    c = _c(spark, sf_dir)
    mine = c.friend_edge.filter(F.col("account_id") == ONE_ACCOUNT)
    edges = materialize(mine, "friends_of_one")
    ids = edges.select(F.col("friend_id").alias("account_id")).union(
        c.accounts.filter(F.col("account_id") == ONE_ACCOUNT).select("account_id")
    )
    pairs = materialize(testmap.played(c.t, accounts=ids), "played_by_friends")
    lib = testmap.library(c.t, pairs=pairs)
    return rec.recommend(lib, edges, c.profile, account_id=ONE_ACCOUNT, owned=pairs.select("account_id", "appid"))


def recommend_all_k10(spark, sf_dir):
    c = _c(spark, sf_dir)
    return rec.recommend(c.library, c.friend_edge, c.profile, k=10, owned=c.owned)


def recommend_rank(spark, sf_dir):
    c = _c(spark, sf_dir)
    return rec.recommend(c.library, c.friend_edge, c.profile, k=10, top_n=None, owned=c.owned)


def recommend_sweep(spark, sf_dir):
    c = _c(spark, sf_dir)
    return rec.recommend_sweep(c.library, c.friend_edge, c.profile, S.SWEEP_FRIENDS, mode=rec.BY_NAME, owned=c.owned)


def recommend_sweep_by_appid(spark, sf_dir):
    c = _c(spark, sf_dir)
    return rec.recommend_sweep(c.library, c.friend_edge, c.profile, S.SWEEP_FRIENDS, mode=rec.BY_APPID, owned=c.owned)


def recommend_by_appid(spark, sf_dir):
    c = _c(spark, sf_dir)
    return rec.recommend(c.library, c.friend_edge, c.profile, k=10, mode=rec.BY_APPID, owned=c.owned)


def recommend_hours(spark, sf_dir):
    return rec.with_hours(recommend_all_k10(spark, sf_dir)).select(
        "account_id", "rank", "name", "total_playtime", "hours", "hours_label"
    )


def recommend_empty(spark, sf_dir):
    """Every account owns all that its first 10 friends would contribute: the
    result is empty but keeps the recommendation schema.

    What friends contribute is needed for the owned games and for the
    recommendations: the first edges and the top games are stored once, and
    the top games of a library of top games are these."""
    c = _c(spark, sf_dir)
    edges = materialize(c.friend_edge.filter(F.col("pos") < 10), "first_friends")
    best = rec.top_games_per_owner(c.library).select(F.col("owner_id").alias("account_id"), "pos", "appid", "name", F.col("playtime").alias("playtime_min"))
    best = materialize(best, "top_games_of_all")
    top = rec.top_games_per_owner(best).select(F.col("owner_id").alias("friend_id"), "appid")
    friends_games = edges.join(top.hint("merge"), "friend_id").select("account_id", "appid")
    return rec.recommend(best, edges, c.profile, k=10, owned=c.owned.unionByName(friends_games))


def top10_per_friend(spark, sf_dir):
    c = _c(spark, sf_dir)
    return rec.top_games_per_owner(c.library).select(
        F.col("owner_id").alias("account_id"), "rank_in_friend", "pos", "appid", "name", "playtime"
    )


def owned_exclusion(spark, sf_dir):
    c = _c(spark, sf_dir)
    cands = rec.candidate_games(c.friend_edge, c.profile, c.library, k=10)
    return rec.exclude_owned(cands, c.owned)


def friends_used(spark, sf_dir):
    c = _c(spark, sf_dir)
    return rec.friends_used(c.friend_edge, c.profile, k=10)


def recommend_after_delta(spark, sf_dir):
    """Recommendations of all accounts, kept up to date: computed on the orders before a date, then refreshed
    for the accounts that the later orders reach.

    The edges that the first 10 friends need and the profiles do not depend on the date and are stored once."""
    c = _c(spark, sf_dir)
    edges = materialize(c.friend_edge.filter(F.col("pos") < 10), "first_friends")
    profile = materialize(c.profile, "profile")
    old_pairs = materialize(testmap.played(c.t, before=testmap.DELTA_FROM), "played_before")
    previous = materialize(rec.recommend(testmap.library(c.t, pairs=old_pairs), edges, profile, k=10, owned=old_pairs.select("account_id", "appid")), "previous")
    changed = c.t.orders.filter(~F.coalesce(F.col("o_orderdate") < F.lit(testmap.DELTA_FROM).cast("timestamp_ntz"), F.lit(False)))
    changed = changed.select(F.col("o_custkey").alias("account_id"))
    return refresh.refresh_recommendations(previous, c.library, edges, profile, changed, k=10, owned=c.owned)


# --- friends, profiles, status ------------------------------------------------

def friend_network(spark, sf_dir):
    c = _c(spark, sf_dir)
    return network.friend_network(c.friend_edge, c.profile)


def friend_count(spark, sf_dir):
    c = _c(spark, sf_dir)
    return network.friend_count(c.friend_edge)


def profile_summary(spark, sf_dir):
    c = _c(spark, sf_dir)
    return profile_ops.profile_summary(c.profile)


def account_status(spark, sf_dir):
    c = _c(spark, sf_dir)
    # Only game counts and playtimes are read from the library, so the stored
    # pairs (no positions or names to derive) stand in for it.
    return status.account_status(c.accounts, **testmap.status_inputs(c.t, c.pairs, c.friend_edge, c.profile))


def account_selection(spark, sf_dir):
    """Profile summaries of the accounts named in a run's account list."""
    c = _c(spark, sf_dir)
    ids, _ = text.parse_account_list(testmap.account_list_lines(c.t))
    return profile_ops.profile_summary(c.profile.join(ids, "account_id", "left_semi"))


# --- library ---------------------------------------------------------------------

def library_explode(spark, sf_dir):
    c = _c(spark, sf_dir)
    return documents.library_roundtrip(c.library)


def recommend_from_documents(spark, sf_dir):
    """Recommendations computed from JSON documents: every profile, library
    and friend list is rendered to its document form, parsed back with the
    explicit document schemas and exploded, then recommended on.  The libraries
    are read for the top games and the owned ones; parsed, they are stored once."""
    c = _c(spark, sf_dir)
    lib = materialize(documents.library_from_pages(documents.library_documents(c.library)), "parsed_library")
    edges = documents.friend_edge_from_pages(documents.friend_documents(c.friend_edge))
    prof = documents.profile_from_documents(documents.parse_payload(documents.profile_documents(c.profile), "user"))
    return rec.recommend(lib, edges, prof, k=10)


def recommend_from_damaged_documents(spark, sf_dir):
    """As ``recommend_from_documents``, with a fixed share of damaged input:
    profiles of accounts divisible by 6 and libraries of accounts ending in 3
    do not parse, and every friend entry at position 3, 10, 17, ... holds an id
    that is no 64-bit integer.  Damaged documents and entries count as absent."""
    c = _c(spark, sf_dir)
    acc = F.col("account_id")

    def damaged(docs, where):
        return docs.withColumn("payload", F.when(where, F.lit('{"response": {broken')).otherwise(F.col("payload")))

    lib_docs = damaged(documents.library_documents(c.library), F.pmod(acc, F.lit(10)) == 3)
    lib = materialize(documents.library_from_pages(lib_docs), "parsed_library")
    bad_id = F.when(F.pmod("pos", F.lit(7)) == 3, F.lit("99999999999999999999")).otherwise(F.col("friend_id").cast("string"))
    edges = documents.friend_edge_from_pages(documents.friend_documents(c.friend_edge.withColumn("friend_id", bad_id)))
    prof_docs = damaged(documents.profile_documents(c.profile), F.pmod(acc, F.lit(6)) == 0)
    prof = documents.profile_from_documents(documents.parse_payload(prof_docs, "user"))
    return rec.recommend(lib, edges, prof, k=10)


def profile_summary_from_documents(spark, sf_dir):
    c = _c(spark, sf_dir)
    prof = documents.profile_from_documents(documents.parse_payload(documents.profile_documents(c.profile), "user"))
    return profile_ops.profile_summary(prof)


def game_defaults(spark, sf_dir):
    c = _c(spark, sf_dir)
    return lib_ops.game_defaults(c.library)


def library_top15(spark, sf_dir):
    c = _c(spark, sf_dir)
    return lib_ops.library_top(c.library)


def library_hours(spark, sf_dir):
    return lib_ops.library_hours(library_top15(spark, sf_dir))


def most_played(spark, sf_dir):
    c = _c(spark, sf_dir)
    return lib_ops.most_played(c.library)


def library_from_containers(spark, sf_dir):
    """Every library as documents in container files, read back and flattened."""
    path = _sink_dir(spark, "containers")
    containers.write_containers(documents.library_documents(_c(spark, sf_dir).library), path)
    return documents.library_from_pages(containers.container_rows(spark, path))


def document_summary(spark, sf_dir):
    """Profile, library, friend-list and news documents in one VARIANT column, read by path."""
    c = _c(spark, sf_dir)
    news_docs = testmap.news_snapshot(c.t).select("kind", "key", "page", "payload")

    def of(kind, docs):
        page = F.col("page").cast("bigint") if "page" in docs.columns else F.lit(0).cast("bigint")
        return docs.select(F.lit(kind).alias("kind"), F.col("account_id").alias("key"), page.alias("page"), "payload")

    docs = of("user", documents.profile_documents(c.profile)).unionByName(of("game", documents.library_documents(c.library)))
    docs = docs.unionByName(of("friend", documents.friend_documents(c.friend_edge))).unionByName(news_docs)
    return opaque.document_summary(docs)


# --- snapshots ---------------------------------------------------------------------

def snapshot_latest(spark, sf_dir):
    c = _c(spark, sf_dir)
    return snapshots.latest_snapshots(c.snapshot)


def snapshot_fresh(spark, sf_dir):
    c = _c(spark, sf_dir)
    return snapshots.snapshot_freshness(snapshots.newest_times(c.snapshot), testmap.snapshot_now()).select(
        "kind", "key", "fetched_at", "age_seconds", "is_fresh"
    )


def snapshot_refresh_list(spark, sf_dir):
    c = _c(spark, sf_dir)
    wanted = snapshots.wanted_documents(c.accounts)
    return snapshots.refresh_list(wanted, c.snapshot, testmap.snapshot_now())


def snapshot_refresh_list_nocache(spark, sf_dir):
    """Refresh list of the no-cache benchmark mode: profiles with the
    0.5 s "latest" ttl, libraries and friend lists with the normal ttl."""
    c = _c(spark, sf_dir)
    wanted = snapshots.wanted_documents(c.accounts)
    return snapshots.refresh_list(wanted, c.snapshot, testmap.snapshot_now(), snapshots.NO_CACHE_TTL)


def snapshot_cache_hits(spark, sf_dir):
    c = _c(spark, sf_dir)
    wanted = snapshots.wanted_documents(c.accounts)
    return snapshots.cache_hits(wanted, c.snapshot, testmap.snapshot_now())


def _stored_log(spark, c):
    """The snapshot log appended in batches, a week of fetches each, as a fetcher would."""
    path = _sink_dir(spark, "snapshots")
    week = F.floor(F.timestamp_diff("DAY", F.lit(testmap.FIRST_FETCH).cast("timestamp_ntz"), F.col("fetched_at")) / 7)
    numbered = materialize(c.snapshot.withColumn("week", week), "log")
    for r in numbered.select("week").distinct().orderBy("week").collect():
        snapshots.append_snapshots(numbered.filter(F.col("week").eqNullSafe(F.lit(r.week))), path)
    return path


def snapshot_latest_compacted(spark, sf_dir):
    """The newest documents from a log compacted twice on its way: after two weeks, and after all but the last."""
    c = _c(spark, sf_dir)
    path = _sink_dir(spark, "compacted")
    cut = [F.lit(t).cast("timestamp_ntz") for t in testmap.COMPACTED_AT]
    at = F.col("fetched_at")
    for part in (at < cut[0], (at >= cut[0]) & (at < cut[1])):
        snapshots.append_snapshots(c.snapshot.filter(part), path)
        compaction.compact(spark, path, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    snapshots.append_snapshots(c.snapshot.filter((at >= cut[1]) | at.isNull()), path)
    return compaction.latest_compacted(spark, path).select("kind", "key", "fetched_at", "payload")


def snapshot_hits_located(spark, sf_dir):
    """Cache hits from the stored log: places first, payloads of hit files after."""
    c = _c(spark, sf_dir)
    return compaction.located_hits(spark, _stored_log(spark, c), snapshots.wanted_documents(c.accounts), testmap.snapshot_now())


# --- run log, resources, news ----------------------------------------------------------

def runlog_parse(spark, sf_dir):
    return _c(spark, sf_dir).run_log


def runlog_averages(spark, sf_dir):
    return runlog.run_averages(_c(spark, sf_dir).run_log).orderBy("label")


def runlog_comparison(spark, sf_dir):
    return runlog.run_comparison(_c(spark, sf_dir).run_log).orderBy("friends")


def resource_averages(spark, sf_dir):
    c = _c(spark, sf_dir)
    return runlog.resource_averages(testmap.resource_sample(c.t))


def news_latest3(spark, sf_dir):
    c = _c(spark, sf_dir)
    return news.latest_news(testmap.news(c.t))


def news_from_snapshots(spark, sf_dir):
    """The newest items of each app, from news documents written to a snapshot table in pages and read back."""
    path = _sink_dir(spark, "news")
    snapshots.append_snapshots(testmap.news_snapshot(_c(spark, sf_dir).t), path)
    return news.latest_news(news.news_from_snapshots(snapshots.read_snapshots(spark, path)))


# --- sinks: written to the shared folder and read back ----------------------------------

def _sink_dir(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/sinks/{uuid.uuid4().hex}/{name}"


def runlog_sink(spark, sf_dir):
    """Timing lines appended to a log folder and parsed again."""
    path = _sink_dir(spark, "runlog")
    text.append_run_log(_c(spark, sf_dir).run_log, path)
    parsed, _ = text.parse_run_log(text.read_lines(spark, path))
    return parsed


def runlog_batches(spark, sf_dir):
    """Raw timing lines ingested in three batches, each of them twice (a retry): every line counts once."""
    path = _sink_dir(spark, "runlog_batches")
    lines = testmap.run_log_lines(_c(spark, sf_dir).t)
    part = F.pmod(F.xxhash64("value"), F.lit(3))
    for n in (0, 0, 1, 2, 1, 2):
        text.ingest_run_log(lines.filter(part == n), path, f"run-{n}")
    parsed, _ = text.parse_run_log(text.read_lines(spark, path))
    return parsed


def decimal_texts(spark, sf_dir):
    """Every event's value, and a thousandth and a millionth of it, as text with one to three decimals."""
    value = F.col("value")
    return _c(spark, sf_dir).t.events.select(
        "event_id",
        *[fixed_decimals(value, d).alias(f"value_{d}") for d in (1, 2, 3)],
        fixed_decimals(value / 1000, 3).alias("milli"),
        fixed_decimals(-value / 1000000, 3).alias("micro"),
        fixed_decimals(F.floor(value * 8) / 16, 1).alias("half"),
    )


def summary_report(spark, sf_dir):
    """The summary report's lines, written and read again."""
    path = _sink_dir(spark, "summary")
    runlog.write_summary(_c(spark, sf_dir).run_log, path)
    return text.read_lines(spark, path)


def resource_sink(spark, sf_dir):
    """Resource average lines appended to a log folder and read again."""
    path = _sink_dir(spark, "resources")
    runlog.append_resource_averages(testmap.resource_sample(_c(spark, sf_dir).t), path)
    return text.read_lines(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        recommend_one, recommend_all_k10, recommend_rank, recommend_sweep, recommend_sweep_by_appid,
        recommend_by_appid, recommend_hours, recommend_empty, top10_per_friend, owned_exclusion,
        recommend_after_delta, friends_used, friend_network, friend_count, profile_summary, account_status,
        account_selection, library_explode, library_from_containers, document_summary, recommend_from_documents, profile_summary_from_documents,
        game_defaults, library_top15, library_hours,
        most_played, snapshot_latest, snapshot_fresh, snapshot_refresh_list, snapshot_refresh_list_nocache,
        snapshot_cache_hits, snapshot_latest_compacted, snapshot_hits_located,
        runlog_parse, runlog_averages, runlog_comparison, resource_averages, news_latest3,
        recommend_from_damaged_documents, news_from_snapshots, runlog_sink, runlog_batches, decimal_texts, summary_report, resource_sink,
    ]
}

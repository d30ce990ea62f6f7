"""JSON documents, text logs, account lists, snapshots, news."""

import json
import os

from conftest import edges_df, library_df, profile_df
from pyspark.sql import functions as F

from playgraph.functions.timecols import ntz_literal
from playgraph.operators import news, runlog, snapshots
from playgraph.sources import documents, text


def _write(dirname, name, doc):
    os.makedirs(dirname, exist_ok=True)
    with open(os.path.join(dirname, name), "w") as f:
        json.dump(doc, f)


def test_library_documents_edge_cases(spark, tmpdir_fresh):
    # S18 (changed): explicit schema; empty and private libraries give no rows.
    d = os.path.join(tmpdir_fresh, "games")
    _write(d, "games_1.json", {"response": {}})
    _write(d, "games_2.json", {"response": {"games": []}})
    _write(d, "games_3.json", {"response": {"games": [{"appid": 7}, {"appid": 8, "name": "Eight", "playtime_forever": 5}]}})
    _write(d, "notes.json", {"response": {"games": [{"appid": 1}]}})  # not a library file name
    docs = documents.read_documents(spark, d, "game")
    lib = documents.library_from_documents(docs)
    assert [(r.account_id, r.pos, r.appid, r.name, r.playtime_min) for r in lib.orderBy("pos").collect()] == \
        [(3, 0, 7, None, None), (3, 1, 8, "Eight", 5)]
    st = {r.account_id: r.library_status for r in documents.library_status(docs).collect()}
    assert st == {1: "NO_DATA", 2: "NO_GAMES", 3: "OK"}
    rejects = [(r.path.rsplit("/", 1)[1], r.reason) for r in documents.document_rejects(spark, d, "game").collect()]
    assert rejects == [("notes.json", "name")]


def test_profile_documents_players_rules(spark, tmpdir_fresh):
    # Missing players -> defaults (found); empty players -> no player.
    d = os.path.join(tmpdir_fresh, "users")
    _write(d, "11.json", {"response": {}})
    _write(d, "12.json", {"response": {"players": []}})
    _write(d, "13.json", {"response": {"players": [{"personaname": "Zed", "timecreated": 86400}]}})
    prof = documents.profile_from_documents(documents.read_documents(spark, d, "user"))
    out = {r.account_id: r for r in prof.collect()}
    assert out[11].player_found and out[11].persona is None
    assert not out[12].player_found
    assert (out[13].persona, out[13].timecreated) == ("Zed", 86400)


def test_friend_documents_and_status(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "friends")
    _write(d, "friends_5.json", {"friendslist": {"friends": [{"steamid": "9"}, {"steamid": "8"}, {"steamid": "9"}]}})
    _write(d, "friends_6.json", {"friendslist": {"friends": []}})
    _write(d, "friends_7.json", {})
    docs = documents.read_documents(spark, d, "friend")
    e = documents.friend_edge_from_documents(docs)
    assert [(r.pos, r.friend_id) for r in e.orderBy("pos").collect()] == [(0, 9), (1, 8), (2, 9)]
    st = {r.account_id: r.friends_status for r in documents.friends_status(docs).collect()}
    assert st == {5: "OK", 6: "NO_FRIENDS", 7: "NO_DATA"}


def test_corrupt_document_is_reported_not_fatal(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "games")
    os.makedirs(d)
    with open(os.path.join(d, "games_4.json"), "w") as f:
        f.write("{not json")
    docs = documents.read_documents(spark, d, "game")
    r = docs.collect()[0]
    assert r.account_id == 4 and r.response is None and r[documents.CORRUPT]
    assert [x.reason for x in documents.document_rejects(spark, d, "game").collect()] == ["content"]


def test_corrupt_profile_is_no_player(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "users")
    _write(d, "1.json", {"response": {"players": [{"personaname": "A"}]}})
    with open(os.path.join(d, "2.json"), "w") as f:
        f.write("{broken")
    prof = documents.profile_from_documents(documents.read_documents(spark, d, "user"))
    assert [r.account_id for r in prof.collect()] == [1]
    payloads = spark.createDataFrame([(1, '{"response":{}}'), (2, "{broken")], "account_id bigint, payload string")
    prof = documents.profile_from_documents(documents.parse_payload(payloads, "user"))
    assert [(r.account_id, r.player_found) for r in prof.collect()] == [(1, True)]


def test_bad_ids_do_not_stop_the_job(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "friends")
    _write(d, "friends_1.json", {"friendslist": {"friends": [{"steamid": "7"}, {"steamid": "x"}, {"steamid": "9" * 20}]}})
    _write(d, f"friends_{'9' * 20}.json", {"friendslist": {"friends": []}})
    docs = documents.read_documents(spark, d, "friend")
    assert [(r.pos, r.friend_id) for r in documents.friend_edge_from_documents(docs).orderBy("pos").collect()] == [(0, 7), (1, None), (2, None)]
    assert [(r.pos, r.value) for r in documents.bad_friend_ids(docs).orderBy("pos").collect()] == [(1, "x"), (2, "9" * 20)]
    assert [r.reason for r in documents.document_rejects(spark, d, "friend").collect()] == ["name"]


def test_written_documents_keep_their_key(spark, tmpdir_fresh):
    lib = library_df(spark, [(a, i, 100 + i, f"g{i}", i * 3) for a in (1, 76561198061116734) for i in range(4)])
    out = os.path.join(tmpdir_fresh, "docs")
    documents.write_documents(documents.library_documents(lib), out, "game")
    assert "document=games_1.json" in os.listdir(out)
    back = documents.library_from_documents(documents.read_documents(spark, out, "game"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, lib.collect()))
    assert documents.document_rejects(spark, out, "game").count() == 0


def test_nested_round_trip_through_files(spark, tmpdir_fresh):
    # Flat -> paged JSON documents -> files -> read back -> flat, equal.
    lib = library_df(spark, [(1, i, 100 + i, f"g{i}", i * 3) for i in range(7)] + [(2, 0, 5, None, None)])
    pages = documents.library_documents(lib, page_size=3)
    out = os.path.join(tmpdir_fresh, "pages")
    pages.select("account_id", "page", "payload").write.parquet(out)
    back = documents.library_from_pages(spark.read.parquet(out), page_size=3)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, lib.collect()))
    e = edges_df(spark, [(1, i, 50 + i) for i in range(5)])
    back_e = documents.friend_edge_from_pages(documents.friend_documents(e, page_size=2), page_size=2)
    assert sorted(map(tuple, back_e.collect())) == sorted(map(tuple, e.collect()))
    p = profile_df(spark, [(1, True, "A", "US", 5), (2, False, None, None, None)])
    back_p = documents.profile_from_documents(documents.parse_payload(documents.profile_documents(p), "user"))
    assert sorted(map(tuple, back_p.collect())) == [(1, True, "A", "US", 5), (2, False, None, None, None)]


def test_run_log_parse_and_rejects(spark):
    # S22 (changed): no ':' -> skipped; two ':' or a non-number -> reject.
    lines = spark.createDataFrame([("a_x: 1.5",), ("a_x: 2.5 ",), ("junk",), ("a:b:1",), ("x: abc",), ("b: 1e3",)], "value string")
    parsed, rejects = text.parse_run_log(lines)
    assert sorted(map(tuple, parsed.collect())) == [("a_x", 1.5), ("a_x", 2.5), ("b", 1000.0)]
    assert sorted(r.value for r in rejects.collect()) == ["a:b:1", "x: abc"]
    avg = {r.label: (r.avg_ms, r.runs, r.line) for r in runlog.run_averages(parsed).collect()}
    assert avg["a_x"] == (2.0, 2, "a_x: 2.000 ms (avg over 2 runs)")


def test_run_log_comparison(spark):
    # Counts from labels with >= 4 parts and a digit third part; missing cells 0.0.
    log = spark.createDataFrame([
        ("spark_recommendation_10_friends_useCache", 4.0),
        ("spark_recommendation_10_friends_useCache", 6.0),
        ("manual_recommendation_25_friends_noCache", 1.0),
        ("api_fetch_profile_10", 9.0),
        ("spark_processing_10", 9.0),
    ], "label string, duration_ms double")
    out = {r.friends: r for r in runlog.run_comparison(log).collect()}
    assert set(out) == {10, 25}
    assert (out[10].spark_cached, out[10].manual_cached, out[10].spark_nocache) == (5.0, 0.0, 0.0)
    assert out[25].manual_nocache == 1.0
    assert out[10].line == f"{10:<10}{0.0:<18.3f}{0.0:<20.3f}{5.0:<18.3f}{0.0:.3f}"


def test_resource_averages_line(spark):
    s = spark.createDataFrame([("w", 10.0, 100.0), ("w", 20.0, 300.0)], "label string, cpu_pct double, rss_mb double")
    r = runlog.resource_averages(s).collect()[0]
    assert r.line == "w: AVG_CPU=15.00% AVG_MEM=200.00MB over 2 samples"


def test_account_list(spark):
    lines = spark.createDataFrame([(" 76561198061116734 ",), ("76561198061116734",), ("",), ("abc",)], "value string")
    ids, rejects = text.parse_account_list(lines)
    assert [r.account_id for r in ids.collect()] == [76561198061116734]
    assert [r.value for r in rejects.collect()] == ["abc"]
    lines = spark.createDataFrame([("9223372036854775807",), ("9223372036854775808",), ("0" * 20 + "5",)], "value string")
    ids, rejects = text.parse_account_list(lines)
    assert sorted(r.account_id for r in ids.collect()) == [5, 9223372036854775807]
    assert [r.value for r in rejects.collect()] == ["9223372036854775808"]


def test_snapshot_latest_fresh_refresh(spark):
    # Strict age < ttl; exactly ttl is stale.  Unknown kinds never fresh.
    snap = spark.createDataFrame([
        ("user", 1, "old", "2024-01-30 00:00:00"),
        ("user", 1, "new", "2024-01-30 14:00:00"),   # age exactly 36000 s
        ("game", 1, "g", "2024-01-30 14:00:01"),
        ("news", 1, "n", "2024-01-30 23:00:00"),
    ], "kind string, key bigint, payload string, fetched_at string").withColumn(
        "fetched_at", F.col("fetched_at").cast("timestamp_ntz"))
    now = ntz_literal("2024-01-31 00:00:00")
    latest = {(r.kind, r.key): r.payload for r in snapshots.latest_snapshots(snap).collect()}
    assert latest[("user", 1)] == "new"
    fresh = {(r.kind, r.key): r.is_fresh for r in snapshots.snapshot_freshness(snapshots.latest_snapshots(snap), now).collect()}
    assert fresh == {("user", 1): False, ("game", 1): True, ("news", 1): False}
    wanted = snapshots.wanted_documents(spark.createDataFrame([(1,), (2,)], "account_id bigint"))
    todo = sorted(map(tuple, snapshots.refresh_list(wanted, snap, now).collect()))
    assert todo == [("friend", 1), ("friend", 2), ("game", 2), ("user", 1), ("user", 2)]
    # "latest" mode: ttl 0.5 s
    assert snapshots.refresh_list(wanted, snap, now, ttl_seconds=0.5).count() == 6
    # no-cache benchmark mode (S21): only profiles use the 0.5 s ttl
    nocache = sorted(map(tuple, snapshots.refresh_list(wanted, snap, now, snapshots.NO_CACHE_TTL).collect()))
    assert nocache == todo


def test_news_latest_three_cut(spark):
    n = spark.createDataFrame([("a", i, "x" * (290 + i * 5)) for i in range(5)] + [("b", 1, "short")],
                              "app string, news_id bigint, body string")
    out = news.latest_news(n).collect()
    a = sorted((r.rank, r.news_id, len(r.contents), r.body_chars) for r in out if r.app == "a")
    assert a == [(1, 4, 300, 310), (2, 3, 300, 305), (3, 2, 300, 300)]
    assert [r.contents for r in out if r.app == "b"] == ["short"]


def test_sinks_round_trip(spark, tmpdir_fresh):
    # SNK-2: timing lines appended as text; SNK-3: both report sections;
    # SNK-4: resource lines appended.
    log_dir = os.path.join(tmpdir_fresh, "log")
    first = spark.createDataFrame([("spark_recommendation_10_friends_useCache", 1.2345)], "label string, duration_ms double")
    text.append_run_log(first, log_dir)
    text.append_run_log(first.selectExpr("label", "duration_ms + 1 AS duration_ms"), log_dir)
    lines = text.read_lines(spark, log_dir)
    assert sorted(r.value for r in lines.collect()) == sorted(
        f"spark_recommendation_10_friends_useCache: {v:.3f}" for v in (1.2345, 1.2345 + 1))
    parsed, _ = text.parse_run_log(lines)
    report = os.path.join(tmpdir_fresh, "report")
    runlog.write_summary(parsed, report)
    files = [f for f in os.listdir(report) if f.startswith("part-")]
    assert len(files) == 1
    body = open(os.path.join(report, files[0])).read().split("\n")
    assert body[0] == "=== Individual Averages ===" and body[2] == "" and body[3].startswith("=== Comparison Table")
    assert body[4] == f"{'Friends':<10}{'Manual (Cached)':<18}{'Manual (No Cache)':<20}{'Spark (Cached)':<18}{'Spark (No Cache)'}"
    assert body[5] == "-" * (len(body[4]) + 1) and body[6].startswith("10        ")
    res = spark.createDataFrame([("w", 1.0, 2.0)], "label string, cpu_pct double, rss_mb double")
    runlog.append_resource_averages(res, os.path.join(tmpdir_fresh, "res"))
    runlog.append_resource_averages(res, os.path.join(tmpdir_fresh, "res"))
    assert spark.read.text(os.path.join(tmpdir_fresh, "res")).count() == 2


def test_append_snapshots_partitioned_by_kind(spark, tmpdir_fresh):
    # SNK-1: appends never overwrite; readers take the newest row per key.
    path = os.path.join(tmpdir_fresh, "snapshot")
    schema = "kind string, key bigint, payload string, fetched_at string"
    first = spark.createDataFrame([("user", 1, "v1", "2024-01-01 00:00:00"), ("game", 1, "g1", "2024-01-01 00:00:00")], schema)
    second = spark.createDataFrame([("user", 1, "v2", "2024-01-02 00:00:00")], schema)
    for batch in (first, second):
        snapshots.append_snapshots(batch.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz")), path)
    assert sorted(d for d in os.listdir(path) if d.startswith("kind=")) == ["kind=game", "kind=user"]
    snap = spark.read.parquet(path)
    assert snap.count() == 3
    latest = {(r.kind, r.key): r.payload for r in snapshots.latest_snapshots(snap).collect()}
    assert latest == {("user", 1): "v2", ("game", 1): "g1"}
    plan = snap.filter("kind = 'user'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan  # per-kind reads prune partitions

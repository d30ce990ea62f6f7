"""Structured Streaming jobs with available-now triggers."""

import json
import os
import subprocess
import sys

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from playgraph.operators import snapshots
from playgraph.streaming import runlog_stream, snapshot_ingest


def _lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _run(queries):
    for q in queries if isinstance(queries, tuple) else (queries,):
        q.awaitTermination(120)


def test_runlog_summary_is_incremental(spark, tmpdir_fresh):
    log = os.path.join(tmpdir_fresh, "log")
    out = os.path.join(tmpdir_fresh, "summary")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    _lines(log, "a.txt", ["spark_recommendation_10_friends_useCache: 4.000",
                          "manual_recommendation_10_friends_noCache: 2.000", "junk", "x: y"])
    _run(runlog_stream.start_summary(spark, log, out, ckpt, available_now=True))
    avg = {r.label: (r.avg_ms, r.runs) for r in runlog_stream.current_summary(spark, out)[0].collect()}
    assert avg["spark_recommendation_10_friends_useCache"] == (4.0, 1)
    assert [r.value for r in spark.read.parquet(os.path.join(out, "rejects")).collect()] == ["x: y"]
    # A second pass appends to the log; the state carries the first pass.
    _lines(log, "b.txt", ["spark_recommendation_10_friends_useCache: 6.000"])
    _run(runlog_stream.start_summary(spark, log, out, ckpt, available_now=True))
    avg = {r.label: (r.avg_ms, r.runs) for r in runlog_stream.current_summary(spark, out)[0].collect()}
    assert avg["spark_recommendation_10_friends_useCache"] == (5.0, 2)
    cmp_ = runlog_stream.current_summary(spark, out)[1].collect()[0]
    assert (cmp_.friends, cmp_.spark_cached, cmp_.manual_nocache, cmp_.manual_cached) == (10, 5.0, 2.0, 0.0)


def test_snapshot_ingest_appends_and_latest_wins(spark, tmpdir_fresh):
    land = os.path.join(tmpdir_fresh, "landing")
    table = os.path.join(tmpdir_fresh, "snapshot")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    os.makedirs(os.path.join(land, "game"))
    os.makedirs(os.path.join(land, "user"))
    with open(os.path.join(land, "game", "games_7.json"), "w") as f:
        json.dump({"response": {"games": [{"appid": 1}]}}, f)
    with open(os.path.join(land, "user", "7.json"), "w") as f:
        json.dump({"response": {"players": []}}, f)
    with open(os.path.join(land, "user", "news_440.json"), "w") as f:   # S26: news is its own kind
        json.dump({"appnews": {"newsitems": []}}, f)
    _run(snapshot_ingest.start_ingest(spark, land, table, ckpt, available_now=True))
    os.makedirs(os.path.join(land, "game", "later"))
    with open(os.path.join(land, "game", "later", "games_7.json"), "w") as f:
        json.dump({"response": {"games": [{"appid": 2}]}}, f)
    os.utime(os.path.join(land, "game", "later", "games_7.json"), (2_000_000_000, 2_000_000_000))
    _run(snapshot_ingest.start_ingest(spark, land, table, ckpt, available_now=True))
    snap = spark.read.parquet(table)
    assert snap.count() == 4
    # A batch append is as visible as a streamed row, and a bad name is kept as a reject.
    extra = spark.createDataFrame([("game", 77, "{}", "2024-01-01 00:00:00")], "kind string, key bigint, payload string, fetched_at string")
    snapshots.append_snapshots(extra.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz")), table)
    with open(os.path.join(land, "game", "odd.txt"), "w") as f:
        f.write("?")
    with open(os.path.join(land, "user", f"{'9' * 20}.json"), "w") as f:
        f.write("{}")
    _run(snapshot_ingest.start_ingest(spark, land, table, ckpt, available_now=True))
    assert spark.read.parquet(table).filter("key = 77").count() == 1
    bad = {os.path.basename(r.path) for r in spark.read.parquet(table + "_rejects").collect()}
    assert bad == {"odd.txt", "9" * 20 + ".json"}
    snap = spark.read.parquet(table)
    latest = {(r.kind, r.key): json.loads(r.payload) for r in snapshots.latest_snapshots(snap).collect()}
    assert latest[("game", 7)]["response"]["games"][0]["appid"] == 2
    assert latest[("user", 7)] == {"response": {"players": []}}
    assert ("news", 440) in latest and ("user", 440) not in latest


def test_streams_refuse_a_missing_checkpoint(spark, tmpdir_fresh):
    for start in (snapshot_ingest.start_ingest, runlog_stream.start_summary):
        with pytest.raises(ValueError):
            start(spark, tmpdir_fresh, tmpdir_fresh, "")


RESTART = """
import sys
sys.path.insert(0, {root!r})
from playgraph.session import build_session
from playgraph.streaming import snapshot_ingest
spark = build_session("local[2]", conf={{"spark.sql.shuffle.partitions": "2"}})
snapshot_ingest.start_ingest(spark, {land!r}, {table!r}, {ckpt!r}, available_now=True).awaitTermination(120)
spark.stop()
"""


def test_restart_in_a_second_session_loses_nothing(spark, tmpdir_fresh):
    land, table, ckpt = (os.path.join(tmpdir_fresh, x) for x in ("landing", "table", "ckpt"))
    script = RESTART.format(root=ROOT, land=land, table=table, ckpt=ckpt)
    for n in (1, 2):
        _lines(land, f"games_{n}.json", ["{}"])
        subprocess.run([sys.executable, "-c", script], check=True, timeout=200, capture_output=True)
    assert sorted(r.key for r in spark.read.parquet(table).collect()) == [1, 2]

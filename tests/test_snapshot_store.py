"""Batches that count once, page sets, compaction and late payload reads."""

import os
import re

import pytest
from pyspark.sql import functions as F

from playgraph.functions.timecols import ntz_literal
from playgraph.operators import compaction, news, snapshots
from playgraph.sources import ledger

ROW = "kind string, key bigint, page bigint, pages int, payload string, at string"


def _docs(spark, rows):
    return spark.createDataFrame(rows, ROW).withColumn("fetched_at", F.col("at").cast("timestamp_ntz")).drop("at")


def _sets(df):
    return sorted((r.kind, r.key, r.page, r.payload) for r in df.collect())


def test_pages_of_a_fetch_appear_and_leave_together(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "snap")
    day = ["2024-01-0%d 00:00:00" % d for d in range(1, 6)]
    snapshots.append_snapshots(_docs(spark, [("news", 1, p, 3, f"old{p}", day[0]) for p in range(3)] + [("user", 1, None, None, "u", day[0])]), path)
    assert _sets(snapshots.latest_page_sets(snapshots.read_snapshots(spark, path))) == [("news", 1, p, f"old{p}") for p in range(3)] + [("user", 1, None, "u")]
    # A newer fetch of two pages: invisible until both are there, then the third page is gone.
    snapshots.append_snapshots(_docs(spark, [("news", 1, 0, 2, "new0", day[1])]), path)
    assert ("news", 1, 2, "old2") in _sets(snapshots.latest_page_sets(snapshots.read_snapshots(spark, path)))
    snapshots.append_snapshots(_docs(spark, [("news", 1, 1, 2, "new1", day[1])]), path)
    assert _sets(snapshots.latest_page_sets(snapshots.read_snapshots(spark, path)))[:2] == [("news", 1, 0, "new0"), ("news", 1, 1, "new1")]
    # A page sent twice counts once; null keys are a key of their own.
    snapshots.append_snapshots(_docs(spark, [("news", 1, 1, 2, "new1", day[1]), ("news", None, 5, None, "n", day[2]), ("news", None, 6, None, "m", day[1])]), path)
    got = _sets(snapshots.latest_page_sets(snapshots.read_snapshots(spark, path)).filter("key is not null"))
    assert got == [("news", 1, 0, "new0"), ("news", 1, 1, "new1"), ("user", 1, None, "u")]
    assert [(r.page, r.payload) for r in snapshots.latest_page_sets(snapshots.read_snapshots(spark, path)).filter("key is null").collect()] == [(5, "n")]


def test_a_batch_counts_once(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "snap")
    docs = _docs(spark, [("user", k, None, None, f"p{k}", "2024-01-01 00:00:00") for k in range(5)])
    for _ in range(3):
        snapshots.append_snapshots(docs, path, batch="s1-0")
    assert snapshots.read_snapshots(spark, path).count() == 5
    # Rows written without a commit (a job that died) are not read; the retry replaces them.
    docs.withColumn("batch", F.lit("s1-1")).write.mode("append").partitionBy("kind", "batch").parquet(path)
    assert spark.read.parquet(path).count() == 10 and snapshots.read_snapshots(spark, path).count() == 5
    snapshots.append_snapshots(docs, path, batch="s1-1")
    assert snapshots.read_snapshots(spark, path).count() == 10
    assert ledger.committed(spark, path) == ["s1-0", "s1-1"]


def test_missing_and_empty_tables(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "none")
    assert snapshots.read_snapshots(spark, path).count() == 0
    assert compaction.latest_compacted(spark, path).count() == 0
    wanted = spark.createDataFrame([("user", 1)], "kind string, key bigint")
    assert compaction.located_hits(spark, path, wanted, ntz_literal("2024-01-01 00:00:00")).count() == 0
    snapshots.append_snapshots(_docs(spark, []), path)
    assert snapshots.read_snapshots(spark, path).count() == 0
    with pytest.raises(Exception, match="UNABLE_TO_INFER|not a Parquet|CANNOT"):
        os.makedirs(path + "x")
        open(path + "x/part.parquet", "w").write("no table")
        ledger.read_or_empty(spark, path + "x", "a int").count()


def _history(seed_days, keys):
    return [("game" if k % 2 else "user", k, None, None, f"d{d}k{k}", "2024-01-%02d 00:00:00" % d) for d in seed_days for k in range(keys) if (k + d) % 3]


def test_compaction_keeps_what_counts(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "snap")
    pages = [("news", 1, p, 3, f"w{p}", "2024-01-03 00:00:00") for p in (0, 1)]  # waits for page 2
    snapshots.append_snapshots(_docs(spark, _history(range(1, 6), 30) + pages + [("news", 1, 0, 1, "first", "2024-01-01 00:00:00")]), path)
    compaction.compact(spark, path, buckets=4)
    assert compaction.retire_compacted(spark, path) and ledger.committed(spark, path) == []
    snapshots.append_snapshots(_docs(spark, _history(range(6, 9), 40) + [("user", None, None, None, "no key", "2024-01-01 00:00:00")]), path)
    base = compaction.newest_base(spark, path)
    assert spark.table(base.name).filter("kind <> 'news'").count() == 30
    assert [r[3] for r in _sets(compaction.latest_compacted(spark, path)) if r[0] == "news"] == ["first"]
    snapshots.append_snapshots(_docs(spark, [("news", 1, 2, 3, "w2", "2024-01-03 00:00:00")]), path)
    compaction.compact(spark, path)
    snapshots.append_snapshots(_docs(spark, [("user", 2, None, None, "late", "2024-02-01 00:00:00")]), path)
    want = {}
    for kind, key, _, _, payload, at in _history(range(1, 9), 30) + _history(range(6, 9), 40) + [("user", 2, None, None, "late", "2024-02-01 00:00:00")]:
        want[kind, key] = max(want.get((kind, key), ("", "")), (at, payload))
    got = _sets(compaction.latest_compacted(spark, path))
    assert [r for r in got if r[0] != "news"] == sorted((k, i, None, p) for (k, i), (_, p) in want.items())
    assert [r[3] for r in got if r[0] == "news"] == ["w0", "w1", "w2"]


def test_compacted_side_is_not_shuffled(spark, tmpdir_fresh):
    """Only the new batch is exchanged; a session that does not know the table finds its buckets again."""
    path = os.path.join(tmpdir_fresh, "snap")
    snapshots.append_snapshots(_docs(spark, _history(range(1, 6), 30)), path)
    name = compaction.compact(spark, path, buckets=8)
    snapshots.append_snapshots(_docs(spark, _history(range(6, 8), 30)), path)
    spark.sql(f"DROP TABLE `{name}`")  # an external table: its files stay
    out = compaction.latest_compacted(spark, path)
    assert out.count() == 30
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = compaction.latest_compacted(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)?, ([A-Z_]+)", plan)
    assert exchanges and all(why == "REPARTITION_BY_NUM" for _, _, why in exchanges), plan
    assert "Bucketed: true" in plan


def test_late_payloads_read_hit_files_only(spark, tmpdir_fresh, monkeypatch):
    path = os.path.join(tmpdir_fresh, "snap")
    for d in range(1, 5):
        snapshots.append_snapshots(_docs(spark, _history([d], 30)), path)
    now, wanted = ntz_literal("2024-01-04 06:00:00"), spark.createDataFrame([("user", 4), ("game", 7), ("user", 4), ("user", 1000)], "kind string, key bigint")
    seen = []
    real = compaction.recent_snapshots
    monkeypatch.setattr(compaction, "recent_snapshots", lambda rows, *a: seen.append(rows) or real(rows, *a))
    got = sorted(map(tuple, compaction.located_hits(spark, path, wanted, now).collect()))
    assert got == sorted(map(tuple, snapshots.cache_hits(wanted, snapshots.read_snapshots(spark, path), now).collect()))
    assert got == [("game", 7, "d4k7"), ("user", 4, "d4k4"), ("user", 4, "d4k4")]
    newest = ledger.committed(spark, path)[-1]
    files = seen[-1].inputFiles()
    assert files and all(f"batch={newest}" in f for f in files) and len(files) < len(spark.read.parquet(path).inputFiles())
    plan = real(seen[-1], now)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(fetched_at" in plan
    # The other ways: the whole folder when too many files are hit, a shuffle join when too many rows are.
    monkeypatch.setattr(compaction, "MAX_FILES", 0)
    monkeypatch.setattr(compaction, "MAX_HITS", 0)
    assert sorted(map(tuple, compaction.located_hits(spark, path, wanted, now).collect())) == got


def test_news_rejects_are_listed(spark):
    good = '{"appnews":{"appid":1,"newsitems":[{"gid":"7","contents":"a"},{"gid":"x7","contents":"b"}]}}'
    log = _docs(spark, [("news", 1, 0, None, good, "2024-01-01 00:00:00"), ("news", 2, 0, None, "{broken", "2024-01-01 00:00:00")])
    assert [(r.app, r.news_id) for r in news.news_from_snapshots(log).collect()] == [(1, 7)]
    assert sorted(map(tuple, news.news_rejects(log).collect())) == [(1, "item", "x7"), (2, "document", "{broken")]

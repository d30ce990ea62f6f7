
import duckdb
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from playgraph.operators import news, status
from playgraph.plans.queries import QUERIES, Canonical
from playgraph.sources import documents, testmap
from playgraph.sources.tables import Tables, table_path


class Docs:
    """Stands in for ``Tables`` with a documents table of its own."""

    def __init__(self, documents):
        self.documents = documents


def test_news_from_snapshots_gives_true_lengths(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{table_path(SF_SMALL, 'documents')}')")
    want = con.execute("SELECT CAST(substr(app, 4) AS BIGINT), rank, news_id, contents, body_chars FROM "
                       f"({entry.oracle_sql()['news_latest3']})").fetchall()
    got = QUERIES["news_from_snapshots"](spark, SF_SMALL).select("app", "rank", "news_id", "contents", "body_chars")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert max(r[4] for r in want) > 300


def test_news_snapshot_holds_every_item_whole(spark):
    t = Tables(spark, SF_SMALL)
    stored = testmap.news_snapshot(t)
    items = news.news_from_snapshots(stored).select("news_id", "body")
    docs = t.documents.select("doc_id", "text")
    assert items.count() == docs.count()
    assert items.exceptAll(docs).count() == 0 and docs.exceptAll(items).count() == 0
    assert stored.count() > stored.select("key").distinct().count()


def test_news_of_any_source_name(spark):
    names = ["src1", "src01", "blog", None, "src99999999999999999999"]
    rows = [(i, "x" * (290 + i), names[i % 5]) for i in range(500)]
    t = Docs(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    stored = testmap.news_snapshot(t)
    assert stored.count() == 5 * 8   # ids 0..499 in pages of 64 ids
    keys = spark.createDataFrame([(n,) for n in names], "app string").select("app", testmap.news_key(F.col("app")).alias("key"))
    key = {r.app: r.key for r in keys.collect()}
    assert len(set(key.values())) == 5 and key["src1"] == 1 and key[None] is None
    got = {(r.app, r.rank, r.news_id, r.body_chars) for r in news.latest_news(news.news_from_snapshots(stored)).collect()}
    assert got == {(key[names[k]], n + 1, 495 + k - 5 * n, 290 + 495 + k - 5 * n) for k in range(5) for n in range(3)}


def test_newer_page_supersedes_only_itself(spark):
    def doc(*items):
        return '{"appnews":{"appid":1,"newsitems":[' + ",".join(f'{{"gid":"{g}","contents":"{c}"}}' for g, c in items) + "]}}"

    log = spark.createDataFrame(
        [("news", 1, 0, doc((1, "a"), (2, "b")), "2024-01-01 00:00:00"), ("news", 1, 0, doc((2, "new")), "2024-01-02 00:00:00"),
         ("news", 1, 1, doc((9, "c")), "2024-01-01 00:00:00"), ("user", 1, 0, "{}", "2024-01-03 00:00:00")],
        "kind string, key bigint, page bigint, payload string, at string",
    ).withColumn("fetched_at", F.col("at").cast("timestamp_ntz"))
    got = {(r.app, r.news_id, r.body) for r in news.news_from_snapshots(log).collect()}
    assert got == {(1, 2, "new"), (1, 9, "c")}


def test_whole_friend_lists_reach_the_operators(spark, monkeypatch):
    seen = []
    real = documents.friend_documents, status.account_status
    monkeypatch.setattr(documents, "friend_documents", lambda edges: seen.append(edges) or real[0](edges))
    monkeypatch.setattr(status, "account_status", lambda accounts, **t: seen.append(t["friend_edge"]) or real[1](accounts, **t))
    sf = "/root/testdata/sf0.01"
    for name in ("recommend_from_documents", "recommend_from_damaged_documents", "account_status"):
        QUERIES[name](spark, sf)
    whole = testmap.friend_edge(Tables(spark, sf))
    reached = whole.filter(F.pmod("account_id", F.lit(9)) > 1)   # the status mapping's accounts with a friend list
    assert [e.count() for e in seen] == [whole.count(), whole.count(), reached.count()]


def test_account_status_of_unfiltered_tables(spark):
    c = Canonical(spark, SF_SMALL)
    got = {tuple(r) for r in status.account_status(c.accounts, c.profile, c.pairs, c.friend_edge).collect()}
    ids = [r.account_id for r in c.accounts.collect()]
    owners = {r.account_id for r in c.pairs.select("account_id").distinct().collect()}
    friends = {i: [] for i in ids}
    for r in c.friend_edge.collect():
        friends[r.account_id].append((r.pos, r.friend_id))
    want = set()
    for i in ids:
        usable = any(f % 13 and f in owners for p, f in friends[i] if p < 10)
        want.add((i, "OK" if i % 13 else "NO_PROFILE", "OK" if i in owners else "NO_DATA",
                  "OK" if friends[i] else "NO_DATA", "OK" if usable else "NO_CANDIDATES"))
    assert got == want and len(got) == len(ids)

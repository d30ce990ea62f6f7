"""News per app: newest items first, bodies cut to the requested length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.operators.snapshots import latest_page_sets, latest_snapshots


NEWS_DOC = "appnews struct<appid:bigint,newsitems:array<struct<gid:string,contents:string,date:bigint>>>"


def news_documents(snapshot: DataFrame) -> DataFrame:
    """key, payload of the stored news documents that count.

    With ``pages`` (a stored table) these are all pages of each app's newest
    complete fetch; with ``page`` alone the newest document of each (app, page);
    with neither the newest document of each app.
    """
    rows = snapshot.filter(F.col("kind") == "news")
    if "pages" in snapshot.columns:
        return latest_page_sets(rows).select("key", "payload")
    return latest_snapshots(rows, ["kind", "key", *(["page"] if "page" in snapshot.columns else [])]).select("key", "payload")


def _items(documents: DataFrame) -> DataFrame:
    return documents.select("key", F.explode(F.from_json("payload", NEWS_DOC)["appnews"]["newsitems"]).alias("item"))


def news_from_snapshots(snapshot: DataFrame) -> DataFrame:
    """app, news_id, body from the stored news documents that count (``news_documents``).

    Items whose id is no 64-bit integer, and documents that do not parse, give
    no row; ``news_rejects`` lists them.
    """
    news_id = F.col("item.gid").try_cast("bigint")
    items = _items(news_documents(snapshot))
    return items.select(F.col("key").alias("app"), news_id.alias("news_id"), F.col("item.contents").alias("body")).filter(F.col("news_id").isNotNull())


def news_rejects(snapshot: DataFrame) -> DataFrame:
    """app, reason (``document`` or ``item``), value: documents that do not parse and items without a 64-bit id."""
    documents = news_documents(snapshot)
    parsed = F.from_json("payload", NEWS_DOC)["appnews"]["newsitems"]
    unread = documents.filter(parsed.isNull()).select(F.col("key").alias("app"), F.lit("document").alias("reason"), F.col("payload").alias("value"))
    items = _items(documents).filter(F.col("item.gid").try_cast("bigint").isNull())
    return unread.unionByName(items.select(F.col("key").alias("app"), F.lit("item").alias("reason"), F.col("item.gid").alias("value")))


def latest_news(news: DataFrame, per_app: int = S.NEWS_PER_APP, max_chars: int = S.NEWS_MAX_CHARS) -> DataFrame:
    """app, rank, news_id, contents, body_chars.

    The cut body is projected before the window so the shuffle carries at
    most ``max_chars`` characters per row; ``body_chars`` is measured on the
    whole body.  ``rank <= per_app`` becomes a partial ``WindowGroupLimit``,
    so an app with a third of all items ships ≤ ``per_app`` rows per task.
    """
    n = news.select(
        "app",
        "news_id",
        F.substring("body", 1, max_chars).alias("contents"),
        F.char_length("body").cast("bigint").alias("body_chars"),
    )
    w = Window.partitionBy("app").orderBy(F.desc("news_id"))
    return (
        n.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= per_app)
        .select("app", "rank", "news_id", "contents", "body_chars")
    )

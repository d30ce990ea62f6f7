"""Library views: most played games, hours matrix, single most played game."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.functions.formats import floor_div, hours_minutes_label, profile_url, whole_hours_label
from playgraph.operators import for_account
from playgraph.operators.recommend import game_triple


def game_defaults(library: DataFrame, account_id: int | None = None) -> DataFrame:
    """account_id, pos, appid, name, playtime with per-game defaults."""
    return game_triple(for_account(library, account_id), owner="account_id")


def library_top(library: DataFrame, n: int = S.HABITS_TOP, account_id: int | None = None) -> DataFrame:
    """account_id, rank, appid, name, total_playtime: the ``n`` most played
    games with playtime > 0; ties keep library order.

    The window carries a ``rank <= n`` filter, which Spark plans as a partial
    ``WindowGroupLimit`` before the shuffle: a huge library ships ≤ n rows
    per map task.
    """
    g = for_account(library, account_id).select(
        "account_id", "pos", "appid", "name", F.col("playtime_min").alias("total_playtime")
    ).filter(F.col("total_playtime") > 0)
    w = Window.partitionBy("account_id").orderBy(F.desc("total_playtime"), F.asc("pos"))
    return (
        g.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= n)
        .select("account_id", "rank", "appid", "name", "total_playtime")
    )


def library_hours(top: DataFrame) -> DataFrame:
    """account_id, rank, name, hours (whole, floored), hours_label (``1,234 hrs``)."""
    return top.select(
        "account_id",
        "rank",
        "name",
        floor_div("total_playtime", 60).alias("hours"),
        whole_hours_label("total_playtime").alias("hours_label"),
    )


def most_played(library: DataFrame, account_id: int | None = None) -> DataFrame:
    """account_id, appid, game, playtime_min, playtime_label, profile_url.

    One aggregate with a map-side partial step: ``max`` of (playtime, -pos,
    appid, name) picks the most played game, earliest in the library on
    ties.  The buffer holds the name, so Spark runs it sort-based; the
    partial step still reduces a huge library to one row per map task.
    """
    g = game_triple(for_account(library, account_id), owner="account_id")
    best = F.max(F.struct(F.col("playtime"), (-F.col("pos")).alias("neg_pos"), "appid", "name")).alias("best")
    agg = g.groupBy("account_id").agg(best)
    return agg.select(
        "account_id",
        F.col("best.appid").alias("appid"),
        F.col("best.name").alias("game"),
        F.col("best.playtime").alias("playtime_min"),
        hours_minutes_label(F.col("best.playtime")).alias("playtime_label"),
        profile_url("account_id").alias("profile_url"),
    )

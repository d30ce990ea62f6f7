"""Friend overview: the first friends of each account with name and country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.operators import for_account


def friend_network(
    friend_edge: DataFrame, profile: DataFrame, n: int = S.FRIENDS_SHOWN, account_id: int | None = None
) -> DataFrame:
    """account_id, pos, friend_id, name, country, profile_found.

    A friend without a usable profile keeps its row with the defaults
    (``Unknown``, ``—``) and ``profile_found = false`` instead of failing the
    whole overview.  ``pos < n`` on the exploded list needs no sort.
    """
    edges = for_account(friend_edge, account_id).filter(F.col("pos") < n)
    p = profile.select(
        F.col("account_id").alias("friend_id"),
        F.col("player_found").alias("__found"),
        F.col("persona").alias("__persona"),
        F.col("country").alias("__country"),
    )
    found = F.coalesce(F.col("__found"), F.lit(False))
    return edges.join(p, "friend_id", "left").select(
        "account_id",
        "pos",
        "friend_id",
        F.coalesce(F.when(found, F.col("__persona")), F.lit(S.DEFAULT_NAME)).alias("name"),
        F.coalesce(F.when(found, F.col("__country")), F.lit(S.DEFAULT_COUNTRY_FRIEND)).alias("country"),
        found.alias("profile_found"),
    )


def friend_count(friend_edge: DataFrame, n: int = S.FRIENDS_SHOWN, account_id: int | None = None) -> DataFrame:
    """account_id, friends_shown = min(n, list length) (partial + final count)."""
    return (
        for_account(friend_edge, account_id).filter(F.col("pos") < n)
        .groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("friends_shown"))
    )

"""Per-account validity checks, as one status row per account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.operators import for_account
from playgraph.operators.recommend import own_exchange


def account_status(
    accounts: DataFrame,
    profile: DataFrame,
    library: DataFrame,
    friend_edge: DataFrame,
    k: int = S.FRIENDS_USED,
    account_id: int | None = None,
    library_docs: DataFrame | None = None,
    friend_docs: DataFrame | None = None,
) -> DataFrame:
    """account_id, profile_status, library_status, friends_status, recommend_status.

    profile:   NO_DATA (no document) | NO_PROFILE (no player) | OK
    library:   NO_DATA (no document) | NO_GAMES (empty list) | NO_PLAYTIME (no game ever played) | OK
    friends:   NO_DATA (no document) | NO_FRIENDS (empty list) | OK
    recommend: NO_CANDIDATES (no friend contributes a game) | OK

    ``library_docs`` and ``friend_docs`` (column account_id) name the accounts
    that have a document of the kind; without them only accounts with rows do,
    and an account without rows is NO_DATA.  One account is a filter on the
    account side only: its friends are looked up in the whole library.

    Every side is reduced to one row per account with partial + final
    aggregation before it meets ``accounts``.
    """
    owners = library.groupBy(F.col("account_id").alias("friend_id")).agg(F.count(F.lit(1)).alias("__owned"))
    accounts, library, friend_edge = (for_account(x, account_id) for x in (accounts, library, friend_edge))
    prof = profile.groupBy("account_id").agg(F.max(F.col("player_found").cast("int")).alias("__found"))
    lib = library.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("__games"), F.max(F.coalesce(F.col("playtime_min"), F.lit(0))).alias("__most")
    )
    fr = friend_edge.groupBy("account_id").agg(F.count(F.lit(1)).alias("__friends"))
    # A friend contributes candidates exactly when it is usable (first k, has
    # a player) and owns a game.  Owners and players are one row per account, so
    # they meet first; the computed key keeps that stage's partitioning from
    # reaching the edge join, which so gets exchanges of its own that AQE can
    # split when one friend is in very many lists.
    players = profile.filter(F.col("player_found")).select(F.col("account_id").alias("friend_id")).distinct()
    usable = players.join(owners.select("friend_id"), "friend_id").select(own_exchange("friend_id").alias("friend_id"))
    cands = (
        friend_edge.filter(F.col("pos") < k)
        .select("account_id", "friend_id")
        .join(usable, "friend_id")
        .groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("__cands"))
    )
    a = accounts.select("account_id").distinct()
    j = a.join(prof, "account_id", "left").join(lib, "account_id", "left")
    j = j.join(fr, "account_id", "left").join(cands, "account_id", "left")
    for docs, flag in ((library_docs, "__lib_doc"), (friend_docs, "__fr_doc")):
        if docs is None:
            j = j.withColumn(flag, F.lit(False))
        else:
            seen = docs.select("account_id").distinct().withColumn(flag, F.lit(True))
            j = j.join(seen, "account_id", "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return j.select(
        "account_id",
        F.when(F.col("__found").isNull(), F.lit(S.NO_DATA))
        .when(F.col("__found") == 0, F.lit(S.NO_PROFILE))
        .otherwise(F.lit(S.OK)).alias("profile_status"),
        F.when(F.col("__games").isNull(), F.when(F.col("__lib_doc"), F.lit(S.NO_GAMES)).otherwise(F.lit(S.NO_DATA)))
        .when(F.col("__most") <= 0, F.lit(S.NO_PLAYTIME))
        .otherwise(F.lit(S.OK)).alias("library_status"),
        F.when(F.col("__friends").isNull(), F.when(F.col("__fr_doc"), F.lit(S.NO_FRIENDS)).otherwise(F.lit(S.NO_DATA)))
        .otherwise(F.lit(S.OK)).alias("friends_status"),
        F.when(F.col("__cands").isNull(), F.lit(S.NO_CANDIDATES)).otherwise(F.lit(S.OK)).alias("recommend_status"),
    )

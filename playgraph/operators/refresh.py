"""Recommendations kept up to date: only accounts that a change can reach are computed again.

A changed library or profile reaches its own account and every account that has
it among its first ``k`` friends (the edge table read backwards); a changed
friend list reaches its own account.  Everything else keeps its stored rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.operators import recommend as rec
from playgraph.plans.batch import materialize


def affected_accounts(friend_edge: DataFrame, changed: DataFrame, changed_lists: DataFrame | None = None, k: int = S.FRIENDS_USED) -> DataFrame:
    """account_id of every account whose recommendations may differ.

    ``changed`` (account_id) names accounts whose library or profile is not the
    stored one any more, ``changed_lists`` those whose friend list is not.  An
    account that lost a friend is in ``changed_lists``, so the new edges suffice.
    """
    ids = changed.select("account_id").distinct()
    # A changed account that sits in a third of all lists skews the join; both sides get an exchange AQE can split.
    first = friend_edge.filter(F.col("pos") < k).select("account_id", rec.own_exchange("friend_id").alias("friend_id"))
    reached = first.join(ids.withColumnRenamed("account_id", "friend_id"), "friend_id", "left_semi").select("account_id")
    found = ids.union(reached)
    if changed_lists is not None:
        found = found.union(changed_lists.select("account_id"))
    return found.filter(F.col("account_id").isNotNull()).distinct()


def refresh_recommendations(
    previous: DataFrame,
    library: DataFrame,
    friend_edge: DataFrame,
    profile: DataFrame,
    changed: DataFrame,
    changed_lists: DataFrame | None = None,
    k: int = S.FRIENDS_USED,
    mode: str = rec.BY_NAME,
    top_n: int | None = S.RECOMMENDATIONS,
    owned: DataFrame | None = None,
) -> DataFrame:
    """``recommend`` of the new tables, from ``previous`` (its result on the old ones) and what changed.

    Affected accounts and the friends they use are stored first; library, owned
    games and edges are cut to them before anything is ranked or joined.
    """
    owned = library if owned is None else owned
    affected = materialize(affected_accounts(friend_edge, changed, changed_lists, k), "affected")
    edges = materialize(friend_edge.filter(F.col("pos") < k).join(affected, "account_id", "left_semi"), "affected_edges")
    friends = edges.select(F.col("friend_id").alias("account_id")).distinct()
    new = rec.recommend(
        library.join(friends, "account_id", "left_semi"),
        edges,
        profile.join(friends, "account_id", "left_semi"),
        k=k,
        mode=mode,
        top_n=top_n,
        owned=owned.join(affected, "account_id", "left_semi"),
    )
    return previous.join(affected, "account_id", "left_anti").select(new.columns).unionByName(new)

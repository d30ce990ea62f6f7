"""Friend-based game recommendations for every account in one job.

Plan (per account, K friends):

    friend_edge(pos < K) ⋈ profile(player found)          -- friends used
        ⋈ top_games_per_owner(library)                     -- ≤ 10 per friend
        ⋉̸ owned (account, appid null-safe)                 -- owned removed
        -> group by (account, game): sum playtime, first encounter
        -> row_number per account ≤ 10

Scale notes:
* ``top_games_per_owner`` is computed once per owner, not per edge; Spark
  plans it with a partial ``WindowGroupLimit`` before the shuffle, so even an
  account owning a third of all rows ships only ≤ 10 rows per map task.
* Candidates are bounded per account (K × 10), so they are hashed on the
  account alone and cross the network once, as lists: one row per friend with
  its games.  Exclusion, sums (a hash aggregate; the encounter order is one
  bigint) and ranks then need no exchange, and nothing is cut or multiplied
  before it moves.  A sweep over several friend counts is one conditional
  aggregation, not one per count; its partitions grow with the friends.
* Owned games are removed before the aggregate (exclusion depends only on
  (account, appid), so the order does not change the answer), by an anti-join
  with one set per account.  A library of more than ``LARGE_LIBRARY`` games is
  first cut to the account's candidates, hashed on (account, appid), so that
  even an account owning a third of all rows gives a small set.
* Candidates carry the number of a game's name (``number_names``); the ranked
  rows get the name back.  Where every candidate is returned, the names travel
  with the lists instead.  Accounts, games and orders grow with the input and
  compress well in Parquet, so joins with them are never broadcast.
* A friend that sits in a third of all friend lists makes the edge side of
  the ``friend_id`` join skewed.  Players and their top games meet first (≤ 10
  rows per friend) and the edges are joined to that once; both sides of that
  join have exchanges of their own, so AQE's skew-join split applies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.functions.formats import hours_one_decimal, hours_one_decimal_label, unknown_game_name
from playgraph.session import materialize

BY_NAME = "by_name"    # group by (appid, name): the DataFrame path
BY_APPID = "by_appid"  # group by appid, last seen name: the hand-written path


def game_triple(library: DataFrame, owner: str = "owner_id") -> DataFrame:
    """(owner, pos, appid, name, playtime) with the per-game defaults:
    name ``Unknown (appid)``, playtime 0."""
    return library.select(
        F.col("account_id").alias(owner),
        "pos",
        "appid",
        F.coalesce(F.col("name"), unknown_game_name("appid")).alias("name"),
        F.coalesce(F.col("playtime_min"), F.lit(0).cast("bigint")).alias("playtime"),
    )


def top_games_per_owner(library: DataFrame, n: int = S.GAMES_PER_FRIEND) -> DataFrame:
    """owner_id, rank_in_friend, pos, appid, name, playtime: each owner's
    ``n`` most played games; ties keep library order (stable sort)."""
    g = game_triple(library)
    w = Window.partitionBy("owner_id").orderBy(F.desc("playtime"), F.asc("pos"))
    return g.withColumn("rank_in_friend", F.row_number().over(w)).filter(F.col("rank_in_friend") <= n)


def friends_with_profile(friend_edge: DataFrame, profile: DataFrame, k: int) -> DataFrame:
    """account_id, friend_pos, friend_id, friend_name for the first ``k``
    friends whose profile has a player (others are skipped entirely)."""
    edges = friend_edge.filter(F.col("pos") < k).select(
        "account_id", F.col("pos").alias("friend_pos"), "friend_id"
    )
    players = profile.filter(F.col("player_found")).select(
        F.col("account_id").alias("friend_id"),
        F.coalesce(F.col("persona"), F.lit(S.DEFAULT_NAME)).alias("friend_name"),
    )
    return edges.join(players.hint("merge"), "friend_id")


def own_exchange(key: str) -> Column:
    """The same bigint key as a computed column.

    A table that was just joined or ranked by ``key`` is already partitioned on
    it, and a following join would run in that stage, where AQE does not split
    skewed partitions.  Under a computed key the join shuffles both sides anew.
    """
    return F.col(key).bitwiseXOR(F.lit(0).cast("bigint"))


def usable_top_games(profile: DataFrame, library: DataFrame, games_per_friend: int = S.GAMES_PER_FRIEND) -> DataFrame:
    """friend_id, rank_in_friend, appid, name, playtime: the top games of every account that has a player."""
    players = profile.filter(F.col("player_found")).select(F.col("account_id").alias("owner_id"))
    top = top_games_per_owner(library, games_per_friend).join(players.hint("merge"), "owner_id")
    return top.select(own_exchange("owner_id").alias("friend_id"), "rank_in_friend", "appid", "name", "playtime")


def candidate_games(
    friend_edge: DataFrame,
    profile: DataFrame,
    library: DataFrame,
    k: int = S.FRIENDS_USED,
    games_per_friend: int = S.GAMES_PER_FRIEND,
) -> DataFrame:
    """account_id, friend_pos, friend_id, rank_in_friend, appid, name,
    playtime: every game one of the first ``k`` usable friends contributes
    (before exclusion)."""
    return _of_friends(friend_edge, usable_top_games(profile, library, games_per_friend), k)


def _of_friends(friend_edge: DataFrame, top: DataFrame, k: int) -> DataFrame:
    """``candidate_games`` from the usable top games."""
    friends = friend_edge.filter(F.col("pos") < k).select("account_id", F.col("pos").alias("friend_pos"), "friend_id")
    return friends.join(top.hint("merge"), "friend_id").select(
        "account_id", "friend_pos", "friend_id", "rank_in_friend", "appid", "name", "playtime"
    )


LISTED = ("rank_in_friend", "appid", "name", "playtime")


def friend_lists(top: DataFrame) -> DataFrame:
    """friend_id and its games: a list per column of ``LISTED``, in rank order.

    One row per friend: what the candidates repeat is the list, not every game's row.
    """
    games = top.groupBy("friend_id").agg(F.sort_array(F.collect_list(F.struct(*LISTED))).alias("games"))
    return games.select(own_exchange("friend_id").alias("friend_id"), *[F.col("games")[c].alias(c) for c in LISTED])


def _each_game(lists: DataFrame) -> DataFrame:
    """A row per game from rows of ``LISTED`` lists."""
    others = [c for c in lists.columns if c not in LISTED]
    rows = lists.select(*others, F.posexplode("appid").alias("__i", "__appid"), *[c for c in LISTED if c != "appid"])
    return rows.select(*others, *[F.col("__appid").alias(c) if c == "appid" else F.get(c, F.col("__i")).alias(c) for c in LISTED])


def _by_account(df: DataFrame, k: int) -> DataFrame:
    """``df`` hashed on the account; the candidates of an account grow with ``k``, and the partitions alike."""
    times = -(-k // S.FRIENDS_USED)
    if times == 1:
        return df.repartition("account_id")
    return df.repartition(times * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "account_id")


APP_NULL, APP_KEY = "__app_null", "__app_key"


def _with_app_keys(df: DataFrame) -> DataFrame:
    """Null-safe join keys for ``appid`` as two plain columns:
    (isnull(appid), coalesce(appid, 0)) equal exactly when ``appid <=> appid``."""
    return df.withColumn(APP_NULL, F.isnull("appid")).withColumn(
        APP_KEY, F.coalesce(F.col("appid"), F.lit(0).cast("bigint"))
    )


def _anti_owned(df: DataFrame, owned: DataFrame) -> DataFrame:
    """``df`` (with app keys) minus owned (account_id, appid); keeps the keys.

    Both sides are hashed on (account_id, app keys), which spreads even an
    account owning a third of all rows over many tasks, and the result stays
    clustered on those columns for a following aggregate.  Owned games grow
    with the orders, so they are never broadcast.
    """
    o = _with_app_keys(owned.select("account_id", "appid")).select(
        F.col("account_id").alias("__own_acc"),
        F.col(APP_NULL).alias("__own_null"),
        F.col(APP_KEY).alias("__own_key"),
    )
    cond = (
        (F.col("account_id") == F.col("__own_acc"))
        & (F.col(APP_NULL) == F.col("__own_null"))
        & (F.col(APP_KEY) == F.col("__own_key"))
    )
    return df.join(o.hint("merge"), cond, "left_anti")


def exclude_owned(df: DataFrame, owned: DataFrame) -> DataFrame:
    """Rows of ``df`` whose (account_id, appid) the account does not own.

    Null-safe: an owned null appid removes null-appid games (plain equality
    would keep them).  An equi-join on plain key columns, never a nested loop.
    """
    return _anti_owned(_with_app_keys(df), owned).drop(APP_NULL, APP_KEY)


LARGE_LIBRARY = 4096  # owned games from which an account's are cut to its candidates before they meet in one task


def owned_within_reach(owned: DataFrame, friend_edge: DataFrame, top: DataFrame, k: int) -> DataFrame:
    """account_id, appid: ``owned``, of accounts with large libraries only what is among their candidates.

    Accounts with large libraries are counted and stored first, their games in
    reach too; both are few.  Without any, ``owned`` is left as it is.
    """
    pairs = owned.select("account_id", "appid").filter(F.col("account_id").isNotNull())
    counted = pairs.groupBy("account_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LARGE_LIBRARY)
    large = materialize(counted.select("account_id"), "large_libraries")
    if large.isEmpty():
        return pairs
    theirs = _with_app_keys(_of_friends(friend_edge.join(large, "account_id", "left_semi"), top, k))
    mine = _with_app_keys(pairs.join(large, "account_id", "left_semi"))
    reached = mine.join(theirs.hint("merge"), ["account_id", APP_NULL, APP_KEY], "left_semi").select("account_id", "appid")
    return pairs.join(large, "account_id", "left_anti").unionByName(materialize(reached.distinct(), "owned_in_reach"))


def _not_owned(df: DataFrame, owned: DataFrame, k: int) -> DataFrame:
    """``df`` (hashed by ``_by_account``) minus owned (account_id, appid), in the task that holds the account.

    An account's owned games, bounded by ``owned_within_reach``, are one set
    with a flag for a null appid.
    """
    sets = _by_account(owned, k).groupBy("account_id").agg(
        F.collect_set("appid").alias("__own_apps"), F.max(F.isnull("appid")).alias("__own_null")
    ).withColumnRenamed("account_id", "__own_acc")
    own = F.when(F.isnull("appid"), F.col("__own_null")).otherwise(F.array_contains("__own_apps", F.col("appid")))
    return df.join(sets.hint("shuffle_hash"), (F.col("account_id") == F.col("__own_acc")) & own, "left_anti")


def number_names(games: DataFrame) -> DataFrame:
    """names_null, names_key, names_name, name_no: each name of an appid and its number among that appid's names.

    The candidates outnumber the top games by the friends that list them, so
    they carry the number and the chosen rows get their name back.  Rows are
    made distinct first: the window holds an appid's names, not its owners.
    """
    distinct = _with_app_keys(games.select("appid", "name")).select(
        F.col(APP_NULL).alias("names_null"), F.col(APP_KEY).alias("names_key"), F.col("name").alias("names_name")
    ).distinct()
    w = Window.partitionBy("names_null", "names_key").orderBy("names_name")
    return distinct.withColumn("name_no", F.row_number().over(w))


def _same_app(names: DataFrame) -> Column:
    return (F.col(APP_NULL) == names["names_null"]) & (F.col(APP_KEY) == names["names_key"])


def same_name(games: DataFrame, names: DataFrame) -> Column:
    return _same_app(names) & games["name"].eqNullSafe(names["names_name"])


def with_numbers(top: DataFrame, names: DataFrame) -> DataFrame:
    """``top`` with the names' numbers in place of the names."""
    return _with_app_keys(top).join(names.hint("merge"), same_name(top, names)).select(
        "friend_id", "rank_in_friend", "appid", F.col("name_no").alias("name"), "playtime"
    )


def with_names(ranked: DataFrame, names: DataFrame) -> DataFrame:
    """``ranked`` with the name itself in place of its number; the appid moves as its keys only."""
    keyed = _with_app_keys(ranked.withColumnRenamed("name", "__name_no")).drop("appid")
    named = keyed.join(names.hint("merge"), _same_app(names) & (F.col("__name_no") == names["name_no"]))
    return named.withColumn("name", F.col("names_name")).withColumn("appid", F.when(~F.col(APP_NULL), F.col(APP_KEY)))


ORDER_SHIFT = 1 << 32


def encounter_order() -> Column:
    """(friend_pos, rank_in_friend) as one bigint with the same order, so
    the aggregates keep fixed-width buffers (hash aggregation, no sort)."""
    return F.col("friend_pos").cast("bigint") * F.lit(ORDER_SHIFT) + F.col("rank_in_friend").cast("bigint")


def _counts(k: int, friend_counts: Sequence[int] | None) -> list[int]:
    return sorted({int(n) for n in friend_counts}) if friend_counts else [k]


def aggregate_wide(cands: DataFrame, mode: str, counts: Sequence[int]) -> DataFrame:
    """One row per (account_id, appid[, name]) with, for every friend count
    N, the summed playtime ``__tN`` and first encounter ``__fN`` over the
    candidates of the first N friends (null when none); by-appid adds the
    name last seen, ``__nN``.

    A single conditional aggregation serves every N: no candidate is
    duplicated per friend count before the shuffle.
    """
    largest = counts[-1]
    order = encounter_order()
    aggs = []
    for n in counts:
        inside = None if n == largest else F.col("friend_pos") < n
        pt = F.col("playtime") if inside is None else F.when(inside, F.col("playtime"))
        od = order if inside is None else F.when(inside, order)
        aggs += [F.sum(pt).cast("bigint").alias(f"__t{n}"), F.min(od).alias(f"__f{n}")]
        if mode == BY_APPID:
            aggs.append(F.max(od).alias(f"__l{n}"))
    # Grouping keys include the null-safe app keys when present, so an input
    # clustered on (account_id, app keys) needs no further exchange.
    keys = ["account_id"] + [c for c in (APP_NULL, APP_KEY) if c in cands.columns] + ["appid"]
    if mode == BY_NAME:
        return cands.groupBy(*keys, "name").agg(*aggs)
    if mode != BY_APPID:
        raise ValueError(f"unknown mode {mode!r}")
    # Sum per (appid, name) with hash aggregation first; the second step
    # picks, per appid, the name seen last (few rows per group).
    return merge_names(cands.groupBy(*keys, "name").agg(*aggs), counts)


def merge_names(by_name: DataFrame, counts: Sequence[int]) -> DataFrame:
    """``aggregate_wide`` by appid from its rows per (appid, name)."""
    keys = ["account_id"] + [c for c in (APP_NULL, APP_KEY) if c in by_name.columns] + ["appid"]
    aggs2 = []
    for n in counts:
        aggs2 += [
            F.sum(f"__t{n}").cast("bigint").alias(f"__t{n}"),
            F.min(f"__f{n}").alias(f"__f{n}"),
            F.max_by("name", F.col(f"__l{n}")).alias(f"__n{n}"),
        ]
    return by_name.groupBy(*keys).agg(*aggs2)


def to_long(wide: DataFrame, mode: str, counts: Sequence[int], sweep: bool) -> DataFrame:
    """account_id, [friends,] appid, name, total_playtime, first_seen."""
    def name(n):
        return F.col(f"__n{n}") if mode == BY_APPID else F.col("name")

    if not sweep:
        n = counts[0]
        return wide.select(
            "account_id", "appid", name(n).alias("name"),
            F.col(f"__t{n}").alias("total_playtime"), F.col(f"__f{n}").alias("first_seen"),
        )
    items = F.array(*[
        F.struct(
            F.lit(n).alias("friends"), name(n).alias("name"),
            F.col(f"__t{n}").alias("total_playtime"), F.col(f"__f{n}").alias("first_seen"),
        )
        for n in counts
    ])
    return (
        wide.select("account_id", "appid", F.explode(items).alias("x"))
        .filter(F.col("x.total_playtime").isNotNull())
        .select("account_id", "x.friends", "appid", "x.name", "x.total_playtime", "x.first_seen")
    )


def aggregate_candidates(
    cands: DataFrame, mode: str = BY_NAME, friend_counts: Sequence[int] | None = None, k: int = S.FRIENDS_USED
) -> DataFrame:
    """account_id, [friends,] appid, name, total_playtime, first_seen.

    ``first_seen`` encodes where the game was first met (friend position,
    then rank in that friend's list); it breaks ties in encounter order.
    """
    counts = _counts(k, friend_counts)
    return to_long(aggregate_wide(cands, mode, counts), mode, counts, bool(friend_counts))


def rank_per_account(agg: DataFrame, keys: Sequence[str], top_n: int | None) -> DataFrame:
    """Add ``rank`` (1-based) by total playtime, ties in encounter order.

    With ``top_n`` the filter becomes a partial ``WindowGroupLimit`` ahead of
    the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc("total_playtime"), F.asc("first_seen"))
    ranked = agg.withColumn("rank", F.row_number().over(w))
    if top_n is not None:
        ranked = ranked.filter(F.col("rank") <= top_n)
    return ranked.select(*keys, "rank", "appid", "name", "total_playtime")


def _kept(friend_edge: DataFrame, top: DataFrame, named: DataFrame, owned: DataFrame, k: int) -> DataFrame:
    """account_id, friend_pos and ``LISTED``, hashed on the account: the candidates from ``named`` that are not owned.

    Exclusion depends on (account, appid) only, so removing owned games before
    summing gives the same groups, and the aggregate stays in the task.
    """
    lists = _by_account(_of_friends(friend_edge, friend_lists(named), k).drop("friend_id"), k)
    return _not_owned(_each_game(lists), owned_within_reach(owned, friend_edge, top, k), k)


def recommend(
    library: DataFrame,
    friend_edge: DataFrame,
    profile: DataFrame,
    k: int = S.FRIENDS_USED,
    mode: str = BY_NAME,
    top_n: int | None = S.RECOMMENDATIONS,
    account_id: int | None = None,
    sweep: Sequence[int] | None = None,
    owned: DataFrame | None = None,
) -> DataFrame:
    """account_id, [friends,] rank, appid, name, total_playtime.

    ``account_id`` restricts the plan to one account (the edge filter is
    applied first, so only that account's friends' libraries are joined).
    ``sweep`` runs several friend counts in one plan (column ``friends``).
    ``owned`` overrides the owned-games table (defaults to ``library``).
    The top games are stored once; their names and the candidates read them.
    """
    counts = _counts(k, sweep)
    owned = library if owned is None else owned
    if account_id is not None:
        friend_edge = friend_edge.filter(F.col("account_id") == F.lit(account_id))
        # Only the account's first K friends' libraries are ranked; Spark picks
        # the join by the measured size of the id list.
        friend_ids = friend_edge.filter(F.col("pos") < counts[-1]).select(F.col("friend_id").alias("account_id"))
        library = library.join(friend_ids, "account_id", "left_semi")
        owned = owned.filter(F.col("account_id") == F.lit(account_id))
    top = materialize(usable_top_games(profile, library), "top_games")
    named = top if top_n is None else with_numbers(top, names := number_names(top))
    wide = aggregate_wide(_kept(friend_edge, top, named, owned, counts[-1]), mode, counts)
    keys = ["account_id", "friends"] if sweep else ["account_id"]
    ranked = rank_per_account(to_long(wide, mode, counts, bool(sweep)), keys, top_n)
    if top_n is not None:
        ranked = with_names(ranked, names)
    return ranked.select(*keys, "rank", "appid", "name", "total_playtime")


def recommend_sweep(
    library: DataFrame,
    friend_edge: DataFrame,
    profile: DataFrame,
    friend_counts: Sequence[int] = S.SWEEP_FRIENDS,
    mode: str = BY_NAME,
    top_n: int | None = S.RECOMMENDATIONS,
    owned: DataFrame | None = None,
) -> DataFrame:
    """Recommendations for several friend counts in one plan (column ``friends``)."""
    return recommend(library, friend_edge, profile, mode=mode, top_n=top_n, sweep=friend_counts, owned=owned)


def both_sweeps(library: DataFrame, friend_edge: DataFrame, profile: DataFrame, owned: DataFrame, store, friend_counts: Sequence[int] = S.SWEEP_FRIENDS, top_n: int | None = S.RECOMMENDATIONS) -> dict[str, DataFrame]:
    """Both modes of the sweep from one stored aggregate per (account, appid, name).

    ``store(df, name)`` writes a table and returns it read back.
    """
    counts = _counts(0, friend_counts)
    top = store(usable_top_games(profile, library), "sweep_top_games")
    kept = _kept(friend_edge, top, top, owned, counts[-1])
    largest, order, aggs = counts[-1], encounter_order(), []
    for n in counts:
        inside = F.lit(True) if n == largest else F.col("friend_pos") < n
        aggs += [
            F.sum(F.when(inside, F.col("playtime"))).cast("bigint").alias(f"__t{n}"),
            F.min(F.when(inside, order)).alias(f"__f{n}"),
            F.max(F.when(inside, order)).alias(f"__l{n}"),
        ]
    wide = store(kept.groupBy("account_id", "appid", "name").agg(*aggs), "sweep_totals")
    modes = {"recommend_sweep": (BY_NAME, wide), "recommend_sweep_by_appid": (BY_APPID, merge_names(wide, counts))}
    return {
        name: rank_per_account(to_long(table, mode, counts, True), ["account_id", "friends"], top_n)
        for name, (mode, table) in modes.items()
    }


def with_hours(recs: DataFrame) -> DataFrame:
    """Add ``hours`` (one decimal, Python rounding) and its display text."""
    return recs.withColumn("hours", hours_one_decimal("total_playtime")).withColumn(
        "hours_label", hours_one_decimal_label("total_playtime")
    )


def friends_used(
    friend_edge: DataFrame, profile: DataFrame, k: int = S.FRIENDS_USED, account_id: int | None = None
) -> DataFrame:
    """account_id, friends_used (names in list order, newline separated),
    friends_used_count.  A friend with a profile but no games still counts;
    the list is bounded by ``k``."""
    if account_id is not None:
        friend_edge = friend_edge.filter(F.col("account_id") == F.lit(account_id))
    f = friends_with_profile(friend_edge, profile, k)
    items = F.array_sort(F.collect_list(F.struct("friend_pos", "friend_name")))
    return f.groupBy("account_id").agg(
        F.array_join(F.transform(items, lambda x: x["friend_name"]), "\n").alias("friends_used"),
        F.count(F.lit(1)).alias("friends_used_count"),
    )

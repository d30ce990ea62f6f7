"""Profile, library, friend and status views (S11-S15, FN-1, FN-2, PRJ-*)."""

from conftest import edges_df, library_df, profile_df

from playgraph import schema as S
from playgraph.functions import formats
from playgraph.operators import library as lib_ops
from playgraph.operators import network, profile as profile_ops, status


def test_profile_summary_defaults_and_dates(spark):
    p = profile_df(spark, [
        (1, True, "Ann", "SE", 1_000_000_000),
        (2, True, None, None, 0),
        (3, True, None, None, None),
        (4, False, None, None, None),
    ])
    out = {r.account_id: r for r in profile_ops.profile_summary(p).collect()}
    assert (out[1].name, out[1].location, out[1].created, out[1].status) == ("Ann", "SE", "2001-09-09", "OK")
    assert out[1].title == "Profile Summary for Ann"
    assert out[1].profile_url == S.PROFILE_URL_PREFIX + "1"
    assert (out[2].name, out[2].location, out[2].created) == ("Unknown", "?", "Unknown")
    assert out[2].title == "Profile Summary for Unknown User"
    assert out[3].created == "Unknown"
    assert out[4].status == "NO_PROFILE" and out[4].name is None


def test_friend_network_left_join_defaults(spark):
    # S11 (changed): a friend without a player keeps a row with defaults.
    e = edges_df(spark, [(1, i, 10 + i) for i in range(12)])
    p = profile_df(spark, [(10, True, "Ten", "FR", 1), (11, False, None, None, None), (12, True, None, None, 1)])
    out = {r.pos: r for r in network.friend_network(e, p).collect()}
    assert len(out) == 10  # first ten only
    assert (out[0].name, out[0].country, out[0].profile_found) == ("Ten", "FR", True)
    assert (out[1].name, out[1].country, out[1].profile_found) == ("Unknown", "—", False)
    assert (out[2].name, out[2].country, out[2].profile_found) == ("Unknown", "—", True)
    assert (out[5].name, out[5].profile_found) == ("Unknown", False)  # no document at all
    assert network.friend_count(e).collect()[0].friends_shown == 10


def test_library_top_filters_zero_and_keeps_order(spark):
    lib = library_df(spark, [(1, 0, 1, "a", 0), (1, 1, 2, "b", 120), (1, 2, 3, "c", 120), (1, 3, 4, "d", 61)] +
                     [(1, 4 + i, 10 + i, f"x{i}", 200 + i) for i in range(20)])
    top = lib_ops.library_top(lib)
    got = [r.appid for r in top.orderBy("rank").collect()]
    assert len(got) == 15 and 1 not in got
    hours = {r.name: (r.hours, r.hours_label) for r in lib_ops.library_hours(top).collect()}
    assert hours["x19"] == (3, "3 hrs")
    big = lib_ops.library_hours(lib_ops.library_top(library_df(spark, [(1, 0, 1, "big", 6_000_000)])))
    assert big.collect()[0].hours_label == "100,000 hrs"


def test_most_played_ties_and_labels(spark):
    lib = library_df(spark, [(1, 0, 1, "a", 125), (1, 1, 2, "b", 125), (2, 0, 3, None, None)])
    out = {r.account_id: r for r in lib_ops.most_played(lib).collect()}
    assert (out[1].game, out[1].playtime_label) == ("a", "2h 5m")
    assert (out[2].game, out[2].playtime_min, out[2].playtime_label) == ("Unknown (3)", 0, "0h 0m")


def test_game_defaults(spark):
    # S14 / PRJ-7
    lib = library_df(spark, [(1, 0, 7, None, None)])
    r = lib_ops.game_defaults(lib).collect()[0]
    assert (r.name, r.playtime) == ("Unknown (7)", 0)


def test_floor_div_and_mod_follow_python(spark):
    # FN-2: -61 // 60 == -2 and -61 % 60 == 59 in Python.
    r = spark.range(1).selectExpr("-61L AS m").select(
        formats.floor_div("m", 60).alias("q"), formats.py_mod("m", 60).alias("r")
    ).collect()[0]
    assert (r.q, r.r) == (-2, 59)


def test_account_status(spark):
    accounts = spark.createDataFrame([(i,) for i in range(1, 6)], "account_id bigint")
    p = profile_df(spark, [(1, True, "a", None, 1), (2, False, None, None, None), (3, True, "c", None, 1), (4, True, "d", None, 1)])
    lib = library_df(spark, [(3, 0, 9, "n", 5)])
    e = edges_df(spark, [(1, 0, 3), (2, 0, 4)])
    out = {r.account_id: r for r in status.account_status(accounts, p, lib, e).collect()}
    assert (out[1].profile_status, out[1].library_status, out[1].friends_status, out[1].recommend_status) == \
        ("OK", "NO_DATA", "OK", "OK")
    assert (out[2].profile_status, out[2].recommend_status) == ("NO_PROFILE", "NO_CANDIDATES")
    assert (out[5].profile_status, out[5].friends_status) == ("NO_DATA", "NO_DATA")
    # With the lists of documents: an empty list is not a missing document.
    docs = spark.createDataFrame([(1,), (3,), (5,)], "account_id bigint")
    lib = lib.union(library_df(spark, [(5, 0, 9, "n", 0)]))
    out = {r.account_id: r for r in status.account_status(accounts, p, lib, e, library_docs=docs, friend_docs=docs).collect()}
    assert [out[i].library_status for i in range(1, 6)] == ["NO_GAMES", "NO_DATA", "OK", "NO_DATA", "NO_PLAYTIME"]
    assert [out[i].friends_status for i in range(1, 6)] == ["OK", "OK", "NO_FRIENDS", "NO_DATA", "NO_FRIENDS"]
    # One account (nobody is its own friend): the friend's library still counts.
    one = status.account_status(accounts, p, lib, e, account_id=1).collect()
    assert [(r.account_id, r.recommend_status) for r in one] == [(1, "OK")]


def test_single_account_mode_equals_filter(spark):
    # FLT-7: one account is a filter, never a separate path.
    lib = library_df(spark, [(a, i, 10 * a + i, f"g{i}", (a * 37 + i * 11) % 90) for a in (1, 2, 3) for i in range(20)])
    e = edges_df(spark, [(a, p, 1 + (a + p % 2) % 3) for a in (1, 2, 3) for p in range(12)])  # nobody is its own friend
    p = profile_df(spark, [(a, True, f"p{a}", "US", 100) for a in (1, 2, 3)])
    accounts = spark.createDataFrame([(a,) for a in (1, 2, 3)], "account_id bigint")
    from playgraph.operators import recommend as rec

    ops = {
        "profile": lambda acc: profile_ops.profile_summary(p, account_id=acc),
        "top": lambda acc: lib_ops.library_top(lib, account_id=acc),
        "most": lambda acc: lib_ops.most_played(lib, account_id=acc),
        "defaults": lambda acc: lib_ops.game_defaults(lib, account_id=acc),
        "network": lambda acc: network.friend_network(e, p, account_id=acc),
        "count": lambda acc: network.friend_count(e, account_id=acc),
        "used": lambda acc: rec.friends_used(e, p, account_id=acc),
        "status": lambda acc: status.account_status(accounts, p, lib, e, account_id=acc),
    }
    for name, op in ops.items():
        every = op(None)
        one = op(2)
        assert one.exceptAll(every.filter("account_id = 2")).count() == 0, name
        assert every.filter("account_id = 2").exceptAll(one).count() == 0, name
        assert one.count() > 0, name

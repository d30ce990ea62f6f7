"""Recommendation semantics on literal frames."""

from conftest import edges_df, found_profiles, library_df, profile_df

from playgraph import schema as S
from playgraph.operators import recommend as rec


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols).collect()]


def test_top_ten_per_friend_cut_before_exclusion(spark):
    # Friend 2 has 11 games; account 1 owns the friend's best game. The
    # 11th game is never a candidate even though one of the ten is removed.
    lib = library_df(spark, [(2, i, 100 + i, f"g{i}", 1000 - i) for i in range(11)] + [(1, 0, 100, "g0", 5)])
    recs = rec.recommend(lib, edges_df(spark, [(1, 0, 2)]), found_profiles(spark, [1, 2]))
    got = {r.appid for r in recs.collect()}
    assert 110 not in got and 100 not in got
    assert got == {100 + i for i in range(1, 10)}


def test_zero_playtime_kept_in_recommendations(spark):
    # S3: zero-playtime games stay candidates.
    lib = library_df(spark, [(2, 0, 7, "zero", 0)])
    recs = rec.recommend(lib, edges_df(spark, [(1, 0, 2)]), found_profiles(spark, [1, 2]))
    assert rows(recs, "appid", "total_playtime") == [(7, 0)]


def test_same_appid_two_names_by_name_and_by_appid(spark):
    # By name -> two rows; by appid -> one row, name last seen.
    lib = library_df(spark, [(2, 0, 5, "Alpha", 30), (3, 0, 5, "Alpha II", 20)])
    e = edges_df(spark, [(1, 0, 2), (1, 1, 3)])
    p = found_profiles(spark, [1, 2, 3])
    by_name = rec.recommend(lib, e, p, mode=rec.BY_NAME)
    assert rows(by_name, "rank", "appid", "name", "total_playtime") == [(1, 5, "Alpha", 30), (2, 5, "Alpha II", 20)]
    by_app = rec.recommend(lib, e, p, mode=rec.BY_APPID)
    assert rows(by_app, "rank", "appid", "name", "total_playtime") == [(1, 5, "Alpha II", 50)]


def test_ties_in_encounter_order(spark):
    # Equal totals rank by first encounter (friend position, then rank).
    lib = library_df(spark, [(2, 0, 9, "late", 10), (3, 0, 8, "b", 10), (2, 1, 7, "a", 10)])
    e = edges_df(spark, [(1, 0, 2), (1, 1, 3)])
    recs = rec.recommend(lib, e, found_profiles(spark, [1, 2, 3]))
    assert [r.appid for r in recs.orderBy("rank").collect()] == [9, 7, 8]


def test_friend_top_ten_ties_keep_library_order(spark):
    # Ties inside a friend's list keep library position.
    lib = library_df(spark, [(2, i, 200 + i, f"t{i}", 50) for i in range(12)])
    top = rec.top_games_per_owner(lib)
    assert sorted(r.appid for r in top.collect()) == [200 + i for i in range(10)]


def test_null_appid_owned_excludes_null_games(spark):
    # Set membership treats None as a value.
    friend_lib = [(2, 0, None, None, 40), (2, 1, 5, "five", 30)]
    owns_null = library_df(spark, friend_lib + [(1, 0, None, "x", 1)])
    e = edges_df(spark, [(1, 0, 2)])
    p = found_profiles(spark, [1, 2])
    assert rows(rec.recommend(owns_null, e, p), "appid") == [(5,)]
    no_null = library_df(spark, friend_lib + [(1, 0, 5, "five", 1)])
    got = rows(rec.recommend(no_null, e, p), "appid", "name")
    assert got == [(None, "Unknown (None)")]


def test_account_without_library_excludes_nothing(spark):
    # S8
    lib = library_df(spark, [(2, 0, 1, "a", 10)])
    recs = rec.recommend(lib, edges_df(spark, [(1, 0, 2)]), found_profiles(spark, [2]))
    assert rows(recs, "appid") == [(1,)]


def test_friend_without_player_is_skipped_entirely(spark):
    # S9 + S10: friend 3 has players: [] -> neither games nor name; friend 4
    # has a profile but no games -> still listed as used.
    lib = library_df(spark, [(2, 0, 1, "a", 10), (3, 0, 2, "b", 99)])
    p = profile_df(spark, [(2, True, "Two", "US", 1), (3, False, None, None, None), (4, True, None, "DE", 1)])
    e = edges_df(spark, [(1, 0, 2), (1, 1, 3), (1, 2, 4)])
    assert rows(rec.recommend(lib, e, p), "appid") == [(1,)]
    used = rec.friends_used(e, p).collect()[0]
    assert used.friends_used == "Two\nUnknown" and used.friends_used_count == 2


def test_duplicate_friend_counts_twice(spark):
    # S19
    lib = library_df(spark, [(2, 0, 1, "a", 10)])
    e = edges_df(spark, [(1, 0, 2), (1, 1, 2)])
    recs = rec.recommend(lib, e, found_profiles(spark, [2]))
    assert rows(recs, "appid", "total_playtime") == [(1, 20)]


def test_only_first_k_friends(spark):
    lib = library_df(spark, [(2, 0, 1, "a", 10), (3, 0, 2, "b", 10)])
    e = edges_df(spark, [(1, 0, 2), (1, 1, 3)])
    recs = rec.recommend(lib, e, found_profiles(spark, [2, 3]), k=1)
    assert rows(recs, "appid") == [(1,)]


def test_empty_result_keeps_schema(spark):
    # S1 (changed): one schema whether or not rows come out.
    lib = library_df(spark, [(2, 0, 1, "a", 10), (1, 0, 1, "a", 3)])
    recs = rec.recommend(lib, edges_df(spark, [(1, 0, 2)]), found_profiles(spark, [2]))
    assert recs.count() == 0
    assert [(f.name, f.dataType.simpleString()) for f in recs.schema.fields] == [
        (f.name, f.dataType.simpleString()) for f in S.RECOMMENDATION.fields
    ]


def test_sweep_equals_separate_runs(spark):
    lib = library_df(spark, [(10 + f, i, 100 + (f * 7 + i) % 13, f"n{(f * 7 + i) % 13}", (f * 31 + i * 17) % 50)
                             for f in range(8) for i in range(6)])
    e = edges_df(spark, [(1, f, 10 + f) for f in range(8)])
    p = found_profiles(spark, [1] + [10 + f for f in range(8)])
    for mode in (rec.BY_NAME, rec.BY_APPID):
        sweep = rec.recommend_sweep(lib, e, p, friend_counts=(2, 5, 8), mode=mode)
        for n in (2, 5, 8):
            one = rec.recommend(lib, e, p, k=n, mode=mode)
            assert rows(sweep.filter(f"friends = {n}"), "rank", "appid", "name", "total_playtime") == \
                rows(one, "rank", "appid", "name", "total_playtime")


def test_single_account_filter_equals_all_accounts_row(spark):
    lib = library_df(spark, [(2, 0, 1, "a", 10), (3, 0, 2, "b", 5), (1, 0, 3, "c", 1)])
    e = edges_df(spark, [(1, 0, 2), (1, 1, 3), (2, 0, 3), (3, 0, 1)])
    p = found_profiles(spark, [1, 2, 3])
    every = rec.recommend(lib, e, p)
    for acc in (1, 2, 3):
        one = rec.recommend(lib, e, p, account_id=acc)
        assert rows(one, "account_id", "rank", "appid") == rows(every.filter(f"account_id = {acc}"), "account_id", "rank", "appid")


def test_hours_python_rounding(spark):
    # Minutes 3, 9, 15, 21, 45 -> 0.1, 0.1, 0.2, 0.3, 0.8; and the whole
    # range against Python's round.
    df = spark.range(0, 20000).withColumnRenamed("id", "total_playtime")
    out = rec.with_hours(df).collect()
    bad = [r.total_playtime for r in out if r.hours != round(r.total_playtime / 60.0, 1)
           or r.hours_label != f"{round(r.total_playtime / 60.0, 1)} hrs"]
    assert bad == []
    got = {r.total_playtime: r.hours for r in out if r.total_playtime in (3, 9, 15, 21, 45)}
    assert got == {3: 0.1, 9: 0.1, 15: 0.2, 21: 0.3, 45: 0.8}

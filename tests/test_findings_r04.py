"""Findings of round 4: candidates move once, as lists by account; what is read twice is stored once."""

import re

import pytest
from conftest import SF_SMALL, edges_df, found_profiles, library_df

from playgraph.operators import recommend as rec
from playgraph.plans import queries as q
from playgraph.sources import documents


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark):
    lib = [(1, 0, 5, "Alpha", 1), (1, 1, None, None, 1), (1, 2, 9, "Own", 2), (1, 3, 11, "Own too", 2)]
    lib += [(2, 0, 5, "Alpha", 30), (2, 1, 6, "Beta", 20), (2, 2, None, None, 9)]
    lib += [(3, 0, 6, "Beta II", 25), (3, 1, 7, None, 8), (3, 2, None, None, 3)]
    return library_df(spark, lib), edges_df(spark, [(1, 0, 2), (1, 1, 3), (4, 0, 3), (4, 1, 2), (4, 2, 2)]), found_profiles(spark, [1, 2, 3, 4])


def _rows(df):
    return sorted(tuple(r[c] for c in ("account_id", "rank", "appid", "name", "total_playtime")) for r in df.collect())


BY_NAME = [(1, 1, 6, "Beta II", 25), (1, 2, 6, "Beta", 20), (1, 3, 7, "Unknown (7)", 8)]
OTHERS = [(4, 1, 5, "Alpha", 60), (4, 2, 6, "Beta", 40), (4, 3, 6, "Beta II", 25), (4, 4, None, "Unknown (None)", 21), (4, 5, 7, "Unknown (7)", 8)]


@pytest.mark.parametrize("mode", [rec.BY_NAME, rec.BY_APPID])
@pytest.mark.parametrize("sweep", [None, (1, 25, 50)])
def test_candidates_move_once(spark, mode, sweep):
    # every candidate moved by (account, app), and its totals, once per friend count, by account again.
    p = plan(rec.recommend(*_tables(spark), mode=mode, sweep=sweep))
    ranked = p[: p.index("LeftAnti")]
    assert "WindowGroupLimit" in ranked and "SortAggregate" not in ranked
    assert ranked.count("Exchange") == 1  # of the ranked rows, for their names
    below = p[p.index("LeftAnti") :]
    assert below.index("posexplode") < below.index("Exchange hashpartitioning(account_id")


def test_lists_keep_every_candidate(spark):
    for top_n in (10, None):
        assert _rows(rec.recommend(*_tables(spark), top_n=top_n)) == BY_NAME + OTHERS
    twice = rec.recommend(_tables(spark)[0], _tables(spark)[1], found_profiles(spark, [2, 2, 3]))
    assert [r[4] for r in _rows(twice) if r[0] == 1] == [40, 25, 8]  # a profile that comes twice counts twice


@pytest.mark.parametrize("sweep", [None, (1, 25)])
def test_large_libraries_are_cut_to_the_candidates(spark, monkeypatch, sweep):
    lib, edges, prof = _tables(spark)
    want = rec.recommend(lib, edges, prof, sweep=sweep).collect()
    stored, store = {}, rec.materialize
    monkeypatch.setattr(rec, "materialize", lambda df, name, *a: stored.setdefault(name, store(df, name, *a)))
    monkeypatch.setattr(rec, "LARGE_LIBRARY", 3)
    got = rec.recommend(lib, edges, prof, sweep=sweep).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    assert [r.account_id for r in stored["large_libraries"].collect()] == [1]
    assert {tuple(r) for r in stored["owned_in_reach"].collect()} == {(1, 5), (1, None)}  # 9 and 11 are nobody's game


def test_partitions_grow_with_the_friends(spark):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert f"hashpartitioning(account_id#" in (p := plan(rec.recommend_sweep(*_tables(spark))))
    assert len(re.findall(rf"hashpartitioning\(account_id#\d+L, {5 * partitions}\), REPARTITION_BY_NUM", p)) == 2
    assert "REPARTITION_BY_NUM" not in plan(rec.recommend(*_tables(spark)))


def test_the_whole_ranking_moves_no_ranked_rows(spark):
    # with every candidate ranked, all of them moved by account for the ranks and by app for their names.
    p = plan(rec.recommend(*_tables(spark), top_n=None))
    assert "Exchange" not in p[: p.index("LeftAnti")] and "name_no" not in p


def _stored(monkeypatch, spark, name):
    names, store = [], q.materialize
    monkeypatch.setattr(q, "materialize", lambda df, name, *a: names.append(name) or store(df, name, *a))
    df = getattr(q, name)(spark, SF_SMALL)
    return names, plan(df)


@pytest.mark.parametrize("name", ["recommend_from_documents", "recommend_from_damaged_documents"])
def test_parsed_libraries_are_stored_once(spark, monkeypatch, name):
    # the libraries were rendered, moved and parsed twice, for the top games and for the owned ones.
    names, p = _stored(monkeypatch, spark, name)
    assert names.count("parsed_library") == 1
    assert "playtime_forever" not in p


def test_flat_rows_move_to_their_document(spark):
    # a list of structs from each task moved in place of the rows.
    p = plan(documents.library_documents(_tables(spark)[0], page_size=2))
    assert p.count("Exchange") == 1 and p.index("collect_list") < p.index("Exchange")
    assert "partial_collect_list" not in p[p.index("Exchange") :]


def test_what_friends_contribute_is_stored_once(spark, monkeypatch):
    # the ranked libraries and the friend lists were made twice, for the owned games and for the candidates.
    names, p = _stored(monkeypatch, spark, "recommend_empty")
    assert names.count("first_friends") == names.count("top_games_of_all") == 1
    assert "__pg_bucket" not in p

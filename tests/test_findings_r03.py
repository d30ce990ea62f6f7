"""Findings of round 3: growing tables are never broadcast, names do not travel with the candidates, inputs are rendered once."""

import re

from conftest import SF_SMALL, edges_df, found_profiles, library_df

from playgraph.operators import recommend as rec
from playgraph.plans import queries as q
from playgraph.sources import containers, testmap
from playgraph.sources.tables import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _small(spark):
    lib = library_df(spark, [(2, 0, 5, "Alpha", 30), (3, 0, 5, "Alpha II", 20), (3, 1, None, None, 9), (3, 2, 7, None, 8)])
    return lib, edges_df(spark, [(1, 0, 2), (1, 1, 3)]), found_profiles(spark, [1, 2, 3])


def test_growing_tables_are_not_broadcast(spark):
    # Small compressed estimates made Spark broadcast orders, part and customer from the driver.
    lib, edges, prof = _small(spark)
    assert "BroadcastHashJoin" not in plan(rec.candidate_games(edges, prof, lib))
    assert "BroadcastHashJoin" not in plan(rec.friends_with_profile(edges, prof, 10))
    t = Tables(spark, SF_SMALL)
    assert "BroadcastHashJoin" not in plan(testmap.played(t))
    assert not re.search(r"BroadcastHashJoin \[appid", plan(testmap.library(t)))
    assert not re.search(r"BroadcastHashJoin \[c_custkey", plan(testmap.profile(t)))


def test_ranked_customers_and_edges_are_not_broadcast(spark, monkeypatch):
    # F2 to F8: at 60 times sf0.1 the plans began with a broadcast of the 900,000 ranked customers, recommend_empty also of the edges.
    def no_broadcast_of_rows(df):
        return not re.search(r"BroadcastHashJoin \[(friend_id|\w+#\d+L?, __pg_bucket)", plan(df))

    assert no_broadcast_of_rows(testmap.friend_edge(Tables(spark, SF_SMALL)))
    tables = []
    monkeypatch.setattr(rec, "recommend", lambda *a, owned, **k: tables.append(owned))
    q.recommend_empty(spark, SF_SMALL)
    assert no_broadcast_of_rows(tables[0])


def test_span_starts_and_owned_games_are_not_broadcast(spark):
    # At 12 times sf0.1 AQE broadcast the libraries' span starts, one row per account, up to three times a query.
    t = Tables(spark, SF_SMALL)
    pairs = testmap.played(t)
    ranked, edges = testmap.library(t, pairs=pairs), testmap.friend_edge(t)
    left = rec.exclude_owned(pairs, pairs.filter("appid % 2 = 0"))
    for df in (ranked, edges, left):
        assert "BroadcastHashJoin" not in plan(df)
        df.collect()
        assert "BroadcastHashJoin" not in plan(df)
    assert left.filter("appid % 2 = 0").isEmpty() and not left.isEmpty()


def test_candidates_carry_name_numbers(spark):
    lib, edges, prof = _small(spark)
    for mode, want in (
        (rec.BY_NAME, [(1, 5, "Alpha", 30), (2, 5, "Alpha II", 20), (3, None, "Unknown (None)", 9), (4, 7, "Unknown (7)", 8)]),
        (rec.BY_APPID, [(1, 5, "Alpha II", 50), (2, None, "Unknown (None)", 9), (3, 7, "Unknown (7)", 8)]),
    ):
        recs = rec.recommend(lib, edges, prof, mode=mode)
        assert sorted((r["rank"], r.appid, r.name, r.total_playtime) for r in recs.collect()) == want
        assert "name_no" in plan(recs)


def test_delta_inputs_are_stored_once(spark, monkeypatch):
    stored, store = [], q.materialize
    monkeypatch.setattr(q, "materialize", lambda df, name, *a: stored.append(name) or store(df, name, *a))
    q.recommend_after_delta(spark, SF_SMALL)
    assert {"first_friends", "profile"} <= set(stored)


def test_containers_render_each_document_once(spark, tmpdir_fresh):
    calls = spark.sparkContext.accumulator(0)

    def render(i):
        calls.add(1)
        return f"{{{i}}}"

    docs = spark.range(50).select("id", spark.udf.register("render_once", render)("id").alias("payload")).withColumnRenamed("id", "account_id")
    containers.write_containers(docs, tmpdir_fresh, target_bytes=200)
    assert containers.container_rows(spark, tmpdir_fresh).count() == 50
    assert calls.value == 50


def test_new_plain_chunks_are_taken_whole():
    # op1_token_ids: every new chunk, most of them plain words, was stripped and kept as a triple first.
    from playgraph.llm.tokens import ChunkEncoder, tokenizer_path

    class Plain(str):
        def strip(self, *_):
            raise AssertionError("a plain word was searched for marks")

    encoder = ChunkEncoder(tokenizer_path("word_bpe_49k.json"))
    assert encoder.words is not None
    encoder._learn({Plain("harbour"), "(harbour),", "a-b", "x1"})
    for chunk in ("harbour", "(harbour),", "a-b", "x1"):
        assert encoder.cache[chunk] == encoder._ids(chunk)


def test_workers_forget_the_encoders_of_other_operators():
    # pipeline: reused Python workers carried packing's encoder and its cache (200 MB) through all other stages.
    from playgraph.llm.shared import lean
    from playgraph.llm.tokens import worker_state

    kept = worker_state()
    kept["encoder", "a file"] = object()
    assert list(lean(lambda batches: (b + 1 for b in batches), encoders=True)(iter([1, 2]))) == [2, 3]
    assert ("encoder", "a file") in kept
    assert list(lean(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3]
    assert ("encoder", "a file") not in kept

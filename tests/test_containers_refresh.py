"""Container files, batches of text logs, refreshed recommendations and VARIANT documents."""

import os
import random

from conftest import edges_df, library_df, profile_df
from pyspark.sql import functions as F

from playgraph.operators import opaque, recommend as rec, refresh, runlog
from playgraph.sources import containers, documents, text
from playgraph.streaming import runlog_stream


def test_one_account_read_touches_one_file(spark, tmpdir_fresh):
    lib = library_df(spark, [(a, i, 100 + i, f"g{i}" * 20, i) for a in range(1, 301) for i in range(6)])
    path = os.path.join(tmpdir_fresh, "box")
    docs = documents.library_documents(lib, page_size=4)
    assert containers.write_containers(docs, path, target_bytes=20_000) > 5
    files = [f for f in os.listdir(os.path.join(path, "data")) if f.startswith("part-")]
    size = docs.agg(F.sum(F.octet_length("payload") + 16)).first()[0]
    assert len(files) <= size // 20_000 + 1  # the number of files follows the bytes
    rows = containers.container_rows(spark, path, [77])
    assert len(rows.inputFiles()) <= 2 and rows.count() == 2  # a range may end inside an account
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(account_id,77)" in plan
    back = documents.library_from_documents(containers.read_containers(spark, path, "game", [77, 5000]))
    assert {r.account_id for r in back.collect()} == {77}
    whole = documents.library_from_pages(containers.container_rows(spark, path), page_size=4)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, lib.collect()))


def test_containers_of_nothing(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "none")
    assert containers.read_containers(spark, path, "game").count() == 0
    assert containers.container_rows(spark, path, [1]).count() == 0
    empty = spark.createDataFrame([(None, "{}")], "account_id bigint, payload string")
    containers.write_containers(empty, path)
    assert containers.container_rows(spark, path).count() == 0 and containers.container_rows(spark, path, [1]).count() == 0


def test_missing_inputs_end_quietly(spark, tmpdir_fresh):
    gone = os.path.join(tmpdir_fresh, "gone")
    assert text.read_lines(spark, gone).count() == 0
    assert documents.library_from_documents(documents.read_documents(spark, gone, "game")).count() == 0
    assert documents.document_rejects(spark, gone, "user").count() == 0
    averages, comparison = runlog_stream.current_summary(spark, gone)
    assert averages.count() == 0 and comparison.count() == 0 and "line" in averages.columns


def test_log_batches_count_once_with_their_rejects(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "log")
    lines = spark.createDataFrame([("a: 1.0005",), ("a: 2",), ("a: 2",), ("b: x",), ("c:1:2",), ("junk",)], "value string")
    for batch in ("run-1", "run-1", "run-2", "run-1"):
        text.ingest_run_log(lines, path, batch)
    assert sorted(r.value for r in text.read_lines(spark, path).collect()) == sorted(["a: 1.000", "a: 2.000", "a: 2.000"] * 2)
    assert sorted(map(tuple, text.run_log_rejects(spark, path).collect())) == sorted([("b: x", "not_a_number"), ("c:1:2", "field_count")] * 2)
    res = os.path.join(tmpdir_fresh, "res")
    samples = spark.createDataFrame([("w", 1.0, 2.0)], "label string, cpu_pct double, rss_mb double")
    for batch in ("r1", "r1", "r2"):
        runlog.append_resource_averages(samples, res, batch)
    assert text.read_lines(spark, res).count() == 2


def test_report_passes_take_bounded_room(spark, tmpdir_fresh):
    log, out, ckpt = (os.path.join(tmpdir_fresh, x) for x in ("log", "out", "ckpt"))
    os.makedirs(log)
    for n in range(5):
        with open(os.path.join(log, f"{n}.txt"), "w") as f:
            f.write(f"w: {n}.5\n")
        for q in runlog_stream.start_summary(spark, log, out, ckpt, available_now=True):
            q.awaitTermination(120)
    assert runlog_stream.current_summary(spark, out)[0].first().avg_ms == 2.5
    assert len([d for d in os.listdir(out) if d.startswith("pass=")]) == runlog_stream.KEPT_PASSES
    assert len(os.listdir(os.path.join(out, "passes"))) <= runlog_stream.KEPT_PASSES + 2


def _world(rng, accounts=40, games=25):
    lib = {(a, g): rng.randint(0, 300) for a in range(accounts) for g in rng.sample(range(games), rng.randint(0, 9))}
    edges = {a: rng.sample([f for f in range(accounts) if f != a], rng.randint(0, 14)) for a in range(accounts)}
    return lib, edges


def _frames(spark, lib, edges, no_player=()):
    rows, pos = [], {}
    for (a, g), m in sorted(lib.items()):
        pos[a] = pos.get(a, -1) + 1
        rows.append((a, pos[a], g, f"g{g}", m))
    prof = profile_df(spark, [(a, a not in no_player, f"p{a}", "US", 1) for a in range(40)])
    return library_df(spark, rows), edges_df(spark, [(a, i, f) for a, fs in edges.items() for i, f in enumerate(fs)]), prof


def test_refreshed_recommendations_equal_recomputed_ones(spark):
    rng = random.Random(6)
    lib, edges = _world(rng)
    old = _frames(spark, lib, edges)
    previous = rec.recommend(*old).cache()
    # Libraries 3 and 11 change, 5 loses everything, 17 loses its player, the friend lists of 8 and 9 change.
    lib2 = {k: v for k, v in lib.items() if k[0] != 5} | {(3, 1): 999, (11, 2): 500, (11, 24): 1}
    edges2 = edges | {8: [3, 4, 5], 9: []}
    new = _frames(spark, lib2, edges2, no_player=(17,))
    ids = lambda xs: spark.createDataFrame([(x,) for x in xs], "account_id bigint")
    changed, lists = ids([3, 11, 5, 17, 3, None]), ids([8, 9])
    got = refresh.refresh_recommendations(previous, *new, changed, lists)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rec.recommend(*new).collect()))
    affected = {r.account_id for r in refresh.affected_accounts(new[1], changed, lists).collect()}
    assert affected == {3, 11, 5, 17, 8, 9} | {a for a, fs in edges2.items() if set(fs[:10]) & {3, 11, 5, 17}} and len(affected) < 40
    # Nothing changed: everything stays as stored.
    same = refresh.refresh_recommendations(previous, *old, ids([]))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, previous.collect()))


def test_variant_documents_of_any_shape(spark):
    docs = spark.createDataFrame(
        [("user", 1, 0, '{"response":{"players":[{"personaname":"ann"}]}}'), ("game", 1, 0, '{"response":{"games":[{"appid":7},{"appid":8}]}}'),
         ("friend", 1, 0, '{"friendslist":{"friends":[{"steamid":"99"},{"steamid":"x"}]}}'), ("news", 5, 2, '{"appnews":{"newsitems":[{"gid":"12","contents":{"odd":[1]}}]}}'),
         ("news", 6, 0, '{"appnews":{"newsitems":"none"}}'), ("news", 7, 0, "{broken"), ("user", 8, 0, None), ("other", 9, 0, "[1, 2]")],
        "kind string, key bigint, page bigint, payload string",
    )
    got = {(r.kind, r.key): (r.n_entries, r.persona, r.first_id) for r in opaque.document_summary(docs).collect()}
    assert got == {("user", 1): (1, "ann", None), ("game", 1): (2, None, 7), ("friend", 1): (2, None, 99), ("news", 5): (1, None, 12),
                   ("news", 6): (None, None, None), ("news", 7): (None, None, None), ("user", 8): (None, None, None), ("other", 9): (None, None, None)}
    assert [r.key for r in opaque.unreadable(docs).collect()] == [7]

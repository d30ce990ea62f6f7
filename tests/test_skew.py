"""Hot keys: one account owns most games, one friend is in every list.

Results must equal a brute-force evaluation of the definition, also when
AQE splits skewed partitions (thresholds lowered so the split happens at
test size).
"""

from collections import defaultdict

import pytest
from conftest import edges_df, found_profiles, library_df

from playgraph.functions.ranking import dense_position
from playgraph.operators import recommend as rec
from playgraph.operators import status

HOT = 1
N_ACCOUNTS = 120


def _fixture(spark):
    lib = [(HOT, i, i, f"g{i % 997}", (i * 7919) % 5000) for i in range(30000)]  # hot library
    for a in range(2, N_ACCOUNTS + 2):
        lib += [(a, j, (a * 31 + j * 17) % 30000, f"g{((a * 31 + j * 17) % 30000) % 997}", (a * j) % 300)
                for j in range(12)]
    edges = []
    for a in range(2, N_ACCOUNTS + 2):
        edges.append((a, 0, HOT))  # the hub friend
        edges += [(a, p, 2 + (a + p) % N_ACCOUNTS) for p in range(1, 6)]
    return lib, edges


def _brute(lib, edges, k=10, n=10):
    by_owner = defaultdict(list)
    owned = defaultdict(set)
    for acc, pos, app, name, pt in lib:
        by_owner[acc].append((pos, app, name, pt))
        owned[acc].add(app)
    top = {o: sorted(g, key=lambda x: (-x[3], x[0]))[:10] for o, g in by_owner.items()}
    friends = defaultdict(list)
    for acc, pos, f in edges:
        if pos < k:
            friends[acc].append((pos, f))
    out = {}
    for acc, fl in friends.items():
        totals, first = {}, {}
        for fpos, f in sorted(fl):
            for rank, (_, app, name, pt) in enumerate(top.get(f, []), 1):
                if app in owned[acc]:
                    continue
                key = (app, name)
                totals[key] = totals.get(key, 0) + pt
                first.setdefault(key, (fpos, rank))
        ranked = sorted(totals, key=lambda g: (-totals[g], first[g]))[:n]
        out[acc] = [(i + 1, g[0], g[1], totals[g]) for i, g in enumerate(ranked)]
    return out


CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def split_early(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_account_and_hub_friend(spark, split_early):
    lib, edges = _fixture(spark)
    recs = rec.recommend(library_df(spark, lib), edges_df(spark, edges), found_profiles(spark, range(1, N_ACCOUNTS + 2)))
    got = defaultdict(list)
    for r in recs.collect():
        got[r.account_id].append((r.rank, r.appid, r.name, r.total_playtime))
    want = _brute(lib, edges)
    assert {a: sorted(v) for a, v in got.items()} == {a: v for a, v in want.items() if v}


def test_hub_friend_is_split_in_the_final_plan(spark, split_early):
    n = 60_000
    edges = spark.range(n).selectExpr("id + 10 AS account_id", "0 AS pos", f"CASE WHEN id % 3 < 2 THEN 1L ELSE id + 10 END AS friend_id")
    lib = spark.range(2000).selectExpr("CASE WHEN id < 20 THEN 1L ELSE id + 10 END AS account_id", "cast(id AS int) AS pos", "id AS appid", "'g' AS name", "id AS playtime_min")
    prof = spark.range(n + 10).selectExpr("id AS account_id", "true AS player_found", "'p' AS persona", "'US' AS country", "1L AS timecreated")
    accounts = edges.select("account_id")
    recs = rec.recommend(lib, edges, prof)
    stat = status.account_status(accounts, prof, lib, edges)
    for df, rows in ((recs, None), (stat, n)):
        got = df.collect()
        assert rows is None or len(got) == rows
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_positions_do_not_depend_on_the_bucket_width(spark):
    rows = [(a, 76561197960265728 + i * 104729 * (a + 1)) for a in (1, 2) for i in range(500)] + [(3, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g bigint, k bigint")
    want = sorted((g, k, sorted(x for h, x in rows if h == g).index(k)) for g, k in rows)
    for width in (1, 7, 100, 1 << 16):
        got = dense_position(df, ["g"], "k", "pos", width, size="n").collect()
        assert sorted((r.g, r.k, r.pos) for r in got) == want, width
        assert {(r.g, r.n) for r in got} == {(1, 500), (2, 500), (3, 300)}

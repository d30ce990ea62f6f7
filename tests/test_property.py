"""Property test: recommendations equal a brute-force evaluation of the
definition on random small inputs (nulls, zero playtime, repeated names,
duplicate friends, friends without profile or player)."""

from collections import defaultdict

from conftest import edges_df, library_df, profile_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playgraph.operators import recommend as rec

ACCOUNTS = range(1, 7)

game = st.tuples(
    st.one_of(st.none(), st.integers(1, 8)),                     # appid
    st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),      # name
    st.one_of(st.none(), st.integers(0, 40)),                    # playtime
)
libraries = st.dictionaries(st.sampled_from(list(ACCOUNTS)), st.lists(game, max_size=13), max_size=6)
friend_lists = st.dictionaries(st.sampled_from(list(ACCOUNTS)), st.lists(st.sampled_from(list(ACCOUNTS) + [9]), max_size=8))
profiles = st.dictionaries(st.sampled_from(list(ACCOUNTS)), st.booleans())   # account -> player found


def brute(libs, friends, profs, k, mode):
    """The definition, written plainly over Python lists."""
    out = {}
    for acc, flist in friends.items():
        owned = {a for a, _, _ in libs.get(acc, [])}
        rows = []                                    # (appid, name, playtime) in encounter order
        for f in flist[:k]:
            if not profs.get(f, False):              # no document or no player: skipped
                continue
            games = [(a, n if n is not None else f"Unknown ({a})", p if p is not None else 0)
                     for a, n, p in libs.get(f, [])]
            top = sorted(games, key=lambda g: g[2], reverse=True)[:10]   # stable
            rows += [g for g in top if g[0] not in owned]
        totals, first, name_of = {}, {}, {}
        for i, (a, n, p) in enumerate(rows):
            key = (a, n) if mode == rec.BY_NAME else a
            totals[key] = totals.get(key, 0) + p
            first.setdefault(key, i)
            name_of[key] = n
        ranked = sorted(totals, key=lambda g: (-totals[g], first[g]))[:10]
        res = [(r + 1, (g[0] if mode == rec.BY_NAME else g), name_of[g], totals[g]) for r, g in enumerate(ranked)]
        if res:
            out[acc] = res
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(libs=libraries, friends=friend_lists, profs=profiles)
def test_recommend_matches_definition(spark, libs, friends, profs):
    lib = library_df(spark, [(acc, pos, a, n, p) for acc, games in libs.items() for pos, (a, n, p) in enumerate(games)])
    e = edges_df(spark, [(acc, pos, f) for acc, fl in friends.items() for pos, f in enumerate(fl)])
    prof = profile_df(spark, [(acc, found, f"p{acc}", None, 1) for acc, found in profs.items()])
    for mode in (rec.BY_NAME, rec.BY_APPID):
        sweep = rec.recommend_sweep(lib, e, prof, friend_counts=(2, 5), mode=mode).collect()
        got = defaultdict(lambda: defaultdict(list))
        for r in sweep:
            got[r.friends][r.account_id].append((r.rank, r.appid, r.name, r.total_playtime))
        for k in (2, 5):
            want = brute(libs, friends, profs, k, mode)
            assert {a: sorted(v) for a, v in got[k].items()} == want, (mode, k)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(libs=libraries)
def test_library_views_match_definition(spark, libs):
    from playgraph.operators import library as lib_ops

    lib = library_df(spark, [(acc, pos, a, n, p) for acc, games in libs.items() for pos, (a, n, p) in enumerate(games)])
    top = defaultdict(list)
    for r in lib_ops.library_top(lib, n=3).collect():
        top[r.account_id].append((r.rank, r.appid, r.name, r.total_playtime))
    want_top = {}
    for acc, games in libs.items():
        played = [g for g in games if g[2] is not None and g[2] > 0]
        best = sorted(played, key=lambda g: g[2], reverse=True)[:3]     # stable: library order on ties
        if best:
            want_top[acc] = [(i + 1, a, n, p) for i, (a, n, p) in enumerate(best)]
    assert {a: sorted(v) for a, v in top.items()} == want_top

    most = {r.account_id: (r.appid, r.game, r.playtime_min, r.playtime_label) for r in lib_ops.most_played(lib).collect()}
    want_most = {}
    for acc, games in libs.items():
        if not games:
            continue
        a, n, p = max(enumerate(games), key=lambda ig: (ig[1][2] or 0, -ig[0]))[1]
        p = p or 0
        want_most[acc] = (a, n if n is not None else f"Unknown ({a})", p, f"{p // 60}h {p % 60}m")
    assert most == want_most


def _python_summary_parse(lines):
    """The log reader's rules in plain Python: no ':' -> skipped; otherwise
    strip, split on ':', exactly two parts and a float() value, else reject."""
    good, bad = [], []
    for line in lines:
        if ":" not in line:
            continue
        parts = line.strip().split(":")
        try:
            if len(parts) != 2:
                raise ValueError
            good.append((parts[0].strip(), float(parts[1].strip())))
        except ValueError:
            bad.append(line)
    return good, bad


number_text = st.sampled_from(["1.5", " 2 ", "1e3", "abc", "", "nan", "-nan", "+inf", "Infinity", "-0.5", "1_000",
                               "1__0", "_1", "1_", ".5", "1.", "0x10", "1.5d", "1e1_0", "  -7.25e-2 ", "."])
log_line = st.one_of(
    st.builds(lambda l, n: f"{l}:{n}", st.sampled_from(["a_b", " lab ", "spark_recommendation_10_friends_useCache"]), number_text),
    st.builds(lambda a, b: f"{a}:{b}:1", st.sampled_from(["a", "b"]), st.sampled_from(["x", "2"])),
    st.sampled_from(["junk", "", "no colon here"]),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(log_line, max_size=12))
def test_run_log_parse_matches_python(spark, lines):
    from playgraph.sources import text

    parsed, rejects = text.parse_run_log(spark.createDataFrame([(v,) for v in lines], "value string"))
    want_good, want_bad = _python_summary_parse(lines)

    def key(row):
        label, v = row
        return (label, repr(float(v)))   # repr keeps values exact and makes nan comparable

    assert sorted(map(key, map(tuple, parsed.collect()))) == sorted(map(key, want_good))
    assert sorted(r.value for r in rejects.collect()) == sorted(want_bad)


snapshot_row = st.tuples(
    st.sampled_from(["user", "game", "friend", "news", "error"]),
    st.integers(1, 3),
    st.sampled_from(["p", "q", "r"]),
    st.sampled_from([0, 1, 35999, 36000, 36001, 90000]),   # age in seconds at "now"
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(snapshot_row, max_size=15))
def test_snapshot_operators_match_definition(spark, rows):
    import datetime as dt

    from pyspark.sql import functions as F

    from playgraph.functions.timecols import ntz_literal
    from playgraph.operators import snapshots

    now = dt.datetime(2024, 1, 31)
    data = [(k, key, p, (now - dt.timedelta(seconds=age)).strftime("%Y-%m-%d %H:%M:%S")) for k, key, p, age in rows]
    snap = spark.createDataFrame(data, "kind string, key bigint, payload string, fetched_at string").withColumn(
        "fetched_at", F.col("fetched_at").cast("timestamp_ntz"))
    latest_rows = snapshots.latest_snapshots(snap).collect()
    got_latest = {(r.kind, r.key): (r.fetched_at.strftime("%Y-%m-%d %H:%M:%S"), r.payload) for r in latest_rows}
    want_latest = {}
    for k, key, p, ts in data:
        want_latest[(k, key)] = max(want_latest.get((k, key), (ts, p)), (ts, p))
    assert got_latest == want_latest

    nowc = ntz_literal("2024-01-31 00:00:00")
    fresh = {(r.kind, r.key) for r in snapshots.snapshot_freshness(snapshots.latest_snapshots(snap), nowc).collect() if r.is_fresh}
    want_fresh = {kk for kk, (ts, _) in want_latest.items()
                  if kk[0] in ("user", "game", "friend")
                  and (now - dt.datetime.strptime(ts, "%Y-%m-%d %H:%M:%S")).total_seconds() < 36000}
    assert fresh == want_fresh

    wanted = snapshots.wanted_documents(spark.createDataFrame([(a,) for a in (1, 2, 3)], "account_id bigint"))
    todo = {(r.kind, r.key) for r in snapshots.refresh_list(wanted, snap, nowc).collect()}
    assert todo == {(k, a) for k in ("user", "game", "friend") for a in (1, 2, 3)} - want_fresh

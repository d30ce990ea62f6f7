"""DuckDB SQL for every registered query (the correctness oracle).

The views ``customer orders lineitem part nation events documents`` are the
parquet test tables.  The canonical tables are rebuilt here as CTEs with
plain SQL (windows over whole groups are fine for a single-node oracle).
Column names and types match the Spark results.
"""

from __future__ import annotations

from playgraph.plans.queries import ONE_ACCOUNT

PROFILE_URL = "https://community.example/profiles/"

BASE = """
lib_played AS (
  SELECT o.o_custkey AS account_id, l.l_partkey AS appid,
         CAST(sum(l.l_quantity) AS BIGINT) AS playtime_min
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey
),
library AS (
  SELECT p.account_id,
         CAST(row_number() OVER (PARTITION BY p.account_id ORDER BY p.appid) - 1 AS INTEGER) AS pos,
         p.appid, pt.p_name AS name, p.playtime_min
  FROM lib_played p LEFT JOIN part pt ON pt.p_partkey = p.appid
),
cust AS (
  SELECT c_custkey AS account_id, c_nationkey AS nation,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS r,
         count(*) OVER (PARTITION BY c_nationkey) AS n
  FROM customer
),
friend_edge AS (
  SELECT s.account_id, CAST(s.k - 1 AS INTEGER) AS pos, t.account_id AS friend_id
  FROM (SELECT account_id, nation, r, n,
               unnest(generate_series(1, least(60, n - 1))) AS k FROM cust) s
  JOIN cust t ON t.nation = s.nation AND t.r = (s.r + s.k) % s.n
),
first_order AS (
  SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey
),
profile AS (
  SELECT c.c_custkey AS account_id,
         (c.c_custkey % 13) <> 0 AS player_found,
         CASE WHEN c.c_custkey % 13 <> 0 AND c.c_custkey % 7 <> 0 THEN c.c_name END AS persona,
         CASE WHEN c.c_custkey % 13 <> 0 AND c.c_custkey % 5 <> 0 THEN n.n_name END AS country,
         CASE WHEN c.c_custkey % 13 <> 0 THEN
              CASE WHEN c.c_custkey % 10 = 0 THEN CAST(0 AS BIGINT)
                   ELSE CAST(floor(epoch(f.first_order)) AS BIGINT) END END AS timecreated
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN first_order f ON f.o_custkey = c.c_custkey
),
games AS (
  SELECT account_id AS owner_id, pos, appid,
         coalesce(name, 'Unknown (' || coalesce(CAST(appid AS VARCHAR), 'None') || ')') AS name,
         coalesce(playtime_min, CAST(0 AS BIGINT)) AS playtime
  FROM library
),
top10 AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY owner_id ORDER BY playtime DESC, pos) AS INTEGER)
              AS rank_in_friend
    FROM games) WHERE rank_in_friend <= 10
)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([BASE, *ctes])


def _friends(k: int, one: bool = False) -> str:
    where = f" AND e.account_id = {ONE_ACCOUNT}" if one else ""
    return f"""
friends AS (
  SELECT e.account_id, e.pos AS friend_pos, e.friend_id,
         coalesce(p.persona, 'Unknown') AS friend_name
  FROM friend_edge e JOIN profile p ON p.account_id = e.friend_id AND p.player_found
  WHERE e.pos < {k}{where}
)"""


def _cands(sweep: bool) -> str:
    if sweep:
        return """
cands AS (
  SELECT f.account_id, s.friends, f.friend_pos, f.friend_id, t.rank_in_friend, t.appid, t.name, t.playtime
  FROM friends f JOIN top10 t ON t.owner_id = f.friend_id
  JOIN (VALUES (10), (25), (50)) s(friends) ON f.friend_pos < s.friends
)"""
    return """
cands AS (
  SELECT f.account_id, f.friend_pos, f.friend_id, t.rank_in_friend, t.appid, t.name, t.playtime
  FROM friends f JOIN top10 t ON t.owner_id = f.friend_id
)"""


def _recommend(k: int = 10, mode: str = "by_name", sweep: bool = False, top_n: int | None = 10,
               one: bool = False, owned: str = "library", extra: tuple[str, ...] = ()) -> str:
    keys = "account_id, friends" if sweep else "account_id"
    first = "min(friend_pos * 100 + rank_in_friend) AS first_seen"
    if mode == "by_name":
        agg = f"""
agg AS (
  SELECT {keys}, appid, name, CAST(sum(playtime) AS BIGINT) AS total_playtime, {first}
  FROM cands GROUP BY {keys}, appid, name
)"""
    else:
        agg = f"""
agg AS (
  SELECT {keys}, appid, arg_max(name, friend_pos * 100 + rank_in_friend) AS name,
         CAST(sum(playtime) AS BIGINT) AS total_playtime, {first}
  FROM cands GROUP BY {keys}, appid
)"""
    ranked = f"""
kept AS (
  SELECT a.* FROM agg a ANTI JOIN {owned} o ON o.account_id = a.account_id AND o.appid = a.appid
),
ranked AS (
  SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY total_playtime DESC, first_seen)
         AS INTEGER) AS rank, appid, name, total_playtime
  FROM kept
)"""
    where = f" WHERE rank <= {top_n}" if top_n else ""
    return _with(*extra, _friends(50 if sweep else k, one), _cands(sweep), agg, ranked) + \
        f"\nSELECT {keys}, rank, appid, name, total_playtime FROM ranked{where}"


OWNED_WITH_FRIENDS = """
owned_all AS (
  SELECT account_id, appid FROM library
  UNION ALL
  SELECT e.account_id, t.appid FROM friend_edge e JOIN top10 t ON t.owner_id = e.friend_id
  WHERE e.pos < 10
)"""


def _recommend_empty() -> str:
    return _recommend(owned="owned_all", extra=(OWNED_WITH_FRIENDS,))


def _profile_summary(where: str = "") -> str:
    return _with() + f"""
SELECT account_id,
       CASE WHEN player_found THEN 'OK' ELSE 'NO_PROFILE' END AS status,
       CASE WHEN player_found THEN coalesce(persona, 'Unknown') END AS name,
       CASE WHEN player_found THEN coalesce(country, '?') END AS location,
       CASE WHEN player_found THEN
            CASE WHEN timecreated IS NULL OR timecreated = 0 THEN 'Unknown'
                 ELSE strftime(DATE '1970-01-01' + CAST(floor(timecreated / 86400) AS INTEGER), '%Y-%m-%d')
            END END AS created,
       CASE WHEN player_found THEN 'Profile Summary for ' || coalesce(persona, 'Unknown User') END AS title,
       CASE WHEN player_found THEN '{PROFILE_URL}' || CAST(account_id AS VARCHAR) END AS profile_url
FROM profile {where}"""


LABEL = """(CASE WHEN event_id % 2 = 0 THEN 'spark' ELSE 'manual' END) || '_recommendation_' ||
 CAST(CASE user_id % 3 WHEN 0 THEN 10 WHEN 1 THEN 25 ELSE 50 END AS VARCHAR) || '_friends_' ||
 (CASE WHEN event_type IN ('click', 'view') THEN 'useCache' ELSE 'noCache' END)"""

RUN_LOG = f"""WITH run_log AS (
  SELECT {LABEL} AS label, CAST(printf('%.3f', value) AS DOUBLE) AS duration_ms FROM events
)"""

SNAPSHOT = """WITH snapshot AS (
  SELECT CASE event_type WHEN 'click' THEN 'user' WHEN 'view' THEN 'game'
                         WHEN 'purchase' THEN 'friend' WHEN 'signup' THEN 'news'
                         ELSE event_type END AS kind,
         user_id AS key, props AS payload, ts AS fetched_at
  FROM events
),
latest AS (
  SELECT kind, key, fetched_at, payload FROM (
    SELECT *, row_number() OVER (PARTITION BY kind, key ORDER BY fetched_at DESC, payload DESC) AS rn
    FROM snapshot) WHERE rn = 1
),
fresh AS (
  SELECT *, CAST(date_diff('microsecond', fetched_at, TIMESTAMP '2024-01-31 00:00:00') AS DOUBLE) / 1e6
            AS age_seconds
  FROM latest
),
flagged AS (
  SELECT *, kind IN ('user', 'game', 'friend') AND age_seconds < 36000.0 AS is_fresh FROM fresh
),
wanted AS (
  SELECT k.kind, c.c_custkey AS key FROM customer c,
  (VALUES ('user'), ('game'), ('friend')) k(kind)
)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["recommend_one"] = _recommend(one=True)
    q["recommend_all_k10"] = _recommend()
    q["recommend_rank"] = _recommend(top_n=None)
    q["recommend_from_documents"] = _recommend()
    q["recommend_after_delta"] = _recommend()
    q["recommend_sweep"] = _recommend(sweep=True)
    q["recommend_sweep_by_appid"] = _recommend(sweep=True, mode="by_appid")
    q["recommend_by_appid"] = _recommend(mode="by_appid")
    q["recommend_hours"] = f"""SELECT account_id, rank, name, total_playtime,
  CAST(printf('%.1f', CAST(total_playtime AS DOUBLE) / 60.0) AS DOUBLE) AS hours,
  printf('%.1f', CAST(total_playtime AS DOUBLE) / 60.0) || ' hrs' AS hours_label
FROM ({_recommend()}) r"""
    q["recommend_empty"] = _recommend_empty()
    q["top10_per_friend"] = _with() + """
SELECT owner_id AS account_id, rank_in_friend, pos, appid, name, playtime FROM top10"""
    # Appids are never null in the test tables, so a plain anti-join is the null-safe one.
    q["owned_exclusion"] = _with(_friends(10), _cands(False)) + """
SELECT c.* FROM cands c
ANTI JOIN (SELECT DISTINCT account_id, appid FROM library) l ON l.account_id = c.account_id AND l.appid = c.appid"""
    q["friends_used"] = _with(_friends(10)) + """
SELECT account_id, string_agg(friend_name, chr(10) ORDER BY friend_pos) AS friends_used,
       count(*) AS friends_used_count
FROM friends GROUP BY account_id"""
    q["friend_network"] = _with() + """
SELECT e.account_id, e.pos, e.friend_id,
       coalesce(CASE WHEN coalesce(p.player_found, false) THEN p.persona END, 'Unknown') AS name,
       coalesce(CASE WHEN coalesce(p.player_found, false) THEN p.country END, '—') AS country,
       coalesce(p.player_found, false) AS profile_found
FROM friend_edge e LEFT JOIN profile p ON p.account_id = e.friend_id
WHERE e.pos < 10"""
    q["friend_count"] = _with() + """
SELECT account_id, count(*) AS friends_shown FROM friend_edge WHERE pos < 10 GROUP BY account_id"""
    q["profile_summary"] = _profile_summary()
    q["profile_summary_from_documents"] = _profile_summary()
    q["account_status"] = _with() + """,
s_library AS (
  SELECT account_id, CASE WHEN account_id % 11 = 2 THEN 0 ELSE playtime_min END AS playtime_min
  FROM library WHERE account_id % 11 > 1
),
s_friends AS (SELECT * FROM friend_edge WHERE account_id % 9 > 1),
s_profile AS (SELECT * FROM profile WHERE account_id % 8 <> 0),
s_cands AS (
  SELECT DISTINCT e.account_id FROM s_friends e
  JOIN s_profile p ON p.account_id = e.friend_id AND p.player_found
  JOIN (SELECT DISTINCT account_id FROM s_library) o ON o.account_id = e.friend_id
  WHERE e.pos < 10
)
SELECT c.c_custkey AS account_id,
  CASE WHEN p.account_id IS NULL THEN 'NO_DATA' WHEN NOT p.player_found THEN 'NO_PROFILE' ELSE 'OK' END
    AS profile_status,
  CASE WHEN c.c_custkey % 11 = 0 THEN 'NO_DATA' WHEN l.account_id IS NULL THEN 'NO_GAMES'
       WHEN l.most <= 0 THEN 'NO_PLAYTIME' ELSE 'OK' END AS library_status,
  CASE WHEN c.c_custkey % 9 = 0 THEN 'NO_DATA' WHEN f.account_id IS NULL THEN 'NO_FRIENDS' ELSE 'OK' END
    AS friends_status,
  CASE WHEN k.account_id IS NULL THEN 'NO_CANDIDATES' ELSE 'OK' END AS recommend_status
FROM (SELECT DISTINCT c_custkey FROM customer) c
LEFT JOIN s_profile p ON p.account_id = c.c_custkey
LEFT JOIN (SELECT account_id, max(playtime_min) AS most FROM s_library GROUP BY account_id) l ON l.account_id = c.c_custkey
LEFT JOIN (SELECT DISTINCT account_id FROM s_friends) f ON f.account_id = c.c_custkey
LEFT JOIN s_cands k ON k.account_id = c.c_custkey"""
    damaged = ("""
d_library AS (SELECT * FROM library WHERE account_id % 10 <> 3)""", """
d_top10 AS (SELECT * FROM top10 WHERE owner_id % 10 <> 3)""", """
friends AS (
  SELECT e.account_id, e.pos AS friend_pos, e.friend_id
  FROM friend_edge e JOIN profile p ON p.account_id = e.friend_id AND p.player_found
  WHERE e.pos < 10 AND e.pos % 7 <> 3 AND e.friend_id % 6 <> 0
)""", """
agg AS (
  SELECT f.account_id, t.appid, t.name, CAST(sum(t.playtime) AS BIGINT) AS total_playtime,
         min(f.friend_pos * 100 + t.rank_in_friend) AS first_seen
  FROM friends f JOIN d_top10 t ON t.owner_id = f.friend_id
  GROUP BY f.account_id, t.appid, t.name
)""", """
ranked AS (
  SELECT a.account_id, CAST(row_number() OVER (PARTITION BY a.account_id ORDER BY total_playtime DESC, first_seen)
         AS INTEGER) AS rank, a.appid, a.name, a.total_playtime
  FROM agg a ANTI JOIN d_library o ON o.account_id = a.account_id AND o.appid = a.appid
)""")
    q["recommend_from_damaged_documents"] = _with(*damaged) + """
SELECT account_id, rank, appid, name, total_playtime FROM ranked WHERE rank <= 10"""
    q["account_selection"] = _profile_summary(
        "WHERE account_id IN (SELECT TRY_CAST(CAST(user_id AS VARCHAR) AS BIGINT) FROM events "
        "WHERE regexp_full_match(CAST(user_id AS VARCHAR), '[0-9]+'))"
    )
    q["library_explode"] = _with() + "\nSELECT account_id, pos, appid, name, playtime_min FROM library"
    q["library_from_containers"] = q["library_explode"]
    q["document_summary"] = _with() + """
SELECT 'user' AS kind, account_id AS key, CAST(0 AS BIGINT) AS page, CAST(CASE WHEN player_found THEN 1 ELSE 0 END AS BIGINT) AS n_entries,
       persona, CAST(NULL AS BIGINT) AS first_id FROM profile
UNION ALL
SELECT 'game', account_id, CAST(floor(pos / 1000) AS BIGINT), count(*), CAST(NULL AS VARCHAR), arg_min(appid, pos) FROM library GROUP BY ALL
UNION ALL
SELECT 'friend', account_id, CAST(floor(pos / 1000) AS BIGINT), count(*), CAST(NULL AS VARCHAR), arg_min(friend_id, pos) FROM friend_edge GROUP BY ALL
UNION ALL
SELECT 'news', TRY_CAST(substr(source, 4) AS BIGINT), CAST(floor(doc_id / 64) AS BIGINT), count(*), CAST(NULL AS VARCHAR), min(doc_id) FROM documents GROUP BY ALL"""
    q["game_defaults"] = _with() + "\nSELECT owner_id AS account_id, pos, appid, name, playtime FROM games"
    top15 = _with() + """
SELECT account_id, rank, appid, name, total_playtime FROM (
  SELECT account_id, appid, name, playtime_min AS total_playtime,
         CAST(row_number() OVER (PARTITION BY account_id ORDER BY playtime_min DESC, pos) AS INTEGER) AS rank
  FROM library WHERE playtime_min > 0) WHERE rank <= 15"""
    q["library_top15"] = top15
    q["library_hours"] = f"""SELECT account_id, rank, name,
  CAST(floor(total_playtime / 60) AS BIGINT) AS hours,
  format('{{:,}}', CAST(floor(total_playtime / 60) AS BIGINT)) || ' hrs' AS hours_label
FROM ({top15}) t"""
    q["most_played"] = _with() + f"""
SELECT account_id, appid, name AS game, playtime AS playtime_min,
       printf('%dh %dm', CAST(floor(playtime / 60) AS BIGINT), CAST(((playtime % 60) + 60) % 60 AS BIGINT))
         AS playtime_label,
       '{PROFILE_URL}' || CAST(account_id AS VARCHAR) AS profile_url
FROM (SELECT owner_id AS account_id, appid, name, playtime,
             row_number() OVER (PARTITION BY owner_id ORDER BY playtime DESC, pos) AS rn FROM games)
WHERE rn = 1"""
    q["snapshot_latest"] = SNAPSHOT + "\nSELECT kind, key, fetched_at, payload FROM latest"
    q["snapshot_latest_compacted"] = q["snapshot_latest"]
    q["snapshot_fresh"] = SNAPSHOT + "\nSELECT kind, key, fetched_at, age_seconds, is_fresh FROM flagged"
    q["snapshot_refresh_list"] = SNAPSHOT + """
SELECT w.kind, w.key FROM wanted w
WHERE NOT EXISTS (SELECT 1 FROM flagged f WHERE f.is_fresh AND f.kind = w.kind AND f.key = w.key)"""
    q["snapshot_refresh_list_nocache"] = SNAPSHOT + """
SELECT w.kind, w.key FROM wanted w
WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.kind = w.kind AND f.key = w.key
                  AND f.kind IN ('user', 'game', 'friend')
                  AND f.age_seconds < CASE WHEN f.kind = 'user' THEN 0.5 ELSE 36000.0 END)"""
    q["snapshot_cache_hits"] = SNAPSHOT + """
SELECT w.kind, w.key, f.payload FROM wanted w
JOIN flagged f ON f.is_fresh AND f.kind = w.kind AND f.key = w.key"""
    q["snapshot_hits_located"] = q["snapshot_cache_hits"]
    q["runlog_parse"] = RUN_LOG + "\nSELECT label, duration_ms FROM run_log"
    q["runlog_averages"] = RUN_LOG + """
SELECT label, round(avg(duration_ms), 6) AS avg_ms, count(*) AS runs,
       label || ': ' || printf('%.3f', avg(duration_ms)) || ' ms (avg over ' || count(*) || ' runs)' AS line
FROM run_log GROUP BY label"""
    q["runlog_comparison"] = RUN_LOG + """,
averages AS (SELECT label, avg(duration_ms) AS avg_ms FROM run_log GROUP BY label),
counts AS (
  SELECT DISTINCT CAST(split_part(label, '_', 3) AS BIGINT) AS friends FROM averages
  WHERE len(string_split(label, '_')) >= 4 AND regexp_full_match(split_part(label, '_', 3), '[0-9]+')
),
cells AS (
  SELECT c.friends,
    coalesce(max(CASE WHEN a.label = 'manual_recommendation_' || c.friends || '_friends_useCache' THEN a.avg_ms END), 0.0) AS mc,
    coalesce(max(CASE WHEN a.label = 'manual_recommendation_' || c.friends || '_friends_noCache' THEN a.avg_ms END), 0.0) AS mn,
    coalesce(max(CASE WHEN a.label = 'spark_recommendation_' || c.friends || '_friends_useCache' THEN a.avg_ms END), 0.0) AS sc,
    coalesce(max(CASE WHEN a.label = 'spark_recommendation_' || c.friends || '_friends_noCache' THEN a.avg_ms END), 0.0) AS sn
  FROM counts c CROSS JOIN averages a GROUP BY c.friends
)
SELECT friends, round(mc, 6) AS manual_cached, round(mn, 6) AS manual_nocache,
       round(sc, 6) AS spark_cached, round(sn, 6) AS spark_nocache,
       printf('%-10d%-18s%-20s%-18s%s', friends, printf('%.3f', mc), printf('%.3f', mn),
              printf('%.3f', sc), printf('%.3f', sn)) AS line
FROM cells"""
    q["resource_averages"] = f"""
WITH samples AS (SELECT {LABEL} AS label, value AS cpu_pct, value + user_id AS rss_mb FROM events)
SELECT label, round(avg(cpu_pct), 6) AS avg_cpu_pct, round(avg(rss_mb), 6) AS avg_rss_mb,
       count(*) AS samples,
       label || ': AVG_CPU=' || printf('%.2f', avg(cpu_pct)) || '% AVG_MEM=' || printf('%.2f', avg(rss_mb))
         || 'MB over ' || count(*) || ' samples' AS line
FROM samples GROUP BY label"""
    q["runlog_sink"] = q["runlog_parse"]
    q["runlog_batches"] = q["runlog_parse"]
    q["decimal_texts"] = """
SELECT event_id, printf('%.1f', value) AS value_1, printf('%.2f', value) AS value_2, printf('%.3f', value) AS value_3,
       printf('%.3f', value / 1000) AS milli, printf('%.3f', -value / 1000000) AS micro, printf('%.1f', floor(value * 8) / 16) AS half
FROM events"""
    q["resource_sink"] = f"SELECT line AS value FROM ({q['resource_averages']}) r"
    header = "printf('%-10s%-18s%-20s%-18s%s', 'Friends', 'Manual (Cached)', 'Manual (No Cache)', 'Spark (Cached)', 'Spark (No Cache)')"
    q["summary_report"] = f"""
SELECT line AS value FROM ({q['runlog_averages']}) a
UNION ALL SELECT line FROM ({q['runlog_comparison']}) c
UNION ALL SELECT unnest(['=== Individual Averages ===', '', '=== Comparison Table (Manual vs Spark with/without cache) ===',
                         {header}, repeat('-', length({header}) + 1)])"""
    # Sources are named src<number>; a source of another name has a hash for its key, which DuckDB has not got.
    q["news_from_snapshots"] = """
SELECT app, rank, news_id, contents, body_chars FROM (
  SELECT TRY_CAST(substr(source, 4) AS BIGINT) AS app, doc_id AS news_id, substring(text, 1, 300) AS contents,
         CAST(length(text) AS BIGINT) AS body_chars,
         CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS INTEGER) AS rank
  FROM documents) WHERE rank <= 3"""
    q["news_latest3"] = """
SELECT app, rank, news_id, contents, body_chars FROM (
  SELECT source AS app, doc_id AS news_id, substring(text, 1, 300) AS contents,
         CAST(length(text) AS BIGINT) AS body_chars,
         CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS INTEGER) AS rank
  FROM documents) WHERE rank <= 3"""
    return q

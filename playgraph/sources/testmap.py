"""Test tables -> canonical tables (the mapping of FIXTURES.md section 2).

customers are accounts, parts are games, summed line quantities are minutes
played, and each nation is a ring of friends ordered by customer key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.functions.formats import fixed_decimals
from playgraph.functions.ranking import DEFAULT_BUCKET_WIDTH, dense_position
from playgraph.functions.timecols import epoch_seconds, ntz_literal
from playgraph.sources.tables import Tables

# Fixed values of the mapping.
FRIEND_LIST_LEN = 60          # friend list length (longer than the longest sweep step, which so cuts)
PERSONA_NULL_EVERY = 7        # c_custkey % 7 = 0 -> no persona
COUNTRY_NULL_EVERY = 5        # c_custkey % 5 = 0 -> no country
CREATED_ZERO_EVERY = 10       # c_custkey % 10 = 0 -> timecreated 0
NO_PLAYER_EVERY = 13          # c_custkey % 13 = 0 -> players: []
EVENT_KIND = {"click": "user", "view": "game", "purchase": "friend", "signup": "news"}
CACHED_EVENT_TYPES = ("click", "view")   # -> "useCache", others "noCache"
SNAPSHOT_NOW = "2024-01-31 00:00:00"
DELTA_FROM = "2001-06-01 00:00:00"        # orders from here on are the change that recommendations are refreshed for
FIRST_FETCH = "2024-01-01 00:00:00"      # weeks of the stored log count from here
COMPACTED_AT = ("2024-01-15 00:00:00", "2024-01-29 00:00:00")
NEWS_PAGE_IDS = 64            # a stored news page covers this many consecutive item ids


def played(t: Tables, accounts: DataFrame | None = None, before: str | None = None) -> DataFrame:
    """account_id, appid, playtime_min: one row per owned game.

    The sum is partial + final on (account, appid), so a hot account's lines
    are reduced map-side and its games spread over tasks.  ``accounts`` (column
    account_id) restricts the orders before the lines are joined, ``before`` to
    those of an earlier date.  All orders grow with the lines, so both sides
    are shuffled: their compressed size must not lead to a broadcast.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    orders = t.orders if before is None else t.orders.filter(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
    o = orders.select("o_orderkey", F.col("o_custkey").alias("account_id"))
    if accounts is None:
        o = o.hint("merge")
    else:
        o = o.join(accounts.select("account_id").distinct(), "account_id", "left_semi")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .groupBy("account_id", F.col("l_partkey").alias("appid"))
        .agg(F.sum("l_quantity").cast("bigint").alias("playtime_min"))
    )


def library(t: Tables, bucket_width: int = DEFAULT_BUCKET_WIDTH, pairs: DataFrame | None = None) -> DataFrame:
    """account_id, pos, appid, name, playtime_min from ``played`` pairs (default: those of all accounts).

    Names join last, against the already summed and ranked rows; they grow with
    the games, so they are never broadcast.
    """
    pairs = played(t) if pairs is None else pairs
    lib = dense_position(pairs, ["account_id"], "appid", "pos", bucket_width)
    names = t.part.select(F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"))
    return lib.join(names.hint("merge"), "appid", "left").select("account_id", "pos", "appid", "name", "playtime_min")


def friend_edge(
    t: Tables, list_len: int = FRIEND_LIST_LEN, bucket_width: int = DEFAULT_BUCKET_WIDTH
) -> DataFrame:
    """account_id, pos, friend_id: friend k (pos k-1) is ring rank (r+k) mod n.

    Each ranked customer emits its own slot (k = 0, at rank r) and one slot
    per friend k (at rank (r+k) mod n).  A window over (nation, rank) then
    hands every friend slot the account sitting at that rank.  A window
    group holds at most one own slot plus ``list_len`` friend slots, and
    the ranking is consumed once (no self-join of the ranked customers, no
    pair enumeration within a nation).
    """
    c = t.customer.select(F.col("c_custkey").alias("account_id"), F.col("c_nationkey").alias("nation"))
    ranked = dense_position(c, ["nation"], "account_id", "r", bucket_width, size="n")
    last = F.least(F.lit(list_len), F.col("n") - 1).cast("int")
    steps = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    slots = ranked.select(
        "account_id", "nation", "r", "n", F.explode(F.concat(F.array(F.lit(0)), steps)).alias("k")
    ).withColumn("t", F.pmod(F.col("r") + F.col("k"), F.col("n")))
    at_rank = F.max(F.when(F.col("k") == 0, F.col("account_id"))).over(Window.partitionBy("nation", "t"))
    return (
        slots.withColumn("friend_id", at_rank)
        .filter(F.col("k") >= 1)
        .select("account_id", (F.col("k") - 1).cast("int").alias("pos"), "friend_id")
    )


def profile(t: Tables) -> DataFrame:
    """account_id, player_found, persona, country, timecreated."""
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order")
    )
    key = F.col("c_custkey")
    found = F.pmod(key, F.lit(NO_PLAYER_EVERY)) != 0

    def when_found(value):
        return F.when(found, value)

    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(first.hint("merge"), "c_custkey", "left")
        .select(
            key.alias("account_id"),
            found.alias("player_found"),
            when_found(F.when(F.pmod(key, F.lit(PERSONA_NULL_EVERY)) != 0, F.col("c_name"))).alias("persona"),
            when_found(F.when(F.pmod(key, F.lit(COUNTRY_NULL_EVERY)) != 0, F.col("n_name"))).alias("country"),
            when_found(
                F.when(F.pmod(key, F.lit(CREATED_ZERO_EVERY)) == 0, F.lit(0).cast("bigint"))
                .otherwise(epoch_seconds("first_order"))
            ).alias("timecreated"),
        )
    )


def accounts(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("account_id"))


def status_inputs(t: Tables, lib: DataFrame, edges: DataFrame, prof: DataFrame) -> dict[str, DataFrame]:
    """Inputs of the account status in which every status word occurs.

    By account number: modulo 8 = 0 has no profile document; modulo 11 = 0 no
    library document, 1 an empty library, 2 a library never played; modulo 9 =
    0 no friend document, 1 an empty friend list.
    """
    def by(m):
        return F.pmod(F.col("account_id"), F.lit(m))

    unplayed = F.when(by(11) == 2, F.lit(0).cast("bigint")).otherwise(F.col("playtime_min"))
    return {
        "profile": prof.filter(by(8) != 0),
        "library": lib.filter(by(11) > 1).withColumn("playtime_min", unplayed),
        "friend_edge": edges.filter(by(9) > 1),
        "library_docs": accounts(t).filter(by(11) != 0),
        "friend_docs": accounts(t).filter(by(9) != 0),
    }


def _kind(event_type):
    expr = None
    for src, kind in EVENT_KIND.items():
        expr = (F.when(event_type == src, F.lit(kind)) if expr is None
                else expr.when(event_type == src, F.lit(kind)))
    return expr.otherwise(event_type)


def snapshot(t: Tables) -> DataFrame:
    """kind, key, payload, fetched_at (an append-only log of fetched docs)."""
    e = t.events
    return e.select(
        _kind(F.col("event_type")).alias("kind"),
        F.col("user_id").alias("key"),
        F.col("props").alias("payload"),
        F.col("ts").alias("fetched_at"),
    )


def _label(e):
    engine = F.when(F.pmod(e.event_id, F.lit(2)) == 0, F.lit("spark")).otherwise(F.lit("manual"))
    friends = F.element_at(F.array(*[F.lit(k) for k in S.SWEEP_FRIENDS]),
                           (F.pmod(e.user_id, F.lit(3)) + 1).cast("int"))
    cache = F.when(e.event_type.isin(*CACHED_EVENT_TYPES), F.lit("useCache")).otherwise(F.lit("noCache"))
    return F.concat(engine, F.lit("_recommendation_"), friends.cast("string"), F.lit("_friends_"), cache)


def run_log_lines(t: Tables) -> DataFrame:
    """``value`` text lines ``label: ms`` as the timer appends them."""
    e = t.events
    return e.select(F.concat(_label(e), F.lit(": "), fixed_decimals(e.value, 3)).alias("value"))


def resource_sample(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        _label(e).alias("label"),
        e.value.alias("cpu_pct"),
        (e.value + e.user_id).alias("rss_mb"),
    )


def news(t: Tables) -> DataFrame:
    """app, news_id, body (newer items have larger ids)."""
    d = t.documents
    return d.select(
        F.col("source").alias("app"), F.col("doc_id").alias("news_id"), F.col("text").alias("body")
    )


def news_key(app: Column) -> Column:
    """The 64-bit key of a source: k for ``srck``, a negative hash for any other name, null for null.

    Numbers with leading zeros or beyond 64 bits are hashed like names, so no two of them share a key.
    """
    number = F.regexp_extract(app, "^src([0-9]+)$", 1).try_cast("bigint")
    named = F.when(app.isNotNull(), F.xxhash64(app).bitwiseOR(F.lit(-(1 << 63))))
    return F.when(F.concat(F.lit("src"), number.cast("string")) == app, number).otherwise(named)


def news_snapshot(t: Tables) -> DataFrame:
    """kind, key, page, payload, fetched_at: every news item with its whole body, in stored documents of bounded size.

    A page of an app holds its items of ``NEWS_PAGE_IDS`` consecutive ids, so no
    document and no ``collect_list`` group grows with an app's history.
    """
    # Items without an id have no range; their page is a hash of the body.
    page = F.coalesce(F.floor(F.col("news_id") / F.lit(NEWS_PAGE_IDS)), F.xxhash64("body")).alias("page")
    item = F.struct(F.col("news_id").cast("string").alias("gid"), F.col("body").alias("contents"), F.lit(0).cast("bigint").alias("date"))
    docs = news(t).groupBy(news_key(F.col("app")).alias("key"), page).agg(F.sort_array(F.collect_list(F.struct("news_id", item.alias("item")))).alias("sorted"))
    docs = docs.withColumn("newsitems", F.transform("sorted", lambda x: x["item"]))
    doc = F.struct(F.struct(F.col("key").alias("appid"), F.col("newsitems")).alias("appnews"))
    return docs.select(F.lit("news").alias("kind"), "key", "page", F.to_json(doc).alias("payload"), snapshot_now().alias("fetched_at"))


def account_list_lines(t: Tables) -> DataFrame:
    """A run's account list as text lines: the id of every event's account
    (one line per event, so ids repeat)."""
    return t.events.select(F.col("user_id").cast("string").alias("value"))


def snapshot_now():
    """The fixed 'now' of the snapshot checks on the test tables."""
    return ntz_literal(SNAPSHOT_NOW)

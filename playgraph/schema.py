"""Document schemas, canonical table schemas and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Input documents (nested JSON, one document per key).  Field names are those
# of the documents as delivered by the web API and must not change.
# ---------------------------------------------------------------------------
PROFILE_DOC = (
    "response struct<players:array<struct<personaname:string,"
    "loccountrycode:string,timecreated:bigint>>>"
)
LIBRARY_DOC = (
    "response struct<games:array<struct<appid:bigint,name:string,"
    "playtime_forever:bigint>>>"
)
FRIENDS_DOC = "friendslist struct<friends:array<struct<steamid:string>>>"

# ---------------------------------------------------------------------------
# Canonical tables.  Account ids are 64-bit integers (the 17-digit ids of the
# documents fit a signed bigint); integer keys hash, sort and shuffle cheaper
# than strings.
# ---------------------------------------------------------------------------
PROFILE = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("player_found", T.BooleanType()),
        T.StructField("persona", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("timecreated", T.LongType()),
    ]
)
LIBRARY = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("appid", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("playtime_min", T.LongType()),
    ]
)
FRIEND_EDGE = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("friend_id", T.LongType()),
    ]
)
SNAPSHOT = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("fetched_at", T.TimestampNTZType()),
    ]
)
RUN_LOG = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("duration_ms", T.DoubleType()),
    ]
)
RESOURCE_SAMPLE = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("cpu_pct", T.DoubleType()),
        T.StructField("rss_mb", T.DoubleType()),
    ]
)

RECOMMENDATION = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("appid", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("total_playtime", T.LongType()),
    ]
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# ---------------------------------------------------------------------------
FRIENDS_SHOWN = 10            # friends listed in the friend overview
FRIENDS_USED = 10             # friends used for one recommendation
GAMES_PER_FRIEND = 10         # top games taken from each friend
RECOMMENDATIONS = 10          # recommendations reported per account
HABITS_TOP = 15               # most played games listed per account
SWEEP_FRIENDS = (10, 25, 50)  # friend counts of the benchmark sweep
CACHE_TTL_SECONDS = 36000.0   # ten hours
LATEST_TTL_SECONDS = 0.5      # "latest" mode
NEWS_PER_APP = 3
NEWS_MAX_CHARS = 300
CACHED_KINDS = ("user", "game", "friend")  # kinds the freshness check knows
DEFAULT_NAME = "Unknown"
DEFAULT_TITLE_NAME = "Unknown User"
DEFAULT_COUNTRY_PROFILE = "?"
DEFAULT_COUNTRY_FRIEND = "—"  # em dash
UNKNOWN_DATE = "Unknown"
UNKNOWN_GAME_PREFIX = "Unknown ("  # + appid + ")"
NULL_APPID_TEXT = "None"           # how a missing appid renders in a name
TITLE_PREFIX = "Profile Summary for "
HOURS_SUFFIX = " hrs"
# Profile link prefix: deployment setting, the account id is appended.
PROFILE_URL_PREFIX = "https://community.example/profiles/"
# Status words of the account status table.
OK = "OK"
NO_DATA = "NO_DATA"
NO_PROFILE = "NO_PROFILE"
NO_GAMES = "NO_GAMES"
NO_PLAYTIME = "NO_PLAYTIME"
NO_FRIENDS = "NO_FRIENDS"
NO_CANDIDATES = "NO_CANDIDATES"

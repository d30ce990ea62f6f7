"""Nested JSON documents <-> canonical tables.

Documents are read with an explicit schema (no inference pass, and an empty
``games`` array keeps its element type).  The account key of a file is its
name: ``{id}.json`` for profiles, ``games_{id}.json`` for libraries and
``friends_{id}.json`` for friend lists; a folder of that name (what
``write_documents`` makes) counts like a file.  Payload strings held in the
``snapshot`` table go through the same parsers via ``from_json``.  Files whose
name or content is unusable are never dropped silently: ``document_rejects``
lists them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playgraph import schema as S

# File-name prefix per document kind; the account id follows.
KEY_PREFIX = {"user": "", "game": "games_", "friend": "friends_", "news": "news_"}
FOLDER = "document"  # partition column of written documents
DOC_SCHEMAS = {"user": S.PROFILE_DOC, "game": S.LIBRARY_DOC, "friend": S.FRIENDS_DOC}
CORRUPT = "_corrupt_record"


def document_file_name(kind: str, key: str = "account_id") -> Column:
    """The file name of a key's document."""
    return F.concat(F.lit(KEY_PREFIX[kind]), F.col(key).cast("string"), F.lit(".json"))


def _key_of(path: Column, kind: str) -> Column:
    """The account id in a document's path (file or folder name); null when the name has none or it is no 64-bit integer."""
    text = F.regexp_extract(path, rf"(?:^|/)(?:{FOLDER}=)?{KEY_PREFIX[kind]}([0-9]+)\.json(?:/[^/]*)?$", 1)
    return text.try_cast("bigint")


def _scan(spark: SparkSession, path: str, kind: str, multiline: bool) -> DataFrame:
    reader = (
        spark.read.schema(f"{DOC_SCHEMAS[kind]}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", str(multiline).lower())
    )
    try:
        df = reader.json(path)
    except AnalysisException as missing:  # a folder that nothing was fetched into yet
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"account_id bigint, __path string, {DOC_SCHEMAS[kind]}, {CORRUPT} string")
    fields = [c for c in df.columns if c != FOLDER]
    where = F.col("_metadata.file_path")
    return df.select(_key_of(where, kind).alias("account_id"), where.alias("__path"), *fields)


def read_documents(spark: SparkSession, path: str, kind: str, multiline: bool = False) -> DataFrame:
    """account_id + the document's top-level fields, one row per document.

    Malformed files come back with all fields null and the raw text in
    ``_corrupt_record`` (PERMISSIVE mode); the canonical tables leave them out.
    Files whose name holds no usable id are in ``document_rejects`` only.
    """
    return _scan(spark, path, kind, multiline).filter(F.col("account_id").isNotNull()).drop("__path")


def document_rejects(spark: SparkSession, path: str, kind: str, multiline: bool = False) -> DataFrame:
    """path, reason (``name`` or ``content``) of every file that gives no usable document."""
    df = _scan(spark, path, kind, multiline)
    # The reader refuses queries on the corrupt-record column alone, so a
    # document field (null whenever the record is corrupt) is read beside it.
    field = next(c for c in df.columns if c not in ("account_id", "__path", CORRUPT))
    unreadable = F.col(CORRUPT).isNotNull() & F.col(field).isNull()
    reason = F.when(F.col("account_id").isNull(), F.lit("name")).when(unreadable, F.lit("content"))
    return df.select(F.col("__path").alias("path"), reason.alias("reason")).filter(F.col("reason").isNotNull())


def parse_payload(df: DataFrame, kind: str, payload: str = "payload") -> DataFrame:
    """Parse a JSON string column into the document's top-level fields, plus
    the raw text of payloads that do not parse in ``_corrupt_record``."""
    doc = F.from_json(
        F.col(payload), f"{DOC_SCHEMAS[kind]}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    others = [c for c in df.columns if c not in (payload, CORRUPT)]
    return df.select(*others, doc.alias("__doc")).select(*others, "__doc.*")


def _readable(docs: DataFrame) -> DataFrame:
    """Documents that parsed (a corrupt one counts as not there)."""
    return docs.filter(F.col(CORRUPT).isNull()) if CORRUPT in docs.columns else docs


# --- documents -> canonical tables ------------------------------------------

def profile_from_documents(docs: DataFrame) -> DataFrame:
    """account_id, player_found, persona, country, timecreated.

    A missing ``players`` (or ``response``) gives an all-default profile; an
    empty ``players`` array means the account has no player.  A document that
    does not parse gives no row: as a friend, its account is skipped.
    """
    docs = _readable(docs)
    players = F.col("response.players")
    first = F.get(players, 0)
    found = ~(players.isNotNull() & (F.size(players) == 0))
    return docs.select(
        "account_id",
        found.alias("player_found"),
        first["personaname"].alias("persona"),
        first["loccountrycode"].alias("country"),
        first["timecreated"].alias("timecreated"),
    )


def library_from_documents(docs: DataFrame) -> DataFrame:
    """account_id, pos, appid, name, playtime_min; documents without games
    yield no rows (their status is in ``library_status``)."""
    exploded = _readable(docs).select("account_id", F.posexplode("response.games").alias("pos", "game"))
    return exploded.select(
        "account_id",
        F.col("pos").cast("int").alias("pos"),
        F.col("game.appid").alias("appid"),
        F.col("game.name").alias("name"),
        F.col("game.playtime_forever").alias("playtime_min"),
    )


def library_status(docs: DataFrame) -> DataFrame:
    """account_id, library_status: NO_DATA (unreadable, or without a ``response`` or with an empty one),
    NO_GAMES (empty list), NO_PLAYTIME (no game ever played) or OK."""
    games = F.col("response.games")
    played = F.exists(games, lambda g: g["playtime_forever"] > 0)
    return docs.select(
        "account_id",
        F.when(games.isNull(), F.lit(S.NO_DATA))
        .when(F.size(games) == 0, F.lit(S.NO_GAMES))
        .when(~F.coalesce(played, F.lit(False)), F.lit(S.NO_PLAYTIME))
        .otherwise(F.lit(S.OK)).alias("library_status"),
    )


def friend_edge_from_documents(docs: DataFrame) -> DataFrame:
    """account_id, pos, friend_id; an id that is no 64-bit integer is null (``bad_friend_ids`` lists it) and joins nothing."""
    exploded = _readable(docs).select("account_id", F.posexplode("friendslist.friends").alias("pos", "f"))
    return exploded.select(
        "account_id",
        F.col("pos").cast("int").alias("pos"),
        F.col("f.steamid").try_cast("bigint").alias("friend_id"),
    )


def bad_friend_ids(docs: DataFrame) -> DataFrame:
    """account_id, pos, value of friend entries whose id is no 64-bit integer."""
    exploded = _readable(docs).select("account_id", F.posexplode("friendslist.friends").alias("pos", "f"))
    return exploded.filter(F.col("f.steamid").try_cast("bigint").isNull()).select(
        "account_id", F.col("pos").cast("int").alias("pos"), F.col("f.steamid").alias("value")
    )


def friends_status(docs: DataFrame) -> DataFrame:
    friends = F.col("friendslist.friends")
    return docs.select(
        "account_id",
        F.when(F.col("friendslist").isNull(), F.lit(S.NO_DATA))
        .when(friends.isNull() | (F.size(friends) == 0), F.lit(S.NO_FRIENDS))
        .otherwise(F.lit(S.OK)).alias("friends_status"),
    )


# --- canonical tables -> documents ------------------------------------------

def _paged(df: DataFrame, item: Column, page_size: int) -> DataFrame:
    """account_id, page, items: array of ``item`` in ``pos`` order per page.

    A page holds at most ``page_size`` entries, so neither a document nor a
    ``collect_list`` group grows with an account's list; the position is
    ``page * page_size`` + the index inside the page.  The flat rows move to
    their page first: lists of structs from many tasks are larger than the rows.
    """
    page = F.floor(F.col("pos") / F.lit(page_size)).cast("int")
    dealt = df.withColumn("page", page).repartition("account_id", "page")
    grouped = dealt.groupBy("account_id", "page").agg(
        F.array_sort(F.collect_list(F.struct(F.col("pos").alias("p"), item.alias("v")))).alias("items")
    )
    return grouped.select("account_id", "page", F.transform("items", lambda x: x["v"]).alias("items"))


def library_documents(library: DataFrame, page_size: int = 1000) -> DataFrame:
    """account_id, page, payload: library pages as JSON documents."""
    game = F.struct(
        F.col("appid").alias("appid"),
        F.col("name").alias("name"),
        F.col("playtime_min").alias("playtime_forever"),
    )
    paged = _paged(library, game, page_size)
    doc = F.struct(F.struct(F.col("items").alias("games")).alias("response"))
    return paged.select("account_id", "page", F.to_json(doc).alias("payload"))


def friend_documents(friend_edge: DataFrame, page_size: int = 1000) -> DataFrame:
    """account_id, page, payload: friend-list pages as JSON documents."""
    friend = F.struct(F.col("friend_id").cast("string").alias("steamid"))
    paged = _paged(friend_edge, friend, page_size)
    doc = F.struct(F.struct(F.col("items").alias("friends")).alias("friendslist"))
    return paged.select("account_id", "page", F.to_json(doc).alias("payload"))


def profile_documents(profile: DataFrame) -> DataFrame:
    """account_id, payload: one profile document per account."""
    player = F.struct(
        F.col("persona").alias("personaname"),
        F.col("country").alias("loccountrycode"),
        F.col("timecreated").alias("timecreated"),
    )
    empty = F.array().cast("array<struct<personaname:string,loccountrycode:string,timecreated:bigint>>")
    players = F.when(F.col("player_found"), F.array(player)).otherwise(empty)
    doc = F.struct(F.struct(players.alias("players")).alias("response"))
    return profile.select("account_id", F.to_json(doc).alias("payload"))


def _unpage(page_size: int) -> Column:
    """Position in the whole list from (page, index inside the page)."""
    return (F.col("page") * F.lit(page_size) + F.col("i")).cast("int").alias("pos")


def library_from_pages(pages: DataFrame, page_size: int = 1000) -> DataFrame:
    """Inverse of ``library_documents``: parse, explode, restore ``pos``."""
    parsed = parse_payload(pages, "game")
    exploded = parsed.select("account_id", "page", F.posexplode("response.games").alias("i", "game"))
    return exploded.select(
        "account_id",
        _unpage(page_size),
        F.col("game.appid").alias("appid"),
        F.col("game.name").alias("name"),
        F.col("game.playtime_forever").alias("playtime_min"),
    )


def friend_edge_from_pages(pages: DataFrame, page_size: int = 1000) -> DataFrame:
    parsed = parse_payload(pages, "friend")
    exploded = parsed.select("account_id", "page", F.posexplode("friendslist.friends").alias("i", "f"))
    return exploded.select(
        "account_id", _unpage(page_size), F.col("f.steamid").try_cast("bigint").alias("friend_id")
    )


def library_roundtrip(library: DataFrame, page_size: int = 1000) -> DataFrame:
    """Flat library -> JSON pages -> parsed -> flat library (must be equal)."""
    return library_from_pages(library_documents(library, page_size), page_size)


def write_documents(docs: DataFrame, path: str, kind: str, mode: str = "overwrite") -> None:
    """Write one document per account (``account_id, payload``) under its file name.

    The name becomes a folder (``document=games_7.json/``) that
    ``read_documents`` resolves to the key again.  Pages of one account must be
    joined before (``page_size`` above the longest list): a page has no name of its own.
    """
    named = docs.select(document_file_name(kind).alias(FOLDER), "payload")
    named.write.mode(mode).partitionBy(FOLDER).text(path)

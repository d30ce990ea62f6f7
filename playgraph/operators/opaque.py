"""Documents of any shape in one VARIANT column, read by path and type.

News documents are opaque: nothing promises their fields.  Parsed once to
VARIANT, a document keeps its own types; a reader asks for a path with the type
it wants and gets null where the document has no such path or value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOC = "doc"


def parsed(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """The other columns and ``doc``, the payload as VARIANT (null when it is no JSON)."""
    others = [c for c in documents.columns if c != payload]
    return documents.select(*others, F.try_parse_json(F.col(payload)).alias(DOC))


def unreadable(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows whose payload is no JSON document."""
    return documents.filter(F.col(payload).isNotNull() & F.try_parse_json(F.col(payload)).isNull())


def at(path: str, kind: str) -> Column:
    """The value at a JSON path as ``kind``, or null."""
    return F.try_variant_get(F.col(DOC), path, kind)


def entries(path: str) -> Column:
    """Number of entries of the list at a path, or null."""
    values = at(path, "array<variant>")
    return F.when(values.isNotNull(), F.size(values)).cast("bigint")


#: The list that each kind of document holds.
LISTS = {"user": "$.response.players", "game": "$.response.games", "friend": "$.friendslist.friends", "news": "$.appnews.newsitems"}


def document_summary(documents: DataFrame) -> DataFrame:
    """kind, key, page, n_entries, persona, first_id: what documents of all kinds hold, from one column.

    ``persona`` is a profile's first player; ``first_id`` the first game, friend
    or news id as a number, whether the document writes it as text or number.
    """
    docs = parsed(documents)
    count, first = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    for kind, path in LISTS.items():
        count = F.when(F.col("kind") == kind, entries(path)).otherwise(count)
    for kind, field in (("game", "appid"), ("friend", "steamid"), ("news", "gid")):
        first = F.when(F.col("kind") == kind, at(f"{LISTS[kind]}[0].{field}", "string").try_cast("bigint")).otherwise(first)
    return docs.select("kind", "key", "page", count.alias("n_entries"), at(f"{LISTS['user']}[0].personaname", "string").alias("persona"), first.alias("first_id"))

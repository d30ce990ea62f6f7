"""Profile summary (one row per account)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playgraph import schema as S
from playgraph.functions.formats import profile_url, utc_date_or_unknown
from playgraph.operators import for_account


def profile_summary(profile: DataFrame, account_id: int | None = None) -> DataFrame:
    """account_id, status, name, location, created, title, profile_url.

    ``status`` is ``NO_PROFILE`` when the document holds no player; the
    display fields are then null (the summary shows an error instead).
    """
    profile = for_account(profile, account_id)
    found = F.col("player_found")

    def shown(c):
        return F.when(found, c)

    return profile.select(
        "account_id",
        F.when(found, F.lit(S.OK)).otherwise(F.lit(S.NO_PROFILE)).alias("status"),
        shown(F.coalesce("persona", F.lit(S.DEFAULT_NAME))).alias("name"),
        shown(F.coalesce("country", F.lit(S.DEFAULT_COUNTRY_PROFILE))).alias("location"),
        shown(utc_date_or_unknown("timecreated")).alias("created"),
        shown(F.concat(F.lit(S.TITLE_PREFIX), F.coalesce("persona", F.lit(S.DEFAULT_TITLE_NAME)))).alias("title"),
        shown(profile_url("account_id")).alias("profile_url"),
    )

"""DataFrame -> DataFrame operators (lazy, no actions).

Every per-account operator takes an optional ``account_id``: the single
account mode is a filter on the inputs (pushed to the scans), never a
separate code path.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def for_account(df: DataFrame, account_id: int | None, col: str = "account_id") -> DataFrame:
    """``df`` restricted to one account, or unchanged when ``account_id`` is None."""
    return df if account_id is None else df.filter(F.col(col) == F.lit(account_id))

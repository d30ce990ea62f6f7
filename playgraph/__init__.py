"""Game-library and friend-graph analytics as lazy Spark DataFrame jobs.

Every public operator takes DataFrames (and plain parameters) and returns a
DataFrame without triggering an action.  A single account is a filter on the
all-accounts plan, never a separate code path.
"""

from playgraph.schema import (  # noqa: F401
    FRIENDS_DOC,
    LIBRARY_DOC,
    PROFILE_DOC,
)

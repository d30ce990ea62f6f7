"""Ranking helpers that never put a whole group into one task.

``row_number().over(Window.partitionBy(g).orderBy(k))`` sorts every group in
a single task: a group holding a third of the table becomes one straggler.
When the order key is unique within the group, the same 0-based position is

    position = (rows of the group in earlier key buckets)
             + (row_number inside the group's own bucket) - 1

with buckets ``k div width``.  A bucket holds at most ``width`` rows of a
group (keys are unique).  On sparse keys there are nearly as many buckets as
rows, so the bucket counts are summed up in the same way: within spans of
``width`` buckets, plus the earlier spans of the group.  Every window so holds
at most ``width`` rows for keys in a range of ``width`` cubed (2^48 by default;
17-digit account ids lie in a range of 2^33).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 16


def bucket_of(key: str, bucket_width: int = DEFAULT_BUCKET_WIDTH):
    return F.floor(F.col(key) / F.lit(bucket_width))


def dense_position(
    df: DataFrame,
    group_cols: list[str],
    key: str,
    out: str = "pos",
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
    size: str | None = None,
) -> DataFrame:
    """Add ``out``: 0-based position of ``key`` (ascending, unique per group),
    and with ``size`` also the group's row count.  ``key`` must be non-null
    and unique within its group (a primary key of the group's rows).

    One shuffle of the data on (group, bucket); ``df`` is read a second time
    for the bucket counts, which are partial sums before they move.  The counts
    meet the rows where the window left them, sorted; estimates from compressed
    files must not lead to a broadcast of the ranked rows, nor the groups'
    measured size to one of the span starts: they grow with the groups.
    """
    rn, bucket, span = "__pg_rn", "__pg_bucket", "__pg_span"
    before = Window.unboundedPreceding, -1
    withb = df.withColumn(bucket, bucket_of(key, bucket_width))
    ranked = withb.withColumn(rn, F.row_number().over(Window.partitionBy(*group_cols, bucket).orderBy(key)))
    counts = withb.groupBy(*group_cols, bucket).agg(F.count(F.lit(1)).alias("__pg_n"))
    counts = counts.withColumn(span, F.floor(F.col(bucket) / F.lit(bucket_width)))
    in_span = F.sum("__pg_n").over(Window.partitionBy(*group_cols, span).orderBy(bucket).rowsBetween(*before))
    spans = counts.groupBy(*group_cols, span).agg(F.sum("__pg_n").alias("__pg_n"))
    earlier = F.sum("__pg_n").over(Window.partitionBy(*group_cols).orderBy(span).rowsBetween(*before))
    whole = [F.sum("__pg_n").over(Window.partitionBy(*group_cols)).alias(size)] if size else []
    starts = spans.select(*group_cols, span, F.coalesce(earlier, F.lit(0)).alias("__pg_earlier"), *whole)
    prefix = counts.withColumn("__pg_in", F.coalesce(in_span, F.lit(0))).join(starts.hint("merge"), [*group_cols, span])
    prefix = prefix.withColumn("__pg_before", F.col("__pg_earlier") + F.col("__pg_in")).drop("__pg_n", span, "__pg_earlier", "__pg_in")
    return (
        ranked.join(prefix.hint("merge"), [*group_cols, bucket])
        .withColumn(out, (F.col("__pg_before") + F.col(rn) - 1).cast("int"))
        .drop(bucket, rn, "__pg_before")
    )

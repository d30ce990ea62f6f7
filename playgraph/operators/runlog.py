"""Roll-ups of the benchmark timing log and of resource samples.

Labels are few (one per workload), so everything after the first
``groupBy('label')`` is tiny; the scan and the partial aggregate are the only
work that grows with the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playgraph.functions.exact import average_of, sum_parts
from playgraph.functions.formats import fixed_decimals
from playgraph.sources.ledger import append_batch

# Comparison-table cells in display order: (engine, cache mode, column).
COMPARISON_CELLS = (
    ("manual", "useCache", "manual_cached"),
    ("manual", "noCache", "manual_nocache"),
    ("spark", "useCache", "spark_cached"),
    ("spark", "noCache", "spark_nocache"),
)
AVG_DIGITS = 6  # numeric averages are rounded so equal inputs compare equal


def label_averages(run_log: DataFrame) -> DataFrame:
    """label, avg_ms, runs (unrounded average of exact sums: the same bits for any order of the log)."""
    totals = run_log.groupBy("label").agg(*sum_parts("duration_ms", "t"), F.count(F.lit(1)).alias("runs"))
    return totals.select("label", average_of("t").alias("avg_ms"), "runs")


def run_averages(run_log: DataFrame) -> DataFrame:
    """label, avg_ms, runs, line (``label: 1.234 ms (avg over 3 runs)``)."""
    return averages_text(label_averages(run_log))


def averages_text(a: DataFrame) -> DataFrame:
    """``run_averages`` from per-label (label, avg_ms, runs)."""
    return a.select(
        "label",
        F.round("avg_ms", AVG_DIGITS).alias("avg_ms"),
        "runs",
        F.format_string("%s: %s ms (avg over %d runs)", "label", fixed_decimals("avg_ms", 3), "runs").alias("line"),
    )


def run_comparison(run_log: DataFrame) -> DataFrame:
    """friends, manual_cached, manual_nocache, spark_cached, spark_nocache, line.

    A friend count comes from every label with at least four ``_`` parts and
    an all-digit third part; each cell is the average of the exact label for
    that count, 0.0 when the label never ran.
    """
    return comparison_from_averages(label_averages(run_log))


def comparison_from_averages(a: DataFrame) -> DataFrame:
    """``run_comparison`` from per-label averages (label, avg_ms)."""
    parts = F.split("label", "_", -1)
    eligible = (F.size(parts) >= 4) & F.get(parts, 2).rlike("^[0-9]+$")
    # A cell's label has a friend count of its own, so one pass over the labels
    # fills the grid: group by that count, and take each cell where it is exact.
    friends = F.get(parts, 2).try_cast("bigint")
    names = [name for _, _, name in COMPARISON_CELLS]
    rows = a.filter(eligible & friends.isNotNull()).select("label", "avg_ms", friends.alias("friends"))

    def cell(engine, cache):
        exact = F.concat(F.lit(f"{engine}_recommendation_"), F.col("friends").cast("string"), F.lit(f"_friends_{cache}"))
        return F.max(F.when(F.col("label") == exact, F.col("avg_ms")))

    wide = rows.groupBy("friends").agg(*[F.coalesce(cell(e, c), F.lit(0.0)).alias(name) for e, c, name in COMPARISON_CELLS])
    text = F.format_string(
        "%-10d%-18s%-20s%-18s%s", F.col("friends"), *[fixed_decimals(n, 3) for n in names]
    )
    return wide.select(
        "friends", *[F.round(n, AVG_DIGITS).alias(n) for n in names], text.alias("line")
    )


def resource_averages(samples: DataFrame) -> DataFrame:
    """label, avg_cpu_pct, avg_rss_mb, samples, line."""
    totals = samples.groupBy("label").agg(*sum_parts("cpu_pct", "c"), *sum_parts("rss_mb", "r"), F.count(F.lit(1)).alias("samples"))
    a = totals.select("label", average_of("c").alias("cpu"), average_of("r").alias("rss"), "samples")
    line = F.format_string(
        "%s: AVG_CPU=%s%% AVG_MEM=%sMB over %d samples",
        "label", fixed_decimals("cpu", 2), fixed_decimals("rss", 2), "samples",
    )
    return a.select(
        "label",
        F.round("cpu", AVG_DIGITS).alias("avg_cpu_pct"),
        F.round("rss", AVG_DIGITS).alias("avg_rss_mb"),
        "samples",
        line.alias("line"),
    )


def append_resource_averages(samples: DataFrame, path: str, batch: str | None = None) -> None:
    """Append the per-label resource lines to the resource log folder; a named ``batch`` counts once."""
    lines = resource_averages(samples).select(F.col("line").alias("value"))
    if batch:
        append_batch(lines, path, batch, fmt="text")
    else:
        lines.write.mode("append").text(path)


# The report's titles, header and column widths.
AVERAGES_TITLE = "=== Individual Averages ==="
COMPARISON_TITLE = "=== Comparison Table (Manual vs Spark with/without cache) ==="
COMPARISON_HEADER = f"{'Friends':<10}{'Manual (Cached)':<18}{'Manual (No Cache)':<20}{'Spark (Cached)':<18}{'Spark (No Cache)'}"


def summary_lines(averages: DataFrame) -> DataFrame:
    """line_no, value: the whole report from per-label averages (title, averages by label, empty line, title,
    header, rule, comparison rows by friend count).

    Lines carry ordering keys, so the one sort is over the few report lines.
    """
    spark = averages.sparkSession
    fixed = spark.createDataFrame(
        [
            (0, "", 0, AVERAGES_TITLE),
            (2, "", 0, ""),
            (3, "", 0, COMPARISON_TITLE),
            (4, "", 0, COMPARISON_HEADER),
            (5, "", 0, "-" * (len(COMPARISON_HEADER) + 1)),
        ],
        "section int, label string, friends bigint, value string",
    )
    avg = averages_text(averages).select(F.lit(1).alias("section"), "label", F.lit(0).cast("bigint").alias("friends"), F.col("line").alias("value"))
    rows = comparison_from_averages(averages).select(F.lit(6).alias("section"), F.lit("").alias("label"), "friends", F.col("line").alias("value"))
    order = Window.orderBy("section", "label", "friends")  # a report of a few lines
    return fixed.union(avg).union(rows).select(F.row_number().over(order).alias("line_no"), "value")


def write_summary(run_log: DataFrame, path: str) -> None:
    """The report, overwritten as one text folder (one file, in order); the log is read once."""
    averages = label_averages(run_log).persist()
    try:
        summary_lines(averages).orderBy("line_no").select("value").coalesce(1).write.mode("overwrite").text(path)
    finally:
        averages.unpersist()

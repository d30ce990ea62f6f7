"""Plain-text inputs: the timing log (``label: ms`` lines) and account lists.

Both parse into a good-rows frame and a ``rejects`` frame; a bad line never
stops the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playgraph.functions.formats import fixed_decimals, strip_ws
from playgraph.sources.ledger import append_batch, committed, read_batches, read_or_empty

# Numbers accepted by Python's float(): decimal with optional exponent,
# digit groups joined by single underscores, and the nan/inf words.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
FLOAT_TEXT = (
    rf"^[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?"
    r"|(?i:nan|inf|infinity))$"
)


def _float_value(text):
    """Cast accepted number text the way Python's float() reads it: drop
    digit-group underscores; a signed nan is nan."""
    return (
        F.when(text.rlike(r"^[+-](?i:nan)$"), F.lit(float("nan")))
        .otherwise(F.regexp_replace(text, "_", "").cast("double"))
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` string per line (splittable text scan); a folder written in batches gives the committed ones,
    a missing one no lines."""
    batches = committed(spark, path)
    if batches:
        return read_batches(spark, path, "value string", batches, fmt="text")
    return read_or_empty(spark, path, "value string", fmt="text")


def parse_run_log(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(label, duration_ms) rows and (value, reason) rejects.

    A line without ``:`` is skipped silently, as the summary does.  A line
    with more than one ``:`` or a value that is not a number is a reject.
    """
    v = F.col("value")
    with_colon = lines.filter(F.instr(v, ":") > 0)
    parts = F.split(strip_ws(v), ":", -1)
    staged = with_colon.select(
        v.alias("value"),
        F.size(parts).alias("__n"),
        strip_ws(F.get(parts, 0)).alias("__label"),
        strip_ws(F.get(parts, 1)).alias("__num"),
    )
    number_ok = F.col("__num").rlike(FLOAT_TEXT)
    good = (F.col("__n") == 2) & number_ok
    parsed = staged.filter(good).select(
        F.col("__label").alias("label"),
        _float_value(F.col("__num")).alias("duration_ms"),
    )
    rejects = staged.filter(~good).select(
        "value",
        F.when(F.col("__n") != 2, F.lit("field_count")).otherwise(F.lit("not_a_number")).alias("reason"),
    )
    return parsed, rejects


def run_log_text(run_log: DataFrame) -> DataFrame:
    """(label, duration_ms) -> ``value`` lines ``label: 12.345``."""
    return run_log.select(
        F.concat(F.col("label"), F.lit(": "), fixed_decimals("duration_ms", 3)).alias("value")
    )


def append_run_log(run_log: DataFrame, path: str, batch: str | None = None) -> None:
    """Append timing lines to the log folder; a named ``batch`` counts once, however often it is written.

    A folder is written with batches or without, not both.
    """
    if batch:
        append_batch(run_log_text(run_log), path, batch, fmt="text")
    else:
        run_log_text(run_log).write.mode("append").text(path)


def ingest_run_log(lines: DataFrame, path: str, batch: str) -> None:
    """One batch of raw lines: good ones go to the log, bad ones to ``<path>_rejects``; both count once."""
    parsed, rejects = parse_run_log(lines)
    append_batch(rejects, path.rstrip("/") + "_rejects", batch)
    append_run_log(parsed, path, batch)


def run_log_rejects(spark: SparkSession, path: str) -> DataFrame:
    """value, reason of the lines that ``ingest_run_log`` set aside."""
    return read_batches(spark, path.rstrip("/") + "_rejects", "value string, reason string")


def parse_account_list(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(account_id) distinct ids and (value) rejects from one-id-per-line text.

    An id is all digits and fits a signed 64-bit integer; everything else but
    blank lines is a reject.
    """
    v = strip_ws("value")
    staged = lines.select(F.col("value"), v.alias("__v"))
    number = F.col("__v").try_cast("bigint")
    ok = F.col("__v").rlike("^[0-9]+$") & number.isNotNull()
    ids = staged.filter(ok).select(number.alias("account_id")).distinct()
    rejects = staged.filter(~ok & (F.col("__v") != "")).select("value")
    return ids, rejects

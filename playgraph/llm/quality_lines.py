"""Document quality rules with a cross-document line frequency, in built-in functions only.

Base rules look at one text: its number of words, word characters, symbols,
repeated lines and words in repeated 3-word windows.  The line rule looks at a
whole host: lines are normalised (A-Z lower-cased, digits as 0, white space
dropped) and hashed, the distinct documents per host and line are counted, lines
in more than ``max(min_docs, share of the host's documents)`` documents are taken
out, and a document that loses more than ``max_lost`` of its word characters is
rejected.  Copies of one text count as one document, so a document is not
rejected for having been copied.

Every measure of a text is computed in the scan, in time linear in the text but
for one sort of its windows.  What is shuffled is one narrow row per distinct
line of a document, first by (host, line, text), so a line or a host that holds
a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import UPPER, stored

BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
DIGITS = "0123456789"
#: Line tables of more rows than this are joined by a salted shuffle in place of a broadcast (24 bytes a row).
BROADCAST_LINES = 200_000
SALTS = 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _pairs(a: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of each two neighbours of an array (empty for fewer than two elements)."""
    n = F.size(a)
    return F.when(n < 2, F.array()).otherwise(F.zip_with(F.slice(a, F.lit(1), n - 1), F.slice(a, F.lit(2), n - 1), body))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def repeated_window_words(words: Column) -> Column:
    """Number of words in 3-word windows that occur twice or more, the first occurrence included.

    Windows are sorted with their places; those equal to a neighbour are
    repeated.  A text without an equal pair (a hash set tells) skips the sort.
    """

    def covered(starts: Column) -> Column:
        steps = _pairs(starts, lambda a, b: F.least(b - a, F.lit(3)))
        return F.when(F.size(starts) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(3), lambda s, x: s + x))

    def places(ranked: Column) -> Column:
        same = _pairs(ranked, lambda a, b: a["w"] == b["w"])
        no = F.array(F.lit(False))
        either = _let(same, lambda e: F.zip_with(F.concat(e, no), F.concat(no, e), lambda p, q: p | q))
        marked = F.zip_with(ranked, either, lambda r, m: F.when(m, r["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def count(windows: Column) -> Column:
        ranked = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(ranked, lambda r: _let(places(r), covered)))

    def windows(w: Column) -> Column:
        n = F.size(w) - 2
        two = F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.zip_with(two, F.slice(w, F.lit(3), n), lambda a, b: F.concat(a, F.lit(" "), b))

    return _let(words, lambda w: F.when(F.size(w) < 3, F.lit(0)).otherwise(_let(windows(w), count))).cast("bigint")


def normal_lines(text: Column) -> Column:
    """The normalised lines of a text, in order; a line without a word is empty."""
    return F.split(F.translate(text, UPPER + DIGITS + BLANKS.replace("\n", ""), UPPER.lower() + "0" * 10), "\n")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda s: F.length(F.btrim(s, F.lit(BLANKS))) > 0)
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def measured(docs: DataFrame, text_col: str, host_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the measures of each text, its fingerprint and its lines; one row per input row, numbered."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col(f"`{host_col}`").cast("string").alias("__host"),
        F.struct(F.xxhash64(text), F.xxhash64(text, F.lit(1))).alias("__print"),
        words_of(text).alias("__words"),
        F.transform(normal_lines(text), lambda s: F.struct(F.xxhash64(s).alias("h"), F.length(s).alias("chars"))).alias("__lines"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
    )
    return rows.select(
        *[F.col(f"`{c}`") for c in keep],
        "__host",
        "__print",
        F.monotonically_increasing_id().alias("__row"),
        F.size("__words").cast("bigint").alias("n_words"),
        F.aggregate("__lines", F.lit(0).cast("bigint"), lambda s, x: s + x["chars"]).alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        repeated_window_words(F.col("__words")).alias("n_repeat_words"),
        F.filter("__lines", lambda x: x["chars"] > 0).alias("__lines"),
    )


def frequent_lines(rows: DataFrame, min_docs: int, share: float) -> DataFrame:
    """``(__host, h)`` of lines in more distinct documents of their host than allowed (a null host is a host of its own)."""
    host = F.coalesce(F.concat(F.lit("h"), F.col("__host")), F.lit("")).alias("__host")
    docs = rows.groupBy(host).agg(F.count_distinct("__print").alias("docs"))
    lines = rows.select(host, "__print", F.explode(F.array_distinct(F.transform("__lines", lambda x: x["h"]))).alias("h"))
    counts = lines.groupBy("__host", "h").agg(F.count_distinct("__print").alias("n")).where(F.col("n") > min_docs)
    return counts.join(docs, "__host").where(F.col("n") > F.lit(share) * F.col("docs")).select("__host", "h")


def lost_lines(rows: DataFrame, frequent: DataFrame, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``(__row, lost_chars, lost_lines, __gone)``: what each document loses, for documents that lose something.

    ``frequent`` is a stored table; up to ``broadcast_lines`` rows it is
    broadcast, a larger one is joined by a shuffle that spreads each line over
    ``SALTS`` tasks.
    """
    host = F.coalesce(F.concat(F.lit("h"), F.col("__host")), F.lit("")).alias("__host")
    lines = rows.select(host, "__row", F.explode("__lines").alias("x")).select("__host", "__row", "x.h", "x.chars")
    if frequent.count() <= broadcast_lines:
        hit = lines.join(F.broadcast(frequent), ["__host", "h"])
    else:
        spread = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hit = lines.withColumn("salt", F.pmod(F.xxhash64("__row"), F.lit(SALTS)).cast("int")).join(spread.hint("merge"), ["__host", "h", "salt"])
    return hit.groupBy("__row").agg(F.sum("chars").alias("lost_chars"), F.count("*").alias("lost_lines"), F.collect_set("h").alias("__gone"))


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    keep: list[str] | None = None,
    min_words: int = 50,
    max_repeat: int = 50,
    min_docs: int = 5,
    share: float = 0.05,
    max_lost: int = 50,
    clean_as: str | None = None,
    broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``) with the measures and the verdict, one row per input row.

    Base rules: ``base_failed`` for fewer than ``min_words`` words or more than
    ``max_repeat`` percent of the words in repeated 3-word windows.  Line rule:
    lines in more than ``min_docs`` and more than ``share`` of their host's
    distinct documents are lost; ``depleted`` when more than ``max_lost``
    percent of the word characters are.  ``kept`` is false for both.  With
    ``clean_as`` the text without the lost lines is returned under that name
    (the other lines as they were).

    A null text counts as empty and fails; a null host is a host of its own;
    null and repeated ids stay rows of their own; equal texts get equal
    verdicts within a host.  Other columns are ignored, names starting with two
    underscores and the names of the measures are taken.  An empty table gives
    no rows.
    """
    keep = ["doc_id"] if keep is None else keep
    with_text = docs if clean_as is None else docs.withColumn("__text", F.col(f"`{text_col}`").cast("string"))
    rows = stored(measured(with_text, text_col, host_col, keep + (["__text"] if clean_as else [])), "quality-rows")
    frequent = stored(frequent_lines(rows, min_docs, share), "quality-lines")
    lost = lost_lines(rows, frequent, broadcast_lines)
    out = rows.join(lost if clean_as else lost.drop("__gone"), "__row", "left")
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    depleted = 100 * F.coalesce("lost_chars", F.lit(0)) > max_lost * F.col("word_chars")
    cols = [
        *[F.col(f"`{c}`") for c in keep],
        *[F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed.alias("base_failed"),
        (~base_failed & ~depleted).alias("kept"),
        F.coalesce("lost_lines", F.lit(0)).alias("lost_lines"),
        F.coalesce("lost_chars", F.lit(0)).alias("lost_chars"),
        depleted.alias("depleted"),
    ]
    if clean_as:
        pairs = F.arrays_zip(F.split("__text", "\n").alias("s"), F.transform(normal_lines(F.col("__text")), lambda s: F.xxhash64(s)).alias("h"))
        left = F.filter(F.transform(pairs, lambda x: F.struct(x["s"].alias("s"), F.array_contains("__gone", x["h"]).alias("gone"))), lambda x: ~x["gone"])
        cols.append(F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(F.array_join(F.transform(left, lambda x: x["s"]), "\n")).alias(clean_as))
    return out.select(cols)

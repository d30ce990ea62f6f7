"""Collocations by Toivonen's sampling: a sample proposes phrases, whole passes count them and their border.

1. A random sample of the rows is mined with a lowered
   threshold; what it holds often enough is proposed.
2. A pass over all texts counts every phrase whose two phrases of one word less
   are both proposed: the proposed phrases and their negative border (single
   words always).  Counts are exact, by the phrases' own bytes.
3. A frequent phrase of the border that was not proposed may have frequent
   extensions nobody counted.  Such phrases are proposed too, and another pass
   counts what they add, until none is left: at most one pass a length.
4. Every cut of a candidate is looked up among the frequent phrases (parts of a
   frequent phrase are frequent); scores are exact decimals.

The proposal is sent to tasks as a bit table of fixed size.  A phrase that falls
on another one's bit is counted in vain, never missed: the same table decides
what a pass counts and what a later one adds.  Within a task, words and phrases
of a slice are numbered exactly, counted, and only distinct ones are handed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import UPPER, stored

BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
#: Bytes of text numbered and counted together.
SLICE = 2 << 20
TABLE_BITS = 26
#: Up to so many languages, their totals are broadcast (one short row each).
FEW_LANGS = 100_000

FOLD = np.arange(256, dtype=np.uint8)
FOLD[[ord(c) for c in UPPER]] += 32
KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: blank, 2: ends a piece
KIND[list(BLANKS)] = 1
KIND[list(BREAKS)] = 2


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word's bytes (words are not empty)."""
    lengths = pc.binary_length(words).to_numpy()
    data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) and words.buffers()[2] is not None else np.zeros(0, np.uint8)
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words)]
    place = (np.arange(int(lengths.sum())) - np.repeat(offsets - offsets[0], lengths)).astype(np.uint64)
    values = _mix((data[offsets[0] : offsets[0] + int(lengths.sum())].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + place * np.uint64(0xC2B2AE3D27D4EB4F))
    return _mix(np.add.reduceat(values, offsets - offsets[0]) + lengths.astype(np.uint64))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its beginning and its last word."""
    return _mix(left * np.uint64(0xA0761D6478BD642F) + right)


class BitTable:
    """A set of 64-bit hashes as bits; a member always answers yes, a stranger seldom."""

    def __init__(self, bits: int = TABLE_BITS, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(1 << max(bits - 6, 0), np.uint64) if words is None else words

    def spot(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = self.spot(hashes)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    def with_spots(self, rows: Iterable[tuple[int, int]]) -> BitTable:
        """A table with these (word number, bits) rows added."""
        words = self.words.copy()
        for i, v in rows:
            words[i] |= np.uint64(v & 0xFFFFFFFFFFFFFFFF)
        return BitTable(self.bits, words)


def _slices(texts: pa.Array, langs: list) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(language, bytes, text starts) by language, about SLICE bytes each."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    groups: dict = {}
    for i, x in enumerate(langs):
        groups.setdefault(x, []).append(i)
    for lang, rows in groups.items():
        part = texts.take(pa.array(rows)) if len(groups) > 1 else texts
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        raw = np.frombuffer(part.buffers()[2], np.uint8) if part.buffers()[2] is not None else np.zeros(0, np.uint8)
        a = 0
        while a < len(part):
            b = max(int(np.searchsorted(offsets, offsets[a] + SLICE, "right")) - 1, a + 1)
            data, starts = FOLD[raw[offsets[a] : offsets[b]]], offsets[a:b] - offsets[a]
            yield from ((lang, d, s) for d, s in _cut(data, starts))
            a = b


def _cut(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One text longer than SLICE is cut where a piece ends."""
    while len(starts) == 1 and len(data) > SLICE:
        ends = np.flatnonzero(KIND[data[SLICE:]] == 2)
        if not len(ends):
            break
        at = SLICE + int(ends[0]) + 1
        yield data[:at], starts
        data = data[at:]
    yield data, starts


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of a slice and the number of the piece each one belongs to."""
    kind = KIND[data]
    mask = kind == 0
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    inner = starts[(starts > 0) & (starts < len(data))]
    begins[inner] = mask[inner]
    breaks = (kind == 2).astype(np.int32)
    breaks[inner] += 1
    at = np.flatnonzero(begins)
    piece = np.cumsum(breaks)[at]
    first = np.flatnonzero(begins[mask])
    body = data[mask]
    offsets = np.r_[first, len(body)].astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))]), piece


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each key, place of each number's first key, count of each number)."""
    _, first, number, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return number, first, count


def slice_phrases(data: np.ndarray, starts: np.ndarray, longest: int, table: BitTable, before: BitTable | None, known: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array, list[np.ndarray]]]:
    """Phrases of a slice that a pass counts: (words, hashes, counts, words of the slice, word places of one occurrence).

    A phrase counts when both its parts of one word less (of ``known`` words at
    most: all its parts of that many) are in ``table``, and not all of them in
    ``before``.  Length 1 counts without a ``before`` only.
    """
    words, piece = _words(data, starts)
    if not len(words):
        return
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)
    hashes = _word_hashes(coded.dictionary)
    if before is None:
        counts = np.bincount(ids, minlength=len(hashes))
        yield 1, hashes, counts, coded.dictionary, np.arange(len(hashes))[:, None]
    # At each place in ``at`` begins a phrase of n - 1 words that this pass reaches, numbered by ``number``.
    at, number, part_hash = np.arange(len(ids)), ids, hashes
    reached = np.full(len(hashes), before is not None)  # by the pass of ``before``, too
    ok, old = np.ones(len(hashes), bool), reached
    for n in range(2, longest + 1):
        if n - 1 <= known:
            ok = table.has(part_hash)
            old = reached & before.has(part_hash) if before is not None else reached
        slot = np.full(len(ids) + 1, -1, np.int64)
        slot[at] = number
        follows = slot[at + 1]
        keep = ok[number] & (follows >= 0)
        keep &= ok[np.maximum(follows, 0)]
        keep[keep] &= piece[at[keep]] == piece[at[keep] + n - 1]
        at, number, follows = at[keep], number[keep], follows[keep]
        if not len(at):
            return
        tail = ids[at + n - 1]
        next_number, first, counts = _numbered(number * len(hashes) + tail)
        part_hash = _joined(part_hash[number[first]], hashes[tail[first]])
        ok, reached = np.ones(len(first), bool), old[number[first]] & old[follows[first]]
        old, send = reached, ~reached
        if send.any():
            yield n, part_hash[send], counts[send], coded.dictionary, ids[at[first[send]][:, None] + np.arange(n)]
        number = next_number


def _phrase_bytes(dictionary: pa.Array, places: np.ndarray) -> pa.Array:
    """The phrases' words joined by a space."""
    if places.shape[1] == 1:
        return dictionary.take(pa.array(places[:, 0]))
    columns = [dictionary.take(pa.array(places[:, i])) for i in range(places.shape[1])]
    return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()))


def _columns(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))


def _propose(sample: DataFrame, low: int, longest: int, bits: int) -> BitTable:
    """Phrases that occur ``low`` times or more in the sample, by their hashes: words and pairs first, then the longer ones."""
    spark, table = sample.sparkSession, BitTable(bits)

    def counted(lengths: range, known: int, table: BitTable) -> DataFrame:
        sent = spark.sparkContext.broadcast(table)

        def run(batches):
            for b in batches:
                for lang, data, starts in _slices(b.column(0), b.column(1).to_pylist()):
                    for n, hashes, counts, _, _ in slice_phrases(data, starts, lengths[-1], sent.value, None, known):
                        if n in lengths:
                            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hashes), pa.string()), pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "h", "n"])

        rows = sample.mapInArrow(run, "lang string, h bigint, n bigint").groupBy("lang", "h").agg(F.sum("n").alias("n"))
        return rows.where(F.col("n") >= low)

    short = table.with_spots(_spots(counted(range(1, min(longest, 2) + 1), 0, table), bits))
    return short if longest < 3 else short.with_spots(_spots(counted(range(3, longest + 1), 2, short), bits))


def _spots(rows: DataFrame, bits: int) -> Iterator[tuple[int, int]]:
    """Bits of the hashes ``h``, one row for 64 of them: at most 2 ** (bits - 6) rows, whatever the number of hashes."""
    spot = F.shiftrightunsigned("h", 64 - bits)
    words = rows.select(F.shiftright(spot, 6).alias("i"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) & 63 as int))").alias("v"))
    return ((r.i, r.v) for r in words.groupBy("i").agg(F.bit_or("v").alias("v")).toLocalIterator())


def _counted(docs: DataFrame, table: BitTable, before: BitTable | None, longest: int, least: int) -> DataFrame:
    """``(lang, phrase, words, a)`` of the phrases this pass counts that occur ``least`` times or more; words 0: the language's words in all."""
    sent = docs.sparkSession.sparkContext.broadcast((table, before))

    def run(batches):
        table, before = sent.value
        for b in batches:
            for lang, data, starts in _slices(b.column(0), b.column(1).to_pylist()):
                for n, _, counts, dictionary, places in slice_phrases(data, starts, longest, table, before, longest):
                    for a in range(0, len(counts), 50_000):
                        yield _rows(lang, _phrase_bytes(dictionary, places[a : a + 50_000]), counts[a : a + 50_000])
                    if n == 1:
                        yield _rows(lang, pa.array([b""], pa.large_binary()), np.array([counts.sum()]))

    # One short key per row: the phrase, a line end (which no phrase holds) and the language.
    counts = docs.mapInArrow(run, "key binary, a bigint").groupBy("key").agg(F.sum("a").alias("a"))
    key = F.col("key").cast("string")
    cut = F.instr(key, "\n")
    rows = counts.where((F.col("a") >= least) | (cut == 1)).select(F.expr("substring(string(key), instr(string(key), '\n') + 1)").alias("lang"), F.substring_index(key, "\n", 1).alias("phrase"), "a")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1)
    return rows.select("lang", "phrase", words.alias("words"), "a")


def _rows(lang: str, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    key = pc.binary_join_element_wise(phrases, pa.scalar(lang.encode(), pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    return pa.RecordBatch.from_arrays([key.cast(pa.binary()), pa.array(counts.astype(np.int64))], ["key", "a"])


def _phrase_hashes(phrases: list[str]) -> np.ndarray:
    """Hashes of phrases as the passes give them."""
    words = [p.encode().split(b" ") for p in phrases]
    flat = _word_hashes(pa.array([w for p in words for w in p], pa.large_binary()))
    lengths = np.array([len(p) for p in words], np.int64)
    first = np.cumsum(lengths) - lengths
    out = flat[first] if len(words) else flat
    for n in range(1, int(lengths.max(initial=1))):
        more = np.flatnonzero(lengths > n)
        out[more] = _joined(out[more], flat[first[more] + n])
    return out


def _unproposed(frequent: DataFrame, table: BitTable, longest: int) -> DataFrame:
    """Hashes of frequent phrases that could be extended but are not in the table."""
    sent = frequent.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for b in batches:
            h = _phrase_hashes(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(h[~sent.value.has(h)].view(np.int64))], ["h"])

    return frequent.where(f"words between 1 and {longest - 1}").select("phrase").mapInArrow(run, "h bigint")


def frequent_phrases(
    docs: DataFrame, least: int = 100, longest: int = 5, sample_percent: float = 12.5, lowered: float = 0.4, bits: int = TABLE_BITS, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``(lang, phrase, words, a)``: all phrases of 1 to ``longest`` words with at least ``least`` occurrences in a language.

    The row with ``words`` 0 holds the language's words in all.  Occurrences
    overlap and stay within a piece.  ``sample_percent``, ``lowered`` and
    ``bits`` decide how much is counted in vain or in further passes, never the
    result.
    """
    texts = _columns(docs, text_col, lang_col)
    low = max(1, int(least * sample_percent / 100 * lowered))
    table = _propose(texts.where(F.rand(11) < sample_percent / 100), low, longest, bits)
    found, before = None, None
    while True:
        new = stored(_counted(texts, table, before, longest, least), "phrases")
        found = new if found is None else found.unionByName(new)
        missed = stored(_unproposed(new, table, longest), "phrases-missed")
        if missed.isEmpty():
            return found
        before, table = table, table.with_spots(_spots(missed, bits))


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, absorbed: int = 100, text_col: str = "text", lang_col: str = "lang", **mining
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of 2 to ``longest`` words.

    A-Z is lower-cased, texts end pieces at ``[.,;:!?]`` and line ends, words
    lie between blanks and tabs.  ``score`` is floor(1000 a n / (l r)) of the
    cut that scores lowest (the first of equals).  A phrase inside a longer one
    with at least ``absorbed`` percent of its occurrences is left out.  Order:
    score, occurrences, then the phrase's bytes.

    Null texts are empty, a null language is ``und``; rows count as often as
    they are given; other columns are ignored.  Empty tables give no rows.
    """
    found = frequent_phrases(docs, least, longest, text_col=text_col, lang_col=lang_col, **mining)
    total = found.where("words = 0").select("lang", F.col("a").alias("n"))
    counts = found.where("words > 0").select("lang", "phrase", "a")
    candidates = found.where("words > 1").withColumn("w", F.split("phrase", " "))

    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("head", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ")).withColumn("rest", F.array_join(F.slice("w", F.col("cut") + 1, F.col("words") - F.col("cut")), " "))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    cuts = cuts.join(F.broadcast(total) if total.count() <= FEW_LANGS else total, "lang")
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("x"))

    inner = candidates.where("words > 2").select("lang", F.col("a").alias("longer"), F.explode(F.array(F.expr("array_join(slice(w, 1, words - 1), ' ')"), F.expr("array_join(slice(w, 2, words - 1), ' ')"))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    rows = best.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("x.a")))
    rows = rows.select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("bigint"))
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

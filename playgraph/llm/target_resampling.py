"""Importance resampling of documents towards the word distribution of a target text collection.

Features are runs of one or two words; each goes to the bucket of its CRC-32.
Bucket counts of all documents and of all target texts give every bucket a gain
(its log ratio, in thousandths), a document's weight is the mean gain of its
features, and a Gumbel draw seeded by its id is added: the best scores are drawn.

The CRCs of a slice of texts are computed together.  CRC-32 is linear over XOR:
a byte contributes a value that depends only on the byte and its distance from
the end of the span, so ``crc = length constant ^ XOR of TABLE[distance, byte]``.
``bitwise_xor.reduceat`` sums the contributions over the spans.  In a pair the
second word's bytes stand as far from the end as in the word alone; only the
first word's are looked up again.  Spans beyond the table are cut in blocks of
its length that are folded one after the other.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import UPPER, partitions_for, stored

BLOCK = 64
#: Bytes of text looked at together, and the length from which a text is cut between words.
SLICE = 2 << 20


def _table() -> np.ndarray:
    """``TABLE[d, b]``: the CRC register, started at 0, after byte b and d zero bytes."""
    reg = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        reg = np.where(reg & 1, (reg >> 1) ^ np.uint32(0xEDB88320), reg >> 1).astype(np.uint32)
    out = np.empty((BLOCK, 256), np.uint32)
    out[0] = reg
    for d in range(1, BLOCK):
        out[d] = (out[d - 1] >> 8) ^ reg[out[d - 1] & 255]
    return out


TABLE = _table()
FLAT = TABLE.ravel()
#: CRC of so many zero bytes: what the initial and final inversion add to a span of that length.
LENGTH_XOR = np.array([zlib.crc32(bytes(n)) for n in range(BLOCK + 1)], np.uint32)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[[ord(c) for c in UPPER]] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True


def _length_xor(lengths: np.ndarray) -> np.ndarray:
    out = LENGTH_XOR[np.minimum(lengths, BLOCK)]
    for n in np.unique(lengths[lengths > BLOCK]).tolist():
        out[lengths == n] = zlib.crc32(bytes(n))
    return out


def _folded(data: np.ndarray) -> int:
    """The register after one span longer than the table: block contributions, then each block moved on by the next."""
    n = len(data)
    head = n % BLOCK
    cuts = np.r_[0, np.arange(head, n, BLOCK)] if head else np.arange(0, n, BLOCK)
    sizes = np.diff(np.r_[cuts, n])
    distance = np.repeat(cuts + sizes, sizes) - 1 - np.arange(n)
    blocks = np.bitwise_xor.reduceat(FLAT[distance * 256 + data], cuts)
    reg = int(blocks[0])
    for b in blocks[1:].tolist():
        reg = b ^ int(TABLE[BLOCK - 1, reg & 255] ^ TABLE[BLOCK - 2, reg >> 8 & 255] ^ TABLE[BLOCK - 3, reg >> 16 & 255] ^ TABLE[BLOCK - 4, reg >> 24])
    return reg


def feature_crcs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """CRCs of all words and word pairs of texts that begin at ``starts`` in ``data`` (bytes, A-Z lower-cased).

    Returns (word crcs, text number of each word, pair crcs, text number of each pair).
    """
    mask = IS_WORD[data]
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    inner = starts[(starts > 0) & (starts < len(data))]
    begins[inner] = mask[inner]
    text = np.searchsorted(starts, np.flatnonzero(begins), "right") - 1
    if not len(text):
        none = np.zeros(0, np.uint32)
        return none, text, none, text
    first = np.flatnonzero(begins[mask])  # in the word bytes alone
    data = data[mask].astype(np.int32)
    lengths = np.diff(np.r_[first, len(data)])
    distance = np.repeat((first + lengths - 1).astype(np.int32), lengths) - np.arange(len(data), dtype=np.int32)
    word = np.bitwise_xor.reduceat(FLAT[np.minimum(distance, BLOCK - 1) * 256 + data], first)
    for i in np.flatnonzero(lengths > BLOCK).tolist():
        word[i] = _folded(data[first[i] : first[i] + lengths[i]])
    crc = word ^ _length_xor(lengths)

    gap = np.r_[lengths[1:], 0] + 1  # what follows a first word: a space and the second
    distance += np.repeat(gap.astype(np.int32), lengths)
    head = np.bitwise_xor.reduceat(FLAT[np.minimum(distance, BLOCK - 1) * 256 + data], first)
    at = np.flatnonzero(text[1:] == text[:-1])
    pair = head[at] ^ TABLE[np.minimum(lengths[at + 1], BLOCK - 1), 0x20] ^ word[at + 1]
    both = lengths[at] + gap[at]
    for j in np.flatnonzero(both > BLOCK).tolist():
        i = at[j]
        a, b = first[i], first[i + 1]
        pair[j] = _folded(np.concatenate([data[a : a + lengths[i]], [0x20], data[b : b + lengths[i + 1]]]))
    return crc, text, pair ^ _length_xor(both), text[at]


def _parts(data: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """One text in parts of about SLICE bytes; a part begins with the last word of the one before (flag: it was counted)."""
    at, again = 0, False
    while len(data) - at > SLICE:
        mask = IS_WORD[data[at:]]
        begins = np.flatnonzero(mask & ~np.r_[False, mask[:-1]])
        begins = begins[1:] if len(begins) > 1 else begins[:0]
        last = begins[max(np.searchsorted(begins, SLICE) - 1, 0)] if len(begins) else None
        if last is None:
            break
        stop = last + int(np.argmin(np.r_[mask[last:], False]))
        yield data[at : at + stop], again
        at, again = at + int(last), True
    yield data[at:], again


def _slices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(bytes, text starts, row numbers, first word counted before) of an Arrow string column, at most about SLICE bytes each."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(int(np.searchsorted(offsets, offsets[a] + SLICE, "right")) - 1, a + 1)
        data = FOLD[raw[offsets[a] : offsets[b]]]
        if b == a + 1 and len(data) > SLICE:
            for part, again in _parts(data):
                yield part, np.zeros(1, np.int64), np.array([a]), again
        else:
            yield data, offsets[a:b] - offsets[a], np.arange(a, b), False
        a = b


def _features(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket of each feature, its row, row of each word) slice by slice."""
    for data, starts, rows, again in _slices(column):
        word, w_text, pair, p_text = feature_crcs(data, starts)
        if again:
            word, w_text = word[1:], w_text[1:]
        yield np.concatenate([word, pair]).astype(np.int64) % buckets, rows[np.concatenate([w_text, p_text])], rows[w_text]


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = 10_000) -> np.ndarray:
    """Features per bucket over all texts; each task hands on one row per bucket, the driver gets one number per bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for bucket, _, _ in _features(b.column(0), buckets):
                total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counts = texts.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed target and corpus shares of each bucket, in thousandths, rounded down."""
    n = len(corpus)
    big, small = float(corpus.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * big / ((s + 1.0) * small))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def feature_weights(docs: DataFrame, gains: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    buckets, sent = len(gains), docs.sparkSession.sparkContext.broadcast(gains.astype(np.float64))

    def run(batches):
        for b in batches:
            words, features, total = (np.zeros(b.num_rows) for _ in range(3))
            for bucket, row, word_row in _features(b.column(0), buckets):
                words += np.bincount(word_row, minlength=b.num_rows)
                features += np.bincount(row, minlength=b.num_rows)
                total += np.bincount(row, weights=sent.value[bucket], minlength=b.num_rows)  # whole numbers: exact in doubles
            weight = total.astype(np.int64) // np.maximum(features, 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(words.astype(np.int64)), pa.array(features.astype(np.int64)), pa.array(weight)], [*b.schema.names[1:], "n_words", "n_features", "weight"])

    cols = docs.select(F.col(f"`{text_col}`").cast("string").alias("__text"), *[F.col(f"`{c}`") for c in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields[1:])
    return cols.mapInArrow(run, f"{schema}, n_words bigint, n_features bigint, weight bigint")


def ranked(rows: DataFrame, order: list, per_task: int = 1_000_000) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in ``order``, without one task that sees them all.

    Rows are dealt by ranges of the order and numbered within each range; the
    driver gets one count per range.
    """
    spark = rows.sparkSession
    parts = partitions_for(spark, rows.count(), per_task)
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    dealt = stored(dealt, "ranked")
    before, base = [], 0
    for p, n in sorted(map(tuple, dealt.groupBy("__part").count().collect())):
        before.append((p, base))
        base += n
    offsets = spark.createDataFrame(before, "__part int, __base bigint")
    return dealt.join(F.broadcast(offsets), "__part").withColumn("rank", F.col("__base") + F.col("__at") + 1).drop("__part", "__at", "__base")


def resample(
    docs: DataFrame,
    target: DataFrame,
    text_col: str = "text",
    target_col: str = "text",
    id_col: str = "doc_id",
    keep: list[str] | None = None,
    percent: int = 25,
    min_words: int = 20,
    seed: int = 7,
    buckets: int = 10_000,
) -> DataFrame:
    """One row per document: ``keep`` (default: the id), ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    ``rank`` numbers the drawn documents (the ``percent`` of all with at least
    ``min_words`` words that score highest, ties to the smaller id) and is null
    for the others; keep the text among ``keep`` to get the drawn texts.  Texts
    are lower-cased in A-Z; words are digits, a-z and anything beyond ASCII.

    Null and empty texts have no features, weight 0 and are not drawn.  A null
    id draws as the text ``null`` and goes last in ties; repeated ids draw the
    same number, ties between them go by weight and features.  Other columns
    are ignored; the names of the results and names with two leading underscores
    are taken.  Empty tables give no rows; an empty target gives every bucket
    the corpus' own shares against a flat one.
    """
    keep = list(dict.fromkeys([id_col] if keep is None else [id_col, *keep]))
    gains = bucket_gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    rows = feature_weights(docs, gains, keep, text_col)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    gumbel = F.floor(-1000 * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = stored(rows.withColumn("score", F.col("weight") + gumbel), "resample-rows")
    able = rows.where(F.col("n_words") >= min_words)
    order = [F.col("score").desc(), F.col(f"`{id_col}`").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]
    drawn = percent * able.count() // 100
    out = ranked(able, order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return out.unionByName(rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint")))

"""Exact removal of repeated byte strings by a distributed prefix-free parse.

A rolling hash over 24-byte triggers cuts every text into phrases: each window
of ``length`` bytes belongs to the trigger of smallest hash inside it, and the
windows of one trigger, with all their bytes, are a phrase.  Equal windows lie
at the same place of equal triggers, wherever they occur, so a comparison never
leaves a phrase: it is settled in the dictionary of distinct phrases (sorted
under their trigger) with each phrase's first place in the parse.  Strings of
one length only are asked for, so windows are grouped, not put in corpus order,
and no suffix array is built:

* a phrase that occurred before repeats whole: all its windows are removed;
* the first occurrence of a phrase whose trigger has other phrases too may share
  some windows with them: the windows of such phrases are sorted per trigger by
  a hash and compared byte by byte, and all but the first of equal ones are removed;
* a trigger seen once has nothing to compare, and most text ends here.

Within a slice of texts equal phrases are settled before anything is shuffled.
Triggers with very many distinct phrases are split over tasks and their windows
settled by an aggregation, by two hashes (128 bits).  Memory is bounded by a slice, a document or
``HOT_ROWS`` phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lean, release_memory, stored, texts_of

TRIGGER = 24
SLICE_BYTES = 1_000_000
HOT_ROWS = 4096
BROADCAST_IDS = 1_000_000
#: Fixed odd multipliers of the hash.
C1, C2, C3, BASE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
VERSIONS = 1 << 17


class PlaceBits:
    """A phrase occurrence in one bigint: text version, first window, settled flag, trigger offset, windows - 1."""

    @staticmethod
    def pack(version, lo, settled, off, more):
        return (version << 46) | (lo << 15) | (settled << 14) | (off << 7) | more

    @staticmethod
    def lo(place):
        return (place >> 15) & ((1 << 31) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * C2
    x = (x ^ (x >> np.uint64(27))) * C3
    return x ^ (x >> np.uint64(31))


def trigger_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the TRIGGER bytes from each place on."""
    n = len(data) - TRIGGER + 1
    raw = np.zeros(len(data) + 8, np.uint8)
    raw[: len(data)] = data
    words = np.empty(len(data), np.uint64)
    for o in range(8):
        part = words[o::8]
        part[:] = np.frombuffer(raw, "<u8", len(part), o)
    h = words[:n] * C1
    for k in (8, 16):
        h = ((h ^ (h >> np.uint64(29))) + words[k : k + n]) * (C2 if k == 8 else C3)
    return _mix(h)


def _powers(n: int, base) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:
        take = min(filled, n - filled)
        out[filled : filled + take] = out[:take] * np.uint64(pow(int(base), filled, 2**64))
        filled += take
    return out


def span_hasher(h: np.ndarray):
    """``f(lo, n)``: hash of the n consecutive trigger hashes from lo on (vectorised, place-independent)."""
    p = _powers(len(h) + 1, BASE)
    inv = _powers(len(h) + 1, INVERSE)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * p[:-1], out=sums[1:])
    return lambda lo, n: _mix((sums[lo + n] - sums[lo]) * inv[lo])


def window_hash(triggers: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hashes of the windows that hold ``n`` triggers from ``lo`` on."""
    return span_hasher(triggers)(lo, n)


def phrases(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple:
    """Phrases of the texts data[starts[i]:ends[i]]: text number, first window, windows, trigger place (in ``data``), trigger hash, phrase hash."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(data) < length:
        return none
    h = trigger_hashes(data)
    low = (h & ~np.uint64(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    span, best = 1, low
    wide = length - TRIGGER + 1
    while 2 * span <= wide:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if wide > span:
        best = np.minimum(best[: len(best) - (wide - span)], best[wide - span :])
    trigger = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    has = ends - starts >= length
    doc_of = np.full(len(trigger) + 1, -1, np.int64)
    for i in np.flatnonzero(has):
        doc_of[starts[i] : ends[i] - length + 1] = i
    doc_of = doc_of[:-1]
    turn = np.flatnonzero((trigger[1:] != trigger[:-1]) | (doc_of[1:] != doc_of[:-1])) + 1
    lo = np.concatenate([[0], turn])
    n = np.diff(np.concatenate([lo, [len(trigger)]]))
    inside = doc_of[lo] >= 0
    lo, n = lo[inside], n[inside]
    if not len(lo):
        return none
    at = trigger[lo]
    whole = span_hasher(h)(lo, n + wide - 1)
    whole = _mix(whole ^ (n.astype(np.uint64) << np.uint64(8)) ^ (at - lo).astype(np.uint64))
    return doc_of[lo], lo, n, at, h[at], whole


def _slices(batches, length):
    """(id, version, bytes, place of the bytes in the text) in slices of bounded size.

    A text longer than a slice comes in parts that overlap by ``length - 1``
    bytes.  That may cut a phrase in two; such parts are compared window by
    window like any other phrases of one trigger, so the result is the same.
    """
    rows, size = [], 0
    for b in batches:
        for i, v, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2))):
            data = t.encode("utf-8", "surrogatepass")
            for a in range(0, max(1, len(data) - length + 1), SLICE_BYTES):
                rows.append((i, v, data[a : a + SLICE_BYTES + length - 1], a))
                size += len(rows[-1][2])
                if size >= SLICE_BYTES:
                    yield zip(*rows)
                    rows, size = [], 0
    if rows:
        yield zip(*rows)


def _parse(length):
    def run(batches):
        for ids, versions, texts, bases in _slices(batches, length):
            sizes = np.array([len(t) for t in texts], np.int64)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            row, lo, n, at, h, whole = phrases(np.frombuffer(b"".join(texts), np.uint8), starts, ends, length)
            doc, version = np.array(ids, np.int64)[row], np.array(versions, np.int64)[row]
            place = lo - starts[row] + np.array(bases, np.int64)[row]
            order = np.lexsort((place, doc, whole, h))
            row, n, h, whole, doc, version, place, off = (x[order] for x in (row, n, h, whole, doc, version, place, at - lo))
            again = np.zeros(len(row), bool)
            again[1:] = (h[1:] == h[:-1]) & (whole[1:] == whole[:-1])
            first = np.maximum.accumulate(np.where(again, 0, np.arange(len(row))))
            again &= (doc > doc[first]) | (place > place[first])
            key = np.where(again, _mix(np.arange(len(h), dtype=np.uint64) ^ h), h).view(np.int64)
            packed = PlaceBits.pack(version, place, again.astype(np.int64), off, n - 1)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(whole.view(np.int64)), pa.array(doc), pa.array(packed)], ["h", "c", "doc_id", "place"])

    return run


def _settle(batches):
    """Rows sorted by (h, c, doc_id, place): kind 0, a repeated phrase; kind 1, the first of a phrase whose trigger has others."""
    names = ["h", "doc_id", "place", "kind"]
    last_h = last_c = None
    first_doc = first_lo = 0
    waiting = None  # the first phrase of the last trigger while no other phrase of it was seen

    def out(h, doc, place, kind):
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (h, doc, place)] + [pa.array(np.full(len(h), kind, np.int32))], names)

    for b in batches:
        h, c, doc, place = (b.column(i).to_numpy() for i in range(4))
        done = (place >> 14) & 1 == 1
        yield out(h[done], doc[done], place[done], 0)
        h, c, doc, place = (x[~done] for x in (h, c, doc, place))
        if not len(h):
            continue
        new_h, new_c = np.ones(len(h), bool), np.ones(len(h), bool)
        new_h[1:] = h[1:] != h[:-1]
        new_c[1:] = new_h[1:] | (c[1:] != c[:-1])
        new_h[0] = last_h is None or h[0] != last_h
        new_c[0] = new_h[0] or c[0] != last_c
        at = np.maximum.accumulate(np.where(new_c, np.arange(len(h)), -1))
        lo = PlaceBits.lo(place)
        ref_doc = np.where(at >= 0, doc[at], first_doc)
        ref_lo = np.where(at >= 0, lo[at], first_lo)
        again = ~new_c & ((doc > ref_doc) | (lo > ref_lo))
        yield out(h[again], doc[again], place[again], 0)
        heads = np.flatnonzero(new_c)
        if len(heads):
            if waiting is not None and not new_h[heads[0]]:
                yield out(*([x] for x in waiting), 1)
            waiting = None
            shares = ~new_h[heads]
            shares[:-1] |= ~new_h[heads[1:]]
            mixed = heads[shares]
            yield out(h[mixed], doc[mixed], place[mixed], 1)
            tail = heads[-1]
            if not shares[-1]:
                waiting = (h[tail], doc[tail], place[tail])
            first_doc, first_lo = doc[tail], lo[tail]
        last_h, last_c = h[-1], c[-1]


def _cut_phrases(length):
    """(doc_id, version, text, refs of (h, place, hot)) to one row per phrase with its bytes."""

    def run(batches):
        for b in batches:
            cols = [[] for _ in range(5)]
            for doc, text, refs in zip(b.column(0).to_pylist(), texts_of(b.column(1)), texts_of(b.column(2))):
                data = text.encode("utf-8", "surrogatepass")
                for ref in refs:
                    place = ref["place"]
                    lo = PlaceBits.lo(place)
                    for c, v in zip(cols, (ref["h"], doc, place, ref["hot"], data[lo : lo + (place & 127) + length])):
                        c.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["h", "doc_id", "place", "hot", "data"])

    return run


def _byte_keys(key: np.ndarray, at: np.ndarray, data: np.ndarray, length: int, rows: int = 20_000) -> np.ndarray:
    """``key`` of the windows that begin ``at`` places of ``data``, told apart where equal keys have unequal bytes."""
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    bad = []
    for a in range(0, len(same), rows):
        part = same[a : a + rows]
        left, right = (at[order[part + d]][:, None] + np.arange(length) for d in (0, 1))
        bad.append(key[order[part[(data[left] != data[right]).any(1)]]])
    for k in np.unique(np.concatenate(bad)) if bad else ():
        seen: dict = {}
        for i in np.flatnonzero(key == k):
            nth = seen.setdefault(data[at[i] : at[i] + length].tobytes(), len(seen))
            if nth:
                key[i] = _mix(np.array([k], np.uint64) + np.uint64(nth) * C1)[0]
    return key


def _equal_windows(length):
    """Phrases sorted by trigger: kind 0, windows equal to an earlier one; kind 1, first windows of a hot trigger, still to be settled."""
    wide = length - TRIGGER + 1

    def settle(rows):
        h, doc, place, hot = (np.array([r[i] for r in rows], t) for i, t in enumerate((np.int64, np.int64, np.int64, bool)))
        data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        sizes = np.array([len(r[4]) for r in rows], np.int64)
        begin = np.cumsum(sizes) - sizes
        n, lo, off = (place & 127) + 1, PlaceBits.lo(place), (place >> 7) & 127
        row = np.repeat(np.arange(len(rows)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        triggers = trigger_hashes(data)
        key = window_hash(triggers, begin[row] + nth, np.full(len(row), wide))
        key = _mix(key ^ _mix(h[row].view(np.uint64) + (off[row] - nth).astype(np.uint64) * C1))
        key = _byte_keys(key, begin[row] + nth, data, length)
        second = np.zeros(len(key), np.uint64)
        if hot.any():  # their windows meet those of other tasks by hashes alone
            second = window_hash(_mix(triggers ^ C3), begin[row] + nth, np.full(len(row), wide))
        start = lo[row] + nth
        order = np.lexsort((start, doc[row], key))
        row, nth, key, start, second = row[order], nth[order], key[order], start[order], second[order]
        again = np.zeros(len(key), bool)
        again[1:] = key[1:] == key[:-1]
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(key))))
        again &= (doc[row] > doc[row[first]]) | (start > start[first])
        gone = np.zeros(len(row), bool)
        gone[order] = again  # back to (row, nth) order
        owner = np.repeat(np.arange(len(rows)), n)
        # Runs of removed windows, cut where the phrase ends.
        cuts = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1] | (owner[1:] != owner[:-1])]))
        stops = np.flatnonzero(gone & np.concatenate([~gone[1:] | (owner[1:] != owner[:-1]), [True]]))
        at = owner[cuts]
        from_lo = lo[at] + cuts - (np.cumsum(n) - n)[at]
        span = (from_lo << 7) | (stops - cuts)
        open_ = ~again & hot[row]
        k, k2 = (np.concatenate([np.zeros(len(cuts), np.int64), x[open_].view(np.int64)]) for x in (key, second))
        d = np.concatenate([doc[at], doc[row[open_]]])
        v = np.concatenate([place[at] >> 46, place[row[open_]] >> 46])
        s = np.concatenate([span, start[open_] << 7])
        kind = np.concatenate([np.zeros(len(cuts), np.int32), np.ones(int(open_.sum()), np.int32)])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (k, k2, d, v, s, kind)], ["key", "key2", "doc_id", "version", "span", "kind"])

    def run(batches):
        held: list[tuple] = []
        for b in batches:
            held += zip(*(b.column(i).to_pylist() for i in range(5)))
            last = held[-1][0] if held else None
            cut = next((i for i in range(len(held), 0, -1) if held[i - 1][0] != last), 0)
            if len(held) - cut > HOT_ROWS:  # only a hot trigger is longer, and its windows are settled later
                cut = len(held)
            while cut:
                take = min(cut, 16384)
                while take < cut and held[take][0] == held[take - 1][0] and not held[take][3]:
                    take += 1
                yield settle(held[:take])
                held, cut = held[take:], cut - take
        if held:
            yield settle(held)

    return run


def repeated_spans(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, version, spans)``: per document its removed windows, each bigint ``first << 7 | count - 1``.

    ``version`` tells apart texts that share an id (a hash of the text).  Null
    ids and texts shorter than ``length`` bytes have none.
    """
    if not TRIGGER < length <= 127 + TRIGGER:
        raise ValueError(f"length must be {TRIGGER + 1} to {127 + TRIGGER}")
    rows = _keyed(docs, id_col, text_col).where("__id is not null and octet_length(__text) >= " + str(length))
    rows = rows.select("__id", "__version", "__text")
    parsed = rows.mapInArrow(lean(_parse(length)), "h bigint, c bigint, doc_id bigint, place bigint")
    ordered = parsed.repartition("h").sortWithinPartitions("h", "c", "doc_id", "place")
    settled = stored(ordered.mapInArrow(lean(_settle), "h bigint, doc_id bigint, place bigint, kind int"), "suffix-settled")

    mixed = settled.where("kind = 1").drop("kind")
    hot = mixed.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > HOT_ROWS).select("h", F.lit(True).alias("hot"))
    refs = mixed.join(hot, "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    refs = refs.groupBy("doc_id", F.shiftright("place", 46).cast("int").alias("version")).agg(F.collect_list(F.struct("h", "place", "hot")).alias("refs"))
    texts = _only(rows.select(F.col("__id").alias("doc_id"), F.col("__version").alias("version"), F.col("__text").alias("text")), mixed.select("doc_id").distinct(), "left_semi")
    held = texts.join(refs, ["doc_id", "version"]).select("doc_id", "text", "refs").mapInArrow(lean(_cut_phrases(length)), "h bigint, doc_id bigint, place bigint, hot boolean, data binary")
    spread = F.when(F.col("hot"), F.xxhash64("doc_id")).otherwise(F.lit(0))
    held = held.withColumn("spread", spread).repartition("h", "spread").sortWithinPartitions("h", "spread", "doc_id", "place").select("h", "doc_id", "place", "hot", "data")
    windows = stored(held.mapInArrow(lean(_equal_windows(length)), "key bigint, key2 bigint, doc_id bigint, version bigint, span bigint, kind int"), "suffix-windows")

    still = windows.where("kind = 1")
    firsts = still.groupBy("key", "key2").agg(F.min(F.struct("doc_id", "span")).alias("first"))
    late = still.join(firsts, ["key", "key2"]).where("struct(doc_id, span) > first").select("doc_id", "version", "span")
    whole = settled.where("kind = 0").select("doc_id", F.shiftright("place", 46).alias("version"), F.expr("shiftleft(shiftright(place, 15) & 2147483647, 7) | (place & 127)").alias("span"))
    spans = whole.union(windows.where("kind = 0").select("doc_id", "version", "span")).union(late)
    return spans.groupBy("doc_id", F.col("version").cast("int").alias("version")).agg(F.collect_list("span").alias("spans"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.withColumn("__id", F.col(f"`{id_col}`").cast("bigint")).withColumn("__text", text).withColumn("__version", F.pmod(F.xxhash64(text), F.lit(VERSIONS)).cast("int"))


def _only(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows whose doc_id is (not) among ``ids``; the ids are broadcast only when few."""
    ids = stored(ids, "suffix-ids")
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def _keep_mask(data: np.ndarray, spans, length: int) -> np.ndarray:
    keep = np.ones(len(data), bool)
    if spans is not None and len(spans):
        s = np.asarray(spans, np.int64)
        delta = np.zeros(len(data) + 1, np.int32)
        np.add.at(delta, s >> 7, 1)
        np.add.at(delta, (s >> 7) + (s & 127) + length, -1)
        keep = np.cumsum(delta[:-1]) == 0
    return keep


CUT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def cut_bytes(text: Column, spans: Column, length: int = 100) -> Column:
    """struct(n_bytes, n_removed, n_spans, kept) of a text's UTF-8 bytes without its removed windows."""

    @F.pandas_udf(CUT)
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in batches:
            out = []
            for t, s in zip(texts, lists):
                data = np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8)
                keep = _keep_mask(data, s, length)
                runs = int((keep[:-1] & ~keep[1:]).sum() + (len(keep) > 0 and not keep[0]))
                out.append((len(data), int((~keep).sum()), runs, data[keep].tobytes()))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    return cut(text, spans)


def cut_text(text: Column, spans: Column, length: int = 100) -> Column:
    """The text without its removed windows; a character stays whole if any of its bytes stays."""

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        release_memory()
        for texts, lists in batches:
            out = []
            for t, s in zip(texts, lists):
                if t is not None and s is not None and len(s):
                    data = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
                    keep = _keep_mask(data, s, length)
                    char = np.cumsum((data & 0xC0) != 0x80) - 1
                    t = data[(np.bincount(char, keep) > 0)[char]].tobytes().decode("utf-8", "surrogatepass")
                out.append(t)
            yield pd.Series(out, dtype=object)

    return cut(text, spans)


def with_spans(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``__spans`` (null: nothing to remove) and ``__text``.

    A byte goes when a ``length``-byte string that covers it also starts earlier
    (smaller id, or earlier in the same text); strings never cross documents.
    Rows sharing an id are one document and do not remove each other.  Null ids
    and null texts lose nothing; an empty table gives no rows.
    """
    spans = stored(repeated_spans(docs, length, id_col, text_col), "suffix-spans")
    keyed = _keyed(docs, id_col, text_col)
    ids = spans.select(F.col("doc_id").alias("__id")).distinct()
    ids = stored(ids, "suffix-ids")
    few = ids.count() <= BROADCAST_IDS
    side = spans.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"), F.col("spans").alias("__spans"))
    if not few:
        return keyed.join(side, ["__id", "__version"], "left").drop("__id", "__version")
    clean = keyed.join(F.broadcast(ids), "__id", "left_anti").withColumn("__spans", F.lit(None).cast("array<bigint>"))
    hit = keyed.join(F.broadcast(ids), "__id", "left_semi").join(side, ["__id", "__version"], "left")
    return clean.unionByName(hit).drop("__id", "__version")

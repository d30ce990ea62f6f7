"""Exact top-k inner-product search by distributed histogram selection.

Vectors become integer tiles (one row per tile, a bounded matrix).  Every
query tile meets every candidate tile through an equi-join on a group number:
candidate tiles are dealt to groups once, the few query tiles are repeated per
group.  Each pass scores everything again and counts, per query, how many
scores fall in each of ``bins`` bins of the query's current score range; the
bin that holds the k-th value becomes the next range.  When the rows at or
above a range are few, or the range is one value wide, one last pass keeps the
scores at or above its lower edge.  A tile passes on at most k of a query's rows
(best score, then smallest id), which is all it can add to the answer, so ties
in hot vectors stay bounded and nothing is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import scratch_dir, stored

TILE = 1024
TILES = "tile int, dim int, peak double, ids binary, rows binary, data binary"
#: Query tiles whose histograms a task holds at once (1 MB each).
HELD_TILES = 32


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, v array<bigint>): floor(scale * x); no row for null ids or vectors with null or non-finite components; equal rows once."""
    x = F.col(vec_col).cast("array<double>")
    good = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = df.where(F.col(id_col).isNotNull() & F.coalesce(good, F.lit(False)))
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale)).alias("v")).distinct()


def _pack(key, table):
    rows = table.column("v").to_pylist()
    dim = max((len(r) for r in rows), default=0)
    data = np.zeros((len(rows), dim), dtype=np.int64)
    for i, r in enumerate(rows):
        data[i, : len(r)] = r
    ids, numbers = (table.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "row"))
    peak = float(np.abs(data.astype(np.float64)).max()) if data.size else 0.0
    out = {"tile": [key[0].as_py()], "dim": [dim], "peak": [peak], "ids": [ids.tobytes()], "rows": [numbers.tobytes()], "data": [data.tobytes()]}
    types = [("tile", pa.int32()), ("dim", pa.int32()), ("peak", pa.float64()), ("ids", pa.binary()), ("rows", pa.binary()), ("data", pa.binary())]
    return pa.table(out, schema=pa.schema(types))


def vector_tiles(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors in tiles of about TILE rows, dealt by a hash of the row number."""
    tiles = max(1, -(-rows // TILE))
    dealt = vectors.withColumn("tile", F.pmod(F.xxhash64("row"), F.lit(tiles)).cast("int"))
    return dealt.groupBy("tile").applyInArrow(_pack, TILES)


def _scores(row) -> tuple:
    """(scores, query rows, candidate ids, candidate rows, where the two rows differ) of a pair of tiles."""
    qr, ci, cr = (np.frombuffer(row[c], np.int64) for c in ("q_rows", "ids", "rows"))
    q, c = (np.frombuffer(row[d], np.int64).reshape(len(r), row[n]) for d, r, n in (("q_data", qr, "q_dim"), ("data", cr, "dim")))
    d = min(q.shape[1], c.shape[1])
    q, c = q[:, :d], c[:, :d]
    if d * row["peak"] * row["q_peak"] < 2**52:
        s = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        s = q @ c.T
        if d * row["peak"] * row["q_peak"] >= 2**62 and (np.abs(q.astype(np.float64)) @ np.abs(c.astype(np.float64)).T >= 2**62).any():
            raise OverflowError("an inner product may pass 64 bits; use a smaller scale")
    return s, qr, ci, cr, qr[:, None] != cr[None, :]


def _pairs(batches):
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            yield {n: batch.column(j)[i].as_py() for j, n in enumerate(names)}


def _extremes(batches):
    for row in _pairs(batches):
        s, qi, _, _, ok = _scores(row)
        has = ok.any(1)
        lo = np.where(ok, s, np.iinfo(np.int64).max).min(1)
        hi = np.where(ok, s, np.iinfo(np.int64).min).max(1)
        yield pa.RecordBatch.from_arrays([pa.array(x[has]) for x in (qi, lo, hi)], ["query_id", "lo", "hi"])


def _ranges(row, qi) -> tuple:
    known = np.frombuffer(row["r_ids"], np.int64)
    at = np.searchsorted(known, qi)
    at[at == len(known)] = 0
    lo, hi = np.frombuffer(row["r_lo"], np.int64)[at], np.frombuffer(row["r_hi"], np.int64)[at]
    return lo, hi, known[at] == qi


def _histogram(bins):
    """Counts per query and bin, summed over all pairs of tiles that a task meets."""

    def rows(held):
        for qi, n in held.values():
            full = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array(qi[full // bins]), pa.array((full % bins).astype(np.int64)), pa.array(n[full].astype(np.int64))], ["query_id", "bin", "n"])

    def run(batches):
        held: dict = {}
        for row in _pairs(batches):
            s, qi, _, _, ok = _scores(row)
            lo, hi, live = _ranges(row, qi)
            width = np.maximum(1, -(-(hi - lo + 1) // bins))[:, None]
            ok &= live[:, None] & (s >= lo[:, None]) & (s <= hi[:, None])
            r, c = np.nonzero(ok)
            cell = r * bins + (s[r, c] - lo[r]) // width[r, 0]
            if row["tile"] not in held:
                if len(held) >= HELD_TILES:
                    yield from rows(held)
                    held = {}
                held[row["tile"]] = (qi, np.zeros(len(qi) * bins, np.int64))
            held[row["tile"]][1][:] += np.bincount(cell, minlength=len(qi) * bins)
        yield from rows(held)

    return run


def _above(k):
    def run(batches):
        for row in _pairs(batches):
            s, qi, ci, cr, ok = _scores(row)
            lo, _, live = _ranges(row, qi)
            ok &= live[:, None] & (s >= lo[:, None])
            r, c = np.nonzero(ok)
            order = np.lexsort((cr[c], ci[c], -s[r, c], r))
            r, c = r[order], c[order]
            rank = np.arange(len(r)) - np.searchsorted(r, r)
            r, c = r[rank < k], c[rank < k]
            asked = np.frombuffer(row["q_ids"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(qi[r]), pa.array(asked[r]), pa.array(ci[c]), pa.array(cr[c]), pa.array(s[r, c])], ["query_row", "query_id", "vec_id", "row", "score"])

    return run


def _pack_ranges(key, table):
    t = table.sort_by("query_id")
    cols = [[key[0].as_py()]] + [[t.column(c).to_numpy().astype(np.int64).tobytes()] for c in ("query_id", "lo", "hi")]
    return pa.table(dict(zip(("tile", "r_ids", "r_lo", "r_hi"), cols)), schema=pa.schema([("tile", pa.int32()), ("r_ids", pa.binary()), ("r_lo", pa.binary()), ("r_hi", pa.binary())]))


def exact_top_k(df: DataFrame, queries, k: int = 5, scale: int = 256, bins: int = 128, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k highest integer inner products, ties to the smaller id.

    ``queries`` is a predicate column over ``vec_id``.  Candidates are all rows
    but the query's own.  Null ids, null vectors and vectors with null or
    non-finite components take no part; rows equal in id and vector count once,
    other rows sharing an id are queries and candidates of their own (ties
    between them in stored order); vectors of unequal length are compared over the shorter one; an empty vector scores 0.
    Scores are 64-bit; vectors whose scores may not fit raise an error.  Empty
    tables, or a query without candidates, give no rows.
    """
    spark = df.sparkSession
    scratch_dir(spark)
    vectors = integer_vectors(df, id_col, vec_col, scale).withColumn("row", F.monotonically_increasing_id())
    vectors = stored(vectors, "topk-vectors")  # numbers its rows for good
    asked = vectors.where(queries)
    n, n_asked = vectors.count(), asked.count()
    groups = max(1, min(-(-n // TILE), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cand = vector_tiles(vectors, n).withColumn("grp", F.pmod("tile", F.lit(groups)).cast("int")).drop("tile")
    q_tiles = stored(vector_tiles(asked, n_asked), "topk-queries")
    q_side = q_tiles.select("tile", F.col("dim").alias("q_dim"), F.col("peak").alias("q_peak"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("data").alias("q_data"))
    cand = stored(cand, "topk-candidates")
    q_tile = F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-n_asked // TILE)))).cast("int")

    def meet(ranges=None):
        side = q_side if ranges is None else q_side.join(ranges.groupBy(q_tile.alias("tile")).applyInArrow(_pack_ranges, "tile int, r_ids binary, r_lo binary, r_hi binary"), "tile")
        side = side.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        return cand.repartition(groups, "grp").join(side.repartition(groups, "grp"), "grp")

    ends = meet().mapInArrow(_extremes, "query_id bigint, lo bigint, hi bigint")
    ranges = stored(ends.groupBy("query_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.lit(0).cast("bigint").alias("above")), "topk-ranges")
    done = None
    while True:
        counts = meet(ranges).mapInArrow(_histogram(bins), "query_id bigint, bin bigint, n bigint").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        w = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        run = counts.withColumn("upto", F.sum("n").over(w)).join(ranges, "query_id")
        width = F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) / bins)).cast("bigint")
        # The bin of the k-th value; a query with fewer than k candidates keeps its whole range.
        hit = run.where((F.col("above") + F.col("upto") >= k) & (F.col("above") + F.col("upto") - F.col("n") < k))
        next_lo = F.col("lo") + F.col("bin") * width
        narrowed = hit.select("query_id", next_lo.alias("lo"), F.least(F.col("hi"), next_lo + width - 1).alias("hi"), (F.col("above") + F.col("upto") - F.col("n")).alias("above"), (F.col("above") + F.col("upto")).alias("kept"))
        short = ranges.join(hit.select("query_id"), "query_id", "left_anti").withColumn("kept", F.lit(0).cast("bigint"))
        step = stored(narrowed.unionByName(short), "topk-ranges")
        settled = (F.col("kept") <= 8 * k) | (F.col("lo") >= F.col("hi"))
        part = step.where(settled).drop("kept")
        done = part if done is None else done.unionByName(part)
        ranges = step.where(~settled).drop("kept")
        if not ranges.take(1):
            break
    best = meet(done).mapInArrow(_above(k), "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint")
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors are collapsed to classes first.  Class representatives are unit
vectors rotated into a PCA basis (fitted on a bounded sample; any rotation keeps
cosines, so the sample affects speed only).  Two vectors of cosine >= t differ by
at most sqrt(2-2t) in every coordinate, so the three leading ones give grid
cells of that width and a vector meets its own and the neighbouring cells only.
Cells are split into tiles of bounded size, and ``SIDE`` tiles of a cell form a
side: the unit of work is a pair of sides, so a tile travels once for all the
tiles it meets there.  Inside a pair of tiles, blocks are compared by accumulating the leading dimensions
first: partial products plus the product of the suffix norms bound the cosine
from above, and rows, columns and whole blocks leave as soon as the bound is
below the threshold.  What remains near the threshold is confirmed in the
original coordinates.  Tiles travel in original coordinates and are rotated in
the task.

A pair of tiles returns link counts per vector and a spanning forest of its
links, never the links themselves.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import stored

TILE, BLOCK, STEP, SIDE = 1024, 256, 8, 8
GRID = 3
VECTORS = "vec_id bigint, key binary, dim int, unit binary"
PACKED = "cell bigint, tile int, dim int, reps binary, mults binary, units binary"


def _unit_rows(batches):
    for b in batches:
        col = b.column(1)
        n = len(col)
        present = col.is_valid().to_numpy(zero_copy_only=False)
        sizes = np.where(present, col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), -1)
        starts = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])[:-1]
        flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        keys, units = [None] * n, [None] * n
        for d in np.unique(sizes[sizes > 0]):
            rows = np.flatnonzero(sizes == d)
            m = flat[starts[rows][:, None] + np.arange(d)] + 0.0
            peak = np.abs(m).max(1)
            good = np.isfinite(peak) & (peak > 0)
            m, rows = m[good], rows[good]
            scaled = m / peak[good][:, None]
            u = scaled / np.sqrt((scaled * scaled).sum(1))[:, None]
            for i, a, x in zip(rows.tolist(), m, u):
                keys[i], units[i] = hashlib.blake2b(a.tobytes(), digest_size=16).digest(), x.tobytes()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(units, pa.binary())], ["vec_id", "key", "dim", "unit"])


def _pca_bases(reps: DataFrame, sample_rows: int) -> dict[int, np.ndarray]:
    """Per vector length an orthonormal basis, widest direction first, from at most ``sample_rows`` vectors (smallest id hash)."""
    rows = reps.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("dim", "unit").collect()
    out = {}
    for d in {r.dim for r in rows}:
        u = np.stack([np.frombuffer(r.unit) for r in rows if r.dim == d])
        out[d] = np.linalg.eigh(u.T @ u)[1][:, ::-1].copy()
    return out


def _in_cells(bases: dict[int, np.ndarray], width: float):
    def run(batches):
        for b in batches:
            dims = b.column(2).to_numpy()
            units = b.column(3).to_pylist()
            cells, lead = np.zeros(len(dims), np.int64), np.zeros((len(dims), 2))
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                y = np.stack([np.frombuffer(units[i]) for i in rows])
                if int(d) in bases:
                    y = y @ bases[int(d)]
                grid = np.zeros((len(rows), GRID), np.int64)
                grid[:, : min(GRID, d)] = np.floor(y[:, :GRID] / width) + 512
                cells[rows] = ((int(d) * 1024 + grid[:, 0]) * 1024 + grid[:, 1]) * 1024 + grid[:, 2]
                lead[rows, : min(2, d)] = y[:, :2]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells), pa.array(lead[:, 0]), pa.array(lead[:, 1])], ["rep", "mult", "dim", "unit", "cell", "lead", "lead2"])

    return run


def _pack(key, table):
    table = table.take(pa.array(np.argsort(table.column("rep").to_numpy(), kind="stable")))
    u = np.stack([np.frombuffer(x) for x in table.column("unit").to_pylist()])
    order = np.lexsort((table.column("lead2").to_numpy(), table.column("lead").to_numpy()))
    cols = {
        "cell": [key[0].as_py()],
        "tile": [key[1].as_py()],
        "dim": [u.shape[1]],
        "reps": [table.column("rep").to_numpy()[order].tobytes()],
        "mults": [table.column("mult").to_numpy()[order].tobytes()],
        "units": [u[order].tobytes()],
    }
    types = [pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 3
    return pa.table(cols, schema=pa.schema(list(zip(cols, types))))


def linked_in_blocks(ya: np.ndarray, yb: np.ndarray, ua: np.ndarray, ub: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= threshold between two blocks of unit vectors (PCA coordinates y, original ones u)."""
    d, slack = ya.shape[1], 1e-9
    rest_a = np.sqrt(np.maximum(0, np.cumsum((ya**2)[:, ::-1], 1)[:, ::-1]))
    rest_b = np.sqrt(np.maximum(0, np.cumsum((yb**2)[:, ::-1], 1)[:, ::-1]))
    ra, rb = np.arange(len(ya)), np.arange(len(yb))
    part, at, step = np.zeros((len(ya), len(yb))), 0, STEP
    while at < d and len(ra) and len(rb):
        to = min(d, at + step)
        part += ya[ra, at:to] @ yb[rb, at:to].T
        at, step = to, 2 * step
        bound = part + np.outer(rest_a[ra, at], rest_b[rb, at]) if at < d else part
        live = bound >= threshold - slack
        keep_a, keep_b = live.any(1), live.any(0)
        if not keep_a.all() or not keep_b.all():
            ra, rb, part = ra[keep_a], rb[keep_b], part[np.ix_(keep_a, keep_b)]
    if not len(ra) or not len(rb):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = np.nonzero(part >= threshold - slack)
    exact = part[i, j] >= threshold + slack
    i, j = ra[i], rb[j]
    near = np.flatnonzero(~exact)
    exact[near] = (ua[i[near]] * ub[j[near]]).sum(1) >= threshold
    return i[exact], j[exact]


class Forest:
    """Union-find that keeps the edges which joined two trees."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        path = []
        while (p := self.up.get(x, x)) != x:
            path.append(x)
            x = p
        for y in path:
            self.up[y] = x
        return x

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _linked_tiles(a, b, same: bool, threshold: float) -> pa.RecordBatch:
    """Link counts (b null) and forest edges between two tiles, each (ids, multiplicities, PCA and original coordinates)."""
    ids_a, mult_a, ya, ua = a
    ids_b, mult_b, yb, ub = b
    links_a, links_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    forest, edges = Forest(), []
    blocks_b = [(o, yb[o : o + BLOCK].mean(0)) for o in range(0, len(ids_b), BLOCK)]
    reach_b = [np.sqrt(((yb[o : o + BLOCK] - c) ** 2).sum(1).max()) for o, c in blocks_b]
    limit = np.sqrt(2 - 2 * threshold) + 1e-9
    for o in range(0, len(ids_a), BLOCK):
        center = ya[o : o + BLOCK].mean(0)
        reach = np.sqrt(((ya[o : o + BLOCK] - center) ** 2).sum(1).max())
        for (p, other), far in zip(blocks_b, reach_b):
            if same and p < o or np.sqrt(((center - other) ** 2).sum()) - reach - far > limit:
                continue
            i, j = linked_in_blocks(ya[o : o + BLOCK], yb[p : p + BLOCK], ua[o : o + BLOCK], ub[p : p + BLOCK], threshold)
            i, j = i + o, j + p
            if same:
                i, j = i[i < j], j[i < j]
            np.add.at(links_a, i, mult_b[j])
            np.add.at(links_a if same else links_b, j, mult_a[i])
            edges += [(x, y) for x, y in zip(ids_a[i].tolist(), ids_b[j].tolist()) if forest.join(x, y)]
    ids, n = np.concatenate([ids_a, ids_b]), np.concatenate([links_a, links_b])
    ids, n = ids[n > 0], n[n > 0]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([ids, [e[0] for e in edges]]).astype(np.int64)), pa.array(np.concatenate([n, np.zeros(len(edges))]).astype(np.int64)), pa.array([None] * len(ids) + [e[1] for e in edges], pa.int64())],
        ["a", "n", "b"],
    )


def _compare(bases: dict[int, np.ndarray], threshold: float):
    """Rows sorted by unit, side and tile: the tiles of the first side are held, each tile of the second meets them."""

    def side(row):
        u = np.frombuffer(row["units"]).reshape(-1, row["dim"])
        y = u @ bases[row["dim"]] if row["dim"] in bases else u
        return np.frombuffer(row["reps"], np.int64), np.frombuffer(row["mults"], np.int64), y, u

    def run(batches):
        unit, held = None, []
        for batch in batches:
            names = batch.schema.names
            for r in range(batch.num_rows):
                row = {n: batch.column(c)[r].as_py() for c, n in enumerate(names)}
                key = (row["cell1"], row["side1"], row["cell2"], row["side2"])
                if key != unit:
                    unit, held = key, []
                if row["second"] == 0:
                    held.append((row["tile"], side(row)))
                    continue
                mine = side(row)
                for tile, other in held:
                    same = row["cell1"] == row["cell2"] and tile == row["tile"]
                    if row["cell1"] != row["cell2"] or tile <= row["tile"]:
                        yield _linked_tiles(other, mine, same, threshold)

    return run


def near_vectors(df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding", sample_rows: int = 8192) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Links join vectors of cosine >= ``threshold`` (between 0 and 1); n_links
    counts the other rows linked directly, equal ones included.  Null or zero
    vectors and vectors with null or non-finite components link with nothing
    and are their own component; vectors of unequal length do not link.  Rows
    with a null id are kept as such without links.  Rows sharing an id share a
    component.  Other columns are ignored; an empty table gives no rows.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    vectors = stored(rows.mapInArrow(_unit_rows, VECTORS), "near-vectors")
    valid = vectors.where("unit is not null and vec_id is not null")
    reps = stored(valid.groupBy("key", "dim", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult")), "near-reps")
    width = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    bases = _pca_bases(reps, sample_rows)
    celled = stored(reps.select("rep", "mult", "dim", "unit").mapInArrow(_in_cells(bases, width), "rep bigint, mult bigint, dim int, unit binary, cell bigint, lead double, lead2 double"), "near-cells")
    cells = stored(celled.groupBy("cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "near-counts")
    tiled = celled.join(cells, "cell").withColumn("tile", F.pmod(F.xxhash64("rep"), "tiles").cast("int"))
    packed = stored(tiled.groupBy("cell", "tile").applyInArrow(_pack, PACKED), "near-tiles")

    offsets = [(a * 1024 + b) * 1024 + c for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)]
    sides = packed.select("cell", F.expr(f"tile div {SIDE}").cast("int").alias("side")).distinct()
    near = sides.withColumn("cell2", F.explode(F.array(*[F.lit(o).cast("bigint") + F.col("cell") for o in offsets if o >= 0])))
    units = near.join(sides.select(F.col("cell").alias("cell2"), F.col("side").alias("side2")), "cell2").where("cell < cell2 or side <= side2")
    units = stored(units.select(F.col("cell").alias("cell1"), F.col("side").alias("side1"), "cell2", "side2"), "near-units")
    need = units.select("*", F.lit(0).alias("second"), F.col("cell1").alias("cell"), F.col("side1").alias("side"))
    need = need.union(units.select("*", F.lit(1).alias("second"), F.col("cell2").alias("cell"), F.col("side2").alias("side")))
    work = need.join(packed.withColumn("side", F.expr(f"tile div {SIDE}").cast("int")), ["cell", "side"])
    unit = ["cell1", "side1", "cell2", "side2"]
    work = work.select(*unit, "second", "tile", "dim", "reps", "mults", "units").repartition(*unit).sortWithinPartitions(*unit, "second", "tile")
    found = stored(work.mapInArrow(_compare(bases, threshold), "a bigint, n bigint, b bigint"), "near-found")

    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    comps = connected_components(found.where("b is not null").select("a", "b"), "near-components")
    classes = reps.select("key", "rep", "mult").join(links, reps.rep == links.a, "left").join(comps, reps.rep == comps.node, "left")
    classes = classes.select("key", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = vectors.select("vec_id", F.expr("case when vec_id is not null then key end").alias("key")).join(classes, "key", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id") == F.col("component_id"))

"""Resharding by minimum-cost flow.

Old shard sizes are the supplies, new capacities the demands, and moving a byte
from old shard i to new shard j costs ``cost[i][j]`` (default: 0 to stay, 1 to
move).  The flow is solved on the driver over shards only; its size follows the
number of shards, not the data.  A shard's documents stand in blocks, largest
size class first, and a document goes where its middle byte falls.  Since a cut
between two transfers so misses its byte by up to half a document, the flow is
solved for large, middling and small documents in turn: each time with the
capacity that is really left, and with some of it kept back (two documents, or
half a share of the smaller ones) for the smaller documents, which even out what
the larger ones missed.

Blocks are bounded, positions are block prefix sums plus a window inside the
block, so no task holds a shard.  Only files of shards that gain or lose a
document are written again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import octets, scratch_dir, stored

BLOCK = ["__old", "__cls", "__bucket"]
#: Smallest size of a level's documents.
LEVELS = (8192, 1024, 0)


def min_cost_transfers(supply: list[int], capacity: list[int], cost: np.ndarray | None = None) -> np.ndarray:
    """``amount[i, j]`` of least total cost that ships every supply within the capacities (successive shortest paths)."""
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("capacities hold less than the shards do")
    price = np.ones((n, m)) if cost is None else np.asarray(cost, dtype=float)
    if cost is None:
        price[np.arange(min(n, m)), np.arange(min(n, m))] = 0
    flow = np.zeros((n, m), dtype=object)
    left, room = list(supply), list(capacity)
    while any(left):
        d_old = np.where([x > 0 for x in left], 0.0, np.inf)
        d_new, via_new, via_old = np.full(m, np.inf), np.full(m, -1), np.full(n, -1)
        while True:
            ahead = d_old[:, None] + price
            best = ahead.argmin(0)
            better = ahead[best, np.arange(m)] < d_new - 1e-9
            d_new[better], via_new[better] = ahead[best, np.arange(m)][better], best[better]
            back = np.where(flow > 0, d_new[None, :] - price, np.inf)
            best = back.argmin(1)
            nearer = back[np.arange(n), best] < d_old - 1e-9
            d_old[nearer], via_old[nearer] = back[np.arange(n), best][nearer], best[nearer]
            if not better.any() and not nearer.any():
                break
        j = min((j for j in range(m) if room[j] > 0), key=lambda j: d_new[j])
        path, at, end = [], j, j
        while True:
            i = int(via_new[at])
            path.append((i, at, 1))
            if via_old[i] < 0:
                break
            path.append((i, int(via_old[i]), -1))
            at = int(via_old[i])
        amount = min([left[path[-1][0]], room[end], *(flow[i, k] for i, k, s in path if s < 0)])
        for i, k, s in path:
            flow[i, k] += s * amount
        left[path[-1][0]] -= amount
        room[end] -= amount
    return flow


@dataclass
class Transfers:
    """The solved plan: bytes from each old to each new shard."""

    old: list[int]
    new: list[int]
    amount: np.ndarray
    moved_bytes: int = 0
    affected: list[int] = field(default_factory=list)

    def __post_init__(self):
        stays = {(i, j) for i, o in enumerate(self.old) for j, n in enumerate(self.new) if o == n}
        moved = [(i, j) for i in range(len(self.old)) for j in range(len(self.new)) if self.amount[i, j] and (i, j) not in stays]
        self.moved_bytes = int(sum(self.amount[i, j] for i, j in moved))
        self.affected = sorted({self.old[i] for i, _ in moved} | {self.new[j] for _, j in moved})

    def cuts(self) -> list[tuple]:
        """(old shard, upper byte positions, new shards): the old shard first keeps its own, then gives to others in order."""
        out = []
        for i, o in enumerate(self.old):
            order = sorted((j for j in range(len(self.new)) if self.amount[i, j]), key=lambda j: (self.new[j] != o, self.new[j]))
            if order:
                out.append((o, np.cumsum([int(self.amount[i, j]) for j in order]).tolist(), [self.new[j] for j in order]))
        return out


def _placed_in_blocks(docs: DataFrame, old: Column, id_col: str, text_col: str, buckets: int) -> DataFrame:
    text = F.col(f"`{text_col}`")
    size = (octets(text) + 16).cast("bigint")
    rows = docs.withColumn("__size", size).withColumn("__old", F.coalesce(old.cast("int"), F.lit(0)))
    rows = rows.withColumn("__crc", F.crc32(F.coalesce(text, F.lit(""))))
    rows = rows.withColumn("__cls", -F.floor(F.log2("__size")).cast("int"))
    level = F.lit(len(LEVELS) - 1)
    for n in range(len(LEVELS) - 2, -1, -1):
        level = F.when(F.col("__cls") <= -int(np.log2(LEVELS[n])), F.lit(n)).otherwise(level)
    rows = rows.withColumn("__level", level)
    return rows.withColumn("__bucket", F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(buckets)).cast("int"))


def _numbered(rows: DataFrame, id_col: str) -> DataFrame:
    w = Window.partitionBy(*BLOCK).orderBy(F.col(f"`{id_col}`"), "__crc")
    rows = rows.withColumn("__end", F.sum("__size").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.withColumn("__nth", F.row_number().over(w))


def reshard(docs: DataFrame, old: Column, n_new: int, capacities: list[int] | None = None, cost=None, id_col: str = "doc_id", text_col: str = "text", block_rows: int = 4096) -> tuple[DataFrame, Transfers]:
    """All rows and columns of ``docs`` plus ``shard`` (0..n_new-1), ``slot`` (gapless from 0 in its shard) and ``size``; and the transfers.

    ``old`` gives each row's present shard (null: 0); ``size`` is the text's
    UTF-8 bytes plus 16 (null text: 16).  Default capacities share all bytes
    equally.  Columns of ``docs`` named like the three new ones are replaced.
    Repeated rows and null ids are placed like others; an empty table gives an
    empty result.
    """
    docs = docs.drop("shard", "slot", "size")
    n = docs.count()
    olds = max(1, docs.select(old.alias("o")).distinct().count())
    rows = _placed_in_blocks(docs, old, id_col, text_col, max(1, -(-n // (block_rows * olds))))
    blocks = stored(rows.groupBy(*BLOCK, "__level").agg(F.sum("__size").alias("__bytes"), F.max("__size").alias("__most")), "reshard-blocks")
    sums = blocks.groupBy("__level", "__old").agg(F.sum("__bytes"), F.max("__most")).collect()  # two numbers per shard and level
    held = {(r[0], r[1]): int(r[2]) for r in sums}
    total = sum(held.values())
    capacities = capacities or [total // n_new + (j < total % n_new) for j in range(n_new)]
    if sum(capacities) < total:
        raise ValueError("capacities hold less than the shards do")
    old_ids = sorted({o for _, o in held})
    if cost is None:
        cost = np.array([[0.0 if o == j else 1.0 for j in range(n_new)] for o in old_ids]).reshape(len(old_ids), n_new)

    def to_shards(numbered: DataFrame, starts: DataFrame) -> DataFrame:
        middle = F.col("__before") + F.col("__end") - F.floor((F.col("__size") + 1) / 2)
        nth = F.least(F.size(F.filter("__ends", lambda e: e <= middle)), F.size("__to") - 1)
        return numbered.join(starts, BLOCK).withColumn("shard", F.element_at("__to", nth + 1))

    light = rows.select(F.col(f"`{id_col}`"), "__crc", "__size", "__level", *BLOCK)
    before = F.sum("__bytes").over(Window.partitionBy("__old").orderBy("__cls", "__bucket").rowsBetween(Window.unboundedPreceding, -1))
    room, amount, starts = list(capacities), np.zeros((len(old_ids), n_new), dtype=object), None
    for level in range(len(LEVELS)):
        supply = [held.get((level, o), 0) for o in old_ids]
        smaller = sum(v for (k, _), v in held.items() if k > level)
        largest = max((int(r[3]) for r in sums if r[0] == level), default=0)
        kept_back = min(smaller // (2 * n_new), 2 * largest)
        free = [max(0, r - kept_back) for r in room]
        lack = max(0, sum(supply) - sum(free))
        plan = Transfers(old_ids, list(range(n_new)), min_cost_transfers(supply, [f + -(-lack // n_new) for f in free], cost))
        amount = amount + plan.amount
        cuts = docs.sparkSession.createDataFrame(plan.cuts(), "__old int, __ends array<bigint>, __to array<int>")
        mine = blocks.where(F.col("__level") == level).withColumn("__before", F.coalesce(before, F.lit(0)))
        mine = stored(mine.join(cuts, "__old").drop("__bytes", "__most", "__level"), "reshard-starts")
        starts = mine if starts is None else starts.union(mine)
        if level < len(LEVELS) - 1 and any(supply):
            got = to_shards(_numbered(light.where(F.col("__level") == level), id_col), mine).groupBy("shard").agg(F.sum("__size"))
            for shard, size in got.collect():  # one number per shard
                room[shard] -= int(size)
    plan = Transfers(old_ids, list(range(n_new)), amount)

    keys = ["shard", *BLOCK]
    runs = to_shards(_numbered(light, id_col), starts).groupBy(*keys).agg(F.min("__nth").alias("__first"), F.count("*").alias("__n"))
    sofar = F.sum("__n").over(Window.partitionBy("shard").orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    runs = stored(runs.withColumn("__base", F.coalesce(sofar, F.lit(0)) - F.col("__first")).drop("__n", "__first"), "reshard-runs")
    full = to_shards(_numbered(rows, id_col), starts).join(runs, keys)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return full.select(*kept, "shard", (F.col("__base") + F.col("__nth")).cast("bigint").alias("slot"), F.col("__size").alias("size")), plan


def rewrite_affected(placed: DataFrame, plan: Transfers, path: str | None = None) -> DataFrame:
    """Write the files of affected shards (``shard=N/`` folders under ``path``) and return all rows: those written, read back, and the untouched ones."""
    spark = placed.sparkSession
    path = path or f"{scratch_dir(spark)}/shards-{uuid.uuid4().hex}"
    hit = F.col("shard").isin(plan.affected) if plan.affected else F.lit(False)
    placed.where(hit).write.partitionBy("shard").mode("overwrite").parquet(path)
    schema = placed.schema
    again = spark.read.schema(schema).parquet(path) if plan.affected else placed.limit(0)
    names = [F.col(f"`{c}`") for c in placed.columns]
    if set(range(len(plan.new))) <= set(plan.affected):
        return again.select(*names)
    return again.select(*names).unionByName(placed.where(~hit).select(*names))

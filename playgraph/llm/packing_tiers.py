"""Hierarchical multi-length packing.

Documents are tokenized where they are read.  Whole windows of the longest
tier are cut off a document first; what remains is routed to the smallest
context tier that holds it.  Tiers are packed from long to short: a window
opens with its longest piece, its gap takes the longest fitting pieces of the
shorter tiers, and the rest of the gap takes the front of the next longer
piece, whose tail goes back to its tier.  So windows are exactly full; only the
last few tokens of a partition are padded.  Windows of one tier are dealt to
step groups of equal token count so that attention cost (sum of squared piece
lengths) is level across a block's steps.

No shuffle: a task packs its own partition in blocks of ``block_tokens`` and
carries the remainder on, so memory is bounded by a block (or one document).
Results depend only on the partition's rows, so a lost task is repeated alike.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .shared import lean, texts_of
from .tokens import tokenizer_path, worker_encoder

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, tier int, step_id bigint"


class TierPool:
    """Remaining pieces ordered by length; a piece is (document, start, length)."""

    def __init__(self):
        self.sizes: list[int] = []
        self.pieces: list[tuple] = []

    def add(self, doc, start: int, length: int) -> None:
        i = bisect.bisect_left(self.sizes, length)
        self.sizes.insert(i, length)
        self.pieces.insert(i, (doc, start, length))

    def take(self, i: int) -> tuple:
        self.sizes.pop(i)
        return self.pieces.pop(i)

    def fill(self, gap: int, cut: bool = True) -> list[tuple]:
        """Pieces for a gap: the longest that fit, then the front of the shortest longer one."""
        out = []
        while gap and self.sizes:
            i = bisect.bisect_right(self.sizes, gap) - 1
            if i >= 0:
                out.append(self.take(i))
                gap -= out[-1][2]
            elif cut:
                doc, start, length = self.take(0)
                out.append((doc, start, gap))
                self.add(doc, start + gap, length - gap)
                gap = 0
            else:
                break
        return out


class TierPacker:
    """Packs one partition; ``emit`` gets (tier, pieces) of every finished window."""

    def __init__(self, tiers: tuple[int, ...], emit):
        self.tiers = sorted(tiers)
        self.emit = emit
        self.pool = TierPool()
        self.left = 0

    def add(self, doc, tokens: int) -> None:
        top, start = self.tiers[-1], 0
        while tokens - start >= top:
            self.emit(top, [(doc, start, top)])
            start += top
        if start < tokens:
            self.pool.add(doc, start, tokens - start)
            self.left += tokens - start

    def _windows(self, tier: int, shorter: int) -> None:
        """Windows of one tier, each opened by a piece longer than the next shorter tier."""
        while self.pool.sizes and self.pool.sizes[-1] > shorter and self.left >= tier:
            pieces = self.pool.fill(tier)
            self.left -= tier
            self.emit(tier, pieces)

    def flush(self, last: bool) -> None:
        """Pack what is there; what doesn't fill a window of its tier waits unless ``last``."""
        for tier, shorter in zip(reversed(self.tiers), [*reversed(self.tiers[:-1]), 0]):
            self._windows(tier, shorter)
        if last:
            for tier in reversed(self.tiers):
                while self.left >= tier:
                    self.left -= tier
                    self.emit(tier, self.pool.fill(tier))
            if self.left:
                self.emit(self.tiers[0], self.pool.fill(self.left))
                self.left = 0


def level_steps(costs: list[int], per_step: int) -> list[int]:
    """Step number of each window: costliest first, dealt back and forth over the steps."""
    steps = max(1, -(-len(costs) // per_step))
    out = [0] * len(costs)
    for place, i in enumerate(sorted(range(len(costs)), key=lambda i: -costs[i])):
        turn, at = divmod(place, steps)
        out[i] = at if turn % 2 == 0 else steps - 1 - at
    return out


def _packed(tokenizer: str, tiers: tuple[int, ...], end_id: int, block_tokens: int, step_tokens: int):
    def run(batches):
        encoder = worker_encoder(tokenizer)
        base = TaskContext.get().partitionId() << 36
        windows: list[tuple] = []
        packer = TierPacker(tiers, lambda tier, pieces: windows.append((tier, pieces)))
        state = {"seq": 0, "step": 0, "tokens": 0}
        end = np.array([end_id], dtype="<u4").tobytes()

        def rows():
            cols = [[] for _ in range(9)]
            for tier in sorted(tiers):
                mine = [p for t, p in windows if t == tier]
                for n, pieces in zip(level_steps([sum(x[2] ** 2 for x in p) for p in mine], max(1, step_tokens // tier)), mine):
                    offset = 0
                    for (doc_id, ids, tokens), start, length in pieces:
                        for c, v in zip(cols, (doc_id, start, length, ids[4 * start : 4 * (start + length)], tokens, base + state["seq"], offset, tier, base + state["step"] + n)):
                            c.append(v)
                        offset += length
                    state["seq"] += 1
                state["step"] += max(1, -(-len(mine) // max(1, step_tokens // tier)))
            windows.clear()
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = [f.split()[0] for f in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts_of(batch.column(1)))):
                ids += end
                packer.add((doc_id, ids, len(ids) // 4), len(ids) // 4)
                state["tokens"] += len(ids) // 4
                if state["tokens"] >= block_tokens:
                    packer.flush(False)
                    state["tokens"] = 0
                    yield rows()
        packer.flush(True)
        yield rows()

    return run


def pack_tiers(
    docs: DataFrame,
    tokenizer: str | None = None,
    tiers: tuple[int, ...] = (256, 512, 1024, 2048),
    end_id: int = 1,
    block_tokens: int = 2_000_000,
    step_tokens: int = 32_768,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: its document, place there, ids (uint32 LE), window, offset, tier and step group.

    A null or empty text is the end id alone; a null id is kept as null;
    repeated rows are packed each for itself; other columns are ignored; an
    empty table gives no rows.  Concatenating a document's pieces by ``start``
    gives its ids back.
    """
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")
    return rows.mapInArrow(lean(_packed(path, tuple(sorted(tiers)), end_id, block_tokens, step_tokens), encoders=True), PIECES)

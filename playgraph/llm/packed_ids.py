"""Token-id output: best-fit-decreasing packing written as binary id matrices.

Documents are tokenized where they are read, overlong ones are split
losslessly, and each block of pieces is packed longest first: a segment tree
over remaining capacities finds the fullest open row that still holds a piece.
Rows become matrices (one table row each): the ids, the position ids that
restart at every segment, and each row's cumulative segment lengths.  No
shuffle; memory is bounded by a block or one document.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import scratch_dir, texts_of
from .tokens import tokenizer_path, worker_encoder

SEGMENT = pa.struct([("row", pa.int32()), ("offset", pa.int32()), ("length", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64())])
MATRIX = pa.schema([("matrix_id", pa.int64()), ("n_rows", pa.int32()), ("width", pa.int32()), ("id_bytes", pa.int32()), ("ids", pa.binary()), ("position_ids", pa.binary()), ("cu_seqlens", pa.list_(pa.list_(pa.int32()))), ("segments", pa.list_(SEGMENT))])
MATRIX_DDL = "matrix_id bigint, n_rows int, width int, id_bytes int, ids binary, position_ids binary, cu_seqlens array<array<int>>, segments array<struct<row:int,offset:int,length:int,doc_id:bigint,start:bigint,doc_tokens:bigint>>"


class CapacityTree:
    """Open rows by remaining capacity; finds the smallest capacity that still holds a piece."""

    def __init__(self, width: int):
        self.leaves = 1 << max(1, width).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def _change(self, capacity: int, by: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, capacity: int, row: int) -> None:
        if capacity:
            self.rows[capacity].append(row)
            self._change(capacity, 1)

    def take(self, size: int):
        """(capacity, row) of the fullest row with at least ``size`` free, or None."""
        i = size + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        self._change(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(sizes: list[int], width: int) -> list[list[int]]:
    """Rows of piece numbers; every size is between 1 and ``width``."""
    tree, rows = CapacityTree(width), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.take(sizes[i])
        capacity, row = at or (width, len(rows))
        if at is None:
            rows.append([])
        rows[row].append(i)
        tree.put(capacity - sizes[i], row)
    return rows


def _matrices(tokenizer: str, width: int, end_id: int, pad_id: int, block_tokens: int, matrix_rows: int, wide: bool):
    kind = np.dtype("<u4") if wide else np.dtype("<u2")

    def block(pieces, state):
        packed = best_fit_decreasing([p[2] for p in pieces], width)
        for a in range(0, len(packed), matrix_rows):
            part = packed[a : a + matrix_rows]
            ids = np.full((len(part), width), pad_id, dtype=kind)
            pos = np.zeros((len(part), width), dtype="<u4" if width > 65536 else "<u2")
            cu, segments = [], []
            for r, row in enumerate(part):
                cu.append([0])
                for i in row:
                    (doc_id, all_ids, total), start, n = pieces[i]
                    at = cu[-1][-1]
                    ids[r, at : at + n] = np.frombuffer(all_ids, "<u4", n, 4 * start)
                    pos[r, at : at + n] = np.arange(n)
                    segments.append({"row": r, "offset": at, "length": n, "doc_id": doc_id, "start": start, "doc_tokens": total})
                    cu[-1].append(at + n)
            state["n"] += 1
            yield pa.RecordBatch.from_pylist([{"matrix_id": state["base"] + state["n"], "n_rows": len(part), "width": width, "id_bytes": kind.itemsize, "ids": ids.tobytes(), "position_ids": pos.tobytes(), "cu_seqlens": cu, "segments": segments}], MATRIX)

    def run(batches):
        encoder = worker_encoder(tokenizer)
        state = {"base": TaskContext.get().partitionId() << 32, "n": -1}
        pieces, tokens = [], 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts_of(batch.column(1)))):
                ids += end
                n = len(ids) // 4
                pieces += [((doc_id, ids, n), s, min(width, n - s)) for s in range(0, n, width)]
                tokens += n
                if tokens >= block_tokens:
                    yield from block(pieces, state)
                    pieces, tokens = [], 0
        if pieces:
            yield from block(pieces, state)

    return run


def id_matrices(docs: DataFrame, tokenizer: str | None = None, width: int = 2048, end_id: int = 1, pad_id: int = 0, block_tokens: int = 2_000_000, matrix_rows: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed matrices of all documents, one per row (schema MATRIX_DDL).

    Null or empty text: the end id alone.  Null ids stay null; repeated rows
    are packed each for itself; other columns are ignored; an empty table gives
    no matrices.  Ids are uint16 where the vocabulary allows it, else uint32.
    """
    from tokenizers import Tokenizer

    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    wide = max(Tokenizer.from_file(path).get_vocab_size(True), end_id + 1, pad_id + 1) > 65536
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")
    return rows.mapInArrow(_matrices(path, width, end_id, pad_id, block_tokens, matrix_rows, wide), MATRIX_DDL)


def write_id_matrices(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``id_matrices`` as Parquet (zstd) under ``path`` (default: a new folder in the shared scratch folder) and read them back."""
    spark = docs.sparkSession
    path = path or f"{scratch_dir(spark)}/id-matrices-{uuid.uuid4().hex}"
    id_matrices(docs, **options).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def matrix_segments(matrices: DataFrame) -> DataFrame:
    """One row per packed piece, its ids cut out of the matrix again (``ids``: little-endian, ``id_bytes`` each)."""
    seg = matrices.select("matrix_id", "width", "id_bytes", "ids", F.explode("segments").alias("s"))
    at = (F.col("s.row") * F.col("width") + F.col("s.offset")) * F.col("id_bytes") + 1
    return seg.select("s.doc_id", "s.start", "s.length", "s.doc_tokens", "matrix_id", F.col("s.row").alias("matrix_row"), "s.offset", F.substring("ids", at, F.col("s.length") * F.col("id_bytes")).alias("ids"))

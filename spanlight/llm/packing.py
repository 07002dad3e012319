"""Token ids in packed rows: best-fit-decreasing packing with a segment tree over free capacity.

Each task streams its documents: texts become token ids, documents longer than a row are cut
losslessly into full rows plus a remainder, and remainders are packed block by block. In a block the
longest segment goes first, into the fullest open row that still has room; a segment tree over the
capacities 0..row_tokens finds that row in log2(row_tokens) steps. No shuffle is needed, a block holds
at most `block_tokens` tokens, and only the last row of each block's kind is part empty.

A row of the result: the ids (little-endian, padded), the cumulative segment lengths, the position of
every token, which restarts at 0 with each segment, and for each segment its document and offset, so
that `unpack` gives back every token.

Defined cases: null and empty texts have no tokens and no segment; null and repeated identifiers are
carried as they are; an empty table gives no rows. Columns other than identifier and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import vocabulary

ROW_TOKENS = 2048
BLOCK_TOKENS = 4_000_000
PAD_ID = 50256  # free in the public vocabularies
SCHEMA = ("pack_id long, n_tokens long, ids binary, cu_seqlens array<int>, position_ids binary, "
          "doc_ids array<long>, starts array<long>")


class FreeRows:
    """Open rows by free capacity; a segment tree counts them, so the best fit is found top to bottom."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._count(free, 1)

    def _count(self, free: int, by: int) -> None:
        i = free + self.size
        while i:
            self.tree[i] += by
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, row) of the open row with the least free capacity that still holds `need` tokens."""
        i = need + self.size
        if not self.tree[i]:
            while i > 1 and (i & 1 or not self.tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        free = i - self.size
        self._count(free, -1)
        return free, self.rows[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of segment numbers; ties keep the order of arrival."""
    free_rows, rows = FreeRows(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = free_rows.take(lengths[i])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        free, row = found
        rows[row].append(i)
        if free > lengths[i]:
            free_rows.add(free - lengths[i], row)
    return rows


def pack(docs: DataFrame, ranks: Broadcast, id_col: str = "doc_id", text_col: str = "text",
         row_tokens: int = ROW_TOKENS, block_tokens: int = BLOCK_TOKENS, pad_id: int = PAD_ID) -> DataFrame:
    """Packed rows of SCHEMA. pack_id counts within a task (task number in the upper bits)."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks.value)
        dtype = "<u2" if max(len(vocab.ranks), pad_id + 1, row_tokens) <= 1 << 16 else "<u4"
        steps = np.arange(row_tokens, dtype=dtype)
        made = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        waiting = 0

        def rows_of(groups: list[list[tuple]]) -> pa.RecordBatch:
            nonlocal made
            cols: list[list] = [[] for _ in range(7)]
            for segments in groups:
                lengths = [len(ids) for _, _, ids in segments]
                row = np.full(row_tokens, pad_id, dtype=dtype)
                position = np.zeros(row_tokens, dtype=dtype)
                ends = np.cumsum(lengths)
                for (_, _, ids), end in zip(segments, ends):
                    row[end - len(ids):end] = ids
                    position[end - len(ids):end] = steps[:len(ids)]
                for col, v in zip(cols, (made, int(ends[-1]), row.tobytes(), [0, *ends.tolist()], position.tobytes(),
                                         [d for d, _, _ in segments], [s for _, s, _ in segments])):
                    col.append(v)
                made += 1
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        def packed() -> Iterator[pa.RecordBatch]:
            rows = best_fit_decreasing([len(ids) for _, _, ids in held], row_tokens)
            for i in range(0, len(rows), 1024):
                yield rows_of([[held[j] for j in row] for row in rows[i:i + 1024]])

        for batch in batches:
            texts = (text.as_py() or "" for text in batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), vocab.encode_many(texts)):
                ids = ids.astype(dtype)
                whole = len(ids) // row_tokens * row_tokens
                for i in range(0, whole, row_tokens * 1024):
                    upto = min(whole, i + row_tokens * 1024)
                    yield rows_of([[(doc, j, ids[j:j + row_tokens])] for j in range(i, upto, row_tokens)])
                if len(ids) > whole:
                    held.append((doc, whole, ids[whole:].copy()))
                    waiting += len(ids) - whole
                if waiting >= block_tokens:
                    yield from packed()
                    held, waiting = [], 0
        if held:
            yield from packed()

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(of, SCHEMA)


def write_packed(packs: DataFrame, path: str) -> None:
    """Write the id matrix with cumulative lengths and positions as Parquet files to a shared folder."""
    packs.write.parquet(path)


def unpack(packs: DataFrame, wide: bool = False) -> DataFrame:
    """(doc_id, start, ids) of every segment: the lossless way back."""
    width = 4 if wide else 2
    at = F.posexplode(F.arrays_zip("doc_ids", "starts", F.slice("cu_seqlens", 1, F.size("doc_ids")).alias("a"),
                                   F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("b")))
    return packs.select("ids", at.alias("pos", "s")).select(
        F.col("s.doc_ids").alias("doc_id"), F.col("s.starts").alias("start"),
        F.expr(f"substring(ids, s.a * {width} + 1, (s.b - s.a) * {width})").alias("ids"))

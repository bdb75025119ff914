"""Packing by best-fit decreasing into fixed windows.

1. Every document is encoded (tokenizers library) and ends with the end id.
   One longer than a window is first cut into full windows; what is left of
   it, and every shorter document, is one piece.  A piece is a row of lengths
   and a checksum, never its ids, and is written to the shared folder.
2. Pieces are dealt to ceil(pieces / GROUP) groups.  In a group, full windows
   are sequences of their own; the others are placed from long to short, each
   into the open window whose remaining capacity is the least that holds it.
   A segment tree over the capacities 0..window finds that window in
   log2(window) steps.
3. Windows left under-filled by a group (at most a few, besides a lack of
   short pieces) stay as they are: the pieces in them are not cut.

A sequence counts as padded to the window, except one whose length is a power
of two, which is kept at that length.

Nulls, ties, emptiness: a null text is empty (one piece: the end id); a null
doc_id stays null; rows with equal doc_id are packed as documents of their
own; equal lengths are placed in (doc_id, start, checksum) order; an empty table gives no rows;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.llm import common, word_tokens

WINDOW = 4096
#: Pieces a group holds at most (about; bounds a packing task's memory).
GROUP = 50_000

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


class CapacityTree:
    """Open windows by remaining capacity: a segment tree of counts over
    0..window; ``take(need)`` gives the window with the least capacity >= need."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: dict[int, list[int]] = {}

    def put(self, capacity: int, number: int) -> None:
        self.open.setdefault(capacity, []).append(number)
        at = self.leaves + capacity
        while at:
            self.counts[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        counts, at = self.counts, self.leaves + need
        if not counts[at]:
            # up to the first ancestor with a non-empty right sibling, then down to its left-most leaf
            while at > 1 and (at & 1 or not counts[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at <<= 1
                if not counts[at]:
                    at += 1
        capacity = at - self.leaves
        while at:
            counts[at] -= 1
            at >>= 1
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset in it) for each length, given in falling order."""
    tree = CapacityTree(window)
    number = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    n = 0
    for i, length in enumerate(lengths.tolist()):
        found = tree.take(length) if length < window else None
        capacity, at = found if found else (window, n)
        n += found is None
        number[i], offset[i] = at, window - capacity
        if capacity > length:
            tree.put(capacity - length, at)
    return number, offset


def pieces_of(docs: DataFrame, vocabulary_path: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece."""
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_tokens.encoder(vocabulary_path)
        end = np.array([end_id], "<u4")
        for batch in parts:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                rows: dict[str, list] = {f.name: [] for f in PIECES}
                for doc_id, ids in zip(some.column(0).to_pylist(), enc.encode(list(common.texts(some)))):
                    ids = np.concatenate([ids, end])
                    for at in range(0, len(ids), window):
                        piece = ids[at:at + window]
                        for k, v in zip(rows, (doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids))):
                            rows[k].append(v)
                yield common.batches(rows, PIECES)

    return common.doc_columns(docs).mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_pieces(pieces: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset.  ``pieces`` must be a written table."""
    groups = max(1, -(-pieces.count() // group))
    names = [f.name for f in PIECES]

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held = [b for b in parts if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
                       ("ids_crc32", "ascending")])
        number, offset = best_fit_decreasing(t.column("length").to_numpy(), window)
        base = TaskContext.get().partitionId() << 40
        t = t.append_column("sequence_id", pa.array(number + base)).append_column("offset", pa.array(offset))
        yield from t.to_batches(max_chunksize=10_000)

    return pieces.select(names).repartition(groups).mapInArrow(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary_path: str, end_id: int, window: int = WINDOW,
                   group: int = GROUP) -> DataFrame:
    pieces = common.written(pieces_of(docs, vocabulary_path, end_id, window), "pieces")
    return pack_pieces(pieces, window, group)


def padding(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row: n_sequences, n_tokens, n_padding."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.expr("(used & (used - 1)) = 0")
    return used.agg(F.count(F.lit(1)).alias("n_sequences"), F.sum("used").alias("n_tokens"),
                    F.sum(F.when(power, 0).otherwise(window - F.col("used"))).alias("n_padding"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack_documents(common.read(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"), end_id=2)

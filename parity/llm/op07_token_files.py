"""Token-ID files: fixed-width bit packing with block offsets.

``write_token_files`` encodes every document (tokenizers library), appends the
end id, and writes the ids in ascending doc_id order into binary files, one a
range partition.  A file holds each id in the least number of bits that the
vocabulary needs, in blocks of ``BLOCK`` ids; the footer has the offset of each
block and a table of documents, so any span of ids is read by unpacking only
its blocks (``TokenFile.ids``).

File layout (little-endian)::

    magic "PKID", u32 version, u32 width in bits, u32 ids a block
    blocks: ids packed with ``width`` bits, low bit first, padded to a byte
    footer: i64 offset of each block (and of the end of the last),
            i64 doc_id, u8 doc_id-is-null, i64 first id (n_docs + 1 of these)
    tail:   i64 footer offset, i64 n_ids, i64 n_blocks, i64 n_docs, magic

Nulls, ties, emptiness: a null text is an empty text (its only id is the end
id); a null doc_id sorts first and stays null; rows with equal doc_id are
written in text order, each with its own start; an empty table gives no files
and no rows; columns other than doc_id and text are ignored.

A task writes under a name of its own and reports it only when the file is
whole, so a retried task never leaves a half-written file in the manifest.
Only the manifest (one row a file) is summed in one place, to give each file
its first global id.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parity.llm import common, word_tokens

MAGIC = b"PKID"
BLOCK = 65_536
_HEAD = struct.Struct("<4sIII")
_TAIL = struct.Struct("<qqqq4s")

MANIFEST = pa.schema([("first_id", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()),
                      ("n_ids", pa.int64())])
DIGEST = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                    ("ids_crc32", pa.int64())])


def width_of(vocabulary: int) -> int:
    """Least bits that hold every id of a vocabulary of this size."""
    return max(1, (max(1, vocabulary) - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    data = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if width % 8 == 0:  # low bit first, whole bytes are the number's low bytes
        return data[:, :width // 8].tobytes()
    bits = np.unpackbits(data, axis=1, bitorder="little")
    return np.packbits(bits[:, :width].reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if width % 8 == 0:
        out = np.zeros((n, 4), np.uint8)
        out[:, :width // 8] = raw[:n * width // 8].reshape(n, width // 8)
        return out.view("<u4").reshape(-1)
    full = np.zeros((n, 32), np.uint8)
    full[:, :width] = np.unpackbits(raw, bitorder="little")[:n * width].reshape(n, width)
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(-1)


class TokenFileWriter:
    """Streams ids into one file; holds a block and the document table."""

    def __init__(self, sink, width: int, block: int = BLOCK) -> None:
        self.sink, self.width, self.block = sink, width, block
        self.at = sink.write(_HEAD.pack(MAGIC, 1, width, block)) or _HEAD.size
        self.at = _HEAD.size
        self.offsets, self.doc_ids, self.nulls, self.starts = [self.at], [], [], [0]
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.width:
            raise ValueError(f"an id needs more than {self.width} bits")
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        whole = len(ids) if last else len(ids) - len(ids) % self.block
        for lo in range(0, whole, self.block):
            data = pack(ids[lo:min(lo + self.block, whole)], self.width)
            self.sink.write(data)
            self.at += len(data)
            self.offsets.append(self.at)
        self.held, self.n_held = [ids[whole:].copy()], len(ids) - whole

    def close(self) -> tuple[int, int]:
        self._flush(True)
        for values, kind in ((self.offsets, "<i8"), (self.doc_ids, "<i8"), (self.nulls, "u1"), (self.starts, "<i8")):
            self.sink.write(np.asarray(values, kind).tobytes())
        self.sink.write(_TAIL.pack(self.at, self.starts[-1], len(self.offsets) - 1, len(self.doc_ids), MAGIC))
        return len(self.doc_ids), self.starts[-1]


class TokenFile:
    """Random access to one file (a seekable binary source of ``size`` bytes)."""

    def __init__(self, source, size: int) -> None:
        self.source = source
        magic, _, self.width, self.block = _HEAD.unpack(self._read(0, _HEAD.size))
        foot, self.n_ids, n_blocks, self.n_docs, tail = _TAIL.unpack(self._read(size - _TAIL.size, _TAIL.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError("not a token file, or a cut one")
        data = self._read(foot, size - _TAIL.size - foot)
        cut = np.cumsum([0, 8 * (n_blocks + 1), 8 * self.n_docs, self.n_docs, 8 * (self.n_docs + 1)])
        part = [data[a:b] for a, b in zip(cut, cut[1:])]
        self.offsets = np.frombuffer(part[0], "<i8")
        self.doc_ids = np.frombuffer(part[1], "<i8")
        self.nulls = np.frombuffer(part[2], "u1")
        self.starts = np.frombuffer(part[3], "<i8")
        self._block_no, self._block_ids = -1, np.empty(0, np.uint32)

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _one_block(self, b: int) -> np.ndarray:
        if b != self._block_no:
            lo, hi = int(self.offsets[b]), int(self.offsets[b + 1])
            n = min(self.block, self.n_ids - b * self.block)
            self._block_no, self._block_ids = b, unpack(self._read(lo, hi - lo), n, self.width)
        return self._block_ids

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids [lo, hi) of the file, from the blocks that hold them."""
        out = [np.empty(0, np.uint32)]
        while lo < hi:
            b = lo // self.block
            end = min(hi, (b + 1) * self.block)
            out.append(self._one_block(b)[lo - b * self.block:end - b * self.block])
            lo = end
        return np.concatenate(out)


def _filesystem(uri: str):
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        return fs.LocalFileSystem(), uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, vocabulary_path: str, folder: str, end_id: int,
                      block: int = BLOCK) -> DataFrame:
    """Write the files; a manifest row (first_id, path, n_docs, n_ids, start) each.

    ``start`` is the number of ids in all files before.  Work: one range
    shuffle of the texts on doc_id; no other movement."""
    spark = docs.sparkSession
    ordered = (common.doc_columns(docs).repartitionByRange("doc_id")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_tokens.encoder(vocabulary_path)
        width = width_of(max(enc.tok.get_vocab_size(with_added_tokens=True), end_id + 1))
        end = np.array([end_id], np.uint32)
        out = sink = None
        first = None
        for batch in parts:
            ids_of = batch.column(0)
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                encoded = enc.encode(list(common.texts(some)))
                for doc_id, ids in zip(ids_of.slice(lo, 1024).to_pylist(), encoded):
                    if out is None:
                        files, root = _filesystem(folder)
                        files.create_dir(root, recursive=True)
                        name = f"{uuid.uuid4().hex}.ids"
                        sink = files.open_output_stream(f"{root}/{name}")
                        out, first = TokenFileWriter(sink, width, block), doc_id
                    out.add(doc_id, np.concatenate([ids, end]))
        if out is not None:
            n_docs, n_ids = out.close()
            sink.close()
            yield common.batches({"first_id": [first], "path": [f"{folder}/{name}"], "n_docs": [n_docs],
                                  "n_ids": [n_ids]}, MANIFEST)

    spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder))
    manifest = common.written(ordered.mapInArrow(write, "first_id long, path string, n_docs long, n_ids long"),
                              "token-manifest")
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "path").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                files, root = _filesystem(row["path"])
                with files.open_input_file(root) as source:
                    f = TokenFile(source, source.size())
                    for lo in range(0, f.n_docs, 4096):
                        hi = min(lo + 4096, f.n_docs)
                        s = f.starts[lo:hi + 1].tolist()
                        yield common.batches({
                            "doc_id": [None if z else d for d, z in zip(f.doc_ids[lo:hi].tolist(), f.nulls[lo:hi])],
                            "start": [row["start"] + x for x in s[:-1]],
                            "n_tokens": [b - a for a, b in zip(s, s[1:])],
                            "ids_crc32": [zlib.crc32(f.ids(a, b).astype("<u4").tobytes()) for a, b in zip(s, s[1:])],
                        }, DIGEST)

    n = max(1, manifest.count())  # one file a task
    return (manifest.select("path", "start").repartition(n)
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    folder = common.shared_path(spark, "token-files")
    manifest = write_token_files(common.read(spark, sf_dir, "documents"),
                                 public_tokenizers.path("word_bpe_49k.json"), folder, end_id=2)
    return read_token_files(manifest)

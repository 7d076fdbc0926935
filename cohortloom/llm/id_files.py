"""Token ids in files of shuffled planes.

Ids are written in blocks of a fixed size. A block's ids, as unsigned 32-bit integers,
are transposed into byte planes (all lowest bytes, then all second bytes, ...) or bit
planes, and each plane is compressed with zstandard by itself; a plane of zeros takes no
space. A file ends with the chunk index (a row per block) and the document index (a row
per document), both as Arrow streams, then their lengths and a mark:

    blocks | chunk index | document index | 2 x unsigned 64-bit length | b"PLANES01"

The manifest of a folder names the files in order. A task writes under a name of its own,
and only names that reached the manifest count, so tasks that were lost or run twice do no harm.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .base import identified_texts
from .tokens import piece_encoder

BLOCK_IDS = 1 << 16
MARK = b"PLANES01"
LEVEL = 3
DOCS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """4 byte planes or 32 bit planes; empty for a plane of zeros."""
    cells = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        planes = np.packbits(np.unpackbits(cells, axis=1, bitorder="little").T, axis=1)
    else:
        planes = np.ascontiguousarray(cells.T)
    return [p.tobytes() if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    width = (n + 7) // 8 if kind == "bit" else n
    table = np.zeros((len(planes), width), np.uint8)
    for row, plane in zip(table, planes):
        if plane:
            row[:] = np.frombuffer(plane, np.uint8)
    cells = np.packbits(np.unpackbits(table, axis=1, count=n).T, axis=1, bitorder="little") if kind == "bit" else table.T
    return np.ascontiguousarray(cells).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file; blocks cross documents, documents cross blocks."""

    def __init__(self, stream, kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = LEVEL):
        self.stream, self.kind, self.block_bytes = stream, kind, 4 * block_ids
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0
        self.chunks: list[tuple[int, int, list[int]]] = []
        self.docs: list[tuple[int | None, int]] = []
        self.n_ids = 0
        self.at = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.waiting.append(ids)
        self.waiting_bytes += len(ids)
        if self.waiting_bytes >= self.block_bytes:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        data = b"".join(self.waiting)
        end = len(data) if last else len(data) - len(data) % self.block_bytes
        for i in range(0, end, self.block_bytes):
            self._block(np.frombuffer(data[i:min(end, i + self.block_bytes)], "<u4"))
        self.waiting, self.waiting_bytes = [data[end:]], len(data) - end

    def _block(self, ids: np.ndarray) -> None:
        packed = [self.compressor.compress(p) if p else b"" for p in to_planes(ids, self.kind)]
        self.chunks.append((self.at, len(ids), [len(p) for p in packed]))
        for p in packed:
            self.stream.write(p)
            self.at += len(p)
        self.n_ids += len(ids)

    def close(self) -> None:
        self._flush(True)
        schema = pa.schema(
            [("offset", pa.int64()), ("n_ids", pa.int64()), ("planes", pa.list_(pa.int32()))], {"planes": self.kind})
        tails = [_stream(self.chunks, schema), _stream(self.docs, DOCS)]
        for tail in [*tails, *(len(t).to_bytes(8, "little") for t in tails), MARK]:
            self.stream.write(tail)
        self.stream.close()


def _stream(rows: list[tuple], schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    columns = list(zip(*rows)) or [()] * len(schema)
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))
    return sink.getvalue().to_pybytes()


class PlaneReader:
    """Reads one file; any block can be read by itself."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail = self._read(size - 24, 24)
        if tail[16:] != MARK:
            raise ValueError("not a file of id planes")
        n_chunks, n_docs = (int.from_bytes(tail[i:i + 8], "little") for i in (0, 8))
        chunks = pa.ipc.open_stream(self._read(size - 24 - n_docs - n_chunks, n_chunks)).read_all()
        self.kind = chunks.schema.metadata[b"planes"].decode()
        self.chunks = chunks.to_pylist()
        self.docs = pa.ipc.open_stream(self._read(size - 24 - n_docs, n_docs)).read_all()
        self.decompressor = zstandard.ZstdDecompressor()

    def _read(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def block(self, k: int) -> np.ndarray:
        chunk = self.chunks[k]
        data, at, planes = self._read(chunk["offset"], sum(chunk["planes"])), 0, []
        for n in chunk["planes"]:
            planes.append(self.decompressor.decompress(data[at:at + n]) if n else b"")
            at += n
        return from_planes(planes, chunk["n_ids"], self.kind)

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, ids of the file before it, ids) in the order written, a block at a time."""
        waiting, k, start = b"", 0, 0
        at = 0
        for batch in self.docs.to_batches():
            for doc_id, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(waiting) - at < 4 * n:
                    parts, have = [waiting[at:]], len(waiting) - at
                    while have < 4 * n:
                        parts.append(self.block(k).tobytes())
                        have += len(parts[-1])
                        k += 1
                    waiting, at = b"".join(parts), 0
                yield doc_id, start, waiting[at:at + 4 * n]
                at += 4 * n
                start += n


def _at(uri: str):
    """File system and path of a URI or an absolute path."""
    return pafs.FileSystem.from_uri(uri)


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, kind: str = "byte",
              block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode every text, append ``end_id``, and write files in ascending doc_id order
    (null ids first) below ``folder``, which all executors reach. Returns the manifest:
    (part, file, n_docs, n_ids, start), one row per file.

    Texts are dealt out by ranges of doc_id (ties by the text's hash), so each task
    encodes and writes one run of the order. Null texts are empty; repeated rows are
    written each; an empty table gives an empty manifest; other columns are not read.
    """
    spark = docs.sparkSession
    end = end_id.to_bytes(4, "little")
    fields = pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    fs, path = _at(folder)
    fs.create_dir(path, recursive=True)

    def write(batches):
        writer, encoder, part = None, piece_encoder(tokenizer), TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.planes"
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if writer is None:
                    task_fs, at = _at(name)
                    writer = PlaneWriter(task_fs.open_output_stream(at), kind, block_ids)
                writer.add(doc_id, encoder.encode(text) + end)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "file": name, "n_docs": len(writer.docs), "n_ids": writer.n_ids}], schema=fields)

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = identified_texts(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    # One row per file, at most spark.sql.shuffle.partitions of them.
    files = sorted(ordered.mapInArrow(write, "part bigint, file string, n_docs bigint, n_ids bigint").collect())
    starts = accumulate((f.n_ids for f in files), initial=0)
    manifest = spark.createDataFrame(
        [(*f, s) for f, s in zip(files, starts)], "part bigint, file string, n_docs bigint, n_ids bigint, start bigint")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents in a folder that ``write_ids``
    wrote, one task per file. start: the ids of all documents before it; ids are
    little-endian unsigned 32-bit integers."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches):
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, at = _at(name)
                rows, size = [], 0
                with fs.open_input_file(at) as file:
                    for doc_id, start, ids in PlaneReader(file).documents():
                        rows.append((doc_id, first + start, len(ids) // 4, ids))
                        size += len(ids)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = max(1, manifest.count())
    return manifest.select("file", "start").repartition(files).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")

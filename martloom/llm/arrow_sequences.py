"""Token ids as Arrow stream files of equal-length sequences, read in place.

A shard file is an Arrow stream of record batches with the same number of sequences each; a
sequence is a fixed-size list of ids and a fixed-size list of mask bits. All full batches have the
same size in bytes, so any sequence is found by arithmetic in the mapped file and read without a
copy. Only a shard's last sequence is padded (mask false). A second stream file holds the shard's
documents with their place in its ids. Shards are ranges of ascending doc_id.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import stored
from martloom.llm.tokens import encoder
from martloom.sources import paths

LENGTH = 2048
BATCH = 64
# Documents of one shard file.
SHARD_ROWS = 10_000
_FILES = "shard int, file string, n_docs long, n_tokens long"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _schema(dtype: np.dtype, length: int) -> pa.Schema:
    ids = pa.list_(pa.field("item", pa.from_numpy_dtype(dtype), nullable=False), length)
    mask = pa.list_(pa.field("item", pa.bool_(), nullable=False), length)
    fields = [pa.field("ids", ids, nullable=False), pa.field("mask", mask, nullable=False)]
    return pa.schema(fields, metadata={"length": str(length), "batch": str(BATCH)})


class ShardWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, filesystem: fs.FileSystem, path: str, dtype: np.dtype, length: int):
        self.schema, self.length, self.dtype = _schema(dtype, length), length, dtype
        self.file = filesystem.open_output_stream(f"{path}.arrows")
        self.docs_file = filesystem.open_output_stream(f"{path}.docs.arrows")
        self.sink = pa.ipc.new_stream(self.file, self.schema)
        self.docs_sink = pa.ipc.new_stream(self.docs_file, _DOCS)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_docs = 0

    def add(self, doc_ids: list[int | None], all_ids: list[np.ndarray]) -> None:
        sizes = np.array([len(ids) for ids in all_ids], np.int64)
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        columns = [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes)]
        self.docs_sink.write_batch(pa.RecordBatch.from_arrays(columns, schema=_DOCS))
        self.held += all_ids
        self.n_held += int(sizes.sum())
        self.n_tokens += int(sizes.sum())
        self.n_docs += len(doc_ids)
        whole = self.length * BATCH
        if self.n_held >= whole:
            ids = np.concatenate(self.held)
            for at in range(0, len(ids) - whole + 1, whole):
                self._write(ids[at : at + whole], whole)
            self.held = [ids[len(ids) // whole * whole :]]
            self.n_held = len(self.held[0])

    def _write(self, ids: np.ndarray, n: int) -> None:
        filled = np.zeros(n, self.dtype)
        filled[: len(ids)] = ids
        mask = pa.array(np.arange(n) < len(ids))
        ids_type, mask_type = self.schema.types
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(filled), type=ids_type),
            pa.FixedSizeListArray.from_arrays(mask, type=mask_type),
        ]
        self.sink.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            self._write(np.concatenate(self.held), -(-self.n_held // self.length) * self.length)
        for sink in (self.sink, self.docs_sink, self.file, self.docs_file):
            sink.close()


class ShardReader:
    """Random access to a shard file. Local files are mapped; others are read as a whole."""

    def __init__(self, filesystem: fs.FileSystem, path: str):
        name = f"{path}.arrows"
        local = isinstance(filesystem, fs.LocalFileSystem)
        source = pa.memory_map(name) if local else filesystem.open_input_file(name)
        self.buffer = source.read_buffer()
        stream = pa.BufferReader(self.buffer)
        self.schema = pa.ipc.read_schema(stream)
        self.length = int(self.schema.metadata[b"length"])
        self.per_batch = int(self.schema.metadata[b"batch"])
        self.first = stream.tell()
        self.step = 0
        if self.first < self.buffer.size - 8:
            pa.ipc.read_message(stream)
            self.step = stream.tell() - self.first
        with filesystem.open_input_file(f"{path}.docs.arrows") as docs:
            self.docs = pa.ipc.open_stream(docs).read_all()

    def batch(self, k: int) -> pa.RecordBatch:
        message = pa.ipc.read_message(self.buffer.slice(self.first + k * self.step))
        return pa.ipc.read_record_batch(message, self.schema)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids, in place, and mask of a sequence."""
        batch, row = self.batch(i // self.per_batch), i % self.per_batch
        ids, mask = (c.slice(row, 1).flatten() for c in batch.columns)
        return ids.to_numpy(zero_copy_only=True), mask

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids from a place in the shard's stream; in place if they lie in one batch."""
        parts, whole = [], self.length * self.per_batch
        while n:
            k, at = divmod(start, whole)
            part = self.batch(k).column(0).flatten().to_numpy(zero_copy_only=True)[at : at + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])


def _write(folder: str, path: str, end_id: int, length: int) -> Callable:
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(root)
        encode, shard = encoder(path), TaskContext.get().partitionId()
        # Each attempt writes files of its own; the row of the one that succeeds names them.
        name, writer = f"shard-{shard:06d}-{uuid.uuid4().hex}", None
        for batch in batches:
            writer = writer or ShardWriter(filesystem, f"{root}/{name}", encode.dtype, length)
            for at in range(0, batch.num_rows, 256):
                doc_ids, texts = (c.to_pylist() for c in batch.slice(at, 256).columns)
                ids = [np.append(encode.ids(t or ""), encode.dtype.type(end_id)) for t in texts]
                writer.add(doc_ids, ids)
        if writer:
            writer.close()
            row = (shard, name, writer.n_docs, writer.n_tokens)
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array(row[:1], pa.int32()), "file": [row[1]], "n_docs": [row[2]], "n_tokens": [row[3]]}
            )

    return shards


def write_sequences(
    docs: DataFrame, folder: str, path: str, end_id: int, length: int = LENGTH, rows: int = SHARD_ROWS
) -> DataFrame:
    """Writes the documents in ascending doc_id; shard, file, n_docs, n_tokens and first_token of
    each file, a table in the shared folder.

    Null ids come first; rows of one id are spread over several shards if they are many; null and
    empty texts are the end id alone; an empty table has no files. Other columns are ignored.
    """
    shards = max(1, -(-docs.count() // rows))
    dealt = (
        docs.select(docs["doc_id"].cast("long"), "text", F.monotonically_increasing_id().alias("_row"))
        .repartitionByRange(shards, "doc_id", "_row")
        .sortWithinPartitions("doc_id", "_row")
        .select("doc_id", "text")
    )
    files = stored(dealt.mapInArrow(_write(folder, path, end_id, length), _FILES))
    # One row per file: few enough for one task.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(folder: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = ShardReader(filesystem, f"{root}/{name}")
                for part in shard.docs.to_batches(max_chunksize=1000):
                    starts, sizes = part.column(1).to_pylist(), part.column(2).to_pylist()
                    ids = [
                        shard.ids(start, n).astype("<u4").tobytes()
                        for start, n in zip(starts, sizes, strict=True)
                    ]
                    moved = pa.array(np.array(starts, np.int64) + first)
                    columns = [part.column(0), moved, part.column(2), pa.array(ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    return rows


def read_documents(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian uint32) of
    every document, read back from the files; one task reads whole files."""
    n = max(1, files.count())
    return files.select("file", "first_token").repartition(n).mapInArrow(
        _read(folder), "doc_id long, start long, n_tokens long, ids binary"
    )


def new_folder(docs: DataFrame) -> str:
    return paths.join(paths.shared_folder(docs.sparkSession), "sequences")


"""Best-fit packing by the sum of squares of the open sequences' gaps.

Each piece goes where the sum over all gaps of (number of open sequences with that gap) squared
becomes smallest, which keeps many different gaps open for later pieces. A fixed number of pieces
(``group_rows``) is packed by one task; the groups are dealt without regard to any key, so no
source, document or group of copies makes a group large. Every group leaves some half-empty
sequences behind, so groups are as large as one task packs in seconds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.llm.common import stored
from martloom.llm.tokens import encoder

CAPACITY = 2048
GROUP_ROWS = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids binary"


class OpenSequences:
    """Sequences of a fixed capacity, those with room left kept by their gap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.used = 0

    def place(self, length: int) -> tuple[int, int]:
        """Number of the sequence that takes the piece, and the piece's offset in it.

        Moving a sequence from gap g to g - length changes the sum of squares by
        2 * (counts[g - length] - counts[g]) + 2; a sequence filled up leaves the sum, and a new
        one only enters it. Ties go to the smallest gap.
        """
        before, after = self.counts[length:], self.counts[: self.capacity + 1 - length]
        change = 2 * (after - before) + 2
        change[0] = 1 - 2 * before[0]
        change[before == 0] = np.iinfo(np.int64).max
        change[-1] = 2 * after[-1] + 1 if length < self.capacity else 0
        gap = length + int(change.argmin())
        if gap == self.capacity:
            sequence = self.used
            self.used += 1
        else:
            sequence = self.by_gap[gap].pop()
            self.counts[gap] -= 1
        if gap > length:
            self.by_gap[gap - length].append(sequence)
            self.counts[gap - length] += 1
        return sequence, self.capacity - gap


def cut_documents(path: str, end_id: int, capacity: int) -> Callable:
    """Arrow batches of (doc_id, text) to batches of pieces; a null text counts as empty."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path).ids
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[tuple] = []
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    ids = np.append(ids_of(text or ""), end_id).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start : start + capacity]
                        out.append((doc_id, k, start, len(piece), piece.tobytes()))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds, strict=True)]
                names = ["doc_id", "piece", "start", "length", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return pieces


def tokenized_pieces(
    docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece of at most ``capacity`` ids; ``ids`` holds little-endian uint32.

    Only documents longer than a sequence are cut. A null or empty text is the end id alone;
    repeated rows stay repeated, a null doc_id stays null, other columns are ignored.
    """
    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(
        cut_documents(path, end_id, capacity), PIECES
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Within a sequence offsets run gapless from 0; sequence numbers are unique, not gapless. Rows
    may repeat and hold nulls in any other column; an empty table gives an empty one.
    """
    groups = max(1, -(-pieces.count() // group_rows))
    # Largest first: what is placed early sets the frame that the small pieces fill.
    dealt = pieces.repartition(groups).sortWithinPartitions("length", ascending=False)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        open_sequences = OpenSequences(capacity)
        for batch in batches:
            lengths = batch.column("length").to_pylist()
            placed = np.array([open_sequences.place(n) for n in lengths], np.int64).reshape(-1, 2)
            yield batch.append_column(
                "sequence_id", pa.array(first + placed[:, 0], pa.int64())
            ).append_column("offset", pa.array(placed[:, 1], pa.int64()))

    schema = StructType(pieces.schema.fields)
    return dealt.mapInArrow(place, schema.add("sequence_id", "long").add("offset", "long"))


def pack_documents(docs: DataFrame, path: str, **how: int) -> DataFrame:
    """Tokenizes and packs documents; the pieces' ids stay in a table that is read for the result.

    Only the narrow columns of the pieces are shuffled.
    """
    cut = stored(tokenized_pieces(docs, path, **how), compression="zstd")
    digest = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(digest)

"""Sum-of-squares online packing of tokenised documents into training sequences.

Each task packs the documents of its partition as they come. An array counts the partly filled
sequences of every fill level; a document goes to the level that makes the sum of the squared
counts least, which keeps levels varied and so lets later documents close sequences exactly.
What is still open at the end is poured together, cutting documents, so that each task ends in
full sequences and a rest that is cut at powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import default_tokenizer, tokenizer
from .common import documents_of, small_batches, table

CAPACITY = 4096
END_ID = 2
#: Partly filled sequences a task holds before it pours them together.
OPEN_MOST = 2048

Piece = tuple[int | None, int, bytes, int]  # doc_id, start, ids, tokens of the document


class Packer:
    def __init__(self, capacity: int = CAPACITY, open_most: int = OPEN_MOST):
        self.capacity, self.open_most = capacity, open_most
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0

    def place(self, size: int) -> int:
        """The fill level (0: a new sequence) where a piece of this size adds least to the sum of squares."""
        count, top = self.count, self.capacity - size
        after = count[size : self.capacity + 1].copy()  # counts of the levels that levels 0 to top would become
        after[top] = -1 if top else 0  # full sequences are not counted: closing one only takes a square away
        grows = 2 * (after - count[: top + 1]) + 2
        grows[top] = 1 - 2 * count[top]
        grows[1:][count[1 : top + 1] == 0] = np.iinfo(np.int64).max
        grows[0] = 2 * count[size] + 1 if top else 0
        return int(grows.argmin())

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Places a document; yields sequences that are now closed."""
        doc, start, ids, total = piece
        full = 4 * self.capacity
        while len(ids) >= full:
            yield [(doc, start, ids[:full], total)]
            start, ids = start + self.capacity, ids[full:]
        if not ids:
            return
        size = len(ids) // 4
        level = self.place(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
            self.n_open -= 1
        pieces.append((doc, start, ids, total))
        if level + size == self.capacity:
            yield pieces
            return
        self.open[level + size].append(pieces)
        self.count[level + size] += 1
        self.n_open += 1
        if self.n_open > self.open_most:
            yield from self.poured(last=False)

    def poured(self, last: bool) -> Iterator[list[Piece]]:
        """Fills the fullest sequences with what the emptiest hold; the rest is cut at powers of two if last."""
        left = [pieces for level in range(self.capacity, 0, -1) for pieces in self.open[level]]
        self.open = [[] for _ in range(self.capacity + 1)]
        self.count[:] = 0
        self.n_open = 0
        supply: list[Piece] = []
        i, j = 0, len(left) - 1
        while i <= j:
            pieces = left[i]
            room = self.capacity - sum(len(p[2]) // 4 for p in pieces)
            i += 1
            while room and (supply or i <= j):
                if not supply:
                    supply = left[j]
                    j -= 1
                doc, start, ids, total = supply.pop()
                pieces.append((doc, start, ids[: 4 * room], total))
                if len(ids) > 4 * room:
                    supply.append((doc, start + room, ids[4 * room :], total))
                room -= min(room, len(ids) // 4)
            if not room:
                yield pieces
            else:
                supply = pieces
        if supply and not last:
            level = sum(len(p[2]) // 4 for p in supply)
            while level >= self.capacity:
                supply, closed = self.cut(supply, self.capacity)
                level -= self.capacity
                yield closed
            if level:
                self.open[level].append(supply)
                self.count[level] += 1
                self.n_open += 1
        while supply and last:
            size = sum(len(p[2]) // 4 for p in supply)
            supply, closed = self.cut(supply, min(self.capacity, 1 << (size.bit_length() - 1)))
            yield closed

    @staticmethod
    def cut(pieces: list[Piece], room: int) -> tuple[list[Piece], list[Piece]]:
        """What is left of the pieces, and as many of them as make up room tokens."""
        taken = []
        pieces = pieces[::-1]
        while room:
            doc, start, ids, total = pieces.pop()
            taken.append((doc, start, ids[: 4 * room], total))
            if len(ids) > 4 * room:
                pieces.append((doc, start + room, ids[4 * room :], total))
            room -= min(room, len(ids) // 4)
        return pieces[::-1], taken


def rows_of(sequences: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
    docs, starts, ids, totals, numbers, offsets = [], [], [], [], [], []
    for number, pieces in sequences:
        at = 0
        for doc, start, blob, total in pieces:
            docs.append(doc)
            starts.append(start)
            ids.append(blob)
            totals.append(total)
            numbers.append(number)
            offsets.append(at)
            at += len(blob) // 4
    longs = [pa.array(x, pa.int64()) for x in (docs, starts, [len(b) // 4 for b in ids], totals, numbers, offsets)]
    return pa.RecordBatch.from_arrays([*longs, pa.array(ids, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def pack(docs: DataFrame, *, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    A document is the ids of its whole text and end_id; null and empty texts have end_id alone.
    Every id lies in exactly one piece. Sequences are full, or their length is a power of two.
    Rows that repeat a doc_id are packed one by one; an empty table gives no rows; other columns
    are ignored. Sequence numbers are unique over all tasks.
    """
    path = path or default_tokenizer()
    docs = documents_of(docs)
    small_batches(docs.sparkSession)
    tail = end_id.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, packer = tokenizer(path), Packer(capacity)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            closed = []
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode(batch.column(1)), strict=True):
                for pieces in packer.add((doc, 0, ids + tail, len(ids) // 4 + 1)):
                    closed.append((number, pieces))
                    number += 1
            yield rows_of(closed)
        yield rows_of([(number + k, pieces) for k, pieces in enumerate(packer.poured(last=True))])

    return docs.mapInArrow(packed, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

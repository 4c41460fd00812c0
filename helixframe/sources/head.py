"""The first lines of large text files, without reading what lies behind them.

Splits of a file are counted in its order, one in the first round and twice as many in each that follows,
until enough lines are there; the others are never opened. Only the splits that hold the wanted
lines are then read. Compressed files cannot be entered midway: a task follows each until it has enough.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import parts
from .session import workers_import

SPLIT_BYTES, READ_BYTES = 32 << 20, 1 << 20
COMPRESSED = {".gz": "gzip", ".bz2": "bz2", ".lz4": "lz4"}
LINES = "path string, line_no long, value string"


def line_batches(chunks: Iterator[bytes], path: str, line_no: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Lines of a stream as rows, from this number on up to the limit; a last line need not end."""
    rest = b""

    def rows(lines: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array(range(line_no, line_no + len(lines)), pa.int64()), pa.array([x.removesuffix(b"\r") for x in lines], pa.binary()).cast(pa.string())], ["path", "line_no", "value"])

    for data in chunks:
        *lines, rest = (rest + data).split(b"\n")
        lines = lines[: max(limit - line_no, 0)]
        if lines:
            yield rows(lines)
            line_no += len(lines)
        if line_no >= limit:
            return
    if rest and line_no < limit:
        yield rows([rest])


def stretch(file, begin: int, end: int) -> Iterator[bytes]:
    """Bytes of the lines that begin within a range: up to the line feed at or behind its last byte."""
    at, size = begin, file.size()
    while at < size:
        data = file.read_at(min(READ_BYTES, size - at), at)
        if at + len(data) >= end:
            cut = data.find(b"\n", max(end - 1 - at, 0))
            if cut >= 0:
                yield data[: cut + 1]
                return
        yield data
        at += len(data)


def head_lines(spark: SparkSession, path: str | Sequence[str], n: int, *, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, line_no (from 0) and value of the first n lines of each file; folders stand for their files."""
    workers_import(spark)
    files = parts.listed([path] if isinstance(path, str) else list(path), "")
    kind = {p: next((codec for e, codec in COMPRESSED.items() if p.endswith(e)), None) for p in files}

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, codec in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, inner = parts.open_path(name)
                with fs.open_input_stream(inner, compression=codec) as stream:
                    yield from line_batches(iter(lambda s=stream: s.read(READ_BYTES), b""), name, 0, n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, inner = parts.open_path(name)
                feeds, at = 0, begin
                with fs.open_input_file(inner) as file:
                    while at < end and (data := file.read_at(min(READ_BYTES, end - at), at)):
                        feeds += data.count(b"\n")
                        at += len(data)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([begin], pa.int64()), pa.array([feeds], pa.int64())], ["path", "begin", "feeds"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, begin, end, feeds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, inner = parts.open_path(name)
                with fs.open_input_file(inner) as file:
                    start, number = begin, feeds
                    if begin and file.read_at(1, begin - 1) != b"\n":
                        # The line that the range begins within is the split's before.
                        start, number = None, feeds + 1
                        for at in range(begin, end, READ_BYTES):
                            cut = file.read_at(min(READ_BYTES, end - at), at).find(b"\n")
                            if cut >= 0:
                                start = at + cut + 1
                                break
                    if start is not None and start < end:
                        yield from line_batches(stretch(file, start, end), name, number, n)

    found = []
    streams = [(p, codec) for p, codec in kind.items() if codec]
    if streams:
        found.append(spark.createDataFrame(streams, "path string, codec string").repartition(len(streams)).mapInArrow(follow, LINES))
    sizes = {}
    for p in (p for p, codec in kind.items() if codec is None):
        fs, inner = parts.open_path(p)
        sizes[p] = fs.get_file_info(inner).size
    # What has been counted of each file: the feeds before each of its splits, a number a split.
    before: dict[str, list[int]] = {p: [0] for p in sizes}
    wanted = 1
    while open_ := [(p, k * split_bytes, min((k + 1) * split_bytes, sizes[p])) for p, feeds in before.items() if feeds[-1] < n for k in range(len(feeds) - 1, len(feeds) - 1 + wanted) if k * split_bytes < sizes[p]]:
        counts = {(r.path, r.begin): r.feeds for r in spark.createDataFrame(open_, "path string, begin long, end long").repartition(len(open_)).mapInArrow(count, "path string, begin long, feeds long").toLocalIterator()}
        for p, begin, _ in open_:
            before[p].append(before[p][-1] + counts[p, begin])
        wanted *= 2
    pieces = [(p, k * split_bytes, min((k + 1) * split_bytes, sizes[p]), feeds[k]) for p, feeds in before.items() for k in range(len(feeds) - 1) if feeds[k] < n]
    if pieces:
        found.append(spark.createDataFrame(pieces, "path string, begin long, end long, feeds long").repartition(len(pieces)).mapInArrow(read, LINES))
    if not found:
        return spark.createDataFrame([], LINES)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])

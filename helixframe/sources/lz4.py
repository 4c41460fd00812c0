"""Text in LZ4 frames, read and written in parallel.

A frame is a header, blocks that say how long they are, and an end mark; files may hold several frames.
Spark's own codec of that name has another format. Tasks first walk the headers of each file and group its
blocks into splits, without decoding any. Then each split is decoded: it leaves the line that it begins
within to the split before, and follows its own last line into the blocks behind. Frames whose blocks
need those before them are one split, decoded as a stream.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource
from xxhash import xxh32_intdigest

from . import parts
from .session import workers_import

# Marks of the format, and the most plain bytes of a block by its code.
MAGIC, SKIPPED = 0x184D2204, range(0x184D2A50, 0x184D2A60)
BLOCK_BYTES = {4: 1 << 16, 5: 1 << 18, 6: 1 << 20, 7: 1 << 22}
LAST = 4
#: Compressed bytes of a split, and plain bytes of a written block.
SPLIT_BYTES, WRITE_CODE = 32 << 20, 7
#: Lines of an Arrow batch, and bytes.
BATCH_LINES, BATCH_BYTES = 8192, 4 << 20


def frame_head(code: int = WRITE_CODE) -> bytes:
    """Head of a frame of independent blocks without checksums."""
    kind = bytes([0x60, code << 4])
    return struct.pack("<I", MAGIC) + kind + bytes([xxh32_intdigest(kind) >> 8 & 0xFF])


def units(window: parts.Window, at: int, frame: bytes = b"") -> Iterator[tuple[int, int, bytes]]:
    """Place, length and the frame's descriptor of everything that can be decoded by itself, from a place on.

    That is a block with its size before it, or a whole frame of linked blocks. A place within a
    frame needs its descriptor (flags and block code).
    """
    while at < window.size:
        if not frame:
            magic = struct.unpack("<I", window.bytes_at(at, 4))[0] if window.size - at >= 4 else 0
            if magic in SKIPPED:
                at += 8 + struct.unpack("<I", window.bytes_at(at + 4, 4))[0]
                continue
            if magic != MAGIC:
                raise ValueError(f"no LZ4 frame at {at}")
            flags = window.bytes_at(at + 4, 1)[0]
            length = 2 + 8 * (flags >> 3 & 1) + LAST * (flags & 1)
            frame, check = window.bytes_at(at + 4, length), window.bytes_at(at + 4 + length, 1)
            if flags >> 6 != 1 or len(check) < 1 or xxh32_intdigest(frame) >> 8 & 0xFF != check[0]:
                raise ValueError(f"damaged head of an LZ4 frame at {at}")
            begin, at = at, at + 4 + length + 1
        independent, checked, summed = frame[0] >> 5 & 1, frame[0] >> 4 & 1, frame[0] >> 2 & 1
        size = window.bytes_at(at, 4)
        if len(size) < 4:
            raise ValueError("LZ4 file ends within a frame")
        n = struct.unpack("<I", size)[0]
        whole = 4 + (n & 0x7FFFFFFF) + 4 * checked
        if n and independent:
            if at + whole > window.size:
                raise ValueError("LZ4 file ends within a block")
            yield at, whole, frame
            at += whole
        elif n:
            at += whole
        else:
            at += 4 + 4 * summed
            if not independent:
                yield begin, at - begin, frame
            frame = b""
    if frame:
        raise ValueError("LZ4 file ends within a frame")


class Range(io.RawIOBase):
    """A stretch of a file as a stream."""

    def __init__(self, window: parts.Window, begin: int, end: int):
        self.window, self.at, self.end = window, begin, end

    def readable(self) -> bool:
        return True

    def read(self, n: int = -1) -> bytes:
        n = self.end - self.at if n is None or n < 0 else min(n, self.end - self.at)
        data = self.window.bytes_at(self.at, n)
        self.at += len(data)
        return data


def plain(window: parts.Window, at: int, length: int, frame: bytes) -> Iterator[bytes]:
    """The plain bytes of a unit."""
    if not frame[0] >> 5 & 1:
        with pa.CompressedInputStream(pa.PythonFile(Range(window, at, at + length), "r"), "lz4") as stream:
            while data := stream.read(BATCH_BYTES):
                yield data
        return
    n = struct.unpack("<I", window.bytes_at(at, 4))[0]
    data = window.bytes_at(at + 4, n & 0x7FFFFFFF)
    if frame[0] >> 4 & 1 and xxh32_intdigest(data) != struct.unpack("<I", window.bytes_at(at + 4 + len(data), 4))[0]:
        raise ValueError(f"damaged LZ4 block at {at}")
    if n >> 31:
        yield data
        return
    # The block as a frame of its own, as nothing else says how long its plain bytes are.
    alone = frame_head(frame[1] >> 4 & 7) + struct.pack("<I", n) + data + struct.pack("<I", 0)
    yield pa.CompressedInputStream(pa.BufferReader(alone), "lz4").read()


def chunks(window: parts.Window, begin: int, frame: bytes) -> Iterator[tuple[int, bytes]]:
    """Place of the unit and plain bytes, from a place on to the end of the file."""
    for at, length, head in units(window, begin, frame):
        for data in plain(window, at, length, head):
            yield at, data


def split_lines(window: parts.Window, begin: int, end: int, frame: bytes, first: bool) -> Iterator[list[bytes]]:
    """Lines of a split, some at a time: those that begin in it, but for the one that begins with it unless the file does.

    So a line that ends right before a border and the one behind it are told apart without knowing
    more than this split: every split reads on through the first line feed behind its end.
    """
    rest, skip, ended = b"", not first, False
    for at, data in chunks(window, begin, frame):
        if at >= end:
            if skip:  # no line begins in this split
                return
            cut = data.find(b"\n")
            if cut < 0:
                rest += data
                continue
            yield (rest + data[:cut]).split(b"\n")
            ended = True
            break
        if skip:
            cut = data.find(b"\n")
            if cut < 0:
                continue
            data, skip = data[cut + 1 :], False
        rest += data
        if len(rest) >= BATCH_BYTES:
            *done, rest = rest.split(b"\n")
            if done:
                yield done
    if not ended and not skip:
        *done, rest = rest.split(b"\n")
        if done:
            yield done
        if rest:  # a last line without a line feed
            yield [rest]


def splits(spark: SparkSession, paths: Sequence[str], split_bytes: int) -> DataFrame:
    """path, begin, finish, frame, first of the splits of files: a task walks the headers of a file."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inner = parts.open_path(path)
                rows: list[list] = []
                with fs.open_input_file(inner) as file:
                    # Only heads are read: a small window.
                    for at, length, frame in units(parts.Window(file, 64), 0):
                        if not rows or at - rows[-1][0] >= split_bytes:
                            rows.append([at, at, frame, not rows])
                        rows[-1][1] = at + length
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.bool_())
                # Where a split begins with a whole frame, its own head is read again.
                heads = [b"" if f and not f[0] >> 5 & 1 else f for f in columns[2]]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), *[pa.array(c, t) for c, t in zip((columns[0], columns[1], heads, columns[3]), kinds, strict=True)]], ["path", "begin", "finish", "frame", "first"])

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), 10_000)))
    return files.mapInArrow(walk, "path string, begin long, finish long, frame binary, first boolean")


def read_lz4(spark: SparkSession, path: str | Sequence[str], *, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """value (a line), path and first (whether it is the file's first line) of text in LZ4 frames; folders stand for their .lz4 files."""
    workers_import(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, inner = parts.open_path(row["path"])
                with fs.open_input_file(inner) as file:
                    first = row["first"]
                    for lines in split_lines(parts.Window(file), row["begin"], row["finish"], row["frame"], first):
                        for k in range(0, len(lines), BATCH_LINES):
                            some = [x.removesuffix(b"\r") for x in lines[k : k + BATCH_LINES]]
                            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()).cast(pa.string()), pa.array([row["path"]] * len(some), pa.string()), pa.array([first, *[False] * (len(some) - 1)], pa.bool_())], ["value", "path", "first"])
                            first = False

    files = parts.listed([path] if isinstance(path, str) else list(path), ".lz4")
    found = splits(spark, files, split_bytes)
    # A split a task, as far as there are tasks: splits differ little in size.
    dealt = found.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "begin")
    return dealt.mapInArrow(read, "value string, path string, first boolean")


class Lz4Writer(parts.PartWriter):
    def __init__(self, path: str, overwrite: bool, block_bytes: int, head: str | None):
        super().__init__(path, overwrite)
        self.block_bytes, self.head = block_bytes, head

    def write(self, iterator: Iterator[pa.RecordBatch]) -> parts.Written:
        codec, held, stream, name = pa.Codec("lz4_raw"), bytearray(), None, ""
        code = min(k for k, n in BLOCK_BYTES.items() if n >= self.block_bytes)

        def put(data: bytes) -> None:
            packed = codec.compress(data, asbytes=True)
            stored = len(packed) >= len(data)
            stream.write(struct.pack("<I", len(data) | 1 << 31 if stored else len(packed)) + (data if stored else packed))

        for batch in iterator:
            if stream is None:
                name = self.part(".lz4")
                stream = self.opened(name)
                stream.write(frame_head(code))
                held += b"" if self.head is None else self.head.encode() + b"\n"
            for line in batch.column(0).cast(pa.binary()).to_pylist():
                held += (line or b"") + b"\n"
                while len(held) >= self.block_bytes:
                    put(bytes(held[: self.block_bytes]))
                    del held[: self.block_bytes]
        if stream is None:
            return parts.Written([])
        if held:
            put(bytes(held))
        stream.write(struct.pack("<I", 0))
        stream.close()
        return parts.Written([name])


class Lz4Text(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lz4text"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: T.StructType, overwrite: bool) -> Lz4Writer:
        return Lz4Writer(self.options["path"], overwrite, int(self.options.get("blockBytes", BLOCK_BYTES[WRITE_CODE])), self.options.get("head"))


def write_lz4(lines: DataFrame, path: str, *, head: str | None = None, mode: str = "append", block_bytes: int = BLOCK_BYTES[WRITE_CODE]) -> None:
    """Lines (the first column, text) as a folder of LZ4 frames, one file a task; head is the first line of every file."""
    workers_import(lines.sparkSession)
    lines.sparkSession.dataSource.register(Lz4Text)
    if mode == "errorifexists":
        fs, inner = parts.open_path(path)
        if fs.get_file_info(inner).type != parts.pafs.FileType.NotFound:
            raise FileExistsError(path)
        mode = "append"
    writer = lines.select(F.col(lines.columns[0]).cast("string").alias("value")).write.format("lz4text").mode(mode).option("blockBytes", block_bytes)
    (writer if head is None else writer.option("head", head)).save(path)

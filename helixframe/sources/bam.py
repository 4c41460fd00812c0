"""Alignments in BAM files, as a Spark data source that reads and writes them in parallel.

With an index (.bai beside the file) a file is cut into tasks at places where the index says that a
record begins, and conditions on the contig and the place choose the parts to be opened at all. Without
one a file is one task, which holds half a megabyte of records at a time, or one record. Only the columns of the schema asked for are decoded.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..functions.alignments import SLIM, slim
from . import bgzf, parts
from .bam_records import FLAGS, HEAD, SCHEMA, batches, bin_of, encoded, numbers, portions
from .session import workers_import

#: Those that a record is made from.
WRITTEN = ("query_name", "ref_id", *FLAGS, "mapping_quality", "template_length", "reference_start", "reference_end", "query_sequence", "query_qualities", "nm", "aligned_pairs", "reference_sequence")

#: Compressed bytes of a task where an index allows it, and plain bytes that are decoded at once.
SPLIT_BYTES, CHUNK = 64 << 20, 1 << 19
#: A bin that holds no records but numbers about the contig.
_NO_BIN = 37450


def header(reader: bgzf.Reader) -> list[tuple[str, int]]:
    """Names and lengths of the contigs; the reader is then at the first record."""
    if reader.read(4) != b"BAM\x01":
        raise ValueError("no BAM file")
    reader.read(struct.unpack("<i", reader.read(4))[0])
    contigs = []
    for _ in range(struct.unpack("<i", reader.read(4))[0]):
        name = reader.read(struct.unpack("<i", reader.read(4))[0])
        contigs.append((name.rstrip(b"\x00").decode(), struct.unpack("<i", reader.read(4))[0]))
    return contigs


# ---------------------------------------------------------------- index


def bins_of(begin: int, end: int) -> set[int]:
    """All bins whose records may overlap a half-open range."""
    end = max(end, begin + 1) - 1
    return {0} | {first + k for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)) for k in range(begin >> shift, (end >> shift) + 1)}


@dataclass
class Index:
    bins: list[dict[int, list[tuple[int, int]]]]  # of each contig, the parts of the file that hold the records of a bin
    linear: list[list[int]]  # of each contig, where the first record over each 16,384 bases begins

    def starts(self) -> list[int]:
        """Places where records begin."""
        return sorted({b for of in self.bins for ranges in of.values() for b, _ in ranges} | {x for of in self.linear for x in of if x})

    def ranges(self, contig: int, begin: int, end: int) -> list[tuple[int, int]]:
        """Parts of the file that hold all records of a contig that overlap a range."""
        window = begin >> 14
        least = self.linear[contig][window] if window < len(self.linear[contig]) else 0
        wanted = bins_of(begin, end) if end - begin < 1 << 29 else None
        return [(max(b, least), e) for k, ranges in self.bins[contig].items() if wanted is None or k in wanted for b, e in ranges if e > least]


def read_index(data: bytes) -> Index:
    if data[:4] != b"BAI\x01":
        raise ValueError("no index of a BAM file")
    at, bins, linear = 8, [], []
    for _ in range(struct.unpack_from("<i", data, 4)[0]):
        of: dict[int, list[tuple[int, int]]] = {}
        n, at = struct.unpack_from("<i", data, at)[0], at + 4
        for _ in range(n):
            k, m = struct.unpack_from("<Ii", data, at)
            ends = struct.unpack_from(f"<{2 * m}Q", data, at + 8)
            at += 8 + 16 * m
            if k != _NO_BIN:
                of[k] = list(zip(ends[::2], ends[1::2], strict=True))
        n, at = struct.unpack_from("<i", data, at)[0], at + 4
        linear.append(list(struct.unpack_from(f"<{n}Q", data, at)))
        bins.append(of)
        at += 8 * n
    return Index(bins, linear)


def write_index(index: Index) -> bytes:
    out = [b"BAI\x01", struct.pack("<i", len(index.bins))]
    for of, linear in zip(index.bins, index.linear, strict=True):
        out.append(struct.pack("<i", len(of)))
        for k, ranges in sorted(of.items()):
            out.append(struct.pack("<Ii", k, len(ranges)) + b"".join(struct.pack("<QQ", *p) for p in ranges))
        out.append(struct.pack(f"<i{len(linear)}Q", len(linear), *linear))
    return b"".join(out)


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts in order, those joined that overlap or meet in a block."""
    out: list[tuple[int, int]] = []
    for b, e in sorted(ranges):
        if out and b >> 16 <= out[-1][1] >> 16:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def cut(ranges: list[tuple[int, int]], starts: list[int], size: int) -> list[tuple[int, int]]:
    """The ranges cut at starts of records, so that a piece has not much more than size compressed bytes."""
    out = []
    for begin, end in ranges:
        at = begin
        for s in starts[int(np.searchsorted(starts, begin, "right")) : int(np.searchsorted(starts, end))] if starts else []:
            if (s >> 16) - (at >> 16) >= size:
                out.append((at, s))
                at = s
        out.append((at, end))
    return out


# ---------------------------------------------------------------- reading


@dataclass
class Piece(InputPartition):
    path: str
    begin: int
    end: int


def records(window: parts.Window, begin: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Plain bytes that hold whole records, where in them these begin, and their virtual offsets: of all records that begin in a range of those."""
    held, marks = bytearray(), []  # marks: where in held the bytes of a block begin, and their virtual offset

    def whole() -> tuple[list[int], int]:
        """Where the whole records in held begin, and where they end."""
        at, n, found, number = 0, len(held), [], struct.Struct("<i").unpack_from
        while at + 4 <= n:
            (size,) = number(held, at)
            if size < HEAD.itemsize:
                raise ValueError("damaged record of a BAM file")
            if at + 4 + size > n:
                break
            found.append(at)
            at += 4 + size
        return found, at

    def taken() -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], bool]:
        """Those records and whether more may follow in the range; what is left stays in held."""
        found, rest = whole()
        places, offsets = (np.array(x, np.int64) for x in zip(*marks, strict=True))
        starts = np.array([*found, rest], np.int64)
        block = np.searchsorted(places, starts, "right") - 1
        virtual = offsets[block] + starts - places[block]
        n = int(np.searchsorted(virtual[:-1], end))
        more = n == len(found) and (rest == len(held) or int(virtual[-1]) < end)
        data = np.array(held[:rest], np.uint8)
        del held[:rest]
        marks[:] = [(max(p - rest, 0), o + max(rest - p, 0)) for p, o in marks[int(block[-1]) :]]
        return (data, starts[:n], virtual[:n]), more

    for place, plain in bgzf.blocks(window, begin >> 16):
        if not held and place << 16 >= end:
            return
        skip = begin & 0xFFFF if place == begin >> 16 else 0
        if len(plain) > skip:
            marks.append((len(held), (place << 16) + skip))
            held += plain[skip:]
        last = place >= end >> 16  # what begins in the blocks behind is out of the range
        if held and (last or len(held) >= CHUNK):
            found, more = taken()
            yield found
            if not more or last and not held:
                return
    if held:
        found, more = taken()
        yield found
        if more and held:
            raise ValueError("BGZF file ends within a record")


class BamReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.files, self.split = options.get("path", ""), int(options.get("splitBytes", SPLIT_BYTES))
        self.names = schema.fieldNames()
        self.contigs: set[str] | None = None
        self.low, self.high = 0, 1 << 31

    def pushFilters(self, filters: list[Filter]):
        """Conditions that say where to look; Spark checks every one again."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | In | LessThan | LessThanOrEqual | GreaterThan | GreaterThanOrEqual) and len(f.attribute) == 1 else None
            if column == "ref_id" and isinstance(f, EqualTo | In):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.contigs = values if self.contigs is None else self.contigs & values
            elif column == "reference_start" and isinstance(f, LessThan | LessThanOrEqual | EqualTo):
                self.high = min(self.high, f.value + (not isinstance(f, LessThan)))
            elif column == "reference_end" and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.low = max(self.low, f.value - isinstance(f, GreaterThanOrEqual))
            yield f

    def pieces(self, path: str) -> list[Piece]:
        fs, inner = parts.open_path(path)
        index = None
        for beside in (inner + ".bai", inner.removesuffix(".bam") + ".bai"):
            if index is None and parts.is_file(fs, beside):
                with fs.open_input_file(beside) as file:
                    index = read_index(file.read())
        with fs.open_input_file(inner) as file:
            window = parts.Window(file)
            reader = bgzf.Reader(window)
            names = [n for n, _ in header(reader)]
            first = reader.offset()
            if first is None:
                return []
            ranges = [(first, window.size << 16)]
            if index is not None and self.contigs is not None:
                ranges = merged([p for k, n in enumerate(names) if n in self.contigs for p in index.ranges(k, max(self.low, 0), max(self.high, 1))])
        return [Piece(path, b, e) for b, e in cut(ranges, index.starts() if index else [], self.split)]

    def partitions(self) -> list[Piece]:
        with ThreadPoolExecutor(16) as pool:
            return [p for found in pool.map(self.pieces, parts.listed([p.strip() for p in self.files.split(",")], ".bam")) for p in found]

    def read(self, partition: Piece | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file has what is asked for
            return
        fs, inner = parts.open_path(partition.path)
        with fs.open_input_file(inner) as file:
            window = parts.Window(file)
            contigs = [n for n, _ in header(bgzf.Reader(window))]
            asked = None if self.contigs is None else np.array([n in self.contigs for n in contigs] + [False])
            for data, at, virtual in records(window, partition.begin, partition.end):
                if asked is not None:
                    some = asked[np.clip(numbers(data, at + 4, "<i4"), -1, len(contigs))]
                    at, virtual = at[some], virtual[some]
                yield from batches(data, at, contigs, self.names, row_no=pa.array(virtual), path=pa.repeat(partition.path, len(at)))


# ---------------------------------------------------------------- writing


class BamWriter(parts.PartWriter):
    """Each task writes one sorted file and its index."""

    def __init__(self, options, overwrite: bool):
        super().__init__(options["path"], overwrite)
        self.contigs: list[tuple[str, int]] = [(n, k) for n, k in json.loads(options["contigs"])]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> parts.Written:
        index = Index([{} for _ in self.contigs], [[] for _ in self.contigs])
        name, out, last, run = "", None, (-1, -1), (-1, -1)
        for batch in (some for whole in iterator for some in portions(whole)):
            if out is None:
                name = self.part(".bam")
                stream = self.opened(name)
                out = bgzf.Writer(stream)
                text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in self.contigs)
                out.write(b"BAM\x01" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(self.contigs)) + b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\x00" + struct.pack("<i", k) for n, k in self.contigs))
                out.flush()
            data, sizes, ref, start, end = encoded(batch, [n for n, _ in self.contigs])
            after = np.append(last[0], ref[:-1]), np.append(last[1], start[:-1])
            if ((ref < after[0]) | ((ref == after[0]) & (start < after[1]))).any():
                raise ValueError("alignments are not in order of contig and place")
            last = int(ref[-1]), int(start[-1])
            run = self.listed(index, run, out.records(data.tobytes(), sizes), ref, start, end)
        if out is None:
            return parts.Written([])
        out.close()
        stream.close()
        with self.opened(f"{name}.bai") as stream:
            stream.write(write_index(index))
        # The index first: a file that shows has one.
        return parts.Written([f"{name}.bai", name])


    def listed(self, index: Index, run: tuple[int, int], offsets: tuple[np.ndarray, np.ndarray], ref: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[int, int]:
        """Enters records that lie between these virtual offsets; run: contig and bin of the record before them, then of the last one."""
        begins, ends = offsets
        bins = bin_of(start, end)
        fresh = np.append(True, (ref[1:] != ref[:-1]) | (bins[1:] != bins[:-1]))
        at = np.flatnonzero(fresh)
        for b, e in zip(at.tolist(), [*(at[1:] - 1).tolist(), len(ref) - 1], strict=True):
            if ref[b] == len(self.contigs):
                continue
            ranges = index.bins[ref[b]].setdefault(int(bins[b]), [])
            if b == 0 and run == (ref[0], bins[0]):  # goes on from the batch before
                ranges[-1] = (ranges[-1][0], int(ends[e]))
            else:
                ranges.append((int(begins[b]), int(ends[e])))
        # Of each contig, the records that reach into a window none has reached before.
        for contig in np.unique(ref[ref < len(self.contigs)]).tolist():
            of, linear = np.flatnonzero(ref == contig), index.linear[contig]
            reached = np.maximum.accumulate(np.append(len(linear), (end[of] - 1 >> 14) + 1))
            for k in np.flatnonzero(reached[1:] > reached[:-1]).tolist():
                linear += [int(begins[of[k]])] * int(reached[k + 1] - len(linear))
        return int(ref[-1]), int(bins[-1])


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> BamReader:
        return BamReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> BamWriter:
        return BamWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format bam known to a session. Conditions reach Python sources only where this option is set."""
    workers_import(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)


def read_bam(spark: SparkSession, path: str | Sequence[str], *, columns: Sequence[str] | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Alignments of BAM files, or of folders of them; of the columns named alone, if some are.

    row_no is the place within a file: take a sample's reads from one file where their order counts.
    Filter by ref_id, and by reference_start < b and reference_end > a for a range, and only the parts
    of indexed files that may hold such records are opened.
    """
    register(spark)
    schema = SCHEMA if columns is None else T.StructType([SCHEMA[c] for c in columns])
    return spark.read.format("bam").schema(schema).option("splitBytes", split_bytes).load(path if isinstance(path, str) else ",".join(path))


def write_bam(alignments: DataFrame, path: str, contigs: Sequence[tuple[str, int]], *, mode: str = "append") -> None:
    """A folder of sorted, indexed BAM files of alignments (columns as they are read; flags that lack are off) on contigs (name, length).

    Rows are dealt by ranges of contig and place, so that each file holds a stretch of the genome; what no record holds stays behind.
    Alignments on no contig of the list come last.
    """
    register(alignments.sparkSession)
    place = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, (n, _) in enumerate(contigs) for x in (n, k)]), F.coalesce("ref_id", F.lit(""))), F.lit(len(contigs))) if contigs else F.lit(0)
    keys = ["_place", "reference_start", "query_name"]
    some = [c for c in WRITTEN if c in alignments.columns]
    travel = (slim(alignments) if "aligned_pairs" in some else alignments).select(*[x for c in some for x in (SLIM if c == "aligned_pairs" else (c,))])
    ordered = travel.withColumn("_place", place).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place")
    ordered.write.format("bam").mode(mode).option("contigs", json.dumps([list(c) for c in contigs])).save(path)

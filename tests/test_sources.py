"""Formats that tasks decode themselves: against plain readers, at every cut, and what is opened of a file."""

import gzip
import hashlib
import json
import os
import random
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThan

from helixframe.operators import chunks, coverage, pangenome, pileup, ranks, snv, workflows
from helixframe.sources import bam, bam_records, bgzf, fastq, head, lz4, parts, readers, scratch, writers

# ---------------------------------------------------------------- BAM


CONTIGS = [("k0", 400_000), ("k1", 900_000), ("k2", 50)]


def alignments(n, seed=1):
    """Sorted rows of alignments with clips, insertions, deletions and differences."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        c = rng.randrange(2)
        start = rng.randrange(CONTIGS[c][1] - 40)
        pairs, sequence, reference, q, r = [], "", "", 0, start
        for length, op in ((rng.randrange(3), "S"), (8, "M"), (rng.randrange(3), "I"), (5, "M"), (rng.randrange(3), "D"), (6, "M"), (rng.randrange(3), "S")):
            for _ in range(length):
                base = rng.choice("ACGT")
                pairs.append({"qpos": None if op == "D" else q, "rpos": r if op in "MD" else None})
                sequence += base if op != "D" else ""
                reference += rng.choice("ACGT") if op == "M" and rng.random() < 0.2 else base if op in "MD" else ""
                q, r = q + (op != "D"), r + (op in "MD")
        first = next(k for k, p in enumerate(pairs) if p["rpos"] is not None)
        last = next(k for k, p in enumerate(reversed(pairs)) if p["rpos"] is not None)
        rows.append(
            {
                "query_name": f"q{i}", "ref_id": CONTIGS[c][0], "is_paired": True, "is_proper_pair": i % 3 > 0, "is_unmapped": False, "is_reverse": i % 2 == 1, "is_read1": i % 2 == 0, "is_read2": i % 2 == 1,
                "is_secondary": i % 7 == 0, "is_qcfail": i % 11 == 0, "is_duplicate": i % 13 == 0, "is_supplementary": False, "mapping_quality": i % 60, "template_length": i - 100, "reference_start": start,
                "reference_end": r, "query_length": len(sequence), "query_alignment_start": first, "query_alignment_end": len(sequence) - last, "query_sequence": sequence,
                "query_qualities": [rng.randrange(41) for _ in sequence] if i % 5 else None, "nm": 3 if i % 4 else None, "aligned_pairs": pairs, "reference_sequence": reference,
            }
        )
    return sorted(rows, key=lambda x: (x["ref_id"], x["reference_start"]))


@pytest.fixture(scope="module")
def bam_file(tmp_path_factory):
    """A folder with one BAM file and its index, and its rows."""
    path, rows = str(tmp_path_factory.mktemp("bam")), alignments(20_000)
    writer = bam.BamWriter({"path": path, "contigs": json.dumps([list(c) for c in CONTIGS])}, False)
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist(rows[:7000]), pa.RecordBatch.from_pylist(rows[7000:])]))])
    assert sorted(e.rsplit(".", 1)[1] for e in os.listdir(path)) == ["bai", "bam"]
    return path, rows


def read_bam(path, filters=(), split=bam.SPLIT_BYTES, monkeypatch=None):
    reader, opened = bam.BamReader({"path": path, "splitBytes": split}, bam.SCHEMA), []
    assert list(reader.pushFilters(list(filters))) == list(filters)  # Spark checks all of them again
    pieces = reader.partitions()
    if monkeypatch:
        whole = bgzf.inflated
        monkeypatch.setattr(bgzf, "inflated", lambda *a: opened.append(1) or whole(*a))
    rows = [r for p in pieces for batch in reader.read(p) for r in batch.to_pylist()]
    if monkeypatch:
        monkeypatch.undo()
    return pieces, rows, len(opened)


@pytest.mark.parametrize("split", [1 << 14, 1 << 17, 1 << 26])
def test_bam_comes_back_whole(bam_file, split):
    path, rows = bam_file
    pieces, found, _ = read_bam(path, split=split)
    assert (len(pieces) > 1) == (split < 1 << 20)
    assert [{k: f[k] for k in rows[0]} for f in found] == rows
    assert [f["row_no"] for f in found] == sorted({f["row_no"] for f in found})


def test_bam_opens_only_blocks_that_may_hold_what_is_asked(bam_file, monkeypatch):
    path, rows = bam_file
    _, _, every = read_bam(path, monkeypatch=monkeypatch)
    _, found, some = read_bam(path, [EqualTo(("ref_id",), "k0")], monkeypatch=monkeypatch)
    assert [f["query_name"] for f in found] == [r["query_name"] for r in rows if r["ref_id"] == "k0"]
    assert some <= every * 0.55
    wanted = [r["query_name"] for r in rows if r["ref_id"] == "k1" and r["reference_start"] < 150_000 and r["reference_end"] > 149_000]
    _, found, few = read_bam(path, [In(("ref_id",), ("k1", "other")), LessThan(("reference_start",), 150_000), GreaterThan(("reference_end",), 149_000)], monkeypatch=monkeypatch)
    assert set(wanted) <= {f["query_name"] for f in found}
    assert wanted and few < every * 0.2
    assert read_bam(path, [EqualTo(("ref_id",), "k2")])[1] == []


def test_bam_through_spark(spark, bam_file, tmp_path):
    path, rows = bam_file
    everything = bam.read_bam(spark, path, split_bytes=1 << 14)
    assert everything.rdd.getNumPartitions() > 5
    assert sorted((r.query_name, r.reference_end, r.nm) for r in everything.select("query_name", "reference_end", "nm").collect()) == sorted((r["query_name"], r["reference_end"], r["nm"]) for r in rows)
    names = bam.read_bam(spark, path, columns=["query_name", "ref_id"]).filter("ref_id = 'k0'")
    assert "PushedFilters" in names._jdf.queryExecution().toString() or names.count() == sum(r["ref_id"] == "k0" for r in rows)
    # Written again by several tasks, and without an index.
    again = str(tmp_path / "again")
    bam.write_bam(everything.repartition(3), again, CONTIGS)
    files = parts.listed([again], ".bam")
    found = bam.read_bam(spark, again)
    assert len(files) > 1
    assert found.drop("path", "row_no").exceptAll(everything.drop("path", "row_no")).isEmpty()
    assert found.count() == len(rows)
    for f in files:
        os.remove(f + ".bai")
    assert bam.read_bam(spark, again).filter("ref_id = 'k0'").count() == sum(r["ref_id"] == "k0" for r in rows)


def test_bam_of_no_rows_and_damaged_files(spark, tmp_path):
    bam.write_bam(spark.createDataFrame([], bam.SCHEMA), str(tmp_path / "none"), CONTIGS)
    assert bam.read_bam(spark, str(tmp_path / "none")).collect() == []
    writer = bam.BamWriter({"path": str(tmp_path / "x"), "contigs": json.dumps([list(c) for c in CONTIGS])}, False)
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist(alignments(300))]))])
    (name,) = parts.listed([str(tmp_path / "x")], ".bam")
    data = bytearray(open(name, "rb").read())
    for damaged in (data[: len(data) // 2], data[:200] + bytes([data[200] ^ 255]) + data[201:], b"junk" * 100):
        open(name, "wb").write(damaged)
        with pytest.raises(Exception, match="BGZF|BAM|decompress"):
            read_bam(str(tmp_path / "x"))
    with pytest.raises(ValueError, match="order"):
        writer.write(iter([pa.RecordBatch.from_pylist(alignments(20)[::-1])]))


def test_bam_records_are_made_and_read_many_at_once(bam_file, tmp_path, monkeypatch):
    path, rows = bam_file
    calls, kept = [], bam.encoded
    monkeypatch.setattr(bam, "encoded", lambda batch, contigs: calls.append(1) or kept(batch, contigs))
    writer = bam.BamWriter({"path": str(tmp_path / "x"), "contigs": json.dumps([list(c) for c in CONTIGS])}, False)
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist(rows[k : k + 5000]) for k in range(0, 20_000, 5000)]))])
    assert len(calls) <= 8
    # Neither the file nor its index depends on how rows came to the writer.
    content = lambda folder, ending: [open(f, "rb").read() for f in parts.listed([folder], ending)]
    assert content(str(tmp_path / "x"), ".bam") == content(path, ".bam") and content(str(tmp_path / "x"), ".bai") == content(path, ".bai")
    reader = bam.BamReader({"path": path}, bam.SCHEMA)
    batches = [b.num_rows for p in reader.partitions() for b in reader.read(p)]
    assert sum(batches) == 20_000 and len(batches) <= 10


def made_record(name, cigar, flag, sequence, tags):
    codes = [bam_records.BASES.index(b) for b in sequence + "=" * (len(sequence) % 2)]
    operations = b"".join(struct.pack("<I", n << 4 | bam_records.OPERATIONS.index(op)) for n, op in cigar)
    body = struct.pack("<iiBBHHHiiii", 0, 100, len(name) + 1, 9, 0, len(cigar), flag, len(sequence), -1, -1, 0) + name.encode() + b"\0" + operations + bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True)) + b"\x1e" * len(sequence) + tags
    return struct.pack("<i", len(body)) + body


@pytest.mark.parametrize("columns", [1 << 20, 5])
def test_bam_records_of_others(tmp_path, monkeypatch, columns):
    """Operations and tags that the writer here never makes, also where one record alone has more columns than a batch should."""
    monkeypatch.setattr(bam_records, "COLUMNS", columns)
    real = [(1, "S"), (2, "M"), (3, "N"), (1, "X")]
    long = b"CGBI" + struct.pack("<5I", 4, *[n << 4 | bam_records.OPERATIONS.index(op) for n, op in real])
    records = [
        made_record("hard", [(4, "H"), (2, "S"), (3, "M"), (1, "I"), (2, "D"), (2, "="), (5, "H")], 0, "ACGTANCC", b"XZZtext\0XBBs" + struct.pack("<ihh", 2, 1, 0) + b"MDZ1a1^GT2\0NMC\xfa"),
        made_record("none", [], 4, "AC", b"NMs\xff\xff"),
        made_record("long", [(4, "S"), (6, "N")], 16, "ACGT", b"XAAq" + long + b"MDZ2T\0"),
        made_record("bare", [(3, "M")], 0, "", b"MDZ3\0"),
    ]
    with open(tmp_path / "x.bam", "wb") as file:
        out = bgzf.Writer(file)
        out.write(b"BAM\x01" + struct.pack("<iii", 0, 1, 2) + b"k\0" + struct.pack("<i", 1000) + b"".join(records))
        out.close()
    hard, none, bare_long, bare = read_bam(str(tmp_path / "x.bam"))[1]
    assert (hard["reference_end"], hard["query_alignment_start"], hard["query_alignment_end"], hard["nm"], hard["reference_sequence"]) == (107, 2, 8, 250, "GAAGTCC")
    assert [(p["qpos"], p["rpos"]) for p in hard["aligned_pairs"]] == [(0, None), (1, None), (2, 100), (3, 101), (4, 102), (5, None), (None, 103), (None, 104), (6, 105), (7, 106)]
    assert (none["aligned_pairs"], none["reference_end"], none["nm"], none["query_alignment_end"]) == (None, None, -1, 2)
    assert (bare_long["reference_end"], bare_long["query_alignment_start"], bare_long["reference_sequence"], bare_long["is_reverse"]) == (106, 1, "CGNNNT", True)
    assert [(p["qpos"], p["rpos"]) for p in bare_long["aligned_pairs"]] == [(0, None), (1, 100), (2, 101), (None, 102), (None, 103), (None, 104), (3, 105)]
    assert (bare["query_sequence"], bare["query_qualities"], bare["reference_sequence"], bare["reference_end"]) == (None, None, "", 103)
    with pytest.raises(ValueError, match="damaged record"):
        list(bam_records.batches(np.frombuffer(records[0][:10] + b"\xff" * 60, np.uint8), np.array([0]), ["k"], ["nm"]))


def test_bam_records_refuse_what_does_not_fit():
    row = next(r for r in alignments(5) if r["query_qualities"])
    made = lambda **changed: bam_records.encoded(pa.RecordBatch.from_pylist([row | changed], pa.RecordBatch.from_pylist([row]).schema), ["k0"])
    assert made()[1][0] > 36
    for changed, said in (({"query_name": "q" * 255}, "query_name"), ({"mapping_quality": 256}, "mapping_quality"), ({"mapping_quality": None}, "mapping_quality"), ({"query_qualities": [1]}, "query_qualities"), ({"reference_sequence": "A"}, "beyond")):
        with pytest.raises(ValueError, match=said):
            made(**changed)


def test_bins_hold_what_overlaps():
    rng = random.Random(2)
    for _ in range(2000):
        a, b = sorted(rng.sample(range(1 << 29), 2))
        c = rng.randrange(1 << 29)
        d = min(c + rng.randrange(1, 1 << 16), 1 << 29)
        if a < d and c < b:
            assert bam.bin_of(c, d) in bam.bins_of(a, b)


# ---------------------------------------------------------------- LZ4


def lz4_lines(path, size):
    """Lines of a file as its splits give them, and how many splits there are."""
    rows, out = [], []
    with open(path, "rb") as f:
        file = pa.PythonFile(f, "r")
        for at, length, frame in lz4.units(parts.Window(file, 64), 0):
            if not rows or at - rows[-1][0] >= size:
                rows.append([at, at, frame, not rows])
            rows[-1][1] = at + length
        for begin, end, frame, first in rows:
            for some in lz4.split_lines(parts.Window(file), begin, end, frame if frame[0] >> 5 & 1 else b"", first):
                out += some
    return out, len(rows)


@pytest.mark.parametrize("seed", range(25))
def test_lz4_lines_at_every_cut(tmp_path, seed):
    rng = random.Random(seed)
    lines = [bytes(rng.choice(b"abc\t ") for _ in range(rng.choice((0, 1, 5, 30, 300)))) for _ in range(rng.randrange(1, 80))]
    writer = lz4.Lz4Writer(str(tmp_path), False, rng.choice((16, 64, 1000, 65536)), None)
    message = writer.write(iter([pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["value"])]))
    writer.commit([message])
    path, text = str(tmp_path / message.names[0]), b"".join(x + b"\n" for x in lines)
    raw = open(path, "rb").read()
    assert pa.CompressedInputStream(pa.BufferReader(raw), "lz4").read() == text  # another reader agrees
    for size in (1, 50, 10**6):
        assert lz4_lines(path, size)[0] == lines
    # Several frames, one of linked blocks, one to be skipped, and a last line without a line feed.
    out = pa.BufferOutputStream()
    with pa.CompressedOutputStream(out, "lz4") as stream:
        stream.write((text + b"tail") * 3)
    open(path, "wb").write(raw + b"\x50\x2a\x4d\x18\x03\0\0\0abc" + raw + out.getvalue().to_pybytes())
    for size in (1, 200, 10**6):
        assert lz4_lines(path, size)[0] == (text * 2 + (text + b"tail") * 3).split(b"\n")


def test_lz4_tables_through_spark(spark, tmp_path):
    rows = spark.range(0, 20_000).select(F.col("id"), (F.col("id") / 7).alias("x"), F.concat(F.lit('say "'), F.col("id"), F.lit("\tit")).alias("s"))
    path = str(tmp_path / "t.lz4")
    lz4.write_lz4(writers.formatted(rows).coalesce(1).select(F.to_csv(F.struct("id", "x", "s"), {"sep": "\t"}).alias("v")), path, head="id\tx\ts", block_bytes=1 << 14)
    files = parts.listed([path], ".lz4")
    assert len(files) == 1
    assert lz4.splits(spark, files, 1 << 15).count() > 3
    assert lz4.read_lz4(spark, path, split_bytes=1 << 15).count() == 20_001
    found = readers.tsv(spark, path, "id long, x string, s string")
    assert found.exceptAll(writers.formatted(rows).select(F.col("id").cast("long"), "x", "s")).isEmpty() and found.count() == 20_000
    with pytest.raises(Exception, match="header differs"):
        readers.tsv(spark, path, "id long, y string, s string").collect()
    with pytest.raises(FileExistsError):
        writers.write_tsv(rows, path, compression="lz4")
    writers.write_tsv(rows.limit(0), str(tmp_path / "none.lz4"), compression="lz4")
    assert readers.tsv(spark, str(tmp_path / "none.lz4"), "id long, x string, s string").collect() == []


def test_damaged_lz4(tmp_path):
    writer = lz4.Lz4Writer(str(tmp_path), False, 1000, None)
    (name,) = writer.write(iter([pa.RecordBatch.from_arrays([pa.array([b"line"] * 5000, pa.binary())], ["value"])])).names
    data = open(tmp_path / f"_{name}", "rb").read()
    for damaged in (data[:-6], b"junk" + data, data[:5] + b"\x00" + data[6:]):
        open(tmp_path / "x", "wb").write(damaged)
        with pytest.raises(ValueError, match="LZ4"):
            lz4_lines(str(tmp_path / "x"), 100)


# ---------------------------------------------------------------- FASTQ over several lines


def in_order(lines):
    """Records as a parser finds them that sees one line after the other."""
    name, seq, qual, in_qual, out = None, [], [], False, []
    for line in lines:
        if name is None:
            name = line[1:].split()[0] if line.startswith("@") and line[1:].split() else None
        elif in_qual:
            qual.append(line)
        elif line.startswith("+"):
            in_qual = True
        else:
            seq.append(line)
        if in_qual and sum(map(len, qual)) >= sum(map(len, seq)) and (qual or not any(seq)):
            out.append((name, "".join(seq), "".join(qual)))
            name, seq, qual, in_qual = None, [], [], False
    return out


def wrapped_records(rng, n):
    def wrap(x):
        out = []
        while x or rng.random() < 0.15:
            k = rng.randrange(0, 4)
            out.append(x[:k])
            x = x[k:]
        return out

    lines = []
    for r in range(n):
        k = rng.choice((0, 1, 2, 5, 9))
        lines += [f"@r{r} d", *wrap("".join(rng.choice("ACGT") for _ in range(k))), "+", *wrap("".join(rng.choice("@+I#") for _ in range(k)))]
        if rng.random() < 0.2:
            lines.append(rng.choice(["", "@", "junk", "+x", "@ "]))
    return lines[: rng.randrange(len(lines) + 1)] if lines and rng.random() < 0.3 else lines


def test_states_at_cuts_are_those_of_a_parser_in_order():
    rng = random.Random(4)
    for _ in range(400):
        lines = wrapped_records(rng, rng.randrange(0, 7))
        cuts = sorted(rng.sample(range(len(lines) + 1), min(len(lines) + 1, rng.randrange(0, 5))))
        pieces = [p for p in (lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)], strict=True)) if p]
        rows = [{"path": "f", "split": 10 * k, **fastq.followed(np.array([len(x) for x in p]), np.array([x.startswith("@") and bool(x[1:].split()) for x in p]), np.array([x.startswith("+") for x in p]))} for k, p in enumerate(pieces)]
        states = fastq.composed(pd.DataFrame(rows)) if rows else None
        done = []
        for k, _ in enumerate(pieces):
            name, seq, need = None, 0, None  # the state of a parser in order
            for line in done:
                if name is None:
                    name, seq, need = (1, 0, None) if line.startswith("@") and line[1:].split() else (None, 0, None)
                elif need is not None:
                    need -= len(line)
                elif line.startswith("+"):
                    need = seq
                else:
                    seq += len(line)
                if need is not None and need <= 0:
                    name, need = None, None
            want = (0, 0) if name is None else (1, seq) if need is None else (2, need)
            assert (states.state[k], states["count"][k] if want[0] else 0) == want
            done += pieces[k]


def test_fastq_over_several_lines_in_several_tasks(spark, tmp_path):
    rng, old = random.Random(9), spark.conf.get("spark.sql.files.maxPartitionBytes")
    names = {}
    for k in range(3):
        lines = [x.replace("@r", f"@f{k}r", 1) for x in wrapped_records(rng, 400)]
        (tmp_path / f"x{k}.fastq").write_text("".join(f"{x}\n" for x in lines))
        names[k] = in_order(lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = readers.fastx(spark, str(tmp_path / "*.fastq"), multiline=True)
        assert spark.read.text(str(tmp_path / "*.fastq")).rdd.getNumPartitions() > 6
        assert sorted((r.id, r.seq, r.qual) for r in found.collect()) == sorted(r for rows in names.values() for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# ---------------------------------------------------------------- heads, digests, scratch


@pytest.mark.parametrize("n", [0, 1, 7, 100, 10_000])
def test_first_lines(spark, tmp_path, n):
    rng = random.Random(n)
    for k in range(2):
        (tmp_path / f"f{k}").write_text("".join("x" * rng.randrange(40) + f"{k}\n" for _ in range(500)) + "end")
    with gzip.open(tmp_path / "g.gz", "wt") as f:
        f.write("".join(f"line {i}\n" for i in range(500)))
    want = {(str(p), i, x) for p in tmp_path.iterdir() for i, x in enumerate((gzip.open(p, "rt") if p.suffix else open(p)).read().removesuffix("\n").split("\n")[:n])}
    got = [(r.path, r.line_no, r.value) for r in head.head_lines(spark, str(tmp_path), n, split_bytes=700).collect()]
    assert set(got) == want
    assert len(got) == len(want)


def test_head_opens_no_more_than_it_needs(spark, tmp_path):
    """What lies behind the splits that hold the wanted lines could not even be decoded."""
    (tmp_path / "x.fastq").write_bytes(b"".join(b"@r%d\nACGT\n+\nIIII\n" % i for i in range(100)) + b"\xff\xfe" * 100_000)
    found = readers.fastx(spark, str(tmp_path / "x.fastq"), max_reads=20)
    assert sorted(r.id for r in found.collect()) == sorted(f"r{i}" for i in range(20))


def test_digests_against_a_catalogue(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "DIGEST_BYTES", 1000)
    for name, size in (("a", 0), ("b", 999), ("c", 100_001)):
        (tmp_path / name).write_bytes(bytes(range(256)) * (size // 256) + b"x" * (size % 256))
    md5 = lambda name: hashlib.md5((tmp_path / name).read_bytes()).hexdigest()
    says = [(str(tmp_path / "a"), md5("a")), (f"{tmp_path.name}/b", "wrong"), (f"{tmp_path.name}/d", "gone")]
    found = readers.checked_digests(spark, spark.createDataFrame(says, "path string, md5sum string"), str(tmp_path)).collect()
    assert {(r.path.rsplit("/", 1)[1], r.expected, r.found, r.equal) for r in found} == {("a", md5("a"), md5("a"), True), ("b", "wrong", md5("b"), False), ("c", None, md5("c"), False), ("d", "gone", None, False)}


def test_scratch_files_go(spark):
    rows = scratch.kept(spark.range(5))
    path = scratch._used[-1]
    assert rows.count() == 5
    writers.write_tsv(rows, scratch.scratch(spark) + ".lz4", compression="lz4")
    assert scratch.clear_scratch(spark) >= 2
    assert not os.path.exists(path)


# ---------------------------------------------------------------- plans of chunks


def packed_plainly(lengths, size):
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    chunk, low, high, number = {}, len(order) - 1, 0, 0
    while high <= low:
        room = size - lengths[order[high]]
        chunk[order[high]] = number
        high += 1
        while low >= high and lengths[order[low]] <= room:
            room -= lengths[order[low]]
            chunk[order[low]] = number
            low -= 1
        number += 1
    return chunk


def test_packing_by_histogram_equals_packing_piece_by_piece(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for s in range(40):
        size = rng.choice((3, 60, 900))
        lengths = [rng.choice((size, rng.randrange(1, 1000))) for _ in range(rng.randrange(0, 700 if s < 3 else 40))]
        want |= {(f"s{s}", f"{i:04d}"): c for i, c in packed_plainly(lengths, 1000).items()}
        rows += [(f"s{s}", f"{i:04d}", n) for i, n in enumerate(lengths)]
    found = chunks.pack_contigs(spark.createDataFrame(rows, "species_id string, contig_id string, length long"), chunk_size=1000).collect()
    assert {(r.species_id, r.contig_id): r.chunk_id for r in found} == want
    assert len(found) == len(want)


def test_ranks_of_large_and_null_groups(spark):
    rows = [(None if k % 3 == 0 else k % 2, k // 2) for k in range(900)] + [(7, 1)]
    found = ranks.ranked(spark.createDataFrame(rows, "g int, x int").repartition(5), ["g"], ["x"]).collect()
    by = {}
    for r in found:
        by.setdefault(r.g, []).append((r["rank"], r.x, r.rank_of))
    for g, values in by.items():
        assert [v[0] for v in sorted(values)] == list(range(len(values)))
        assert [v[1] for v in sorted(values)] == sorted(v[1] for v in values)
        assert {v[2] for v in values} == {sum(r[0] == g for r in rows)}


# ---------------------------------------------------------------- sites in blocks, merging, checks


def test_counts_in_blocks_equal_counts_of_bases(spark, bam_file):
    path, rows = bam_file
    reads = bam.read_bam(spark, path).filter("ref_id = 'k0' AND reference_start < 60000").withColumns({"sample_name": F.when(F.col("mapping_quality") % 2 == 0, "a").otherwise("b"), "species_id": F.lit("s")})
    want = pileup.pileup(pileup.explode_alignments(reads), base_quality=20).filter("depth > 0")
    got = coverage.counted_sites(reads, base_quality=20)
    columns = ["sample_name", "species_id", "ref_id", "ref_pos", "count_a", "count_c", "count_g", "count_t", "depth"]
    text = lambda df: df.select(*[F.col(c).cast("string") for c in columns])
    assert got.count() == want.count() > 1000
    assert text(got).exceptAll(text(want)).isEmpty()
    assert coverage.counted_sites(reads.limit(0), base_quality=20).collect() == []


def test_rows_before_the_shuffle_do_not_grow_with_depth(spark, bam_file, monkeypatch):
    path, _ = bam_file
    reads = bam.read_bam(spark, path).filter("ref_id = 'k0' AND reference_start < 60000").withColumns({"sample_name": F.lit("a"), "species_id": F.lit("s")}).coalesce(1)
    deep = reads.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("k")
    assert coverage.blocks_of(deep, base_quality=20).count() == coverage.blocks_of(reads, base_quality=20).count()
    monkeypatch.setattr(coverage, "HELD", 3)
    assert coverage.counted_sites(deep, base_quality=20).agg(F.sum("depth")).first()[0] == 20 * coverage.counted_sites(reads, base_quality=20).agg(F.sum("depth")).first()[0]


def shuffles(df):
    """What the plan of df before it runs deals rows out by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]


def test_merging_bucketed_sites_shuffles_none(spark, tmp_path):
    sites = spark.range(4000).select(
        F.concat(F.lit("s"), F.col("id") % 4).alias("sample_name"), F.lit("sp").alias("species_id"), F.concat(F.lit("c"), F.col("id") % 3).alias("ref_id"), F.floor(F.col("id") / 12).alias("ref_pos"), F.lit("A").alias("ref_allele"),
        (F.col("id") % 9 + 5).alias("count_a"), (F.col("id") % 7).alias("count_c"), F.lit(0).cast("long").alias("count_g"), F.lit(0).cast("long").alias("count_t"), (F.col("id") % 9 + 5 + F.col("id") % 7).alias("depth"),
    )
    samples = spark.createDataFrame([(f"s{k}", "sp", 12.0, 4) for k in range(4)], "sample_name string, species_id string, mean_depth double, samples_count long")
    writers.write_sites(sites, "bucketed_sites", str(tmp_path / "sites"), buckets=4)
    try:
        freq = {}
        for name, rows in (("plain", sites), ("bucketed", spark.table("bucketed_sites"))):
            good = snv.site_filter(snv.noise_floor(rows), F.broadcast(samples), site_depth=3)
            called = snv.population(snv.pooled(good, keep_samples=True), snp_types=("any",))
            freq[name] = snv.frequencies(called, samples)
            assert any("ref_pos" in x for x in shuffles(called)) == (name == "plain")
            assert any("ref_pos" in x for x in shuffles(freq[name])) == (name == "plain")
        assert freq["plain"].count() == freq["bucketed"].count() > 1000
        assert freq["plain"].exceptAll(freq["bucketed"]).isEmpty()
    finally:
        spark.sql("DROP TABLE bucketed_sites")


def test_five_thousand_samples_are_one_array(spark, tmp_path):
    numbers = spark.range(5000).select(F.concat(F.lit("s"), "id").alias("sample_name"), F.col("id").alias("number"))
    long = spark.range(0, 5000, 7).select((F.col("id") % 3).alias("site"), F.concat(F.lit("s"), "id").alias("sample_name"), (F.col("id") / 1000).alias("freq"))
    rows = snv.sample_arrays(long, ["site"], "freq", numbers, -1.0)
    assert rows.columns == ["site", "values"]
    writers.write_matrix(rows, str(tmp_path / "m"), numbers)
    lines = [x.split("\t") for f in sorted((tmp_path / "m").glob("part-*")) for x in f.read_text().splitlines()]
    heads, body = [x for x in lines if x[0] == "site"], {x[0]: x[1:] for x in lines if x[0] != "site"}
    assert all(h == ["site", *[f"s{k}" for k in range(5000)]] for h in heads) and heads
    for site in range(3):
        assert body[str(site)] == [f"{k / 1000:.3f}" if k % 7 == 0 and k % 3 == site else "-1.000" for k in range(5000)]


def test_checks_within_the_plan(spark):
    one, two = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int"), spark.createDataFrame([("a", 3), ("b", 4)], "k string, y int")
    assert sorted(tuple(r) for r in pangenome.joined_one_to_one(one, two, "k").collect()) == [("a", 1, 3), ("b", 2, 4)]
    for left, right in ((one, two.filter("k = 'a'")), (one.filter("k = 'a'"), two), (one.union(one), two), (one, two.union(two))):
        lazy = pangenome.joined_one_to_one(left, right, "k")  # no job yet, so no error
        with pytest.raises(Exception, match="tables differ in k"):
            lazy.count()
    members = lambda *rows: spark.createDataFrame(rows, "gene_id string, centroid_id string")
    assert pangenome.checked_centroids(members(("a", "a"), ("b", "a"))).count() == 2
    for rows, said in (((("b", "a"), ("a", "c"), ("c", "c")), "centroid is not its own"), ((("b", "a"),), "centroid is not its own"), ((("a", "a"), ("b", "a"), ("b", "a")), "gene occurs twice")):
        with pytest.raises(Exception, match=said):
            pangenome.checked_centroids(members(*rows)).count()
    toc = spark.createDataFrame([("G", "sp")], "genome string, species string")
    genes = spark.createDataFrame([("G", "g1", 3, "B1", "acg"), ("G", "g1", 3, "B2", "acg")], "genome_id string, gene_id string, gene_length int, marker_id string, marker_gene string")
    assert workflows.build_markerdb(genes, toc, markers=["B2"])["sequences"].first().sequence == "ACG"
    with pytest.raises(Exception, match="gene_id occurs twice"):
        workflows.build_markerdb(genes, toc)["map"].count()


def test_annotation_files_of_other_columns(spark, tmp_path):
    for k, names in enumerate((["query", "EC"], ["query", "EC"], ["query", "other"])):
        (tmp_path / f"f{k}").write_text("## c\n#" + "\t".join(names) + f"\ng{k}\t1\n")
    assert sorted(r.query for r in readers.orthologs(spark, [str(tmp_path / "f0"), str(tmp_path / "f1")]).collect()) == ["g0", "g1"]
    with pytest.raises(Exception, match="differ in their columns"):
        readers.orthologs(spark, str(tmp_path)).collect()


def test_profiles_read_few_files(spark):
    from helixframe.plans import queries as catalog

    for name in ("species_profile", "run_species"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
        assert 0 < plan.count("FileScan") <= 6, name

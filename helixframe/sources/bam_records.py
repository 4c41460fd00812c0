"""Records of BAM files to and from Arrow, a batch at a time.

All records of a batch are worked on at once: what varies in length (operations, bases, tags, columns of
alignments) lies end to end in one array beside the number of items of each record.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

from ..functions.alignments import SLIM

# Bits of the flag, codes of bases and operations, sizes and types of tag values.
FLAGS = {"is_paired": 1, "is_proper_pair": 2, "is_unmapped": 4, "is_reverse": 16, "is_read1": 64, "is_read2": 128, "is_secondary": 256, "is_qcfail": 512, "is_duplicate": 1024, "is_supplementary": 2048}
BASES, OPERATIONS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
TAG_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
TAG_TYPES = {"c": "i1", "C": "u1", "s": "<i2", "S": "<u2", "i": "<i4", "I": "<u4"}


def _schema() -> T.StructType:
    text = {"path", "query_name", "ref_id", "query_sequence", "reference_sequence"}
    kinds: dict[str, T.DataType] = {"row_no": T.LongType(), "query_qualities": T.ArrayType(T.IntegerType()), "aligned_pairs": T.ArrayType(T.StructType([T.StructField("qpos", T.IntegerType()), T.StructField("rpos", T.IntegerType())]))}
    names = [
        "path", "row_no", "query_name", "ref_id", *FLAGS, "mapping_quality", "template_length", "reference_start", "reference_end", "query_length", "query_alignment_start",
        "query_alignment_end", "query_sequence", "query_qualities", "nm", "aligned_pairs", "reference_sequence",
    ]
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType() if n in text else T.BooleanType() if n in FLAGS else T.IntegerType())) for n in names])


#: The columns of an alignment. row_no is its place in the file.
SCHEMA = _schema()

#: The most columns of alignments that a batch lays out, unless one record has more.
COLUMNS = 1 << 20
HEAD = np.dtype([("ref", "<i4"), ("start", "<i4"), ("l_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_cigar", "<u2"), ("flag", "<u2"), ("l_seq", "<i4"), ("next_ref", "<i4"), ("next_start", "<i4"), ("tlen", "<i4")])
_SIZED = np.dtype([("size", "<i4"), *[(n, HEAD[n]) for n in HEAD.names]])
_LETTERS = np.frombuffer(BASES.encode(), np.uint8)
_UPPER = np.frombuffer(bytes(range(256)).upper(), np.uint8)
_CODES = np.full(256, 15, np.uint8)
_CODES[_LETTERS] = np.arange(16)
_CODES = _CODES[_UPPER]
_IN_QUERY, _IN_REF = (np.array([op in some for op in OPERATIONS]) for some in ("M=XIS", "M=XDN"))
_SKIP, _CLIP, _HARD = (OPERATIONS.index(op) for op in "NSH")
_SIZES = np.zeros(256, np.int64)
_SIZES[[ord(k) for k in TAG_SIZES]] = list(TAG_SIZES.values())
_CARET = ord("^")
#: Levels of bins, from the coarsest: bits of a place below a bin's number, and the number of the first bin.
LEVELS = ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681))


def bin_of(begin, end):
    """The smallest bin that holds a half-open range; of arrays, those of all ranges."""
    found, last = 0, end - 1
    for shift, first in LEVELS:
        found = found + (begin >> shift == last >> shift) * (first + (begin >> shift) - found)
    return found


# ---------------------------------------------------------------- arrays end to end


def before(lengths: np.ndarray) -> np.ndarray:
    """Where each one's items begin."""
    return np.cumsum(lengths) - lengths


def spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every item, whose it is and its place among them."""
    of = np.repeat(np.arange(len(lengths)), lengths)
    return of, np.arange(len(of)) - before(lengths)[of]


def within(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values before each item among those of its own, of n."""
    sums = before(values)
    first = np.searchsorted(of, np.arange(n))
    return sums - np.append(sums, 0)[first][of]


def counted(of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, minlength=n)


def items(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    of, place = spread(lengths)
    return data[starts[of] + place]


def numbers(data: np.ndarray, at: np.ndarray, kind: str | np.dtype) -> np.ndarray:
    kind = np.dtype(kind)
    return data[at[:, None] + np.arange(kind.itemsize)].view(kind).reshape(len(at))


def put(out: np.ndarray, starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> None:
    of, place = spread(lengths)
    out[starts[of] + place] = values


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)


def texts(data: np.ndarray, lengths: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    bits = None if valid is None else pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    found = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets_of(lengths)), pa.py_buffer(np.ascontiguousarray(data, np.uint8)), bits)
    found.validate(full=True)
    return found


def lists(values: pa.Array, lengths: np.ndarray, valid: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets_of(lengths)), values, mask=pa.array(~valid))


# ---------------------------------------------------------------- reading


def tags(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """NM (value, known), MD and CG (place, length, -1 where there is none) of records, of which tag after tag is looked at in all at once."""
    n, at = len(at), at.copy()
    found = {"NM": (np.zeros(n, np.int64), np.zeros(n, bool)), "MD": (np.zeros(n, np.int64), np.full(n, -1)), "CG": (np.zeros(n, np.int64), np.full(n, -1))}
    code = lambda name: ord(name[0]) << 8 | ord(name[1])
    zeros = np.append(np.flatnonzero(data == 0), len(data))
    left = np.flatnonzero(at + 3 <= end)
    while len(left):
        here = at[left]
        name, kind = data[here].astype(np.int64) << 8 | data[here + 1], data[here + 2]
        here, step = here + 3, _SIZES[kind]
        text, array = (kind == ord("Z")) | (kind == ord("H")), kind == ord("B")
        if text.any():
            step[text] = zeros[np.searchsorted(zeros, here[text])] + 1 - here[text]
            k = np.flatnonzero(text & (name == code("MD")))
            found["MD"][0][left[k]], found["MD"][1][left[k]] = here[k], step[k] - 1
        if array.any():
            if (here[array] + 5 > end[left[array]]).any():
                raise ValueError("damaged record of a BAM file")
            many = numbers(data, here[array] + 1, "<i4").astype(np.int64)
            step[array] = np.where((many >= 0) & (_SIZES[data[here[array]]] > 0), 5 + many * _SIZES[data[here[array]]], 0)
            k = name[array] == code("CG")
            found["CG"][0][left[array][k]], found["CG"][1][left[array][k]] = here[array][k] + 5, many[k]
        if (step <= 0).any() or (here + step > end[left]).any():
            raise ValueError("damaged record of a BAM file")
        whole = (name == code("NM")) & ~text & ~array
        for letter in set(kind[whole].tolist()):
            k = np.flatnonzero(whole & (kind == letter))
            found["NM"][0][left[k]], found["NM"][1][left[k]] = numbers(data, here[k], TAG_TYPES[chr(letter)]), True
        at[left] = here + step
        left = left[at[left] + 3 <= end[left]]
    return found


def differences(data: np.ndarray, place: np.ndarray, length: np.ndarray, read: np.ndarray, n_read: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bases of the contig at the columns of alignments that have one, from the aligned bases of the reads and what differs (MD), and their numbers."""
    n = len(place)
    of, _ = spread(length)
    text = items(data, place, length)
    fresh = np.ones(len(of), bool)
    fresh[1:] = of[1:] != of[:-1]
    last = lambda some: np.concatenate(([False], some[:-1])) & ~fresh  # noqa: E731 - the mark before is of this kind
    digit, alpha = (text >= 48) & (text <= 57), (_UPPER[text] >= 65) & (_UPPER[text] <= 90)
    # Numbers: each digit counts by its distance from the end of its run.
    begins = digit & ~last(digit)
    run = np.cumsum(begins) - 1
    sizes = counted(run[digit], int(begins.sum()))
    power = sizes[run[digit]] - 1 - spread(sizes)[1]
    value = np.bincount(run[digit], weights=(text[digit] - 48.0) * 10.0 ** np.minimum(power, 12), minlength=len(sizes))
    # Letters: those of a run behind ^ are gone from the read.
    heads = alpha & ~last(alpha)
    gone = (heads & last(text == _CARET))[np.maximum.accumulate(np.where(heads, np.arange(len(of)), 0))]
    at = np.flatnonzero(begins | alpha)
    same, whose = digit[at], of[at]
    taken = np.where(same, 0, ~gone[at]).astype(np.int64)
    taken[same] = np.minimum(value, 1 << 31).astype(np.int64)
    first = within(taken, whose, n)
    part, k = spread(np.where(same, np.minimum(taken, np.maximum(n_read[whose] - first, 0)), 1))
    copied, rec = same[part], whose[part]
    letters = text[at][part]
    letters[copied] = read[(before(n_read)[rec] + first[part] + k)[copied]]
    return _UPPER[letters], counted(rec, n)


def batches(data: np.ndarray, at: np.ndarray, contigs: Sequence[str], names: Sequence[str], **more: pa.Array) -> Iterator[pa.RecordBatch]:
    """The columns named of the records whose sizes stand at places of data; more: columns that are known already."""
    if not len(at):
        return
    wanted, n = set(names), len(at)
    size = numbers(data, at, "<i4").astype(np.int64)
    body = at + 4
    end = body + size
    head = numbers(data, body, HEAD)
    l_seq, n_cigar, flag, ref = (head[c].astype(np.int64) for c in ("l_seq", "n_cigar", "flag", "ref"))
    name_at = body + HEAD.itemsize
    cigar_at = name_at + head["l_name"]
    seq_at = cigar_at + 4 * n_cigar
    qual_at = seq_at + (l_seq + 1) // 2
    if (qual_at + l_seq > end).any() or (l_seq < 0).any() or (head["l_name"] == 0).any() or (ref >= len(contigs)).any():
        raise ValueError("damaged record of a BAM file")
    all_tags = bool(wanted & {"nm", "reference_sequence"})
    tagged = np.arange(n) if all_tags else np.flatnonzero(n_cigar == 2)
    known = tags(data, (qual_at + l_seq)[tagged], end[tagged])
    # Operations: those of CG, where a record has more than its head can count.
    count, where = n_cigar.copy(), cigar_at.copy()
    long = known["CG"][1] >= 0
    count[tagged[long]], where[tagged[long]] = known["CG"][1][long], known["CG"][0][long]
    rec, k = spread(count)
    word = numbers(data, where[rec] + 4 * k, "<u4").astype(np.int64)
    length, op = word >> 4, word & 15
    if (op >= len(OPERATIONS)).any():
        raise ValueError("damaged record of a BAM file")
    mapped = (count > 0) & (flag & 4 == 0) & (ref >= 0)
    laid = length * (_IN_QUERY | _IN_REF)[op] * mapped[rec]
    if wanted & {"aligned_pairs", "reference_sequence"} and laid.sum() > COLUMNS and n > 1:
        sums = np.cumsum(np.bincount(rec, weights=laid, minlength=n))
        half = min(max(int(np.searchsorted(sums, sums[-1] / 2)), 1), n - 1)
        for some in (slice(0, half), slice(half, n)):
            yield from batches(data, at[some], contigs, names, **{c: v[some] for c, v in more.items()})
        return

    found = dict(more)
    for c in wanted & set(FLAGS):
        found[c] = pa.array(flag & FLAGS[c] != 0)
    whole = lambda values, known=None: pa.array(values.astype(np.int64), mask=None if known is None else ~known).cast(pa.int32())
    found["query_length"], found["mapping_quality"], found["template_length"] = whole(l_seq), whole(head["mapq"]), whole(head["tlen"])
    found["reference_start"] = whole(head["start"], head["start"] >= 0)
    found["reference_end"] = whole(head["start"] + np.bincount(rec, weights=length * _IN_REF[op], minlength=n), mapped)
    if all_tags:
        found["nm"] = whole(*known["NM"])
    if "ref_id" in wanted:
        found["ref_id"] = pa.array(contigs, pa.string()).take(pa.array(ref, mask=ref < 0))
    if "query_name" in wanted:
        found["query_name"] = texts(items(data, name_at, head["l_name"].astype(np.int64) - 1), head["l_name"].astype(np.int64) - 1)
    if wanted & {"query_alignment_start", "query_alignment_end"}:
        # The operation at an end of each record, and the one beside it where that is a hard clip.
        padded_op, padded = np.append(op, [0, 0]), np.append(length, [0, 0])
        first = before(count)

        def clipped(outer, inner, known):
            return np.where(known & (padded_op[outer] == _CLIP), padded[outer], np.where((count > 1) & (padded_op[outer] == _HARD) & (padded_op[inner] == _CLIP), padded[inner], 0))

        found["query_alignment_start"] = whole(clipped(first, first + 1, count > 0))
        found["query_alignment_end"] = whole(l_seq - clipped(first + count - 1, first + count - 2, count > 1))
    if wanted & {"query_sequence", "reference_sequence", "query_qualities"}:
        base_of, base = spread(l_seq)
    if wanted & {"query_sequence", "reference_sequence"}:
        pairs = data[seq_at[base_of] + base // 2]
        sequence = _LETTERS[np.where(base & 1, pairs & 15, pairs >> 4)]
        found["query_sequence"] = texts(sequence, l_seq, l_seq > 0)
    if "query_qualities" in wanted:
        has = l_seq > 0
        has[has] = data[qual_at[has]] != 255
        quality = data[qual_at[base_of] + base][has[base_of]].astype(np.int32)
        found["query_qualities"] = lists(pa.array(quality), l_seq * has, has)
    if wanted & {"aligned_pairs", "reference_sequence"}:
        of, k = spread(laid)
        in_query, in_ref = _IN_QUERY[op][of], _IN_REF[op][of]
        qpos = np.where(in_query, within(length * _IN_QUERY[op], rec, n)[of] + k, -1)
        column_of = rec[of]
    if "aligned_pairs" in wanted:
        rpos = np.where(in_ref, (within(length * _IN_REF[op], rec, n) + head["start"][rec])[of] + k, -1)
        side = lambda x: pa.array(x.astype(np.int32), mask=x < 0)
        found["aligned_pairs"] = lists(pa.StructArray.from_arrays([side(qpos), side(rpos)], ["qpos", "rpos"]), counted(column_of, n), mapped)
    if "reference_sequence" in wanted:
        has = mapped & (known["MD"][1] >= 0)
        aligned = in_query & in_ref & (qpos < l_seq[column_of])
        read = sequence[before(l_seq)[column_of[aligned]] + qpos[aligned]]
        letters, many = differences(data, known["MD"][0], np.where(has, known["MD"][1], 0), read, counted(column_of[aligned], n))
        there = in_ref & has[column_of]
        skipped, whose = (op[of] == _SKIP)[there], column_of[there]
        rank = within((~skipped).astype(np.int64), whose, n)
        stays = skipped | (rank < many[whose])
        skipped, whose, rank = skipped[stays], whose[stays], rank[stays]
        shown = np.full(len(whose), ord("N"), np.uint8)
        shown[~skipped] = letters[(before(many)[whose] + rank)[~skipped]]
        found["reference_sequence"] = texts(shown, counted(whose, n), has)
    yield pa.RecordBatch.from_arrays([found[c] for c in names], list(names))


# ---------------------------------------------------------------- writing


def _plain(batch: pa.RecordBatch, name: str, missing: int | None = None) -> np.ndarray:
    """A column of whole numbers or flags; nulls are errors unless there is something for them."""
    column = batch.column(name).cast(pa.int64())
    if column.null_count and missing is None:
        raise ValueError(f"{name} is null")
    return column.fill_null(missing if missing is not None else 0).to_numpy(zero_copy_only=False)


def _text(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of text end to end, and their numbers."""
    column, lengths = batch.column(name).cast(pa.binary()), _sizes(batch, name)
    if column.null_count:
        column = column.fill_null(b"")
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]] if lengths.sum() else np.zeros(0, np.uint8)
    return data, lengths


def _known(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return pc.is_valid(batch.column(name)).to_numpy(zero_copy_only=False)


def _sizes(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """Numbers of items of a column of lists, or of bytes of one of text."""
    column = batch.column(name)
    if pa.types.is_null(column.type):
        return np.zeros(len(column), np.int64)
    lengths = pc.list_value_length(column) if pa.types.is_list(column.type) or pa.types.is_large_list(column.type) else pc.binary_length(column)
    return lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts that lay out so many columns of alignments, or a row each."""
    sums = np.cumsum(sum((_sizes(batch, c) for c in ("query_sequence", "aligned_pairs", SLIM[1], "reference_sequence") if c in batch.schema.names), np.zeros(batch.num_rows, np.int64)))
    at = 0
    while at < batch.num_rows:
        stop = max(int(np.searchsorted(sums, (sums[at - 1] if at else 0) + COLUMNS, "right")), at + 1)
        yield batch.slice(at, stop - at)
        at = stop


def _fits(values: np.ndarray, low: int, high: int, name: str) -> np.ndarray:
    if len(values) and (values.min() < low or values.max() > high):
        raise ValueError(f"{name} does not fit into a BAM record")
    return values


def operations(qpos: np.ndarray, rpos: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Operations of alignments, as BAM counts them, and their numbers; bases of the read beyond an alignment's ends are clipped."""
    of, place = spread(columns)
    both = (qpos >= 0) & (rpos >= 0)
    paired, first = np.flatnonzero(both), before(columns)
    left, right = np.searchsorted(paired, first), np.searchsorted(paired, first + columns) - 1
    edge = np.append(paired, len(of))
    inside = (np.arange(len(of)) > edge[left][of]) & (np.arange(len(of)) < edge[right][of]) & (left <= right)[of]
    op = np.where(both, 0, np.where(qpos < 0, 2, np.where(inside, 1, 4)))
    begins = place == 0
    begins[1:] |= op[1:] != op[:-1]
    at = np.flatnonzero(begins)
    return (np.diff(np.append(at, len(of))) << 4 | op[at]).astype("<u4"), counted(of[at], len(columns))


def stated_differences(of: np.ndarray, gap: np.ndarray, same: np.ndarray, base: np.ndarray, has: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """MD of the records that have one, end to end, and their lengths: from the columns with a base of the contig, whose record, whether the read has none there or the same."""
    n = len(has)
    event = np.flatnonzero(gap | ~same)
    columns, whose = counted(of, n), of[event]
    first = before(columns)
    joined = np.zeros(len(event), bool)  # another base of a deletion
    joined[1:] = gap[event[1:]] & gap[event[:-1]] & (event[1:] == event[:-1] + 1) & (whose[1:] == whose[:-1])
    last = first[whose] - 1
    last[1:] = np.where(whose[1:] == whose[:-1], event[:-1], last[1:])
    events = counted(whose, n)
    ends = first - 1
    ends[events > 0] = event[(np.cumsum(events) - 1)[events > 0]]
    # Every event is a piece of text; so is the number that ends a record.
    ending = np.flatnonzero(has)
    place = np.arange(len(event)) + before(has.astype(np.int64))[whose]
    total = len(event) + len(ending)
    number, letter, caret, rec = np.zeros(total, np.int64), np.zeros(total, np.uint8), np.zeros(total, bool), np.zeros(total, np.int64)
    final = (np.cumsum(events) + before(has.astype(np.int64)))[ending]
    number[place], letter[place], caret[place], rec[place] = np.where(joined, -1, event - last - 1), base[event], gap[event] & ~joined, whose
    number[final], rec[final] = (first + columns - 1 - ends)[ending], ending
    digits = np.where(number < 0, 0, 1 + sum((number >= 10**k).astype(np.int64) for k in range(1, 10)))
    lengths = digits + caret + (letter > 0)
    at = before(lengths)
    out = np.zeros(int(lengths.sum()), np.uint8)
    for k in range(int(digits.max(initial=0))):
        some = digits > k
        out[(at + digits - 1 - k)[some]] = 48 + number[some] // 10**k % 10
    out[(at + digits)[caret]] = _CARET
    some = letter > 0
    out[(at + digits + caret)[some]] = letter[some]
    return out, np.bincount(rec, weights=lengths, minlength=n).astype(np.int64)


def encoded(batch: pa.RecordBatch, contigs: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Records of alignments end to end and their sizes; number of the contig (that of all contigs, where a record is on none), begin and end."""
    n, there = batch.num_rows, set(batch.schema.names)
    ref = pc.index_in(batch.column("ref_id").cast(pa.string()), pa.array(contigs, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) if contigs else np.full(n, -1)
    start = _plain(batch, "reference_start", -1)
    begin = np.maximum(start, 0)
    end = _plain(batch, "reference_end", 0)
    end = np.where(end > 0, end, begin + 1)
    name, l_name = _text(batch, "query_name")
    if batch.column("query_name").null_count:
        raise ValueError("query_name is null")
    sequence, l_seq = _text(batch, "query_sequence")
    base_of, base = spread(l_seq)
    quality, l_qual = batch.column("query_qualities").cast(pa.list_(pa.int64())).flatten(), _sizes(batch, "query_qualities")
    if quality.null_count or (l_qual != l_seq)[_known(batch, "query_qualities")].any():
        raise ValueError("query_qualities are not one of each base")
    nothing = np.zeros(0, np.int64)
    qpos, rpos, columns = nothing, nothing, np.zeros(n, np.int64)
    if set(SLIM) <= there:  # places as they travel, see functions.alignments
        columns = _sizes(batch, SLIM[1])
        qpos, beside = (batch.column(c).flatten().cast(pa.int64()) for c in SLIM[1:])
        rpos = np.where(pc.is_valid(beside).to_numpy(zero_copy_only=False), beside.fill_null(0).to_numpy(zero_copy_only=False) + np.repeat(_plain(batch, SLIM[0], 0), columns), -1)
        qpos = qpos.fill_null(-1).to_numpy(zero_copy_only=False)
    elif "aligned_pairs" in there:
        pairs, columns = batch.column("aligned_pairs").flatten(), _sizes(batch, "aligned_pairs")
        sides = dict(zip([f.name for f in pairs.type], pairs.flatten(), strict=True))
        qpos, rpos = (sides[c].cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False) for c in ("qpos", "rpos"))
    words, n_cigar = operations(qpos, rpos, columns)

    nm = _known(batch, "nm") if "nm" in there else np.zeros(n, bool)
    has, stated, l_stated = np.zeros(n, bool), np.zeros(0, np.uint8), np.zeros(n, np.int64)
    if "reference_sequence" in there:
        has = _known(batch, "reference_sequence")
        reference, l_ref = _text(batch, "reference_sequence")
        of = spread(columns)[0]
        some = (rpos >= 0) & has[of]
        of, q, r = of[some], qpos[some], rpos[some] - start[of[some]]
        if ((r < 0) | (r >= l_ref[of]) | (q >= l_seq[of])).any():
            raise ValueError("aligned_pairs reach beyond a sequence")
        below = reference[before(l_ref)[of] + r]
        same = np.zeros(len(of), bool)
        same[q >= 0] = sequence[(before(l_seq)[of] + q)[q >= 0]] == below[q >= 0]
        stated, l_stated = stated_differences(of, q < 0, same, below, has)

    flag = sum((_plain(batch, c, 0) * bit for c, bit in FLAGS.items() if c in there), np.zeros(n, np.int64))
    packed = (l_seq + 1) // 2
    size = _SIZED.itemsize + l_name + 1 + 4 * n_cigar + packed + l_seq + 7 * nm + (4 + l_stated) * has
    at = before(size)
    out = np.zeros(int(size.sum()), np.uint8)
    head = np.zeros(n, _SIZED)
    head["next_ref"] = head["next_start"] = -1
    head["size"], head["ref"], head["start"], head["flag"], head["l_seq"] = _fits(size, 0, (1 << 31) - 1, "an alignment") - 4, ref, _fits(start, -1, (1 << 31) - 1, "reference_start"), flag, l_seq
    head["l_name"], head["mapq"] = _fits(l_name, 0, 254, "query_name") + 1, _fits(_plain(batch, "mapping_quality"), 0, 255, "mapping_quality")
    head["bin"], head["n_cigar"] = bin_of(begin, end) & 0xFFFF, _fits(n_cigar, 0, 65_535, "aligned_pairs")
    head["tlen"] = _fits(_plain(batch, "template_length"), -(1 << 31), (1 << 31) - 1, "template_length")
    out[at[:, None] + np.arange(_SIZED.itemsize)] = head.view(np.uint8).reshape(n, _SIZED.itemsize)
    at = at + _SIZED.itemsize
    put(out, at, l_name, name)
    at = at + l_name + 1
    put(out, at, 4 * n_cigar, words.view(np.uint8))
    at = at + 4 * n_cigar
    codes = _CODES[sequence]
    high = base & 1 == 0
    out[(at[base_of] + base // 2)[high]] = codes[high] << 4
    out[(at[base_of] + base // 2)[~high]] |= codes[~high]
    at = at + packed
    out[at[base_of] + base] = 255
    put(out, at, l_qual, _fits(quality.to_numpy(zero_copy_only=False), 0, 255, "query_qualities"))
    at = at + l_seq
    if nm.any():
        number = np.zeros(int(nm.sum()), np.dtype([("name", "S3"), ("value", "<i4")]))
        number["name"], number["value"] = b"NMi", _fits(_plain(batch, "nm", 0)[nm], -(1 << 31), (1 << 31) - 1, "nm")
        out[at[nm][:, None] + np.arange(7)] = number.view(np.uint8).reshape(-1, 7)
    at = at + 7 * nm
    if has.any():
        out[at[has][:, None] + np.arange(3)] = np.frombuffer(b"MDZ", np.uint8)
        put(out, at + 3, l_stated, stated)
    return out, size, np.where(ref < 0, len(contigs), ref), begin, end

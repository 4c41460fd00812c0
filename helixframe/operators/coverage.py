"""Counts of bases at the sites of a contig, made in blocks.

A read covers some hundred sites; a row a base would send each of them over the network. Here the task
that has the reads counts them into arrays of BLOCK sites by four bases, Arrow batch by Arrow batch, and
only arrays are shuffled and added up. What travels so is bounded by the covered blocks of each task, not by the depth.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.alleles import BASES
from ..sources.session import workers_import
from .pileup import COUNTS

#: Sites of a block, and blocks that a task holds before it hands them on (32 KB each).
BLOCK, HELD = 2048, 1024

#: Columns of a read that its bases at sites come from, beside sample and species.
OBSERVED = ("ref_id", "aligned_pairs", "query_sequence", "query_qualities")

_CODE = np.full(256, -1, np.int8)
_CODE[np.frombuffer("".join(BASES).encode(), np.uint8)] = np.arange(len(BASES))


def counted_batch(batch: pa.RecordBatch, base_quality: int) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """((row of the batch with the block's contig, block), counts) of the bases of a batch: contig (number), aligned_pairs, query_sequence, query_qualities."""

    def flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
        offsets = np.asarray(column.offsets)
        return offsets - offsets[0], column.values.slice(offsets[0], offsets[-1] - offsets[0])

    at, pairs = flat(batch.column(1))
    q_at, quality = flat(batch.column(3))
    text = batch.column(2).cast(pa.binary())
    s_at = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, text.offset * 4)
    letters = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    places = [pairs.field(k) for k in ("qpos", "rpos")]
    both = np.asarray(places[0].is_valid()) & np.asarray(places[1].is_valid())
    row = np.repeat(np.arange(len(batch)), np.diff(at))[both]
    qpos, rpos = (np.asarray(p.fill_null(0))[both].astype(np.int64) for p in places)
    # A read without sequence or qualities has no base to count.
    known = (qpos < np.diff(s_at)[row]) & (qpos < np.diff(q_at)[row])
    row, qpos, rpos = row[known], qpos[known], rpos[known]
    code = _CODE[letters[s_at[row] + qpos]].astype(np.int64)
    good = (code >= 0) & (np.asarray(quality.fill_null(-1))[q_at[row] + qpos] >= base_quality)
    row, rpos, code = row[good], rpos[good], code[good]
    contig = np.asarray(batch.column(0))[row]
    if not len(row):
        return
    keys, first, of = np.unique(np.stack([contig, rpos // BLOCK]), axis=1, return_index=True, return_inverse=True)
    size = len(BASES) * BLOCK
    for begin in range(0, keys.shape[1], HELD):
        some = keys[:, begin : begin + HELD]
        mine = (of >= begin) & (of < begin + some.shape[1])
        sums = np.bincount((of[mine] - begin) * size + code[mine] * BLOCK + rpos[mine] % BLOCK, minlength=some.shape[1] * size).astype(np.int32).reshape(-1, size)
        for k in range(some.shape[1]):
            yield (int(row[first[begin + k]]), int(some[1, k])), sums[k]


def blocks_of(reads: DataFrame, *, base_quality: int) -> DataFrame:
    """sample_name, species_id, ref_id, block, counts: partial sums of the blocks of each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def handed() -> pa.RecordBatch:
            keys = list(zip(*held, strict=True))
            columns = [*[pa.array(k, pa.string()) for k in keys[:3]], pa.array(keys[3], pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["sample_name", "species_id", "ref_id", "block", "counts"])

        for batch in batches:
            names = [batch.column(k).to_pylist() for k in range(3)]
            number: dict[tuple, int] = {}
            contig = np.array([number.setdefault(key, len(number)) for key in zip(*names, strict=True)], np.int64)
            rest = pa.RecordBatch.from_arrays([pa.array(contig), *batch.columns[3:]], ["contig", "aligned_pairs", "query_sequence", "query_qualities"])
            for (row, block), counts in counted_batch(rest, base_quality):
                key = (*[n[row] for n in names], block)
                if key in held:
                    held[key] += counts
                else:
                    held[key] = counts.copy()
                if len(held) >= HELD:
                    yield handed()
                    held = {}
        if held:
            yield handed()

    workers_import(reads.sparkSession)
    narrow = reads.select(*[F.col(c).cast("string").alias(c) for c in ("sample_name", "species_id", "ref_id")], "aligned_pairs", "query_sequence", "query_qualities")
    narrow = narrow.filter(F.col("aligned_pairs").isNotNull() & F.col("query_sequence").isNotNull() & F.col("query_qualities").isNotNull())
    return narrow.mapInArrow(count, "sample_name string, species_id string, ref_id string, block long, counts binary")


def summed(blocks: DataFrame) -> DataFrame:
    """Partial sums of a block added up, and its sites with any depth: sample_name, species_id, ref_id, ref_pos (from 1), counts, depth."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sites(key: tuple, total: np.ndarray) -> pa.RecordBatch:
            counts = total.reshape(len(BASES), BLOCK)
            depth = counts.sum(axis=0)
            at = np.flatnonzero(depth)
            names = [pa.array([k] * len(at), pa.string()) for k in key[:3]]
            return pa.RecordBatch.from_arrays([*names, pa.array(at + key[3] * BLOCK + 1, pa.int64()), *[pa.array(c[at], pa.int64()) for c in counts], pa.array(depth[at], pa.int64())], ["sample_name", "species_id", "ref_id", "ref_pos", *COUNTS, "depth"])

        now, total = None, np.zeros(0, np.int64)
        for batch in batches:
            for *key, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if now is not None:
                        yield sites(now, total)
                    now, total = key, np.zeros(len(BASES) * BLOCK, np.int64)
                total += np.frombuffer(counts, np.int32)
        if now is not None:
            yield sites(now, total)

    keys = ["sample_name", "species_id", "ref_id", "block"]
    dealt = blocks.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "counts")
    return dealt.mapInArrow(add, "sample_name string, species_id string, ref_id string, ref_pos long, " + ", ".join(f"{c} long" for c in (*COUNTS, "depth")))


def counted_sites(reads: DataFrame, *, base_quality: int = 30) -> DataFrame:
    """The sites that reads (columns of readqc, sample_name, species_id) cover with good bases, as pileup() counts them, without those of depth 0."""
    return summed(blocks_of(reads, base_quality=base_quality))

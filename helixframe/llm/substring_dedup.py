"""Substring dedup by super-k-mer partitioning.

A window is so many consecutive words of one document. The minimiser of a window is the least
hash of its word n-grams; consecutive windows that share it are a super-k-mer and travel as one
packed string to the bucket of that minimiser. Equal windows have equal minimisers and so meet
in one bucket, where sorting finds the first document of each exactly.

Text is packed only where windows of different super-k-mers may be equal: equal super-k-mers are
grouped by two hashes (128 bits) first, of each only one string travels, and a minimiser that
one document or one string has alone needs none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents_of, one_row_each, partitions, small_batches, stored, table
from .words import gram_hashes, range_hashes, sliding_min, word_blocks

WINDOW = 50
GRAM = 8
#: Super-k-mers of one minimiser that one task sorts; more are sorted by Spark, window by window.
BUCKET = 4096
#: Windows of a super-k-mer. One word said over and over has the same least hash throughout; such runs are cut here.
RUN = 128


def super_kmers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """mini, pid (hash of the words), doc_id, th, start (first window), n (windows) of every super-k-mer."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (np.asarray(batch.column(k)) for k in (0, 1))
            for w in word_blocks(batch.column(2)):
                grams = gram_hashes(w.hashes, gram)
                if len(grams) < window - gram + 1:
                    continue
                least = sliding_min(grams, window - gram + 1)
                row = np.repeat(np.arange(len(w.rows)), np.diff(w.first))[: len(least)]
                places = np.arange(len(least))
                whole = places + window <= w.first[row + 1]  # the window ends in the same row
                places, row, least = places[whole], row[whole], least[whole]
                if not len(places):
                    continue
                new = np.ones(len(places), bool)
                new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                since = np.arange(len(places)) - np.repeat(at, np.diff(np.append(at, len(places))))
                at = np.flatnonzero(since % RUN == 0)
                n = np.diff(np.append(at, len(places)))
                begin = places[at]
                pid = range_hashes(w.hashes, begin, begin + n + window - 1)
                r = row[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (least[at].view(np.int64), pid.view(np.int64), ids[w.rows[r]], marks[w.rows[r]], (begin - w.first[r]).astype(np.int32), n.astype(np.int32))],
                    ["mini", "pid", "doc_id", "th", "start", "n"],
                )

    return docs.select("doc_id", "th", "text").mapInArrow(find, "mini long, pid long, doc_id long, th long, start int, n int")


def packed_strings(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The super-k-mers wanted of each document, as strings: mini, pid, doc_id, salted, packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids, wants = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = text.encode().split()
                out += [(r["mini"], r["pid"], ids[i], r["salted"], b" ".join(words[r["start"] : r["start"] + r["n"] + window - 1])) for r in wants[i]]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()), strict=True)], ["mini", "pid", "doc_id", "salted", "packed"])

    runs = wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("mini", "pid", "start", "n", "salted")).alias("runs"))
    return docs.join(runs, ["doc_id", "th"]).select("doc_id", "text", "runs").mapInArrow(pack, "mini long, pid long, doc_id long, salted boolean, packed binary")


def windows_of(packed: bytes, window: int) -> list[bytes]:
    starts, ends, at = [], [], 0
    for word in packed.split(b" "):
        starts.append(at)
        at += len(word) + 1
        ends.append(at - 1)
    return [packed[s:e] for s, e in zip(starts, ends[window - 1 :], strict=False)]


def sorted_bucket(members: list[tuple[int, int, bytes]], window: int) -> Iterator[tuple[int, list[int]]]:
    """Of the (pid, doc_id, packed) of a minimiser: pid and, for each window, the first document that has it, where that is an earlier one."""
    cut = [windows_of(packed, window) for _, _, packed in members]
    order = sorted((w, doc) for (_, doc, _), windows in zip(members, cut, strict=True) for w in set(windows))
    first = {w: next(same)[1] for w, same in groupby(order, key=lambda x: x[0])}
    for (pid, doc, _), windows in zip(members, cut, strict=True):
        firsts = [first[w] for w in windows]
        if min(firsts) < doc:
            yield pid, firsts


def bucket_firsts(strings: DataFrame, window: int) -> DataFrame:
    """mini, pid, firsts: minimisers with few strings are sorted in their bucket's task, the others by Spark."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(mini: int, members: list) -> pa.RecordBatch:
            found = list(sorted_bucket(members, window))
            return pa.RecordBatch.from_arrays(
                [pa.array([mini] * len(found), pa.int64()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64()))], ["mini", "pid", "firsts"]
            )

        now, members = None, []
        for batch in batches:
            for mini, pid, doc, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if mini != now and members:
                    yield done(now, members)
                    members = []
                now = mini
                members.append((pid, doc, packed))
        if members:
            yield done(now, members)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mini, pid, doc, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cut = windows_of(packed, window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([mini] * len(cut), pa.int64()), pa.array([pid] * len(cut), pa.int64()), pa.array([doc] * len(cut), pa.int64()), pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())],
                    ["mini", "pid", "doc_id", "place", "words"],
                )

    columns = ["mini", "pid", "doc_id", "packed"]
    few = strings.filter(~F.col("salted")).select(columns).repartition(partitions(strings.sparkSession), "mini").sortWithinPartitions("mini").mapInArrow(sort, "mini long, pid long, firsts array<long>")
    each = strings.filter("salted").select(columns).mapInArrow(explode, "mini long, pid long, doc_id long, place int, words binary").withColumn("words", F.sha2("words", 256))
    first = each.groupBy("words").agg(F.min("doc_id").alias("first"))
    many = (
        each.join(first, "words")
        .groupBy("mini", "pid")
        .agg(F.sort_array(F.collect_list(F.struct("place", "first"))).alias("found"), F.min(F.col("first") - F.col("doc_id")).alias("least"))
        .filter("least < 0")
        .select("mini", "pid", F.col("found.first").alias("firsts"))
    )
    return few.unionByName(many)


def substring_dedup(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, text (the words that stay, joined by one space), n_words, n_removed.

    A word goes if a window covers it whose words also start in a document of a smaller doc_id;
    windows are those of the input. Texts shorter than a window keep all words, null and empty
    texts have none. Rows that repeat a doc_id never remove each other's words; rows alike in doc_id and text
    are cut once and given out as often as they occur. A null doc_id counts as larger than any other. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    last = F.lit(2**63 - 1)
    docs = documents_of(docs).select(F.coalesce("doc_id", last).alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    docs = one_row_each(docs, docs.select("doc_id", "th"), ["doc_id", "th"])
    runs = stored(super_kmers(docs, window, gram))
    pids = runs.groupBy("mini", "pid").agg(F.min(F.struct("doc_id", "th", "start", "n")).alias("first"), F.max("doc_id").alias("last"))
    minis = pids.groupBy("mini").agg(F.count(F.lit(1)).alias("strings"), F.min("first.doc_id").alias("least"), F.max("last").alias("most")).filter("least < most").select("mini", "strings")
    shared = stored(pids.join(minis, "mini").select("mini", "pid", "strings", "first", "last"))
    wanted = shared.filter("strings > 1").select("mini", "pid", "first.doc_id", "first.th", "first.start", "first.n", (F.col("strings") > BUCKET).alias("salted"))
    by_row = docs.repartition(partitions(spark), "doc_id", "th")
    firsts = stored(bucket_firsts(packed_strings(by_row, wanted, window), window))
    known = shared.select("mini", "pid", F.col("first.doc_id").alias("first"), "last").join(firsts, ["mini", "pid"], "left").filter("first < last OR firsts IS NOT NULL")
    # A later copy of a super-k-mer loses all of its windows, the first one those that its bucket found earlier elsewhere.
    lost = (
        runs.join(known, ["mini", "pid"])
        .select("doc_id", "th", F.struct("start", "n", F.when(F.col("doc_id") == F.col("first"), F.col("firsts")).alias("firsts")).alias("run"), "first")
        .filter("first < doc_id OR run.firsts IS NOT NULL")
        .groupBy("doc_id", "th")
        .agg(F.collect_list("run").alias("runs"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, gone = [], [], []
            ids, runs_of = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = text.encode().split()
                totals.append(len(words))
                gone.append(0)
                if runs_of[i]:
                    step = np.zeros(len(words) + 1, np.int64)
                    for r in runs_of[i]:
                        at = r["start"] + (np.arange(r["n"]) if r["firsts"] is None else np.flatnonzero(np.array(r["firsts"]) < ids[i]))
                        np.add.at(step, at, 1)
                        np.add.at(step, at + window, -1)
                    stays = np.cumsum(step[:-1]) == 0
                    gone[-1] = len(words) - int(stays.sum())
                    words = [words[k] for k in np.flatnonzero(stays)]
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), batch.column(3)], ["doc_id", "text", "n_words", "n_removed", "copies"])

    return (
        by_row.join(lost, ["doc_id", "th"], "left")
        .select("doc_id", "text", "runs", "copies")
        .mapInArrow(cut, "doc_id long, text string, n_words long, n_removed long, copies long")
        .withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(F.nullif("doc_id", last).alias("doc_id"), "text", "n_words", "n_removed")
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL = {
    "op4_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50) x),
first AS (SELECT s, min(doc_id) AS m FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i, unnest(range(0, 50)) AS k FROM win JOIN first USING (s) WHERE m < doc_id) y),
each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w WHERE len(ws) > 0),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
}

"""FASTQ whose sequences and qualities may span lines, read by splits.

Where a record ends depends on all before it: a quality line may begin with @, and qualities end when
they are as long as the sequence. Each split is first followed from every line on at which a record
might begin, on nothing but the lengths and first marks of its lines. That says how the state behind it
depends on the state before it; these maps are composed in the order of a file's splits, a row a split.
Then each split is parsed once, from the state it really begins in. What crosses a border comes in
fragments, at most two a split, which are put together by record.

States: 0 looks for a head, 1 is in a sequence of so many letters yet, 2 lacks so many qualities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import workers_import

#: States of so many splits are broadcast; with more, lines are shuffled to them.
BROADCAST_SPLITS = 100_000


def followed(lengths: np.ndarray, heads: np.ndarray, plus: np.ndarray) -> dict:
    """How the state behind a split depends on the one before it.

    letters is the sum of lengths; plus_at the letters before the first line with +, null without one, after the state if
    a head is looked for behind that line. up_to, kind and value: where qualities end within so many letters, the state behind the split.
    """
    n = len(lengths)
    total = np.concatenate(([0], np.cumsum(lengths)))
    index = np.arange(n + 1)

    def following(marks: np.ndarray) -> np.ndarray:
        """The first marked line from each one on, n if there is none."""
        found = np.where(np.append(marks, True), index, n)
        return np.minimum.accumulate(found[::-1])[::-1]

    head, mark = following(heads), following(plus)
    after_head = np.minimum(head + 1, n)
    q = mark[after_head]
    after_mark = np.minimum(q + 1, n)
    need = total[q] - total[after_head]
    wanted = total[after_mark] + need
    end = np.where(need > 0, np.searchsorted(total, wanted), after_mark)
    # A record that a head at this line begins, and that does not end in the split, is where following stops.
    kind = np.where(head == n, 0, np.where(q == n, 1, np.where(wanted > total[n], 2, -1)))
    value = np.where(kind == 1, total[n] - total[after_head], np.where(kind == 2, wanted - total[n], 0))
    to = np.where(kind >= 0, index, end)
    while not np.array_equal(further := to[to], to):
        to = further
    kind, value = kind[to], value[to]
    new = np.ones(n, bool)
    new[:-1] = (kind[1:-1] != kind[2:]) | (value[1:-1] != value[2:])
    runs = np.flatnonzero(new) + 1
    first = mark[0]
    return {
        "letters": int(total[n]), "from_head": [int(kind[0]), int(value[0])], "plus_at": None if first == n else int(total[first]), "plus_end": None if first == n else int(total[first + 1]),
        "after": None if first == n else [int(kind[first + 1]), int(value[first + 1])], "up_to": total[runs].tolist(), "kind": kind[runs].tolist(), "value": value[runs].tolist(),
    }


MAP_SCHEMA = "path string, split long, letters long, from_head array<long>, plus_at long, plus_end long, after array<long>, up_to array<long>, kind array<long>, value array<long>"
STATE_SCHEMA = "path string, split long, state int, count long, owner long"


def composed(rows: pd.DataFrame) -> pd.DataFrame:
    """The state that each split of a file begins in, and owner, the split in which its record began (-1: none)."""
    rows = rows.sort_values("split").reset_index(drop=True)
    state, count, owner, out = 0, 0, -1, []

    for r in rows.itertuples():
        out.append((r.path, r.split, state, count, owner))
        done = None  # the state from a new head on, if this record ends here
        if state == 0:
            done = r.from_head
        else:
            at = 0
            if state == 1 and not pd.isna(r.plus_at):
                count, at, state = count + int(r.plus_at), int(r.plus_end), 2
                if count == 0:
                    done = r.after
            elif state == 1:
                count += r.letters
            if state == 2 and done is None:
                k = int(np.searchsorted(r.up_to, at + count))
                if k < len(r.up_to):
                    done = (r.kind[k], r.value[k])
                else:
                    count -= r.letters - at
        if done is not None:
            state, count = int(done[0]), int(done[1])
            owner = r.split if state else -1
    return pd.DataFrame(out, columns=["path", "split", "state", "count", "owner"])


def split_maps(lines: DataFrame) -> DataFrame:
    """followed() of each split of lines (path, split, value, in order within a split)."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def found() -> pa.RecordBatch:
            columns = [np.concatenate([np.asarray(h[k]) for h in held]) for k in range(3)]
            row = followed(*columns)
            return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]], pa.int64()), *[pa.array([row[c]], t) for c, t in zip(row, (pa.int64(), longs, pa.int64(), pa.int64(), longs, longs, longs, longs), strict=True)]], ["path", "split", *row])

        longs = pa.list_(pa.int64())
        for batch in batches:
            paths, splits = batch.column(0), np.asarray(batch.column(1))
            ends = np.append(np.flatnonzero((splits[1:] != splits[:-1]) | np.asarray(paths.slice(1).to_numpy(False) != paths.slice(0, len(paths) - 1).to_numpy(False))) + 1, len(batch))
            begin = 0
            for end in ends if len(batch) else []:
                key = (paths[begin].as_py(), int(splits[begin]))
                if key != now and held:
                    yield found()
                    held = []
                now = key
                held.append([batch.column(k).slice(begin, end - begin).to_numpy(False) for k in (2, 3, 4)])
                begin = end
        if held:
            yield found()

    marks = lines.select("path", "split", F.length("value").alias("n"), F.col("value").rlike(r"^@.*\S").alias("head"), F.startswith("value", F.lit("+")).alias("plus"))
    return marks.mapInArrow(follow, MAP_SCHEMA)


def parsed(lines: DataFrame) -> DataFrame:
    """path, split, owner, ended, id, seq, qual of records and fragments, of lines with the state of their split; owner is null for what is whole."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head, seq, qual = None, None, [], []
        state, count, owner, found = 0, 0, -1, []

        def put(ended: bool) -> None:
            whole = ended and owner == now[1]
            found.append((*now, None if whole else owner, ended, head, "".join(seq), "".join(qual)))

        for batch in batches:
            found = []
            for path, split, value, state0, count0, owner0 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (path, split) != now:
                    if now is not None and state:
                        put(False)
                    now, head, seq, qual = (path, split), None, [], []
                    state, count, owner = state0, count0, owner0
                if state == 0:
                    if value.startswith("@") and value[1:].split():
                        state, count, owner, head = 1, 0, split, value[1:].split()[0]
                elif state == 1 and not value.startswith("+"):
                    seq.append(value)
                    count += len(value)
                else:
                    if state == 2:
                        qual.append(value)
                        count -= len(value)
                    state = 2
                    if count <= 0:
                        put(True)
                        state, head, seq, qual = 0, None, [], []
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*found, strict=True)) or [[]] * 7, kinds, strict=True)], names)
        if now is not None and state:
            found = []
            put(False)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names)

    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string())
    names = ["path", "split", "owner", "ended", "id", "seq", "qual"]
    return lines.mapInArrow(parse, "path string, split long, owner long, ended boolean, id string, seq string, qual string")


def split_lines(lines_: DataFrame) -> DataFrame:
    """path, split, value of text read with Spark, in the order of the file within a split."""
    return lines_.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), "value")


def records(lines_: DataFrame, keep) -> DataFrame:
    """id, seq, qual of FASTQ text as Spark's text reader gives it. keep writes a DataFrame and gives it back read, so that it is worked out once.

    A record whose qualities never become as long as its sequence is none.
    """
    workers_import(lines_.sparkSession)
    lines_ = split_lines(lines_)
    states = keep(split_maps(lines_).groupBy("path").applyInPandas(composed, STATE_SCHEMA))
    if states.count() <= BROADCAST_SPLITS:
        placed = lines_.join(F.broadcast(states), ["path", "split"])
    else:
        placed = lines_.withColumn("_id", F.monotonically_increasing_id()).join(states, ["path", "split"]).repartition("path", "split").sortWithinPartitions("path", "split", "_id").drop("_id")
    found = keep(parsed(placed.select("path", "split", "value", "state", "count", "owner")))
    part = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", c))), lambda x: x[c]), "")
    crossing = found.filter("owner IS NOT NULL").groupBy("path", "owner").agg(F.max("ended").alias("ended"), F.max("id").alias("id"), part("seq").alias("seq"), part("qual").alias("qual")).filter("ended")
    return found.filter("owner IS NULL").select("id", "seq", "qual").unionByName(crossing.select("id", "seq", "qual"))

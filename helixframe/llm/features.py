"""Numbers that the classifiers read from texts, and the labelled rows they are fitted on."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents_of
from .words import _BASE, _BASE_INVERSE, _MIX, Words, _power, mixed


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the fold of a document (null: -1)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n)), F.lit(-1))


def labels_of(labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """doc_id, label of the labelled documents to learn from, one row each."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn).groupBy("doc_id").agg(F.max("label").alias("label"))


def sample_for_fitting(docs: DataFrame, labels: DataFrame, label: str, learn: Column, *, rows: int, chars: int) -> pd.DataFrame:
    """At most rows labelled documents of each class, of at most chars code points: text, label.

    The ids of least hash are chosen among the labels, twice as many as wanted because some texts
    are too long or gone. So few ids are broadcast, and no other text is shuffled. This bound, and
    nothing else, is what fitting sees: it keeps the driver's memory fixed.
    """
    marked = labels_of(labels, label, learn)
    order = [F.xxhash64("doc_id"), "doc_id"]
    parts = [marked.filter(F.col("label") == k).orderBy(*order).limit(2 * rows) for k in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # 4 * rows ids at most
    # Of rows that repeat a doc_id one is taken, before anything reaches the driver.
    found = documents_of(docs).filter(F.length("text").between(1, chars)).join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text")).select("doc_id", "text", "label").toPandas()
    found["order"] = [zlib.crc32(str(i).encode()) for i in found["doc_id"]]
    return found.sort_values(["order", "doc_id"]).groupby("label").head(rows).reset_index(drop=True)


def class_sizes(labels: DataFrame, label: str, learn: Column) -> tuple[int, int]:
    """Labelled documents of either class among those to learn from."""
    counts = labels_of(labels, label, learn).agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    return counts[0], counts[1]


def distinct_words(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of a block, the first place of each, and for each word which of them it is."""
    return np.unique(w.hashes, return_index=True, return_inverse=True)


def byte_grams(w: Words, places: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte n-grams of the words at these places, and where those of each word begin.

    A word stands between two marks, so that its ends count; a word shorter than n is one gram.
    """
    data = np.frombuffer(w.data, np.uint8)
    starts, length = w.starts[places], w.ends[places] - w.starts[places]
    # Words side by side, with a mark (byte 0) before and after each.
    at = np.concatenate(([0], np.cumsum(length + 2)))
    laid = np.zeros(at[-1], np.uint8)
    inner = np.repeat(starts - at[:-1] - 1, length) + (places_of := np.arange(length.sum()) + np.repeat(2 * np.arange(len(length)) + 1, length))
    laid[places_of] = data[inner]
    values = np.zeros(len(laid) + 1, np.uint64)
    np.cumsum(_MIX[laid] * _power(_BASE, len(laid)), out=values[1:])
    inverse = _power(_BASE_INVERSE, len(laid) + 1)
    counts = np.stack([np.maximum(length + 2 - n + 1, 1) for n in sizes])
    begin = np.concatenate(([0], np.cumsum(counts.sum(0))))
    grams = np.zeros(begin[-1], np.uint64)
    offset = begin[:-1].copy()
    for k, n in enumerate(sizes):
        c = counts[k]
        within = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        s = np.repeat(at[:-1], c) + within
        e = np.minimum(s + n, np.repeat(at[1:], c))
        grams[np.repeat(offset, c) + within] = mixed((values[e] - values[s]) * inverse[s] + np.uint64(n))
        offset += c
    return grams, begin

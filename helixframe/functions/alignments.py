"""Pairs of places of alignments, as they travel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: What stands for aligned_pairs while reads are shuffled.
SLIM = ("_from", "_qpos", "_rpos")


def slim(reads: DataFrame) -> DataFrame:
    """Reads as they travel best: aligned_pairs (32 bytes a pair) as an array of places in the read and one of distances from reference_start (4 bytes each, much alike among reads). full_pairs puts them together."""
    kind = reads.schema["aligned_pairs"].dataType.elementType["rpos"].dataType  # type: ignore[attr-defined]
    start = F.coalesce(F.col("reference_start").cast(kind), F.lit(0).cast(kind)) if "reference_start" in reads.columns else F.lit(0).cast(kind)
    sides = F.transform("aligned_pairs", lambda p: p["qpos"]), F.transform("aligned_pairs", lambda p: p["rpos"] - start)
    return reads.withColumns(dict(zip(SLIM, (start, *sides), strict=True))).drop("aligned_pairs")


def full_pairs(row: str = "") -> Column:
    """aligned_pairs of rows, or of a struct in them, with the columns of slim."""
    start, qpos, rpos = (F.col(f"{row}.{c}" if row else c) for c in SLIM)
    return F.arrays_zip(qpos.alias("qpos"), F.transform(rpos, lambda r: r + start).alias("rpos"))


def full(row: str, columns: Sequence[str]) -> list[Column]:
    """These columns of a struct with the columns of slim."""
    return [(full_pairs(row) if c == "aligned_pairs" else F.col(f"{row}.{c}")).alias(c) for c in columns]

"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

The normalised length needs the whole text, so one scan takes all there is to know of a row: length,
hash of a prefix, digest. Only these narrow rows are refined. A row whose length, or whose prefix at
that length, no other has leaves after one count; the digests of the rest alone are grouped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents_of, stored, table, with_counts

PREFIX_CHARS = 128
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without white space (U+0020, U+0009 to U+000D)."""
    return F.translate(text, BLANKS, "")


def exact_dedup(docs: DataFrame, *, prefix_chars: int = PREFIX_CHARS, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and the columns to carry.

    Texts are equal when they are identical after white space is deleted; null counts as
    empty, and all empty texts are equal. The row with the most code points in its original
    text, then the smallest doc_id, stays (a null doc_id comes last). Rows that repeat a doc_id
    count as copies like any others: exactly one row of a group is marked as kept. text_sha256 is
    the digest of the normalised text. Other columns are ignored. An empty table gives an empty result.
    """
    facts = stored(
        documents_of(docs, *carry)
        .select("doc_id", *carry, F.length("text").cast("long").alias("chars"), normalised(F.col("text")).alias("plain"))
        .select(
            "doc_id", *carry, "chars",
            F.octet_length("plain").alias("size"),
            F.xxhash64(F.substring("plain", 1, prefix_chars)).alias("prefix"),
            F.unhex(F.sha2("plain", 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    total, spread = facts.count(), F.xxhash64("row")
    # A length that one row has is also a length and prefix that one row has: both leave by this count, of which tasks first make partial ones.
    alive = facts.groupBy("size", "prefix").agg(F.count(F.lit(1)).alias("alive")).filter("alive > 1")
    tagged = stored(with_counts(facts, alive, ["size", "prefix"], "alive", total, spread), small=True)
    best = F.max(F.struct("chars", (-F.col("doc_id")).alias("minus_id"), (-F.col("row")).alias("minus_row"))).alias("best")
    groups = (
        tagged.filter("alive IS NOT NULL")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), best)
        .filter("group_size > 1")
        .select("digest", "group_size", (-F.col("best.minus_id")).alias("keep_id"), (-F.col("best.minus_row")).alias("keep_row"))
    )
    joined = with_counts(tagged, groups, ["digest"], "group_size", total, spread)
    alone = F.col("keep_row").isNull()
    return joined.select(
        "doc_id",
        *carry,
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = {
    "op8_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS plain FROM documents
), r AS (
  SELECT doc_id, sha256(plain) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY plain) AS group_size
  FROM d
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, keep_id = doc_id AS kept, text_sha256 FROM r
"""
}

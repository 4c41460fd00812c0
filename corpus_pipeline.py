"""A corpus in five stages: toxic documents go, exact copies go, of near copies one stays, personal data become pseudonyms, the rest is packed.

Each stage takes (spark, docs, sf_dir), docs with the columns of documents, and works on all that
the one before kept; every stage is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import row_keys, stored, table
from helixframe.llm.exact_dedup import exact_dedup
from helixframe.llm.features import remainder
from helixframe.llm.ngram_join import ngram_jaccard_join
from helixframe.llm.packing import pack
from helixframe.llm.pseudonyms import pseudonyms, session_key
from helixframe.llm.toxicity import toxicity

#: Documents from this toxicity score on go.
TOXIC = 0.5


def bundled(docs: DataFrame) -> DataFrame:
    """doc_id, text and all else in one column, so that no name can clash with one that an operator uses."""
    return docs.select("doc_id", "text", F.struct(F.col("text").isNotNull().alias("text_was_there"), *[c for c in docs.columns if c not in ("doc_id", "text")]).alias("bundle"))


def unbundled(found: DataFrame, columns: list[str]) -> DataFrame:
    text = F.when(F.col("bundle.text_was_there"), F.col("text")).alias("text")
    return found.select(*[text if c == "text" else F.col(c) if c == "doc_id" else F.col(f"bundle.{c}") for c in columns])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below TOXIC. Fitted on the labelled ones outside fold 0, scored all alike; empty texts stay."""
    scored = toxicity(bundled(docs), table(spark, sf_dir, "labels"), learn=remainder(F.col("doc_id"), 5) != 0, carry=["text", "bundle"])
    return unbundled(scored.filter(F.col("score") < TOXIC), docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the longest stays, then the smallest doc_id; of rows alike in doc_id and text, one."""
    keyed = row_keys(bundled(docs))
    rows = exact_dedup(keyed, carry=["k1", "k2"]).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("stays")).filter("stays")
    alone, alike = (keyed.join(rows.filter(which).select("k1", "k2"), ["k1", "k2"], "left_semi") for which in ("n = 1", "n > 1"))
    return unbundled(alone.unionByName(alike.dropDuplicates(["k1", "k2"])), docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of Jaccard 0.75 connect, the document of smallest doc_id stays; those without words or doc_id stay."""
    gone = ngram_jaccard_join(docs).filter("component_id <> doc_id").select("doc_id", "text_hash").distinct()
    marked = bundled(docs).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return unbundled(marked.join(gone, ["doc_id", "text_hash"], "left_anti"), docs.columns)


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in their texts; n_chars follows the text."""
    changed = unbundled(pseudonyms(bundled(docs), key=session_key(spark), carry=["bundle"]), docs.columns)
    return changed.withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence."""
    return pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_jaccard", without_near_copies),
    ("pseudonyms", with_pseudonyms),
    ("packing", packed),
]

#: A recurrent network, Feistel permutations and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

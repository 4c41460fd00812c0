"""Merkle manifest of a dataset: a tree over the rows of each source, a tree over the sources, a proof for every row.

Leaves are numbered within their source by one range partitioning; each aligned block of FANOUT ** LEVELS
leaves is one group, so a source of any size is many small groups. In a block the 64-byte hex digests
lie in one numpy matrix: runs are its rows after a reshape, hashed level by level, and what a leaf's
siblings are is plain index arithmetic. The roots of the blocks are the leaves of the next round,
until every tree is one node; then proofs go down again, each block adding its own levels to the
proof that its root has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions, small_batches, stored, table

FANOUT = 3
#: Levels of a block: a task holds FANOUT ** LEVELS digests at a time.
LEVELS = 5
HEX = 64

_PROOF = "array<struct<left string, right string>>"
_MEMBER = "struct<at long, digest string, doc_id long, other string>"


def leaf(*fields: Column) -> Column:
    """Digest of fields in order, each `-` if null, else its length in UTF-8 bytes, `:` and its value."""
    return F.sha2(F.concat(*[F.when(f.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string"))) for f in fields]), 256)


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(proof, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda s: F.concat(s["left"], s["right"]))), 256)


def hash_rows(matrix: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Hex digests of the first widths bytes of each row, as rows of 64 bytes."""
    found = b"".join(hashlib.sha256(row[:w]).hexdigest().encode() for row, w in zip(matrix, widths.tolist(), strict=True))
    return np.frombuffer(found, np.uint8).reshape(-1, HEX)


def tree_of(leaves: np.ndarray, fanout: int, levels: int | None) -> list[np.ndarray]:
    """Matrices of digests from the leaves to the root: as many levels as given, or until one node remains."""
    nodes = [leaves]
    while len(nodes[-1]) > 1 if levels is None else len(nodes) <= levels:
        now = nodes[-1]
        runs = -(-len(now) // fanout)
        laid = np.zeros((runs * fanout, HEX), np.uint8)
        laid[: len(now)] = now
        size = np.minimum(fanout, len(now) - fanout * np.arange(runs))
        nodes.append(hash_rows(laid.reshape(runs, fanout * HEX), size * HEX))
    return nodes


def siblings(nodes: list[np.ndarray], fanout: int) -> tuple[np.ndarray, np.ndarray]:
    """How many nodes stand left and right of each leaf's ancestor in its run, and which (in the matrices laid end to end); leaf by leaf, level by level."""
    leaves, depth = len(nodes[0]), len(nodes) - 1
    base = np.concatenate(([0], np.cumsum([len(x) for x in nodes])))
    counts, firsts = np.zeros((2, leaves, depth), np.int64), np.zeros((2, leaves, depth), np.int64)
    for k in range(depth):
        at = np.arange(leaves) // fanout**k
        start = at - at % fanout
        counts[0, :, k], firsts[0, :, k] = at - start, base[k] + start
        counts[1, :, k], firsts[1, :, k] = np.minimum(start + fanout, len(nodes[k])) - at - 1, base[k] + at + 1
    return counts, firsts


def laid_out(pool: np.ndarray, counts: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """Strings of counts digests of the pool each, from firsts on."""
    counts, firsts = counts.ravel(), firsts.ravel()
    ends = np.cumsum(counts)
    which = np.repeat(firsts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
    offsets = np.concatenate(([0], ends * HEX)).astype(np.int32)
    return pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(pool[which]).tobytes()))


def digests(members: pa.StructArray) -> np.ndarray:
    """The digests of a block's members, in their order, as a matrix."""
    column = members.field("digest").cast(pa.string())
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, HEX)


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """rows with at (place in their tree by order, from 0) and total (rows of the tree); equal rows are told apart by the column row.

    One range partitioning deals them out, so that a tree of very many rows is many tasks; rows of
    a task are numbered from the counts of those before it.
    """
    keys = [tree, *order, "row"]
    dealt = stored(rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys).withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}))
    runs = dealt.groupBy(tree, "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(tree, "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy(tree)).alias("total"))
    return dealt.join(starts, [tree, "part"]).withColumn("at", F.col("before") + F.col("place") - F.col("first")).drop("part", "place", "first", "before", "row")


def blocks_of(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """tree, block, total, members, root: the aligned blocks of nodes (tree, at, total, digest, doc_id, other), written once."""
    size = fanout**levels
    member = F.struct("at", "digest", "doc_id", "other")
    groups = nodes.groupBy("tree", F.floor(F.col("at") / size).alias("block")).agg(F.max("total").alias("total"), F.array_sort(F.collect_list(member)).alias("members"))

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, found = np.asarray(batch.column(3).offsets), []
            for k, total in enumerate(batch.column(2).to_pylist()):
                members = batch.column(3).values.slice(offsets[k], offsets[k + 1] - offsets[k])
                found.append(tree_of(digests(members), fanout, levels if total > size else None)[-1].tobytes().decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "root"])

    small_batches(nodes.sparkSession)
    return stored(groups.mapInArrow(roots, f"tree string, block long, total long, members array<{_MEMBER}>, root string"))


def proofs_of(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """tree, at, digest, doc_id, other, proof, subroot, root of every member of blocks that know their own proof, subroot and root.

    A block that is its whole tree has no proof yet: subroot is then its root.
    """
    size = fanout**levels

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = np.asarray(batch.column(2).offsets)
            above = np.asarray(batch.column(3).offsets)
            for k, total in enumerate(batch.column(1).to_pylist()):
                members = batch.column(2).values.slice(offsets[k], offsets[k + 1] - offsets[k])
                nodes = tree_of(digests(members), fanout, levels if total > size else None)
                counts, firsts = siblings(nodes, fanout)
                pool, n, depth = np.concatenate(nodes), len(members), len(nodes) - 1
                upper = batch.column(3).values.slice(above[k], above[k + 1] - above[k])
                # The member's own levels, then those of its block.
                own = [laid_out(pool, counts[i], firsts[i]) for i in (0, 1)]
                order = (np.arange(n)[:, None] * depth + np.arange(depth)[None, :], n * depth + np.broadcast_to(np.arange(len(upper)), (n, len(upper))))
                order = pa.array(np.concatenate(order, axis=1).ravel())
                sides = [pa.concat_arrays([x, upper.field(name).cast(pa.string())]).take(order) for x, name in zip(own, ("left", "right"), strict=True)]
                steps = pa.StructArray.from_arrays(sides, ["left", "right"])
                proof = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * (depth + len(upper)), pa.int32()), steps)
                same = lambda c: batch.column(c).slice(k, 1).take(pa.array(np.zeros(n, np.int64)))  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays(
                    [same(0), *[members.field(f) for f in ("at", "digest", "doc_id", "other")], proof, same(4), same(5)], ["tree", "at", "digest", "doc_id", "other", "proof", "subroot", "root"]
                )

    small_batches(blocks.sparkSession)
    return blocks.select("tree", "total", "members", "proof", "subroot", "root").mapInArrow(prove, f"tree string, at long, digest string, doc_id long, other string, proof {_PROOF}, subroot string, root string")


def grown(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Blocks of all rounds, from the leaves to the round in which every tree is one block."""
    size, rounds = fanout**levels, []
    while True:
        rounds.append(blocks_of(nodes, fanout, levels))
        if rounds[-1].filter(F.col("total") > size).isEmpty():
            return rounds
        nodes = rounds[-1].select("tree", F.col("block").alias("at"), F.ceil(F.col("total") / size).alias("total"), F.col("root").alias("digest"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("other"))


def descended(rounds: list[DataFrame], known: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Proofs of the leaves of trees whose roots' proof, subroot and root are known (tree, proof, subroot, root)."""
    known = known.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        found = proofs_of(blocks.drop("root").join(known.select("tree", "block", "proof", "subroot", "root"), ["tree", "block"]), fanout, levels)
        known = found.withColumnRenamed("at", "block")
    return known


def merkle_manifest(docs: DataFrame, *, fanout: int = FANOUT, levels: int = LEVELS, other: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, other_leaf, proof, subroot, root.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Leaves of a source ascend by
    doc_id (null first, then by digest); runs of so many nodes become their digest, the last run of
    fewer, even of one, until one is left: the subroot. Subroots by source (null first, then by
    UTF-8 bytes) form a tree likewise: root. proof has for each level from the leaf to the root the
    digests left and right of it in its run; folded() leads from leaf and proof to root, and
    proof_digest() sums the proof up. other is a second text to make a leaf of (other_leaf, null
    where it equals the leaf), as of an altered copy. Rows that repeat a doc_id, or all
    of a row, are leaves of their own. Other columns are ignored. An empty table has no rows and no root.
    """
    spark = docs.sparkSession
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    # Null sorts before all sources, as the empty string before all that begin with a mark.
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(*fields).alias("digest"),
        (leaf(*fields[:-1], other) if other is not None else F.lit(None).cast("string")).alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows.withColumn("other", F.nullif("other", "digest")))
    trees = grown(numbered(rows, "tree", "doc_id", "digest"), fanout, levels)
    subroots = stored(trees[-1].select(F.lit("").alias("top"), "tree", F.col("root").alias("digest"), F.lit(0).alias("row")), small=True)
    sources = numbered(subroots, "top", "tree")
    top = grown(sources.select(F.col("top").alias("tree"), "at", "total", "digest", F.lit(None).cast("long").alias("doc_id"), F.col("tree").alias("other")), fanout, levels)
    # The one block of the last round is the whole tree of sources.
    of_sources = descended(top, top[-1].select("tree", F.array().cast(_PROOF).alias("proof"), F.col("root").alias("subroot"), "root"), fanout, levels)
    known = stored(of_sources.select(F.col("other").alias("tree"), "proof", F.col("digest").alias("subroot"), "root"), small=True)
    return descended(trees, known, fanout, levels).select("doc_id", F.col("digest").alias("leaf"), F.col("other").alias("other_leaf"), "proof", "subroot", "root")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle_manifest(table(spark, sf_dir, "documents"), other=tampered)
    found = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), folded(F.coalesce("other_leaf", "leaf"), F.col("proof")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))




def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("d.doc_id", "source", "lang", "n_chars", text)) + ")"


SQL = {
    "op13_merkle_manifest": rf"""
WITH RECURSIVE crc AS (
  SELECT doc_id, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(unicode(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
         LAMBDA c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], LAMBDA x, k: xor(x >> 1, 3988292384 * (x & 1)))) AS c
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) i
), leaves AS (
  SELECT d.doc_id, source, {_sql_leaf("text")} AS leaf, {_sql_leaf("CASE WHEN c & 1 = 1 THEN replace(text, chr(10), '') ELSE text END")} AS tampered
  FROM documents d LEFT JOIN crc ON crc.doc_id = d.doc_id
), p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM leaves),
lv AS (
  SELECT s, 0 AS l, pos, leaf AS h, n FROM p
  UNION ALL SELECT s, l + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM lv WHERE n > 1 GROUP BY s, l, pos // 3, n
), subroots AS (SELECT s, h FROM lv WHERE n = 1),
up AS (
  SELECT 0 AS l, s AS pos, h, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL SELECT l + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY l, pos // 3, n
), sibling AS (
  SELECT p.s, p.pos, lv.l AS l, lv.pos AS q, lv.h FROM p JOIN lv ON lv.s = p.s AND lv.n > 1 AND lv.pos // 3 = p.pos // CAST(3 ** (lv.l + 1) AS BIGINT) AND lv.pos <> p.pos // CAST(3 ** lv.l AS BIGINT)
  UNION ALL
  SELECT p.s, p.pos, 1000 + up.l, up.pos, up.h FROM p JOIN up ON up.n > 1 AND up.pos // 3 = p.s // CAST(3 ** (up.l + 1) AS BIGINT) AND up.pos <> p.s // CAST(3 ** up.l AS BIGINT)
), proof AS (SELECT s, pos, string_agg(h, '' ORDER BY l, q) AS h FROM sibling GROUP BY 1, 2),
f AS (
  SELECT s, pos AS leaf_pos, 0 AS l, pos, tampered AS h, n FROM p
  UNION ALL
  SELECT f.s, leaf_pos, f.l + 1, f.pos // 3, sha256(string_agg(CASE WHEN lv.pos = f.pos THEN f.h ELSE lv.h END, '' ORDER BY lv.pos)), (f.n + 2) // 3
  FROM f JOIN lv ON lv.s = f.s AND lv.l = f.l AND lv.pos // 3 = f.pos // 3 WHERE f.n > 1 GROUP BY f.s, leaf_pos, f.l, f.pos // 3, f.n
), g AS (
  SELECT s, leaf_pos, 0 AS l, s AS pos, h, (SELECT count(*) FROM subroots) AS n FROM f WHERE n = 1
  UNION ALL
  SELECT g.s, leaf_pos, g.l + 1, g.pos // 3, sha256(string_agg(CASE WHEN up.pos = g.pos THEN g.h ELSE up.h END, '' ORDER BY up.pos)), (g.n + 2) // 3
  FROM g JOIN up ON up.l = g.l AND up.pos // 3 = g.pos // 3 WHERE g.n > 1 GROUP BY g.s, leaf_pos, g.l, g.pos // 3, g.n
), root AS (SELECT h FROM up WHERE n = 1)
SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, sha256(coalesce(proof.h, '')) AS proof_sha256, g.h AS folded_root, g.h = root.h AS verified
FROM p JOIN subroots ON subroots.s = p.s JOIN g ON g.s = p.s AND g.leaf_pos = p.pos AND g.n = 1 LEFT JOIN proof ON proof.s = p.s AND proof.pos = p.pos, root
"""
}

"""Near duplicates by a size-aware heavy-light join on word shingles.

Two sets of shingles link when their Jaccard similarity is at least a threshold, which for their
sizes is a least overlap. Small sets enumerate their subsets of exactly that size: sets of the
two sizes that share a subset link, nothing else is to be checked. Large sets put their shingles of least hash
into inverted lists, which are scanned for candidates that are then checked exactly. The size
that parts small from large is where the estimated costs of both sum to the least.

Equal sets are one class throughout. A set too few of whose posted shingles are shared cannot
have a link and leaves early. Short lists give all their pairs. A link that shows in long lists
alone (large groups of copies, passages that many share) is between sets that have many
shingles in such lists; those sets are posted again, rarest shingles first, so that what merely
shares a passage meets no more. There each member is checked against one leader of the list a
round, what is found to belong together needs no further pairs, and only the rest is compared
pair by pair. A large group of near copies so takes checks in proportion to its size, and no
link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents_of, one_row_each, partitions, small_batches, stored, table
from .graph import components
from .words import gram_hashes, mixed, range_hashes, word_blocks

WORDS = 5
PERCENT = 75
#: Rounds of leaders before what is left is compared pair by pair.
ROUNDS = 2
#: Lists of up to so many sets give all their pairs.
SHORT = 12
#: Largest set size that may count as small, and the cost of a posting against a subset.
SMALL_MOST, POSTING_COST = 12, 6


def least_overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """Least overlap of sets of n and m that link: 100 i >= p (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def own_overlap(n, percent: int = PERCENT):
    """Least overlap with any partner."""
    return -(-percent * n // 100)


def extra(n):
    """Shingles posted beyond the least prefix, so that a link shows in several lists."""
    return n // 8


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct 64-bit shingles of each text that has words; letters A to Z count as lower case."""
    for w in word_blocks(texts, lower=True):
        grams = gram_hashes(w.hashes, words)
        for r, i, j in zip(w.rows, w.first, w.first[1:], strict=False):
            if j - i >= words:
                yield int(r), np.unique(grams[i : j - words + 1])
            elif j > i:
                yield int(r), range_hashes(w.hashes, np.array([i]), np.array([j]))


def class_keys(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, th, n (set size) and two hashes of the set."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            k1, k2 = np.zeros(len(batch), np.uint64), np.zeros(len(batch), np.uint64)
            for r, s in shingle_sets(batch.column(2), words):
                n[r], (k1[r], k2[r]) = len(s), class_key(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))], ["doc_id", "th", "n", "k1", "k2"])

    return docs.select("doc_id", "th", "text").mapInArrow(keys, "doc_id long, th long, n long, k1 long, k2 long")


def cheapest_boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The size up to which sets enumerate subsets, from the number of classes of each small size."""

    def cost(s: int) -> int:
        subsets = sum(k * sum(math.comb(n, least_overlap(n, m, percent)) for m in range(own_overlap(n, percent), min(s, 100 * n // percent) + 1) if least_overlap(n, m, percent) <= min(n, m)) for n, k in sizes.items() if n <= s)
        return subsets + POSTING_COST * sum(k * (n - own_overlap(n, percent) + 1 + extra(n)) for n, k in sizes.items() if n > s or n >= own_overlap(s + 1, percent))

    return min(range(SMALL_MOST + 1), key=cost)


def posted(n, percent: int = PERCENT):
    """How many shingles of a set of n are posted."""
    return n - own_overlap(n, percent) + 1 + extra(n)


def class_key(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return mixed(s).sum(), mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum()


def subset_keys(docs: DataFrame, words: int, boundary: int, percent: int) -> DataFrame:
    """key of every subset that a small set enumerates for a partner's size, with side (1 if the partner is larger, -1 if smaller, 0 if as large) and the set's class (n, k1, k2)."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for _, s in shingle_sets(batch.column(0), words):
                n = len(s)
                if n > boundary:
                    continue
                k1, k2 = (int(k.view(np.int64)) for k in class_key(s))
                for m in range(own_overlap(n, percent), min(boundary, 100 * n // percent) + 1):
                    c = least_overlap(n, m, percent)
                    if c > min(n, m):
                        continue
                    at = np.array(list(combinations(range(n), c)))
                    found = np.full(len(at), min(n, m) << 32 | max(n, m), np.uint64)
                    for k in range(c):
                        found = mixed(found * np.uint64(0x2545F4914F6CDD1D) + s[at[:, k]])
                    out += [(key, (m > n) - (m < n), n, k1, k2) for key in found.view(np.int64).tolist()]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "side", "n", "k1", "k2"])

    # A set of so few shingles has few words, but words may be long or repeated: no text is left out here.
    return docs.select("text").mapInArrow(keys, "key long, side long, n long, k1 long, k2 long").distinct()


def postings(reps: DataFrame, words: int, percent: int) -> DataFrame:
    """token, doc_id of the shingles of least hash of each large set."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tokens, owners = np.asarray(batch.column(0)), [], []
            for r, s in shingle_sets(batch.column(1), words):
                q = posted(len(s), percent)
                tokens.append(s[:q])
                owners.append(np.full(q, ids[r]))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(owners))], ["token", "doc_id"])

    return reps.select("doc_id", "text").mapInArrow(post, "token long, doc_id long")


def shared_only(rows: DataFrame) -> DataFrame:
    """The postings whose list has another member; sorted lists stream by, none is held whole."""

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.RecordBatch | None = None  # the last row so far, not yet settled
        linked = False  # it equals the row before it
        for batch in batches:
            if not len(batch):
                continue
            now = batch if before is None else pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
            token = np.asarray(now.column(0))
            same = token[1:] == token[:-1]
            keep = np.zeros(len(token), bool)
            keep[0] = linked
            keep[1:] |= same
            keep[:-1] |= same
            linked = bool(keep[-1])
            before = now.slice(len(now) - 1)
            yield now.slice(0, len(now) - 1).filter(pa.array(keep[:-1]))
        if before is not None and linked:
            yield before

    spark = rows.sparkSession
    small_batches(spark)
    return rows.repartition(partitions(spark), "token").sortWithinPartitions("token").mapInArrow(shared, "token long, doc_id long")


def set_table(reps: DataFrame, words: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(r, s) for r, s in shingle_sets(batch.column(1), words)]
            if found:
                offsets = np.concatenate(([0], np.cumsum([len(s) for _, s in found])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([r for r, _ in found])), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([s for _, s in found]).view(np.int64)))], ["doc_id", "tokens"]
                )

    return reps.select("doc_id", "text").mapInArrow(sets, "doc_id long, tokens array<long>")


def least_shared(n: Column, m: Column, percent: int) -> Column:
    """Least number of posted shingles that linking sets of n and m share.

    The extra(least) + 1 least common shingles are posted by both; and the overlap beyond what
    either did not post is within what both did.
    """
    rest = lambda x: F.ceil(percent * x / 100) - 1 - F.floor(x / 8)  # noqa: E731  not posted
    return F.greatest(1 + F.floor(F.least(n, m) / 8), F.ceil(percent * (n + m) / (100 + percent)) - F.greatest(rest(n), rest(m)))


def verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose sets link; those that share too few posted shingles are not looked up in full."""

    def beside(pairs: DataFrame, table_: DataFrame, *columns: str) -> DataFrame:
        for k in "ab":
            pairs = pairs.join(table_.select(F.col("doc_id").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in columns]), k)
        return pairs

    near = beside(pairs.distinct(), sketches, "n", "posted").filter(
        (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")) & (F.size(F.array_intersect("a_posted", "b_posted")) >= least_shared(F.col("a_n"), F.col("b_n"), percent))
    )
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return beside(near.select("a", "b"), sets, "tokens").filter(100 * both >= percent * (F.size("a_tokens") + F.size("b_tokens") - both)).select("a", "b")


def pairs_within(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of a list (token, doc_id, n) that sizes allow."""
    other = lists.select("token", F.col("doc_id").alias("b"), F.col("n").alias("m"))
    return lists.join(other, "token").filter((F.col("doc_id") < F.col("b")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))).select(F.col("doc_id").alias("a"), "b")


def rarest_first(sets: DataFrame, percent: int) -> DataFrame:
    """token, doc_id, n, left, central of lists over the least prefix of each set, shingles that fewest of these sets have first.

    left is how many shingles of the set come from this one on, central how many sets its shingles are in on average.
    """
    each = sets.select("doc_id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    of_doc = Window.partitionBy("doc_id")
    placed = each.join(counts, "token").withColumn("left", F.col("n") + 1 - F.row_number().over(of_doc.orderBy("k", "token"))).withColumn("central", F.avg("k").over(of_doc))
    # A shingle that no other of these sets has keeps its place in the prefix but makes no list.
    return placed.filter((F.col("left") >= F.ceil(percent * F.col("n") / 100)) & (F.col("k") > 1)).select("token", "doc_id", "n", "left", "central")


def leader_links(lists: DataFrame, check, percent: int, rounds: int) -> DataFrame:
    """Links that connect what all links of the lists connect, None if there are no pairs; check gives those of candidate pairs that link.

    The leader is the set whose shingles are the commonest: of edited copies, what they were made
    from. A pair counts in a list only if, with this the first shingle they share, enough are left.
    """
    links = None
    for k in range(rounds + 1):
        now = lists.withColumn("component", F.col("doc_id"))
        if links is not None:
            now = lists.join(components(links).withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        order = F.struct("central", "doc_id") if k == 0 else F.struct(F.xxhash64("doc_id", F.lit(k)), "doc_id")
        open_lists = stored(now.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.max_by(F.struct("doc_id", "n", "left", "component"), order).alias("lead")).filter("least < most"), small=True)
        if open_lists.isEmpty():
            break
        if k < rounds:
            other = open_lists.select("token", "lead.*")
        else:
            now = stored(now.join(open_lists.select("token"), "token", "left_semi"))
            other = now
        other = other.select("token", *[F.col(c).alias(f"other_{c}") for c in ("doc_id", "n", "left", "component")])
        may = (F.col("component") != F.col("other_component")) & (F.least("left", "other_left") >= F.ceil(percent * (F.col("n") + F.col("other_n")) / (100 + percent)))
        if k == rounds:
            may &= F.col("doc_id") < F.col("other_doc_id")
        pairs = now.join(other, (now["token"] == other["token"]) & may).select(F.least("doc_id", "other_doc_id").alias("a"), F.greatest("doc_id", "other_doc_id").alias("b"))
        found = stored(check(pairs))
        links = found if links is None else links.unionByName(found)
    return links


def ngram_jaccard_join(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, class_id (least doc_id with the same set), component_id.

    The set of a document is its distinct shingles of so many words; with fewer words, the whole
    sequence is one shingle; without words, or with null text, the set is empty and the document
    linked with nothing. Rows that repeat a doc_id are the same document. A null doc_id is passed
    through, unlinked. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = documents_of(docs).withColumn("th", F.xxhash64("text"))
    keys = stored(class_keys(docs, words), small=True)
    real = keys.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(real.groupBy("n", "k1", "k2").agg(F.min(F.struct("doc_id", "th")).alias("rep")).select("n", "k1", "k2", F.col("rep.doc_id").alias("class_id"), F.col("rep.th").alias("th")), small=True)
    histogram = {r.n: r.k for r in classes.filter(F.col("n") <= 2 * SMALL_MOST).groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()}
    boundary = cheapest_boundary(histogram, percent)
    # Small sets.
    subsets = subset_keys(docs, words, boundary, percent).join(classes.filter(F.col("n") <= boundary).select("n", "k1", "k2", "class_id"), ["n", "k1", "k2"]).select("key", "side", "class_id")
    # Sets of one side alone need not link: the subset is of a size that the other side asks for. With both sides there, all are connected.
    leaders = subsets.groupBy("key").agg(F.min("class_id").alias("a"), F.count(F.lit(1)).alias("k"), F.min("side").alias("least"), F.max("side").alias("most")).filter("k > 1 AND (least = 0 OR least < most)").select("key", "a")
    light = stored(subsets.join(leaders, "key").filter("a < class_id").select("a", F.col("class_id").alias("b")).distinct(), small=True)

    # Large sets, and the small ones that such a set may link with.
    large = classes.filter(F.col("n") >= own_overlap(boundary + 1, percent)).select(F.col("class_id").alias("doc_id"), "th", "n")
    # Rows that repeat an id and text are one member of a list, and one set.
    one = one_row_each(docs, real.select("doc_id", "th"), ["doc_id", "th"])
    shared = stored(shared_only(postings(one.join(large.drop("n"), ["doc_id", "th"]), words, percent)))
    smallest = F.ceil(percent * F.col("n") / 100)  # partner
    enough = F.greatest(1 + F.floor(smallest / 8), F.ceil(percent * (F.col("n") + smallest) / (100 + percent)) - (F.ceil(percent * F.col("n") / 100) - 1 - F.floor(F.col("n") / 8)) - 1)
    sketches = stored(shared.groupBy("doc_id").agg(F.collect_list("token").alias("posted")).join(large.select("doc_id", "n"), "doc_id").filter(F.size("posted") >= enough))
    alive = sketches.select("doc_id", "n", F.explode("posted").alias("token"))
    counts = alive.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    lists = stored(alive.join(counts, "token"))
    small_batches(spark)
    sets = stored(set_table(one.join(large.join(sketches, "doc_id", "left_semi").select("doc_id", "th"), ["doc_id", "th"]), words))
    check = lambda pairs: verified(pairs, sketches, sets, percent)
    cold = stored(check(pairs_within(lists.filter(F.col("k") <= SHORT).select("token", "doc_id", "n"), percent)))
    hot = lists.filter(F.col("k") > SHORT).groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= enough).select("doc_id")
    again = stored(rarest_first(sets.join(hot, "doc_id", "left_semi"), percent))
    links = leader_links(again, check, percent, rounds)
    heavy = cold if links is None else cold.unionByName(links)

    names = components(light.unionByName(heavy)).select(F.col("node").alias("class_id"), "component")
    found = classes.select("n", "k1", "k2", "class_id").join(names, "class_id", "left")
    # Empty sets and null ids match nothing: a key of their own spreads them over the tasks.
    spread = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("k2")).otherwise(F.xxhash64("doc_id", "th"))
    return (
        keys.withColumn("k2", spread)
        .join(found, ["n", "k1", "k2"], "left")
        .select("doc_id", F.col("th").alias("text_hash"), F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component", "class_id", "doc_id").alias("component_id"))
    )


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


SQL = {
    "op3_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0) x
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y, c = nx.n AND c = ny.n AS same FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
reach AS (SELECT x AS doc_id, min(y) AS y FROM r GROUP BY 1),
equal AS (SELECT x AS doc_id, min(y) AS y FROM l WHERE same GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(reach.y, d.doc_id)) AS component_id, least(d.doc_id, coalesce(equal.y, d.doc_id)) AS class_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN reach USING (doc_id) LEFT JOIN equal USING (doc_id)
"""
}

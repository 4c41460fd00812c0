"""Nearest neighbours by additive quantisation.

A vector is stored as one entry of each of several codebooks of full dimension; their sum is the
approximation. Codebooks are fitted on a bounded sample: k-means on residuals, then least squares
for all entries together. A beam search encodes every vector, and the ratio of its norm to that of
its approximation is stored. Queries are scored by look-up tables of their products with all
entries, and the best candidates are ranked again by exact products of the original vectors.

Queries and rows are dealt into blocks and every query block meets every row block. A block's task
holds its vectors too, so it ranks its own candidates exactly, and only the k best of a query and
block are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions, small_batches, stored, table

CODEBOOKS, ENTRIES, BEAM = 16, 256, 4
#: Vectors of the fitting sample, those of least hash; the only bound on what fitting sees.
SAMPLE = 16_384
#: Rows and queries that are scored against each other in one task, which holds both.
ROW_BLOCK, QUERY_BLOCK = 16_384, 16_384
#: Queries and rows that are scored together within a task.
QUERY_CHUNK, ROW_CHUNK = 64, 4096
#: Candidates of a query that are ranked exactly, in each row block.
RERANK = 384


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 5) -> np.ndarray:
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        of = (x @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)
        sizes = np.bincount(of, minlength=len(centres))
        order = np.argsort(of, kind="stable")
        full = np.flatnonzero(sizes)
        sums = np.add.reduceat(x[order], np.concatenate(([0], np.cumsum(sizes)))[full], axis=0)
        centres[full] = sums / sizes[full, None]
        empty = np.flatnonzero(sizes == 0)
        centres[empty] = x[rng.integers(0, len(x), len(empty))]
    return centres


class Codebooks:
    """books: codebooks x entries x dimensions."""

    def __init__(self, books: np.ndarray, beam: int = BEAM):
        self.books, self.beam = books, beam
        self.squares = (books * books).sum(2)

    @classmethod
    def fit(cls, x: np.ndarray, codebooks: int = CODEBOOKS, entries: int = ENTRIES, beam: int = BEAM, seed: int = 7) -> Codebooks:
        rng = np.random.default_rng(seed)
        x = x.astype(np.float32)
        entries = min(entries, len(x))
        rest, books = x.copy(), []
        for _ in range(codebooks):
            c = kmeans(rest, entries, rng)
            rest -= c[(rest @ c.T - 0.5 * (c * c).sum(1)).argmax(1)]
            books.append(c)
        found = cls(np.stack(books), beam)
        # With the codes of a beam search given, the best entries of all codebooks together are a least-squares problem.
        codes, _ = found.encode(x)
        used = (codes.astype(np.int64) + entries * np.arange(codebooks)).ravel()
        size = codebooks * entries
        gram = np.zeros((size, size), np.float32)
        for i in range(codebooks):
            for j in range(codebooks):
                gram[i * entries : (i + 1) * entries, j * entries : (j + 1) * entries] = np.bincount(codes[:, i].astype(np.int64) * entries + codes[:, j], minlength=entries * entries).reshape(entries, entries)
        right = np.zeros((size, x.shape[1]), np.float32)
        np.add.at(right, used, np.repeat(x, codebooks, axis=0))
        start = found.books.reshape(size, -1)
        ridge = 1.0
        move = np.linalg.solve(gram + ridge * np.eye(size, dtype=np.float32), right - gram @ start)
        return cls((start + move).reshape(found.books.shape).astype(np.float32), beam)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the ratio of each vector's norm to that of its approximation."""
        x = x.astype(np.float32)
        m, k, d = self.books.shape
        codes_of, ratios = np.zeros((len(x), m), np.uint8), np.ones(len(x), np.float32)
        for at in range(0, len(x), 256):
            part = x[at : at + 256]
            n = np.arange(len(part))
            rest = part[:, None, :]  # of each path of the beam, what its entries leave
            error = (part * part).sum(1, keepdims=True)
            codes = np.zeros((len(part), 1, 0), np.uint8)
            for b in range(m):
                # |rest - c|^2 = |rest|^2 - 2 rest.c + |c|^2
                cost = (rest.reshape(-1, d) @ (-2 * self.books[b].T)).reshape(len(part), -1, k)
                cost += self.squares[b]
                cost += error[:, :, None]
                flat = cost.reshape(len(part), -1)
                best = np.empty((len(part), min(self.beam, flat.shape[1])), np.int64)
                error = np.empty(best.shape, np.float32)
                for i in range(best.shape[1]):
                    best[:, i] = flat.argmin(1)
                    error[:, i] = flat[n, best[:, i]]
                    flat[n, best[:, i]] = np.inf
                path, entry = best // k, best % k
                rest = np.take_along_axis(rest, path[:, :, None], 1) - self.books[b][entry]
                codes = np.concatenate([np.take_along_axis(codes, path[:, :, None], 1), entry[:, :, None].astype(np.uint8)], axis=2)
            chosen = codes[:, 0]  # the first path is the best one
            near = sum(self.books[b][chosen[:, b]] for b in range(m))
            norm = np.sqrt((near * near).sum(1))
            codes_of[at : at + 256] = chosen
            np.divide(np.sqrt((part * part).sum(1)), norm, out=ratios[at : at + 256], where=norm > 0)
        return codes_of, ratios

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Products of each entry of each codebook with each query: codebooks x entries x queries."""
        return self.books @ queries.astype(np.float32).T

    @staticmethod
    def scores(tables: np.ndarray, codes: np.ndarray, ratios: np.ndarray) -> np.ndarray:
        """Approximate inner products, queries x rows, by one look-up a codebook; a look-up fetches those of all queries."""
        total = tables[0][codes[:, 0]]
        for b in range(1, len(tables)):
            total += tables[b][codes[:, b]]
        total *= ratios[:, None]
        return np.ascontiguousarray(total.T)


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(vectors.flatten()).astype(np.float32).reshape(-1, dims)


def index(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, codes, ratio and packed (the components as 32-bit floats) of every vector (vec_id, embedding)."""
    dims = books.books.shape[2]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dims)
            codes, ratios = books.encode(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(ratios, pa.float32()), pa.array([v.tobytes() for v in x], pa.binary())], ["vec_id", "codes", "ratio", "packed"]
            )

    return vectors.select("vec_id", "embedding").mapInArrow(encode, "vec_id long, codes binary, ratio float, packed binary")


def one_each(vectors: DataFrame) -> DataFrame:
    """One row a vec_id: of several the greatest vector, compared from the first component on."""
    return vectors.groupBy("vec_id").agg(F.max("embedding").alias("embedding"))


def fitted(vectors: DataFrame, sample: int = SAMPLE) -> Codebooks | None:
    ids = vectors.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    rows = one_each(vectors.join(F.broadcast(ids), "vec_id")).select("embedding").toPandas()  # as many as ids at most
    if not len(rows):
        return None
    dims = rows["embedding"].map(len).mode()[0]
    return Codebooks.fit(np.stack([np.asarray(e, np.float32) for e in rows["embedding"] if len(e) == dims]))


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, in order of place; of equal ones the first."""
    if len(scores) <= k:
        return np.arange(len(scores))
    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > edge)
    return np.sort(np.concatenate([above, np.flatnonzero(scores == edge)[: k - len(above)]]))


def candidates(books: Codebooks, queries: np.ndarray, own: np.ndarray, codes: np.ndarray, ratios: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of the rows that score highest for each query, as many as most; own is the place that is none, or -1.

    Rows pass in chunks; what is below a query's worst candidate so far is passed over.
    """
    tables = books.tables(queries)
    places = [np.zeros(0, np.int64) for _ in queries]
    found = [np.zeros(0, np.float32) for _ in queries]
    least = np.full(len(queries), -np.inf, np.float32)
    for at in range(0, len(codes), ROW_CHUNK):
        near = books.scores(tables, codes[at : at + ROW_CHUNK], ratios[at : at + ROW_CHUNK])
        mine = np.flatnonzero((own >= at) & (own < at + near.shape[1]))
        near[mine, own[mine] - at] = -np.inf
        for q in range(len(queries)):
            more = np.flatnonzero(near[q] > least[q])
            if len(more):
                places[q], found[q] = np.concatenate([places[q], more + at]), np.concatenate([found[q], near[q, more]])
                if len(found[q]) > most:
                    keep = best_of(found[q], most)
                    places[q], found[q] = places[q][keep], found[q][keep]
                    least[q] = found[q].min()
    return places


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 20, rerank: int = RERANK, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k vectors of largest inner product for each query: query_id, rank, vec_id, score.

    vectors and queries have vec_id (long) and embedding (array of float); a query's own vec_id is
    no candidate. The score is the inner product of the original vectors in double precision,
    summed from the first component on; ties go to the smaller vec_id. Vectors that are null,
    zero, of another length than most, or hold null or non-finite components take no part, nor
    do null ids. Rows that repeat a vec_id are one vector, the greatest of them as arrays compare.
    Other columns are ignored. Without vectors or queries the result is empty.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    vectors, queries = (d.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")).filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()) for d in (vectors, queries))
    books = fitted(vectors)
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = books.books.shape[2]
    rows, asked = (one_each(d.filter(F.size("embedding") == dims)) for d in (vectors, queries))
    coded = stored(index(rows, books))
    row_blocks = -(-coded.count() // row_block) or 1
    query_blocks = -(-asked.count() // query_block) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = coded.withColumn("rb", F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)).cast("int")).withColumn("qb", every(query_blocks))
    right = asked.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")).withColumn("rb", every(row_blocks))

    def score(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        ids = rows["vec_id"].to_numpy()
        whole = lambda c, kind: np.frombuffer(b"".join(rows[c]), kind).reshape(len(rows), -1)
        codes, x, ratios = whole("codes", np.uint8), whole("packed", np.float32), rows["ratio"].to_numpy()
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for at in range(0, len(asked) if len(ids) else 0, QUERY_CHUNK):
            part = asked.iloc[at : at + QUERY_CHUNK]
            q = np.stack(part["embedding"].to_numpy())
            names = part["vec_id"].to_numpy()
            own = np.minimum(np.searchsorted(ids, names), len(ids) - 1)
            own = np.where(ids[own] == names, own, -1)
            for i, places in enumerate(candidates(books, q, own, codes, ratios, rerank)):
                products = x[places].astype(np.float64) * q[i].astype(np.float64)
                exact = np.cumsum(products, axis=1)[:, -1]  # one component after the other
                first = np.lexsort((ids[places], -exact))[:k]
                out.append((np.full(len(first), names[i]), ids[places[first]], exact[first]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    # As many tasks as there are pairs of blocks: by bytes they look small, and Spark would put them together.
    tasks = min(row_blocks * query_blocks, partitions(spark))
    left, right = (d.repartition(tasks, "rb", "qb") for d in (left, right))
    found = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInPandas(score, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))

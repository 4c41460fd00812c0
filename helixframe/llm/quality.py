"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded; gated attention, learned from the
labels of documents alone, weighs them; the weighted representation is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, documents_of, small_batches, table
from .features import byte_grams, class_sizes, distinct_words, remainder, sample_for_fitting
from .toxicity import sigmoid, threshold
from .words import Words, word_blocks

PASSAGE = 64
WIDTH, CODE, ATTENTION = 8, 16, 8
GRAM_ROWS = 1 << 14
GRAMS = (2, 4)
MEASURES = 12
#: Bounds of the fitting sample: documents of each class, and their length.
SAMPLE_ROWS, SAMPLE_CHARS = 1500, 20_000
EPOCHS, BATCH = 5, 32
#: A document counts as good from this score on.
CUT = 0.7

_KINDS = np.zeros((5, 256), bool)
_KINDS[0, 65:91] = True  # capitals
_KINDS[1, 48:58] = True  # digits
_KINDS[2, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True  # marks
_KINDS[3, [ord(c) for c in ".,;:?'\""]] = True  # ordinary punctuation
_KINDS[4, 128:] = True  # beyond ASCII


def passages(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Of each passage of a block its row and first word; the last of a row may be short."""
    n = np.diff(w.first)
    count = -(-n // PASSAGE)
    row = np.repeat(np.arange(len(n)), count)
    return row, w.first[row] + (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * PASSAGE


def measures(w: Words, of: np.ndarray, row: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Plain numbers of each passage: sizes, shares of kinds of characters, repetition within it and before it."""
    last = np.minimum(first + PASSAGE, w.first[row + 1])
    n = (last - first).astype(np.float64)
    data = np.frombuffer(w.data, np.uint8)
    begin, end = w.starts[first], w.ends[last - 1]
    kinds = [np.concatenate(([0], np.cumsum(k[data]))) for k in _KINDS]
    size = (end - begin).astype(np.float64)
    shares = [(k[end] - k[begin]) / size for k in kinds]
    length = w.ends - w.starts
    sizes = np.add.reduceat(length, first).astype(np.float64)
    owner = np.repeat(np.arange(len(w.rows)), np.diff(w.first))
    distinct = int(of.max()) + 1

    def fresh(group: np.ndarray) -> np.ndarray:
        """Of each passage the share of words that their group (passage or row) has not had before."""
        _, at = np.unique(group * distinct + of, return_index=True)
        new = np.zeros(len(of))
        new[at] = 1
        return np.add.reduceat(new, first) / n

    passage = np.repeat(np.arange(len(row)), last - first)
    pair = np.append((of[1:] == of[:-1]) & (owner[1:] == owner[:-1]), False).astype(np.float64)
    hard = np.frombuffer(w.data, np.uint8)[w.ends - 1]
    odd_end = (_KINDS[2][hard] & ~_KINDS[3][hard]).astype(np.float64)
    # Sentences and lines: a line ends where white space behind a word holds a line feed.
    after = np.minimum(w.ends, len(data) - 1)
    breaks = (data[after] == 10).astype(np.float64)
    columns = [np.log1p(n) - 3, sizes / n / 8, *shares, fresh(passage), fresh(owner), np.add.reduceat(pair, first) / n, np.add.reduceat(odd_end, first) / n, np.add.reduceat(breaks, first) / n]
    return np.stack(columns, axis=1).astype(np.float32)


class Attention:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        r = lambda *s, scale: (rng.normal(size=s) * scale).astype(np.float32)
        self.p = {
            "grams": r(GRAM_ROWS, WIDTH, scale=0.1),
            "enc": r(MEASURES + WIDTH, CODE, scale=0.3),
            "enc_b": np.zeros(CODE, np.float32),
            "v": r(CODE, ATTENTION, scale=0.3),
            "u": r(CODE, ATTENTION, scale=0.3),
            "a": r(ATTENTION, scale=0.3),
            "out": r(CODE, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        self.mean, self.scale, self.shift = np.zeros(MEASURES, np.float32), np.ones(MEASURES, np.float32), 0.0

    def inputs(self, w: Words) -> tuple[np.ndarray, np.ndarray, tuple]:
        row, first = passages(w)
        _, places, of = distinct_words(w)
        grams, begin = byte_grams(w, places, GRAMS)
        grams = (grams % np.uint64(GRAM_ROWS)).astype(np.int64)
        share = (1 / np.diff(begin)).astype(np.float32)
        words = np.add.reduceat(self.p["grams"][grams], begin[:-1], axis=0) * share[:, None]
        n = np.diff(np.append(first, w.first[-1])).astype(np.float32)
        mean = np.add.reduceat(words[of], first, axis=0) / n[:, None]
        plain = (measures(w, of, row, first) - self.mean) / self.scale
        return row, np.concatenate([np.clip(plain, -6, 6), 4 * mean], axis=1), (first, of, grams, begin, share, n)

    def forward(self, row: np.ndarray, x: np.ndarray):
        """Logits of the rows that have passages, in their order."""
        code = np.tanh(x @ self.p["enc"] + self.p["enc_b"])
        v, u = np.tanh(code @ self.p["v"]), sigmoid(code @ self.p["u"])
        begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        of = np.cumsum(np.r_[True, row[1:] != row[:-1]]) - 1
        e = np.exp(np.clip((v * u) @ self.p["a"], -30, 30))
        a = e / np.add.reduceat(e, begin)[of]
        pooled = np.add.reduceat(a[:, None] * code, begin, axis=0)
        return pooled @ self.p["out"] + self.p["bias"][0], (code, v, u, begin, of, a, pooled)

    def backward(self, d: np.ndarray, x: np.ndarray, kept: tuple) -> tuple[dict, np.ndarray]:
        code, v, u, begin, of, a, pooled = kept
        dp = d[:, None] * self.p["out"]
        da = (code * dp[of]).sum(1)
        de = a * (da - np.add.reduceat(a * da, begin)[of])
        dv, du = de[:, None] * self.p["a"] * u * (1 - v * v), de[:, None] * self.p["a"] * v * u * (1 - u)
        dcode = (a[:, None] * dp[of] + dv @ self.p["v"].T + du @ self.p["u"].T) * (1 - code * code)
        grad = {"out": pooled.T @ d, "bias": np.array([d.sum()]), "a": (v * u).T @ de, "v": code.T @ dv, "u": code.T @ du, "enc": x.T @ dcode, "enc_b": dcode.sum(0)}
        return grad, dcode @ self.p["enc"].T

    def scores(self, w: Words) -> np.ndarray:
        result = np.full(len(w.rows), np.nan, np.float32)
        if len(w.hashes):
            row, x, _ = self.inputs(w)
            result[np.unique(row)] = self.forward(row, x)[0]
        return result - np.float32(self.shift)


def fit(texts: list[str], labels: np.ndarray, priors: tuple[int, int], *, epochs: int = EPOCHS, seed: int = 5) -> Attention:
    net, rng = Attention(seed), np.random.default_rng(seed)
    everything = pa.array(texts, pa.string())
    plain = [measures(w, distinct_words(w)[2], *passages(w)) for w in word_blocks(everything) if len(w.hashes)]
    if plain:
        all_ = np.concatenate(plain)
        net.mean, net.scale = all_.mean(0), all_.std(0) + np.float32(1e-3)
    squares = {k: np.full_like(v, 1e-6) for k, v in net.p.items()}
    balance = {k: 0.5 * len(labels) / max(1, (labels == k).sum()) for k in (0, 1)}
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            for w in word_blocks(pa.array([texts[i] for i in chosen], pa.string())):
                if not len(w.hashes):
                    continue
                row, x, (first, of, grams, begin, share, n) = net.inputs(w)
                logits, kept = net.forward(row, x)
                target = labels[chosen[w.rows[np.unique(row)]]].astype(np.float32)
                d = ((1 / (1 + np.exp(-logits)) - target) * np.where(target > 0, balance[1], balance[0]) / len(target)).astype(np.float32)
                grad, dx = net.backward(d, x, kept)
                for name, g in grad.items():
                    squares[name] += g * g
                    net.p[name] -= (0.05 * g / np.sqrt(squares[name])).astype(np.float32)
                # Each word takes its share of its passages' gradient, each n-gram of its words'.
                per_word = np.repeat(4 * dx[:, MEASURES:] / n[:, None], n.astype(np.int64), axis=0)
                by = np.argsort(of, kind="stable")
                per_distinct = np.add.reduceat(per_word[by], np.flatnonzero(np.r_[True, np.diff(of[by]) != 0]), axis=0)
                g = np.repeat(per_distinct * share[:, None], np.diff(begin), axis=0)
                by = np.argsort(grams, kind="stable")
                edge = np.flatnonzero(np.r_[True, np.diff(grams[by]) != 0])
                rows, g = grams[by][edge], np.add.reduceat(g[by], edge, axis=0)
                squares["grams"][rows] += g * g
                net.p["grams"][rows] -= 0.05 * g / np.sqrt(squares["grams"][rows])
    net.shift = threshold(np.concatenate([net.scores(w) for w in word_blocks(everything)]), labels, priors) - float(np.log(CUT / (1 - CUT)))
    return net


def quality(docs: DataFrame, labels: DataFrame, *, learn: Column | None = None) -> DataFrame:
    """One row per document: doc_id, score (0 to 1, higher: likelier good; good from CUT on).

    labels has doc_id and quality (0 or 1; null: none). Only labelled documents for which learn
    holds are fitted on, at most SAMPLE_ROWS of each class. Texts without words, null ones too,
    score 0. If one class has no examples, every other text scores 1. Repeated rows are scored
    alike; other columns are ignored.
    """
    learn = F.lit(True) if learn is None else learn
    small_batches(docs.sparkSession)
    sample = sample_for_fitting(docs, labels, "quality", learn, rows=SAMPLE_ROWS, chars=SAMPLE_CHARS)
    if sample["label"].nunique() < 2:
        return documents_of(docs).select("doc_id", F.when(F.col("text").rlike(WORD), 1.0).otherwise(0.0).alias("score"))
    net = fit(sample["text"].tolist(), sample["label"].to_numpy(), class_sizes(labels, "quality", learn))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size, under a MB

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full(len(batch), np.nan)
            for w in word_blocks(batch.column(1)):
                found[w.rows] = shared.value.scores(w)
            p = np.where(np.isnan(found), 0.0, 1 / (1 + np.exp(-np.clip(np.nan_to_num(found), -60, 60))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])

    return documents_of(docs).mapInArrow(score, "doc_id long, score double")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = remainder(F.col("doc_id"), 4)
    scored = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=fold != 2)
    return scored.select("doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))

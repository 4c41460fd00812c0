"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Its inputs are words and their characters: a hashed embedding of each word beside the mean of
hashed embeddings of its byte n-grams. It reads windows of words that overlap by half, over the
whole text; a text is as toxic as its most toxic window. It is trained in numpy on a bounded
sample of labelled documents, whose label is that of the text: windows weigh in by how toxic the
network finds them so far.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents_of, small_batches, table
from .features import byte_grams, class_sizes, distinct_words, remainder, sample_for_fitting
from .words import Words, word_blocks

WINDOW, STRIDE = 32, 16
HIDDEN, WIDTH, ATTENTION = 8, 8, 8
WORD_ROWS, GRAM_ROWS = 1 << 14, 1 << 15
GRAMS = (3, 5, 7)
#: Bounds of the fitting sample: documents of each class, and their length.
SAMPLE_ROWS, SAMPLE_CHARS = 1200, 12_000
EPOCHS, BATCH = 6, 24
#: Small samples are gone through more often, until there were so many steps.
STEPS_LEAST, EPOCHS_MOST = 240, 40
#: Windows scored together.
CHUNK = 4096


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(x * np.float32(0.5)) + np.float32(1))


class Network:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        r = lambda *s, scale: (rng.normal(size=s) * scale).astype(np.float32)
        h, d = HIDDEN, 2 * WIDTH
        self.p = {
            "words": r(WORD_ROWS, WIDTH, scale=0.1),
            "grams": r(GRAM_ROWS, WIDTH, scale=0.1),
            "att": r(2 * h, ATTENTION, scale=0.5),
            "att_v": r(ATTENTION, scale=0.5),
            "out": r(2 * h, scale=0.5),
            "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.p |= {f"in_{side}": r(d, 3 * h, scale=0.4), f"in_bias_{side}": np.zeros(3 * h, np.float32), f"zr_{side}": r(h, 2 * h, scale=0.3), f"c_{side}": r(h, h, scale=0.3)}
        self.shift = 0.0

    # Inputs: one row a distinct word, the last row is padding.
    def inputs(self, w: Words, places: np.ndarray) -> tuple[np.ndarray, tuple]:
        rows = (w.hashes[places] % np.uint64(WORD_ROWS)).astype(np.int64)
        grams, begin = byte_grams(w, places, GRAMS)
        grams = (grams % np.uint64(GRAM_ROWS)).astype(np.int64)
        share = (1 / np.diff(begin)).astype(np.float32)
        mean = np.add.reduceat(self.p["grams"][grams], begin[:-1], axis=0) * share[:, None]
        return np.concatenate([self.p["words"][rows], 4 * mean], axis=1), (rows, grams, begin, share)

    def gates(self, x: np.ndarray, side: str) -> np.ndarray:
        g = x @ self.p[f"in_{side}"] + self.p[f"in_bias_{side}"]
        return np.concatenate([g, np.zeros((1, g.shape[1]), np.float32)])

    def run(self, gates: np.ndarray, index: np.ndarray, mask: np.ndarray, side: str, keep: bool = False):
        """Hidden states (steps, windows, hidden) of one direction; index and mask: (steps, windows)."""
        h3, steps = HIDDEN, range(len(index)) if side == "f" else range(len(index) - 1, -1, -1)
        zr, c = self.p[f"zr_{side}"], self.p[f"c_{side}"]
        state = np.zeros((index.shape[1], h3), np.float32)
        states, trace = np.empty((*index.shape, h3), np.float32), []
        for t in steps:
            g = gates[index[t]]
            both = sigmoid(g[:, : 2 * h3] + state @ zr)
            z, r = both[:, :h3] * mask[t][:, None], both[:, h3:]
            rh = r * state
            new = np.tanh(g[:, 2 * h3 :] + rh @ c)
            if keep:
                trace.append((t, both, new, state, rh))
            state = state + z * (new - state)
            states[t] = state
        return states, trace

    def forward(self, gf: np.ndarray, gb: np.ndarray, index: np.ndarray, keep: bool = False):
        """Logits of windows; index (windows, steps) into the gates, whose last row is padding."""
        index = np.ascontiguousarray(index.T)
        mask = (index < len(gf) - 1).astype(np.float32)
        (f, tf), (b, tb) = self.run(gf, index, mask, "f", keep), self.run(gb, index, mask, "b", keep)
        states = np.concatenate([f, b], axis=2)
        u = np.tanh(states @ self.p["att"])
        e = np.exp(u @ self.p["att_v"]) * mask
        a = e / e.sum(0)
        pooled = (a[:, :, None] * states).sum(0)
        return pooled @ self.p["out"] + self.p["bias"][0], (index, mask, states, u, a, pooled, tf, tb)

    def backward(self, d: np.ndarray, kept: tuple, n_inputs: int) -> tuple[dict, np.ndarray, np.ndarray]:
        """Gradients for logit gradients d: of parameters, and of the gates of either direction."""
        index, mask, states, u, a, pooled, tf, tb = kept
        grad = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        dp = d[:, None] * self.p["out"]
        da = (states * dp).sum(2)
        de = a * (da - (a * da).sum(0))
        du = de[:, :, None] * self.p["att_v"] * (1 - u * u)
        flat = states.reshape(-1, states.shape[2])
        grad["att_v"] = (de[:, :, None] * u).sum((0, 1))
        grad["att"] = flat.T @ du.reshape(-1, ATTENTION)
        ds = a[:, :, None] * dp + du @ self.p["att"].T
        out = []
        for side, trace, part in (("f", tf, ds[:, :, :HIDDEN]), ("b", tb, ds[:, :, HIDDEN:])):
            zr, c = self.p[f"zr_{side}"], self.p[f"c_{side}"]
            gzr, gc = np.zeros_like(zr), np.zeros_like(c)
            dg = np.zeros((n_inputs + 1, 3 * HIDDEN), np.float32)
            dh = np.zeros_like(part[0])
            for t, both, new, state, rh in reversed(trace):
                dh = dh + part[t]
                m = mask[t][:, None]
                z, r = both[:, :HIDDEN] * m, both[:, HIDDEN:]
                dnew = dh * z * (1 - new * new)
                drh = dnew @ c.T
                dz = dh * (new - state) * m * both[:, :HIDDEN] * (1 - both[:, :HIDDEN])
                dr = drh * state * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                gzr += state.T @ dzr
                gc += rh.T @ dnew
                np.add.at(dg, index[t], np.concatenate([dzr, dnew], axis=1))
                dh = dh * (1 - z) + drh * r + dzr @ zr.T
            grad[f"zr_{side}"], grad[f"c_{side}"] = gzr, gc
            out.append(dg[:-1])
        return grad, out[0], out[1]

    def scores(self, w: Words) -> np.ndarray:
        """Logit of each row of a block: that of its most toxic window; of no words, NaN."""
        result = np.full(len(w.rows), np.nan, np.float32)
        if not len(w.hashes):
            return result
        _, places, of = distinct_words(w)
        x, _ = self.inputs(w, places)
        gf, gb = self.gates(x, "f"), self.gates(x, "b")
        row, index = window_index(w, of, len(places))
        logits = np.concatenate([self.forward(gf, gb, index[i : i + CHUNK])[0] for i in range(0, len(index), CHUNK)])
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        result[row[first]] = np.maximum.reduceat(logits, first)
        return result - np.float32(self.shift)


def window_index(w: Words, of: np.ndarray, padding: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all overlapping windows of a block: the row of each, and the distinct word at each step."""
    n = np.diff(w.first)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(n)), count)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    place = w.first[row][:, None] + start[:, None] + np.arange(WINDOW)
    inside = place < w.first[row + 1][:, None]
    return row, np.where(inside, of[np.minimum(place, len(of) - 1)], padding)


def fit(texts: list[str], labels: np.ndarray, priors: tuple[int, int], *, epochs: int = EPOCHS, seed: int = 3) -> Network:
    """Trains on documents with their labels; priors: how many of either class there are, to set the threshold."""
    net, rng = Network(seed), np.random.default_rng(seed)
    squares = {k: np.full_like(v, 1e-6) for k, v in net.p.items()}

    def move(name: str, g: np.ndarray, rate: float, rows: np.ndarray | None = None) -> None:
        if rows is None:
            squares[name] += g * g
            net.p[name] -= rate * g / np.sqrt(squares[name])
        else:
            squares[name][rows] += g * g
            net.p[name][rows] -= rate * g / np.sqrt(squares[name][rows])

    def summed(rows: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(rows, kind="stable")
        first = np.flatnonzero(np.r_[True, rows[order][1:] != rows[order][:-1]])
        return rows[order][first], np.add.reduceat(g[order], first, axis=0)

    balance = {k: 0.5 * len(labels) / max(1, (labels == k).sum()) for k in (0, 1)}
    epochs = max(epochs, min(EPOCHS_MOST, STEPS_LEAST * BATCH // max(1, len(texts))))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        sharp = 0.5 + 2.5 * min(1, 1.5 * epoch / epochs)
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            for w in word_blocks(pa.array([texts[i] for i in chosen], pa.string()), lower=True):
                if not len(w.hashes):
                    continue
                target = labels[chosen[w.rows]].astype(np.float32)
                _, places, of = distinct_words(w)
                x, (rows, grams, begin, share) = net.inputs(w, places)
                gf, gb = net.gates(x, "f"), net.gates(x, "b")
                row, index = window_index(w, of, len(places))
                logits, _ = net.forward(gf, gb, index)
                # The windows that speak for each document, most toxic first; a few carry the gradient.
                rank = np.lexsort((-logits, row))
                within = np.arange(len(row)) - np.searchsorted(row[rank], row[rank])
                top = rank[within < 6]
                weight = np.exp(np.minimum(sharp * (logits[top] - logits.max()), 0)) + 1e-12
                total = np.bincount(row[top], weight, len(w.rows))
                weight = (weight / total[row[top]]).astype(np.float32)
                some, kept = net.forward(gf, gb, index[top], keep=True)
                doc = np.bincount(row[top], weight * some, len(w.rows))
                error = (1 / (1 + np.exp(-doc)) - target) * np.where(target > 0, balance[1], balance[0])
                d = (error[row[top]] * weight).astype(np.float32) / len(w.rows)
                grad, df, db = net.backward(d, kept, len(places))
                dx = np.zeros_like(x)
                for side, dg in (("f", df), ("b", db)):
                    grad[f"in_{side}"], grad[f"in_bias_{side}"] = x.T @ dg, dg.sum(0)
                    dx += dg @ net.p[f"in_{side}"].T
                for name, g in grad.items():
                    move(name, g.astype(np.float32), 0.04)
                r, g = summed(rows, dx[:, :WIDTH])
                move("words", g, 0.15, r)
                r, g = summed(grams, np.repeat(4 * dx[:, WIDTH:] * share[:, None], np.diff(begin), axis=0))
                move("grams", g, 0.15, r)
    net.shift = threshold(np.concatenate([net.scores(w) for w in word_blocks(pa.array(texts, pa.string()), lower=True)]), labels, priors)
    return net


def threshold(logits: np.ndarray, labels: np.ndarray, priors: tuple[int, int]) -> float:
    """Where the fewest rows fall on the wrong side, each class counted as often as it occurs."""
    real = np.isfinite(logits)
    logits, labels = logits[real], labels[real]
    if not len(logits) or labels.min() == labels.max():
        return 0.0
    weight = np.where(labels == 1, priors[1] / (labels == 1).sum(), priors[0] / (labels == 0).sum())
    order = np.argsort(logits)
    wrong = np.cumsum(np.where(labels[order] == 1, weight[order], -weight[order]))
    wrong = np.concatenate(([0], wrong)) + weight[labels == 0].sum()
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    edges = np.concatenate(([logits[order[0]] - 1], logits[order], [logits[order[-1]] + 1]))
    middle = best[len(best) // 2]
    return float((edges[middle] + edges[middle + 1]) / 2)


def score_documents(docs: DataFrame, net: Network, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text, and the columns to carry (text among them with null as empty)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size, a few MB

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full(len(batch), np.nan)
            for w in word_blocks(batch.column(1), lower=True):
                found[w.rows] = shared.value.scores(w)
            p = np.where(np.isnan(found), 0.0, 1 / (1 + np.exp(-np.clip(np.nan_to_num(found), -60, 60))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), *[batch.column(k) for k in kept]], ["doc_id", "score", *[batch.schema.names[k] for k in kept]])

    docs = documents_of(docs, *[c for c in carry if c != "text"])
    kept = [1] if "text" in carry else []
    kept += range(2, len(docs.columns))
    fields = [docs.schema["doc_id"], T.StructField("score", T.DoubleType()), *[docs.schema.fields[k] for k in kept]]
    return docs.mapInArrow(score, T.StructType(fields))


def toxicity(docs: DataFrame, labels: DataFrame, *, learn: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, score (0 to 1, higher: likelier toxic), and the columns to carry.

    labels has doc_id and toxic (0 or 1; null: none). Only labelled documents for which learn
    holds are fitted on, at most SAMPLE_ROWS of each class. Texts without words, null ones too,
    score 0. If one class has no examples, every text scores 0. Repeated rows are scored alike;
    other columns are ignored.
    """
    learn = F.lit(True) if learn is None else learn
    sample = sample_for_fitting(docs, labels, "toxic", learn, rows=SAMPLE_ROWS, chars=SAMPLE_CHARS)
    if sample["label"].nunique() < 2:
        return documents_of(docs, *[c for c in carry if c != "text"]).select("doc_id", F.lit(0.0).alias("score"), *carry)
    net = fit(sample["text"].tolist(), sample["label"].to_numpy(), class_sizes(labels, "toxic", learn))
    return score_documents(docs, net, carry)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = remainder(F.col("doc_id"), 5)
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=fold != 0)
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

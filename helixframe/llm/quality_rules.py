"""Quality rules as a learned decision list.

Counts of a text give measures that people can read (share of symbols, of repeated words, ...).
Sequential covering learns an ordered list of rules from labelled measures: a conjunction of
thresholds is grown on two thirds of the rows that no rule covers yet, pruned on the last third,
and taken if it is precise enough; what it covers is set aside. Rules of either verdict compete for the next
place. The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents_of, small_batches, table
from .features import labels_of, remainder
from .words import _SPACE, Words, gram_hashes, mixed, word_blocks, word_hashes

#: A text fails the base rules with fewer words, or if more than this share (percent) of its words repeat.
LEAST_WORDS, REPEAT_PERCENT = 50, 50
REPEAT = 3
#: Bound of the fitting sample: labelled documents of each class, of which the measures go to the driver.
SAMPLE_ROWS = 10_000
#: Most rules, most conditions of one, least precision (percent, Laplace estimate) of a rule, and least number of rows it covers.
RULES, CONDITIONS, PRECISION, COVER = 24, 4, 90, 8

#: What is counted in a text; the first five are those of the base rules and their report.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_pairs", "n_lines", "n_capitals", "n_digits", "n_marks", "n_odd_ends"]

#: Measures that rules ask for, as SQL over the counts.
MEASURES = {
    "words": "CAST(n_words AS DOUBLE)",
    "chars_per_word": "coalesce(try_divide(word_chars, n_words), 0D)",
    "words_per_line": "coalesce(try_divide(n_words, n_lines), 0D)",
    "symbols_per_word": "coalesce(try_divide(n_symbols, n_words), 0D)",
    "repeated_lines": "coalesce(try_divide(n_dup_lines, n_lines), 0D)",
    "repeated_words": "coalesce(try_divide(n_repeat_words, n_words), 0D)",
    "distinct_words": "coalesce(try_divide(n_distinct, n_words), 0D)",
    "doubled_words": "coalesce(try_divide(n_pairs, n_words), 0D)",
    "capitals": "coalesce(try_divide(n_capitals, word_chars), 0D)",
    "digits": "coalesce(try_divide(n_digits, word_chars), 0D)",
    "marks": "coalesce(try_divide(n_marks, word_chars), 0D)",
    "odd_ends": "coalesce(try_divide(n_odd_ends, n_words), 0D)",
}


def _bytes(found) -> np.ndarray:
    kind = np.zeros(256, bool)
    kind[[*found]] = True
    return kind


_SYMBOL = _bytes(b"#*$%&|<>")
_CAPITAL, _DIGIT = _bytes(range(65, 91)), _bytes(range(48, 58))
_MARK = _bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
_ODD = _MARK & ~_bytes(b".,;:?'\")")
#: First bytes of code points other than white space.
_BLACK = ~_SPACE & ~_bytes(range(128, 192))


def first_seen(owner: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Of each row, how many different hashes it has."""
    _, at = np.unique(mixed(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(owner[at], minlength=rows)


def counts_of(w: Words) -> np.ndarray:
    """The COUNTS of each row of a block, a row each. Words and lines are equal when their 64-bit hashes are."""
    rows, n = len(w.rows), np.diff(w.first)
    data, owner = np.frombuffer(w.data, np.uint8), np.repeat(np.arange(rows), n)

    def characters(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(kind[data])))
        return total[w.at[1:]] - total[w.at[:-1]]

    # Windows of words that their row has twice or more: all words they cover.
    covered = np.zeros(len(owner), bool)
    if len(owner) >= REPEAT:
        within = np.flatnonzero(owner[REPEAT - 1 :] == owner[: len(owner) - REPEAT + 1])
        _, which, times = np.unique(mixed(gram_hashes(w.hashes, REPEAT)[within] + owner[within].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
        again = within[times[which] > 1]
        for k in range(REPEAT):
            covered[again + k] = True
    pair = (w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1])
    # Lines begin with the row and after each line feed.
    feeds = np.flatnonzero(data == 10)
    begin = np.concatenate((w.at[:-1], feeds + 1))
    of = np.concatenate((np.arange(rows), np.searchsorted(w.at, feeds, "right") - 1))
    order = np.lexsort((begin, of))
    begin, of = begin[order], of[order]
    end = np.minimum(np.append(feeds, len(data))[np.searchsorted(feeds, begin)], w.at[of + 1])
    worded = np.searchsorted(w.starts, begin) < np.searchsorted(w.starts, end)
    begin, end, of = begin[worded], end[worded], of[worded]
    lines = np.bincount(of, minlength=rows)
    weigh = lambda x: np.bincount(owner[: len(x)], x, rows).astype(np.int64)
    return np.stack(
        [
            n, characters(_BLACK), characters(_SYMBOL), lines - first_seen(of, word_hashes(data, begin, end), rows), weigh(covered),
            first_seen(owner, w.hashes, rows), weigh(pair), lines, characters(_CAPITAL), characters(_DIGIT), characters(_MARK), weigh(_ODD[data[w.ends - 1]] if len(owner) else covered),
        ],
        axis=1,
    ).astype(np.int64)


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the COUNTS of every text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((len(batch), len(COUNTS)), np.int64)
            for w in word_blocks(batch.column(1)):
                found[w.rows] = counts_of(w)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(found[:, k]) for k in range(len(COUNTS))]], ["doc_id", *COUNTS])

    small_batches(docs.sparkSession)
    return documents_of(docs).mapInArrow(count, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    measure: int
    above: bool  # at least the threshold, else below it
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.measure] >= self.threshold if self.above else x[:, self.measure] < self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    verdict: int
    right: int = 0  # rows of the sample that it covers when its turn comes, of its class and not
    wrong: int = 0

    def covers(self, x: np.ndarray) -> np.ndarray:
        found = np.ones(len(x), bool)
        for c in self.conditions:
            found &= c.holds(x)
        return found


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]
    default: int
    measures: tuple[str, ...]

    def condition(self, rule: Rule) -> str:
        """The rule as SQL over the measures."""
        return " AND ".join(f"{self.measures[c.measure]} {'>=' if c.above else '<'} {c.threshold!r}D" for c in rule.conditions)

    def decided(self, values: list[Column], otherwise: Column) -> Column:
        """Of the first rule that holds, its value."""
        found = None
        for rule, value in zip(self.rules, values, strict=True):
            found = F.when(F.expr(self.condition(rule)), value) if found is None else found.when(F.expr(self.condition(rule)), value)
        return otherwise if found is None else found.otherwise(otherwise)

    def verdict(self) -> Column:
        return self.decided([F.lit(r.verdict) for r in self.rules], F.lit(self.default))

    def place(self) -> Column:
        """Which rule decides, from 1; 0 for the default."""
        return self.decided([F.lit(k + 1) for k in range(len(self.rules))], F.lit(0))

    def __str__(self) -> str:
        said = [f"{k + 1}. if {self.condition(r)} then {'keep' if r.verdict else 'drop'} ({r.right} right, {r.wrong} wrong)" for k, r in enumerate(self.rules)]
        return "\n".join([*said, f"else {'keep' if self.default else 'drop'}"])


def best_condition(x: np.ndarray, y: np.ndarray) -> Condition | None:
    """The threshold with the largest information gain (FOIL) for class 1 of y, halfway between two values; None if none gains."""
    p, n = int(y.sum()), int((1 - y).sum())
    if not p or not n:
        return None
    before, best, least = np.log2(p / (p + n)), None, 1e-9
    for m in range(x.shape[1]):
        order = np.argsort(x[:, m], kind="stable")
        v = x[order, m]
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        if not len(cut):
            continue
        low = np.cumsum(y[order])[cut - 1]
        for above, right, total in ((False, low, cut), (True, p - low, len(v) - cut)):
            gain = np.where(right > 0, right * (np.log2(np.maximum(right, 1) / total) - before), 0)
            k = int(np.argmax(gain))
            if gain[k] > least:
                # Halfway, unless rounding takes it to the smaller value.
                half = (v[cut[k] - 1] + v[cut[k]]) / 2
                best, least = Condition(m, above, float(half if half > v[cut[k] - 1] else v[cut[k]])), float(gain[k])
    return best


def grown(x: np.ndarray, y: np.ndarray) -> list[Condition]:
    """Conditions added one by one while class 1 gains and another class is covered."""
    found: list[Condition] = []
    while len(found) < CONDITIONS and (c := best_condition(x, y)) is not None:
        found.append(c)
        inside = c.holds(x)
        x, y = x[inside], y[inside]
    return found


def pruned(conditions: list[Condition], x: np.ndarray, y: np.ndarray) -> list[Condition]:
    """The first conditions for which rows of class 1 outweigh the others most, as a share of those covered."""
    worth, inside = [], np.ones(len(x), bool)
    for c in conditions:
        inside &= c.holds(x)
        p, n = int(y[inside].sum()), int((1 - y)[inside].sum())
        worth.append((p - n) / (p + n) if p + n else -1.0)
    return conditions[: int(np.argmax(worth)) + 1] if worth else []


def learn_list(x: np.ndarray, y: np.ndarray, measures: tuple[str, ...] = tuple(MEASURES)) -> DecisionList:
    """The decision list of measures x and classes y (0 or 1). Deterministic; rows of one class give no rules but that default, none give default 1."""
    rng, rules = np.random.default_rng(12), []
    while len(rules) < RULES and len(set(y.tolist())) == 2:
        part = np.zeros(len(y), bool)  # rows to grow on, two thirds of each class
        for k in (0, 1):
            mine = rng.permutation(np.flatnonzero(y == k))
            part[mine[: -(-2 * len(mine) // 3)]] = True
        best, best_worth = None, (0.0, 0)
        for k in (0, 1):
            target = (y == k).astype(np.int64)
            conditions = pruned(grown(x[part], target[part]), x[~part], target[~part])
            rule = Rule(tuple(conditions), k)
            inside = rule.covers(x)
            right = int(target[inside].sum())
            rule = Rule(rule.conditions, k, right, int(inside.sum()) - right)
            precision = (right + 1) / (inside.sum() + 2)
            if conditions and inside.sum() >= COVER and 100 * precision >= PRECISION and precision > target.mean() and (precision, right) > best_worth:
                best, best_worth = rule, (precision, right)
        if best is None:
            break
        rules.append(best)
        left = ~best.covers(x)
        x, y = x[left], y[left]
    # What no rule covers goes by its larger class.
    default = int(y.mean() >= 0.5) if len(y) else rules[-1].verdict if rules else 1
    return DecisionList(tuple(rules), default, measures)


def rules_from(docs: DataFrame, labels: DataFrame, *, learn: Column | None = None, rows: int = SAMPLE_ROWS) -> DecisionList:
    """The list learned from labels.quality where learn holds: of each class at most so many documents, those whose ids have the least hash.

    Documents that fail the base rules teach nothing, as no rule ever sees them. Of rows that repeat a
    doc_id one is taken. Only ids of this bound are broadcast and only their measures reach the driver.
    """
    marked = labels_of(labels, "quality", F.lit(True) if learn is None else learn)
    parts = [marked.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    counted = text_counts(documents_of(docs).join(chosen.select("doc_id"), "doc_id", "left_semi")).filter(~base_failed())
    measured = counted.select("doc_id", *[F.expr(sql).alias(m) for m, sql in MEASURES.items()])
    found = measured.groupBy("doc_id").agg(F.max(F.struct(*MEASURES)).alias("m")).join(chosen, "doc_id").select("doc_id", "label", "m.*").toPandas().sort_values("doc_id")
    return learn_list(found[list(MEASURES)].to_numpy(np.float64), found["label"].to_numpy(np.int64))


def quality_rules(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """One row per document: doc_id, the COUNTS, base_failed, kept, and rule: which of the list decided (from 1; 0 its default, null where the base rules did).

    Null and empty texts have no words and fail the base rules. Repeated rows get equal verdicts.
    Other columns are ignored. An empty table gives an empty result.
    """
    counted = text_counts(docs).withColumn("base_failed", base_failed())
    measured = counted.withColumns({m: F.expr(sql) for m, sql in MEASURES.items()})
    found = measured.withColumns({"kept": ~F.col("base_failed") & (rules.verdict() == 1), "rule": F.when(~F.col("base_failed"), rules.place())})
    return found.select("doc_id", *COUNTS, "base_failed", "kept", "rule")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # A quarter of the labels is not learned from: the README states what the list says of it.
    rules = rules_from(docs, table(spark, sf_dir, "labels"), learn=remainder(F.col("doc_id"), 4) != 2)
    return quality_rules(docs, rules).select("doc_id", *COUNTS[:5], "base_failed", "kept", "rule")

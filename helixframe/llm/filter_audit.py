"""Filter interaction audit by inclusion-exclusion.

Filters that run one after the other hide each other's work. One aggregate counts, for every set S
of filters, the documents that fail all of S: the sum of a product of flags. All else follows from
these 32 numbers a part. Inverted over the subsets (Moebius), they give the survivors of any set of
filters, so of any prefix of any order, and what one filter alone takes away. The documents that a
set of filters removes are a game whose dividends (Harsanyi) are (-1)^(|S|+1) times the same counts;
shared out equally they are the Shapley values, without going through the orders.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, documents_of, stored, table

BLANKS = " \t\n\x0b\x0c\r"
#: Limits of the filters: least words, least share of distinct words, largest share of capitals (percent), symbols that fail.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 100, 80, 10, "[#$%&*|]"
FILTERS = "ABCDE"


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Whether a text with these words fails filter A (short), B (few distinct words), C (many capitals), D (symbols)."""
    distinct = F.size(F.array_distinct(words))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * distinct.cast("long") < DISTINCT_PERCENT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > CAPITAL_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def label_flags(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic (0 or 1): one row an id; of rows that repeat an id, any that says 1 counts."""
    of = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    return labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(of("quality").alias("good"), of("toxic").alias("toxic"))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, flags A to E (0 or 1), good, toxic, n: how many documents are alike in all of them and in their text.

    E fails where any row with the same text has a smaller doc_id. Rows are counted, never listed:
    equal rows merge in the task that reads them, so a group of copies, however large, is a few rows
    for each label, and the least id of a text is found among those. The digest of a text (SHA-256)
    stands for it. A null doc_id is neither smaller nor larger than any, and has no labels.
    """
    texts = documents_of(docs, F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")).withColumn("words", words_of(F.col("text")))
    fails = {k: v.cast("int") for k, v in text_failures(F.col("text"), F.col("words")).items()}
    rows = texts.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[v.alias(k) for k, v in fails.items()])
    known = label_flags(labels).withColumn("deal", F.lit(0).cast("long"))
    # A null doc_id meets no label: such rows are dealt by their digest.
    deal = F.when(F.col("doc_id").isNull(), F.xxhash64("digest").bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long"))
    ids = rows.groupBy("doc_id", "digest", "part", *fails).agg(F.count(F.lit(1)).alias("n")).withColumn("deal", deal)
    labelled = ids.join(known, ["doc_id", "deal"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    alike = ["digest", "part", *fails, "good", "toxic"]
    # Of each kind the least id and its rows, the rows of all ids and those without one.
    kinds = stored(
        labelled.groupBy(*alike).agg(
            F.min("doc_id").alias("least"),
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
            F.min_by("n", "doc_id").alias("n_least"),
        ),
        small=True,
    )
    firsts = kinds.groupBy("digest").agg(F.min("least").alias("first"))
    first = F.col("nameless") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    split = F.explode(F.array(F.struct(F.lit(0).alias("E"), first.alias("n")), F.struct(F.lit(1).alias("E"), (F.col("n") - first).alias("n"))))
    return kinds.join(firsts, "digest").select("part", *fails, "good", "toxic", split.alias("kind")).select("part", *fails, "kind.E", "good", "toxic", "kind.n").filter("n > 0")


def subsets(of: int) -> list[int]:
    """All sets of filters, as masks, that lie within one."""
    return [s for s in range(of + 1) if s & of == s]


def audit(rows: DataFrame, filters: Sequence[str] = FILTERS, measures: Sequence[str] = ()) -> DataFrame:
    """One row per part, order of the filters and step: filter_order, step, kept, removed, redundant, unique_fails, shapley, and <measure>_lost.

    rows have a part, a 0/1 flag for each filter (1: fails) and n, how many documents the row stands for.
    measures name further 0/1 columns: of the documents that this step removes, those that have it. kept are the documents that pass all
    filters up to this step, redundant those that fail its filter but were removed before, unique_fails
    those that fail no other; shapley is what the filter removes, summed over all orders.
    There are len(filters)! * len(filters) rows a part; without rows there is no part.
    """
    names, full, orders = list(filters), (1 << len(filters)) - 1, factorial(len(filters))
    sign = lambda s: -1 if s.bit_count() % 2 else 1
    flags = lambda s: [f"`{f}`" for i, f in enumerate(names) if s >> i & 1]
    weights = {"all": ["n"]} | {m: [f"`{m}`", "n"] for m in measures}
    sums = [f"CAST(sum({' * '.join([*flags(s), *weight])}) AS BIGINT)" for weight in weights.values() for s in range(full + 1)]
    joint = rows.groupBy("part").agg(F.expr(f"array({', '.join(sums)})").alias("joint"))
    # Stored, as what follows asks for each of these few numbers many times.
    joint = stored(joint, small=True)
    count = lambda m, s: f"joint[{list(weights).index(m) * (full + 1) + s}]"
    total = lambda terms: " + ".join(f"{k} * {c}" for k, c in terms)
    survivors = {m: [total((sign(s), count(m, s)) for s in subsets(p)) for p in range(full + 1)] for m in weights}
    # A set's dividend, shared among its filters, once for each order: orders / |S| is whole.
    shapley = [total((-sign(s) * (orders // s.bit_count()), count("all", s)) for s in range(1, full + 1) if s >> i & 1) for i in range(len(names))]
    inverted = stored(joint.select("part", "joint", F.expr(f"array({', '.join(shapley)})").alias("shapley"), *[F.expr(f"array({', '.join(a)})").alias(f"survive_{m}") for m, a in survivors.items()]), small=True)

    # The steps of all orders, a list of constants of which each part takes every one: places of the filter, of those before it and of all others, as masks.
    steps = [("".join(names[i] for i in o), k + 1, o[k], sum(1 << i for i in o[:k])) for o in permutations(range(len(names))) for k in range(len(names))]
    constants = ", ".join(f"('{order}', {step}, {f}, {before}, {before | 1 << f}, {full & ~(1 << f)}, {1 << f})" for order, step, f, before in steps)
    each = inverted.selectExpr("*", f"inline(array({constants})) AS (filter_order, step, f, before, after, others, alone)")
    return each.selectExpr(
        "part", "filter_order", "step",
        "survive_all[after] AS kept",
        "survive_all[before] - survive_all[after] AS removed",
        "joint[alone] - survive_all[before] + survive_all[after] AS redundant",
        f"survive_all[others] - survive_all[{full}] AS unique_fails",
        *[f"survive_{m}[before] - survive_{m}[after] AS {m}_lost" for m in measures],
        "shapley[f] AS shapley",
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E for each language, as in audit(), with good_lost and toxic_lost by the labels.

    Null texts count as empty (they fail A, and E if an empty text has a smaller doc_id); a null
    language is the part named by the empty string. Every row counts, also one that repeats an id:
    E asks for a smaller id, so rows of one id never fail by each other. Other columns are ignored.
    An empty table gives an empty result.
    """
    return audit(failures(docs, labels), FILTERS, ("good", "toxic"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_FAILS_BEFORE = " OR ".join(f"(instr(filter_order, '{f}') < step AND {f} = 1)" for f in FILTERS)
_FAILS_HERE = " OR ".join(f"(filter_order[step] = '{f}' AND {f} = 1)" for f in FILTERS)

SQL = {
    "op11_filter_audit": rf"""
WITH RECURSIVE l AS (SELECT doc_id, max(coalesce(CAST(quality = 1 AS INT), 0)) AS good, max(coalesce(CAST(toxic = 1 AS INT), 0)) AS toxic FROM labels GROUP BY 1),
w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CAST(len(ws) < 100 AS INT) AS A, CAST(100 * len(list_distinct(ws)) < 80 * len(ws) AS INT) AS B,
         CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS INT) AS C,
         CAST(regexp_matches(t, '[#$%&*|]') AS INT) AS D, coalesce(CAST(first < w.doc_id AS INT), 0) AS E
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id
), k AS (SELECT part, good, toxic, A, B, C, D, E, count(*) AS n FROM d GROUP BY ALL),
o(filter_order) AS (SELECT '' UNION ALL SELECT filter_order || f FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) x WHERE NOT contains(filter_order, f)),
s AS (SELECT filter_order, CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS step FROM o WHERE length(filter_order) = 5),
x AS (SELECT *, {_FAILS_BEFORE} AS gone, {_FAILS_HERE} AS fails FROM k, s),
r AS (
  SELECT part, filter_order, step,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant, coalesce(sum(n) FILTER (fails AND A + B + C + D + E = 1), 0) AS unique_fails,
         coalesce(sum(n) FILTER (NOT gone AND fails AND good = 1), 0) AS good_lost, coalesce(sum(n) FILTER (NOT gone AND fails AND toxic = 1), 0) AS toxic_lost
  FROM x GROUP BY 1, 2, 3
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley
FROM r
"""
}

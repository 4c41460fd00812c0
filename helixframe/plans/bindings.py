"""Domain views over the star-schema test tables.

Every view is a projection of one table whose expressions mean the same in Spark and in DuckDB, so
that an operator and its oracle start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: view -> (table, expressions)
VIEWS: dict[str, tuple[str, list[str]]] = {
    "v_obs": (
        "lineitem",
        [
            "concat('s', l_suppkey % 8) AS sample_name",
            "concat('sp', (l_partkey % 400) % 5) AS species_id",
            "concat('c', l_partkey % 400 % 10) AS ref_id",
            "l_partkey % 400 + 1 AS ref_pos",
            "substr('ACGT', cast(l_partkey % 4 + 1 AS int), 1) AS ref_allele",
            "substr('ACGT', cast((l_partkey + CASE WHEN l_quantity <= 35 THEN 0 WHEN l_quantity <= 45 THEN 1 WHEN l_quantity <= 48 THEN 2 ELSE 3 END) % 4 + 1 AS int), 1) AS base",
            "l_linenumber * 6 + 10 AS base_qual",
            "l_orderkey AS read_id",
        ],
    ),
    "v_aln": (
        "lineitem",
        [
            "concat('r', l_orderkey) AS query",
            "l_linenumber AS aln_no",
            "l_partkey % 180 AS target",
            "concat('sp', l_partkey % 12) AS species_id",
            "concat('B', cast((l_partkey % 180 - l_partkey % 12) / 12 AS int)) AS marker_id",
            "90.0 + round(l_discount * 100) AS pid",
            "cast(l_quantity * 3 AS int) AS aln",
            "150 AS qlen",
            "l_quantity AS score",
        ],
    ),
    "v_genes": (
        "part",
        [
            "concat('G', p_partkey % 9, '_', p_partkey) AS gene_id",
            "p_partkey - p_partkey % 2 AS c99",
            "p_partkey - p_partkey % 4 AS c95",
            "p_partkey - p_partkey % 64 AS c75",
            "201 + p_size * 30 AS gene_length",
            "CASE WHEN p_partkey % 10 < 7 THEN NULL ELSE p_brand END AS marker_id",
        ],
    ),
    "v_feat": (
        "part",
        [
            "p_partkey AS gene_id",
            "p_partkey % 20 AS contig_id",
            "cast((p_partkey - p_partkey % 20) / 20 AS int) * 150 + 1 AS start_pos",
            "cast((p_partkey - p_partkey % 20) / 20 AS int) * 150 + 1 + 200 + p_size * 3 AS end_pos",
            "CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand",
            "CASE WHEN p_partkey % 11 = 0 THEN 'tRNA' ELSE 'CDS' END AS gene_type",
        ],
    ),
    "v_hits": (
        "orders",
        ["o_orderkey AS hit_id", "o_custkey % 20 AS contig_id", "o_orderkey % 15000 + 1 AS start_pos", "o_orderkey % 15000 + 51 + o_custkey % 100 AS end_pos"],
    ),
}


def bind(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """The view; pid and other decimals are doubles."""
    name, expressions = VIEWS[view]
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet").selectExpr(*expressions)
    return df.withColumn("pid", df["pid"].cast("double")) if view == "v_aln" else df


def with_views(*names: str) -> str:
    """The head of an oracle's SQL: WITH and these views, each followed by a comma."""
    return "WITH " + "".join(f"{v} AS (SELECT {', '.join(VIEWS[v][1]).replace('90.0 + round', 'CAST(90 AS DOUBLE) + round')} FROM {VIEWS[v][0]}), " for v in names)


# ---------------------------------------------------------------- alignments

#: Bases that contigs repeat, each from another place on.
GENOME = "ACGTTGCAAGCTCATGCCGATTTAGGCAC"
#: Contigs of the made-up genome and their length.
CONTIGS, CONTIG_LENGTH = 6, 480
#: Rows are in order of contig, as in a sorted file; some names have pairs on two contigs.
#: Every order is a fragment with a forward (k = 0) and a reverse read (k = 1) of 20 bases. Some have
#: a deletion (forward), an insertion (reverse), clipped ends, or are secondary, improper or orphans.
#: Expressions over o (order), c (contig), k (mate) and i (column of the alignment).
GAP, EXTRA, CLIP = "k = 0 AND o % 9 = 4", "k = 1 AND o % 8 = 5", "k = 0 AND o % 7 = 3"
COLUMN = {
    "qpos": f"CASE WHEN {GAP} THEN CASE WHEN i < 10 THEN i WHEN i > 10 THEN i - 1 END ELSE i END",
    "rpos": f"CASE WHEN {CLIP} AND i < 2 THEN NULL WHEN {EXTRA} THEN CASE WHEN i < 5 THEN s + i WHEN i > 5 THEN s + i - 1 END ELSE s + i END",
}
START = "o * 7 % 400 + k * (o % 24)"
RBASE = f"substr('{GENOME}', cast((rpos + c * 3) % {len(GENOME)} + 1 AS int), 1)"
QBASE = f"CASE WHEN rpos IS NULL THEN 'A' WHEN (o * 31 + rpos * 17 + k * 13) % 29 = 0 THEN translate({RBASE}, 'ACGT', 'CGTA') ELSE {RBASE} END"
QUAL = "cast((o * 5 + qpos * 7 + k * 11) % 38 + 4 AS int)"
READ = {
    "sample_name": "concat('s', o % 3)",
    "species_id": "concat('sp', c % 2)",
    "ref_id": "concat('k', c)",
    "query_name": "concat('q', o - CASE WHEN o % 10 = 7 THEN 3 ELSE 0 END)",
    "is_read1": "k = 0",
    "is_reverse": "k = 1",
    "is_secondary": "o % 13 = 0",
    "is_proper_pair": "o % 17 <> 0",
    "mapping_quality": "cast(CASE WHEN o % 11 = 0 THEN 3 ELSE 42 END AS int)",
    "template_length": "cast(CASE WHEN o % 23 = 0 THEN 5000 ELSE 20 + o % 24 END AS int)",
    "is_qcfail": "o % 29 = 3",
    "is_duplicate": "(o + k) % 31 = 7",
    "row_no": "c * 2000000000 + o * 2 + k",
}


#: In DuckDB, view cols has a row an alignment column (o, c, k, i, qpos, rpos, qbase, rbase, qual), and reads all that a read is asked for but arrays.
COLS_SQL = f"""WITH cols AS (
  SELECT *, CASE WHEN qpos IS NOT NULL THEN {QBASE} END AS qbase, CASE WHEN rpos IS NOT NULL THEN {RBASE} END AS rbase, {QUAL} AS qual FROM (
    SELECT o, c, k, i, {', '.join(f'{e} AS {n}' for n, e in COLUMN.items())} FROM (
      SELECT o, c, k, i, {START} AS s FROM (SELECT o_orderkey AS o, o_custkey % {CONTIGS} AS c FROM orders) x, (SELECT unnest([0, 1]) AS k) y, (SELECT unnest(range(0, 21)) AS i) z
      WHERE NOT (k = 1 AND o % 19 = 0) AND (i < 20 OR ({GAP})))) w),
reads AS (
  SELECT o, c, k, {', '.join(f'{e} AS {n}' for n, e in READ.items())}, min(rpos) AS reference_start, max(rpos) + 1 AS reference_end,
    count(qpos) AS query_length, CASE WHEN {CLIP} THEN 2 ELSE 0 END AS query_alignment_start, 20 AS query_alignment_end,
    count(*) FILTER (rpos IS NOT NULL AND (qpos IS NULL OR qbase <> rbase)) + count(*) FILTER (rpos IS NULL AND i >= 2) AS nm, avg(qual) FILTER (qpos IS NOT NULL) AS mean_quality
  FROM cols GROUP BY o, c, k),
"""


#: Where QBASE differs from RBASE, (o * 31 + rpos * 17 + k * 13) % 29 = 0: at one rpos of any 29, this one modulo 29 (17 * 12 % 29 = 1).
DIFFERS = "pmod(-12 * pmod(o * 31 + k * 13, 29), 29)"


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments with the columns of readqc, sample_name, species_id and row_no.

    Each is made from its order, without a row an alignment column; but for orders that share a key, which are put together as
    the SQL does, nothing is shuffled. Letters, places and qualities follow COLUMN, QBASE and QUAL in closed form.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(F.col("o_orderkey").alias("o"), (F.col("o_custkey") % CONTIGS).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    mates = orders.selectExpr("*", "explode(array(0, 1)) AS k").filter("NOT (k = 1 AND o % 19 = 0)")
    # s: place of the first column; first and len: the stretch of the contig below the read; at: the letter of it that differs, if at < len.
    placed = mates.selectExpr("*", f"coalesce({GAP}, false) AS gap", f"coalesce({EXTRA}, false) AS extra", f"coalesce({CLIP}, false) AS clip", f"cast({START} AS int) AS s")
    placed = placed.selectExpr("*", "s + if(clip, 2, 0) AS first", "20 + int(gap) - int(extra) - 2 * int(clip) AS len").selectExpr("*", f"cast(pmod({DIFFERS} - first, 29) AS int) AS at")
    below = placed.selectExpr("*", f"substr('{GENOME * 2}', cast((first + c * 3) % {len(GENOME)} + 1 AS int), len) AS below")
    changed = below.selectExpr("*", "if(at < len, overlay(below PLACING translate(substr(below, at + 1, 1), 'ACGT', 'CGTA') FROM at + 1), below) AS bases")
    # Letters of all columns: A where the read alone has one; then those that the contig alone has go.
    columns = changed.selectExpr("*", "CASE WHEN clip THEN concat('AA', bases) WHEN extra THEN concat(substr(bases, 1, 5), 'A', substr(bases, 6)) ELSE bases END AS letters")
    qpos = lambda gap: F.array(*[F.lit(q).cast("int") for q in ([*range(10), None, *range(10, 20)] if gap else range(20))])
    none = F.array(F.lit(None).cast("int"))
    rpos = (
        F.when(F.col("clip"), F.concat(none, none, F.sequence(F.col("first"), F.col("first") + F.col("len") - 1)))
        .when(F.col("extra"), F.concat(F.sequence(F.col("s"), F.col("s") + 4), none, F.sequence(F.col("s") + 5, F.col("s") + 18)))
        .otherwise(F.sequence(F.col("s"), F.col("s") + F.col("len") - 1))
    )
    # QUAL has 38 possible rows of values, by (o * 5 + k * 11) % 38.
    table = F.array(*[F.array(*[F.lit((b + q * 7) % 38 + 4) for q in range(20)]) for b in range(38)])
    again = lambda values: F.when(F.col("n") == 1, values).otherwise(F.flatten(F.transform(values, lambda x: F.array_repeat(x, F.col("n").cast("int")))))
    letters = lambda text: F.when(F.col("n") == 1, text).otherwise(F.array_join(again(F.split(text, "")), ""))
    pairs = F.arrays_zip(F.when(F.col("gap"), qpos(True)).otherwise(qpos(False)).alias("qpos"), rpos.alias("rpos"))
    differing = F.expr("int(gap) + int(extra) + int(at < len AND NOT (gap AND at + if(clip, 2, 0) = 10))")
    return columns.selectExpr("*", *[f"{e} AS {n}" for n, e in READ.items()]).select(
        *READ, again(pairs).alias("aligned_pairs"), letters(F.expr("if(gap, concat(substr(letters, 1, 10), substr(letters, 12)), letters)")).alias("query_sequence"), letters(F.col("below")).alias("reference_sequence"),
        again(F.get(table, F.expr("cast((o * 5 + k * 11) % 38 AS int)"))).alias("query_qualities"),
        F.col("first").alias("reference_start"), F.expr("first + len AS reference_end"), (differing * F.col("n")).cast("int").alias("nm"), (F.col("n") * 20).cast("int").alias("query_length"),
        F.expr("if(clip, 2, 0)").alias("query_alignment_start"), F.lit(20).alias("query_alignment_end"),
    )


def genome(spark: SparkSession) -> DataFrame:
    """species_id, ref_id, sequence of the contigs that these reads are aligned to."""
    long = GENOME * (CONTIG_LENGTH // len(GENOME) + 2)
    return spark.createDataFrame([(f"sp{c % 2}", f"k{c}", long[c * 3 % len(GENOME) :][:CONTIG_LENGTH]) for c in range(CONTIGS)], "species_id string, ref_id string, sequence string")

"""Queries over alignments: quality control, mates, pileups with their reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import coverage, pileup, readqc
from ..sources.bam import read_bam, write_bam
from ..sources.scratch import scratch
from . import bindings
from .bindings import COLS_SQL, reads
from .registry import digest, query, rounded

#: Thresholds low enough for reads of 20 bases.
LIMITS = {"aln_mapid": 90.0, "aln_readq": 20.0, "aln_mapq": 10, "aln_cov": 0.9}
KEEP = "NOT is_secondary AND 100 * (20 - query_alignment_start - nm) / (20 - query_alignment_start) >= 90 AND mean_quality >= 20 AND mapping_quality >= 10 AND (20 - query_alignment_start) / 20 >= 0.9"
KEPT = COLS_SQL + f"kept AS (SELECT *, {KEEP} AS keep FROM reads)"
#: The last of the reads that pass, of each name and mate.
SINGLE = KEPT + """,
single AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_name, species_id, query_name, is_read1 ORDER BY row_no DESC) AS place FROM kept WHERE keep) x WHERE place = 1)"""


def single(spark, sf_dir, *columns: str) -> DataFrame:
    return readqc.single_reads(reads(spark, sf_dir), columns=columns or coverage.OBSERVED, **LIMITS)


@query(SINGLE + " SELECT sample_name, species_id, ref_id, query_name, is_read1, row_no FROM single")
def single_reads(spark, sf_dir):
    return single(spark, sf_dir, "ref_id", "row_no").select("sample_name", "species_id", "ref_id", "query_name", "is_read1", "row_no")


@query(COLS_SQL + "x AS (SELECT 1) SELECT sample_name, species_id, ref_id, query_name, is_read1, row_no FROM (SELECT *, row_number() OVER (PARTITION BY sample_name, species_id, query_name, is_read1 ORDER BY row_no DESC) AS place FROM reads) y WHERE place = 1")
def analysis_ready_reads(spark, sf_dir):
    return readqc.single_reads(reads(spark, sf_dir), analysis_ready=True, columns=["ref_id", "row_no"]).select("sample_name", "species_id", "ref_id", "query_name", "is_read1", "row_no")


@query(KEPT + " SELECT sample_name, species_id, ref_id, count(*) AS aligned_reads, count(*) FILTER (keep) AS mapped_reads FROM kept GROUP BY 1, 2, 3")
def contig_reads(spark, sf_dir):
    return readqc.contig_reads(reads(spark, sf_dir), readqc.keep_read(**LIMITS))


@query(COLS_SQL + "x AS (SELECT 1) SELECT ref_id, count(*) AS reads FROM reads WHERE o % 5 > 0 GROUP BY 1")
def mapped_targets(spark, sf_dir):
    """Reads of every fifth order count as not aligned."""
    rows = reads(spark, sf_dir).withColumn("ref_id", F.when(F.floor(F.col("row_no") / 2) % 5 > 0, F.col("ref_id")))
    return readqc.mapped_targets(rows)


@query(COLS_SQL + """b AS (SELECT reads.sample_name, reads.ref_id, reads.query_name, rpos + 1 AS ref_pos, qbase AS base, qual AS base_qual, reads.row_no FROM cols JOIN reads USING (o, c, k) WHERE qpos IS NOT NULL AND rpos IS NOT NULL AND o % 10 = 0)
SELECT * FROM b""")
def alignment_bases(spark, sf_dir):
    some = reads(spark, sf_dir).filter(F.floor(F.col("row_no") / 2) % 10 == 0)
    bases = pileup.explode_alignments(some.withColumn("query_name", F.concat_ws(" ", "query_name", "row_no")))
    name = F.split("read_id", " ")
    return bases.select("sample_name", "ref_id", name[0].alias("query_name"), F.col("ref_pos").cast("long").alias("ref_pos"), "base", "base_qual", name[1].cast("long").alias("row_no"))


def piled(of: str, quality: str = "qual", where: str = "qpos IS NOT NULL") -> str:
    """SQL of the counts at each site of the reads in a table, whose bases have at least quality 20."""
    counts = ", ".join(f"count(*) FILTER (qbase = '{b}' AND q >= 20) AS count_{b.lower()}" for b in "ACGT")
    return f"""SELECT sample_name, species_id, ref_id, rpos + 1 AS ref_pos, any_value(rbase) AS ref_allele, {counts}, count(*) FILTER (q >= 20) AS depth
  FROM (SELECT cols.rpos, cols.qbase, cols.rbase, t.sample_name, t.species_id, t.ref_id, {quality} AS q FROM cols JOIN {of} AS t USING (o, c, k) WHERE {where} AND rpos IS NOT NULL) z GROUP BY 1, 2, 3, 4 HAVING count(*) FILTER (q >= 20) > 0"""


@query(SINGLE + " " + piled("single"))
def reference_pileup(spark, sf_dir):
    """Counts of the reads that pass; the reference allele comes from the contigs."""
    counted = pileup.pileup(pileup.explode_alignments(single(spark, sf_dir)), base_quality=20)
    return pileup.with_reference(counted, bindings.genome(spark), block=64).withColumn("ref_pos", F.col("ref_pos").cast("long"))


@query(SINGLE + " " + piled("single"))
def block_pileup(spark, sf_dir):
    """The same counts, made in blocks of sites before anything is shuffled."""
    counted = coverage.counted_sites(single(spark, sf_dir), base_quality=20)
    return pileup.with_reference(counted, bindings.genome(spark), block=64)


@query(SINGLE + f" SELECT * FROM ({piled('single')}) p WHERE ref_id = 'k2' AND ref_pos > 100 AND ref_pos <= 160")
def region_pileup(spark, sf_dir):
    """A slice of one contig, from 100 to 160, 0-based and half open."""
    bases = pileup.region(pileup.explode_alignments(single(spark, sf_dir)), "k2", 100, 160)
    return pileup.with_reference(pileup.pileup(bases, base_quality=20), bindings.genome(spark)).withColumn("ref_pos", F.col("ref_pos").cast("long"))


# ---------------------------------------------------------------- files

STORED = ["ref_id", "query_name", "is_read1", "is_reverse", "is_secondary", "is_qcfail", "is_duplicate", "is_proper_pair", "mapping_quality", "template_length", "reference_start", "reference_end", "query_length", "query_alignment_start", "query_alignment_end", "nm"]
BAM = COLS_SQL + f"""bam AS (SELECT {', '.join(STORED)}, query_sequence, reference_sequence, qualities, pairs FROM reads JOIN (
  SELECT o, c, k, string_agg(qbase, '' ORDER BY i) FILTER (qpos IS NOT NULL) AS query_sequence, string_agg(rbase, '' ORDER BY i) FILTER (rpos IS NOT NULL) AS reference_sequence,
    string_agg(CAST(qual AS VARCHAR), ',' ORDER BY i) FILTER (qpos IS NOT NULL) AS qualities, string_agg(coalesce(CAST(qpos AS VARCHAR), '') || ':' || coalesce(CAST(rpos AS VARCHAR), ''), ' ' ORDER BY i) AS pairs FROM cols GROUP BY 1, 2, 3) x USING (o, c, k))"""


def stored_bam(spark, sf_dir) -> str:
    """A folder of sorted and indexed BAM files of all reads."""
    path = scratch(spark)
    write_bam(reads(spark, sf_dir).withColumns({"is_paired": F.lit(True), "is_read2": ~F.col("is_read1")}), path, [(f"k{c}", bindings.CONTIG_LENGTH) for c in range(bindings.CONTIGS)])
    return path


@query(BAM + " SELECT * FROM bam")
def read_bam_files(spark, sf_dir):
    """Everything that an alignment holds, through BAM files."""
    found = read_bam(spark, stored_bam(spark, sf_dir), split_bytes=1 << 15)
    place = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    pairs = F.array_join(F.transform("aligned_pairs", lambda p: F.concat(place(p["qpos"]), F.lit(":"), place(p["rpos"]))), " ")
    counts = [F.col(c).cast("long").alias(c) if c in ("reference_start", "reference_end", "query_length", "nm") else F.col(c) for c in STORED]
    return found.select(*counts, "query_sequence", "reference_sequence", digest(F.col("query_qualities")).alias("qualities"), pairs.alias("pairs"))


@query(BAM + " SELECT ref_id, query_name, is_read1, reference_start, nm FROM bam WHERE ref_id IN ('k2', 'k4') AND reference_start < 160 AND reference_end > 100")
def read_bam_region(spark, sf_dir):
    """Alignments over a range of two contigs: the index says which parts of the files to open, the schema which columns to decode."""
    found = read_bam(spark, stored_bam(spark, sf_dir), columns=["ref_id", "query_name", "is_read1", "reference_start", "reference_end", "nm"])
    some = found.filter(F.col("ref_id").isin("k2", "k4") & (F.col("reference_start") < 160) & (F.col("reference_end") > 100))
    return some.select("ref_id", "query_name", "is_read1", F.col("reference_start").cast("long").alias("reference_start"), F.col("nm").cast("long").alias("nm"))


# ---------------------------------------------------------------- mates

PAIR_LIMITS = {**LIMITS, "aln_mapid": 92.0, "fragment_length": 1000, "fragment_ratio": 3.0}
#: From the rules of the pair filter, a row an alignment column: which are inside the overlap, what mismatches there.
PAIRS = COLS_SQL + """
last_of AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_name, species_id, ref_id, query_name, k ORDER BY row_no DESC) AS place FROM reads WHERE NOT is_secondary AND is_proper_pair) x WHERE place = 1),
pair0 AS (SELECT f.o AS fo, r.o AS ro, f.c AS c, f.sample_name, f.species_id, f.ref_id, f.query_name, f.reference_end AS f_end, f.nm AS f_nm, r.nm AS r_nm, f.query_alignment_start AS f_qs,
    20 - f.query_alignment_start AS f_len, 20 AS r_len, greatest(0, least(f.reference_end, r.reference_end) - greatest(f.reference_start, r.reference_start)) AS on_ref
  FROM last_of f JOIN last_of r USING (sample_name, species_id, ref_id, query_name)
  WHERE f.k = 0 AND r.k = 1 AND (f.mean_quality + r.mean_quality) / 2 >= 20 AND greatest(f.mapping_quality, r.mapping_quality) >= 10 AND abs(f.template_length) <= 3000 AND (40 - f.query_alignment_start) / 40 >= 0.9),
pair1 AS (SELECT p.*, on_ref - (SELECT count(*) FROM cols x WHERE x.o = fo AND x.c = p.c AND x.k = 0 AND x.rpos >= f_end - on_ref AND x.qpos IS NULL) AS mates FROM pair0 p),
cell AS (SELECT p.fo, p.ro, p.c, x.k, x.qpos, x.rpos, CASE WHEN x.k = 0 THEN coalesce(x.qpos >= 20 - mates, false) ELSE coalesce(x.qpos <= mates - 1, false) END AS inside, coalesce(x.qbase <> x.rbase, true) AS differs
  FROM pair1 p JOIN cols x ON x.c = p.c AND ((x.k = 0 AND x.o = fo) OR (x.k = 1 AND x.o = ro))),
walked AS (SELECT fo, ro, c, count(*) FILTER (k = 0 AND inside AND differs) AS f_in, count(*) FILTER (k = 1 AND inside AND differs) AS r_in, count(*) FILTER (k = 1 AND NOT inside AND differs) AS r_out,
    count(*) FILTER (k = 0 AND inside AND rpos IS NULL) AS f_gaps FROM cell GROUP BY 1, 2, 3),
pair2 AS (SELECT *, CASE WHEN mates <> 0 THEN mates - f_gaps ELSE 0 END AS overlap FROM pair1 JOIN walked USING (fo, ro, c) WHERE mates = 0 OR abs(f_in - r_in) <= 1),
pair3 AS (SELECT *, 100 * (f_len + r_len - overlap - (f_nm + CASE WHEN mates <> 0 THEN r_out ELSE r_nm END)) / (f_len + r_len - overlap) AS identity FROM pair2),
pairs AS (SELECT * FROM pair3 WHERE identity >= 92),
qual AS (SELECT p.*, f.qual AS f, r.qual AS r FROM (SELECT *, unnest(range(0, 20)) AS pos FROM pairs) p
  JOIN cols f ON f.o = fo AND f.c = p.c AND f.k = 0 AND f.qpos = p.pos JOIN cols r ON r.o = ro AND r.c = p.c AND r.k = 1 AND r.qpos = p.pos),
beside AS (SELECT q.*, fr.r AS facing_f, rf.f AS facing_r FROM qual q
  LEFT JOIN (SELECT fo, ro, c, pos, r FROM qual) fr ON fr.fo = q.fo AND fr.ro = q.ro AND fr.c = q.c AND q.mates <> 0 AND fr.pos = q.pos - (20 - q.overlap) AND q.pos >= 20 - q.overlap
  LEFT JOIN (SELECT fo, ro, c, pos, f FROM qual) rf ON rf.fo = q.fo AND rf.ro = q.ro AND rf.c = q.c AND q.mates <> 0 AND rf.pos = q.pos + (20 - q.overlap) AND q.pos < q.overlap),
settled AS (SELECT *, CASE WHEN facing_f IS NOT NULL AND f < facing_f THEN 0 ELSE f END AS fq, CASE WHEN facing_r IS NOT NULL AND facing_r >= r THEN 0 ELSE r END AS rq FROM beside)"""


def paired(spark, sf_dir) -> DataFrame:
    return readqc.proper_pairs(reads(spark, sf_dir), **PAIR_LIMITS)


@query(PAIRS + """ SELECT sample_name, species_id, ref_id, query_name, CAST(overlap AS BIGINT) AS overlap, round(identity, 6) AS identity,
  string_agg(fq, ',' ORDER BY pos) AS fwd_qualities, string_agg(rq, ',' ORDER BY pos) AS rev_qualities FROM settled GROUP BY sample_name, species_id, ref_id, query_name, overlap, identity, fo, ro""")
def proper_pairs(spark, sf_dir):
    found = paired(spark, sf_dir).select("sample_name", "species_id", "ref_id", "query_name", F.col("overlap").cast("long").alias("overlap"), "identity", digest(F.col("fwd_qualities")).alias("fwd_qualities"), digest(F.col("rev_qualities")).alias("rev_qualities"))
    return rounded(found, "identity")


BOTH = PAIRS + """,
t AS (SELECT fo AS o, c, 0 AS k, pos, fq AS q, sample_name, species_id, ref_id FROM settled UNION ALL SELECT ro, c, 1, pos, rq, sample_name, species_id, ref_id FROM settled)"""


@query(BOTH + " " + piled("t", "t.q", "t.pos = qpos"))
def paired_pileup(spark, sf_dir):
    """Counts of mates that pass together: where they overlap, the better base alone counts."""
    counted = pileup.pileup(pileup.explode_alignments(readqc.mates(paired(spark, sf_dir))), base_quality=20)
    return pileup.with_reference(counted, bindings.genome(spark)).withColumn("ref_pos", F.col("ref_pos").cast("long"))

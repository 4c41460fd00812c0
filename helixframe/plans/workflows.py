"""The workflows end to end, each with the SQL of its result."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import codon_table, subsequence
from ..operators import snv, workflows
from ..operators.ranks import ranked
from ..sources import writers
from ..sources.scratch import scratch
from . import bindings
from .alignments import BOTH, COLS_SQL, LIMITS, PAIR_LIMITS, SINGLE, piled
from .bindings import CONTIG_LENGTH, CONTIGS, bind, reads, with_views
from .catalog import AMBI, PAN, PREV, PROFILES, VOTE, calls, contigs, cutoffs, genes, hit_genes, picked, profiles, seqs
from .curation import TOC, orthologs, toc
from .registry import query, rounded

# ---------------------------------------------------------------- species


def species_result(spark, sf_dir) -> workflows.Tables:
    """Hits on marker genes, without their species and marker: those come from the marker map."""
    hits = bind(spark, sf_dir, "v_aln")
    gene_map = hits.select("species_id", F.col("target").alias("gene_id"), "marker_id").distinct().withColumn("gene_length", (F.col("gene_id") * 7 % 400 + 600).cast("int"))
    ids = gene_map.filter("gene_id % 11 <> 5").select("gene_id")
    return workflows.run_species(hits.drop("species_id", "marker_id"), gene_map, ids, cutoffs(spark, sf_dir), aln_cov=0.5)


#: The same from the start, on the genes of the sequence file.
RUN_SPECIES = AMBI.replace("FROM v_aln WHERE pid", "FROM v_aln WHERE target % 11 <> 5 AND pid") + """,
ambi AS (SELECT * FROM ambi_all WHERE round(reads, 6) >= 2 AND species_id IN (SELECT species_id FROM ambi_all WHERE round(reads, 6) >= 2 GROUP BY 1 HAVING count(*) >= 2)),
mk AS (SELECT species_id, marker_id, CAST(sum(target * 7 % 400 + 600) AS BIGINT) AS marker_length, string_agg(CAST(target AS VARCHAR), ',' ORDER BY target) AS gene_ids FROM (SELECT DISTINCT species_id, marker_id, target FROM v_aln WHERE target % 11 <> 5) x GROUP BY 1, 2),
mat AS (SELECT m.*, coalesce(u.reads, 0) AS uniq_reads, coalesce(u.alnbps, 0) AS uniq_alnbps, coalesce(round(a.reads, 6), 0) AS ambi_reads, coalesce(a.alnbps, 0) AS ambi_alnbps
  FROM mk m LEFT JOIN uniq u USING (species_id, marker_id) LEFT JOIN ambi a USING (species_id, marker_id) WHERE species_id IN (SELECT species_id FROM uniq UNION SELECT species_id FROM ambi)),
prof AS (SELECT species_id, sum(uniq_reads + ambi_reads) AS n, median((uniq_alnbps + ambi_alnbps) / marker_length) AS med, sum(uniq_alnbps + ambi_alnbps) / sum(marker_length) AS cov,
  count(*) FILTER (uniq_reads > 0) AS uc, count(*) FILTER (ambi_reads > 0) AS ac, count(*) FILTER (uniq_reads > 0 OR ambi_reads > 0) AS tc, count(*) AS total FROM mat GROUP BY 1)"""


@query(RUN_SPECIES + """ SELECT species_id, round(n, 4) AS marker_read_counts, round(med, 5) AS median_marker_coverage, round(cov, 5) AS marker_coverage, round(cov / sum(cov) OVER (), 6) AS marker_relative_abundance,
  uc / total AS unique_fraction_covered, tc AS total_covered, uc AS unique_covered, ac AS ambiguous_covered, total AS total_marker_counts FROM prof""")
def run_species(spark, sf_dir):
    found = rounded(species_result(spark, sf_dir)["species"], "marker_read_counts", digits=4)
    return rounded(rounded(found, "median_marker_coverage", "marker_coverage", digits=5), "marker_relative_abundance")


@query(RUN_SPECIES + " SELECT species_id, marker_id, marker_length, gene_ids, round(uniq_reads + ambi_reads, 4) AS total_reads, round(uniq_alnbps + ambi_alnbps, 3) AS total_alnbps, uniq_reads, uniq_alnbps FROM mat")
def run_species_markers(spark, sf_dir):
    found = species_result(spark, sf_dir)["markers"].select("species_id", "marker_id", "marker_length", "gene_ids", "total_reads", "total_alnbps", "uniq_reads", "uniq_alnbps")
    return rounded(rounded(found, "total_reads", digits=4), "total_alnbps", digits=3)


# ---------------------------------------------------------------- variants

SNPS = {**LIMITS, "aln_baseq": 20}
SITE_KEYS = "sample_name, species_id, ref_id, ref_pos, ref_allele"


def snps(spark, sf_dir, **how) -> workflows.Tables:
    return workflows.run_snps(reads(spark, sf_dir), bindings.genome(spark), **(SNPS | how))


def long_pos(df: DataFrame) -> DataFrame:
    return df.withColumn("ref_pos", F.col("ref_pos").cast("long"))


#: Alignments whose bases count: those of failed and duplicate reads do not, secondary ones neither.
COVERS = "NOT t.is_secondary AND NOT t.is_qcfail AND NOT t.is_duplicate"
SNP_SITES = SINGLE + f", pile AS ({piled('single', where='qpos IS NOT NULL AND ' + COVERS)})"
SNP_SUMMARY = SNP_SITES + f""",
summary AS (SELECT *, covered_bases / genome_length AS fraction_covered, total_depth / covered_bases AS mean_depth FROM
  (SELECT sample_name, species_id, count(*) AS covered_bases, CAST(sum(depth) AS BIGINT) AS total_depth FROM pile GROUP BY 1, 2) c
  JOIN (SELECT sample_name, species_id, count(*) AS aligned_reads, count(*) FILTER (keep) AS mapped_reads FROM kept GROUP BY 1, 2) r USING (sample_name, species_id)
  CROSS JOIN (SELECT CAST({CONTIG_LENGTH * CONTIGS // 2} AS BIGINT) AS genome_length) g)"""


@query(SNP_SITES + calls("pile", SITE_KEYS, "count_", "depth", 0.1) + f""",
adv AS (SELECT p.*, bs[1] AS major_allele, bs[least(2, len(bs))] AS minor_allele, CAST(len(bs) AS INT) AS allele_counts FROM pile p JOIN calls USING ({SITE_KEYS}) WHERE depth >= 2)
SELECT *, {picked('major_allele')} / depth AS major_allele_freq, CASE WHEN major_allele = minor_allele THEN 0.0::DOUBLE ELSE {picked('minor_allele')} / depth END AS minor_allele_freq FROM adv""")
def run_snps(spark, sf_dir):
    return long_pos(snps(spark, sf_dir, advanced=True)["pileup"])


@query(SNP_SUMMARY + " SELECT * FROM summary")
def run_snps_summary(spark, sf_dir):
    return snps(spark, sf_dir)["summary"]


#: Of the pairs of a name that pass, the one on the last contig.
LAST_PAIR = BOTH + f""", last_pair AS (SELECT fo, ro, c FROM (SELECT *, row_number() OVER (PARTITION BY sample_name, species_id, query_name ORDER BY c DESC) AS place FROM pairs) x WHERE place = 1),
m AS (SELECT t.*, is_secondary, is_qcfail, is_duplicate FROM t JOIN reads USING (o, c, k) JOIN last_pair l ON l.c = t.c AND t.o = CASE WHEN t.k = 0 THEN fo ELSE ro END),
pile AS ({piled("m", "t.q", "t.pos = qpos AND " + COVERS)})"""


@query(LAST_PAIR + " SELECT * FROM pile WHERE depth >= 2")
def run_snps_paired(spark, sf_dir):
    """Mates that pass together; a name with pairs on two contigs counts on the later one alone."""
    return long_pos(paired_result(spark, sf_dir)["pileup"])


@query(LAST_PAIR + """ SELECT sample_name, species_id, aligned_reads, mapped_reads, covered_bases FROM (SELECT sample_name, species_id, count(*) AS aligned_reads FROM reads GROUP BY 1, 2) a
JOIN (SELECT sample_name, species_id, 2 * count(*) AS mapped_reads FROM pairs GROUP BY 1, 2) b USING (sample_name, species_id) JOIN (SELECT sample_name, species_id, count(*) AS covered_bases FROM pile GROUP BY 1, 2) d USING (sample_name, species_id)""")
def run_snps_paired_summary(spark, sf_dir):
    return paired_result(spark, sf_dir)["summary"].select("sample_name", "species_id", "aligned_reads", "mapped_reads", "covered_bases")


def paired_result(spark, sf_dir) -> workflows.Tables:
    return workflows.run_snps(reads(spark, sf_dir), bindings.genome(spark), **PAIR_LIMITS, aln_baseq=20, paired_only=True)


#: Reads that are ready: the last of each name and mate, none filtered.
READY = COLS_SQL + f"""ready AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_name, species_id, query_name, is_read1 ORDER BY row_no DESC) AS place FROM reads) x WHERE place = 1),
pile AS ({piled('ready', where='qpos IS NOT NULL AND ' + COVERS)})"""


@query(READY + " SELECT * FROM pile WHERE depth >= 2")
def run_snps_ready(spark, sf_dir):
    return long_pos(snps(spark, sf_dir, analysis_ready=True)["pileup"])


@query(READY + """ SELECT sample_name, species_id, n AS aligned_reads, n AS mapped_reads, covered_bases, total_depth FROM (SELECT sample_name, species_id, count(*) AS n FROM reads GROUP BY 1, 2) a
JOIN (SELECT sample_name, species_id, count(*) AS covered_bases, CAST(sum(depth) AS BIGINT) AS total_depth FROM pile GROUP BY 1, 2) d USING (sample_name, species_id)""")
def run_snps_ready_summary(spark, sf_dir):
    """All reads are aligned and mapped ones, also those that add no depth."""
    return snps(spark, sf_dir, analysis_ready=True)["summary"].select("sample_name", "species_id", "aligned_reads", "mapped_reads", "covered_bases", "total_depth")


#: Genes of the contigs: 60 bases each with gaps between, every fifth no CDS.
GENE = ["concat('k', c) AS contig_id", "concat('k', c, '_', j) AS gene_id", "j * 80 + 11 AS start_pos", "j * 80 + 70 AS end_pos", "CASE WHEN j % 2 = 0 THEN '+' ELSE '-' END AS strand", "CASE WHEN (c + j) % 5 = 0 THEN 'tRNA' ELSE 'CDS' END AS gene_type"]


def gene_table(spark) -> DataFrame:
    return spark.range(CONTIGS * 6).selectExpr(f"id % {CONTIGS} AS c", f"cast(floor(id / {CONTIGS}) AS bigint) AS j").selectExpr(*GENE)


def gene_sequences(spark) -> DataFrame:
    """Bases of each gene from its start to its stop."""
    on = gene_table(spark).join(bindings.genome(spark).withColumnRenamed("ref_id", "contig_id"), "contig_id")
    return on.select("gene_id", subsequence(F.col("sequence"), F.col("start_pos").cast("int"), F.col("end_pos").cast("int"), F.col("strand")).alias("sequence"))


MERGED = SNP_SUMMARY + f""",
rel AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY species_id) AS samples_count FROM summary WHERE mean_depth >= 1 AND fraction_covered >= 0.1) x WHERE samples_count >= 2),
quiet AS (SELECT sample_name, species_id, ref_id, ref_pos, ref_allele, a AS count_a, c AS count_c, g AS count_g, t AS count_t, a + c + g + t AS depth FROM (SELECT *, CASE WHEN count_a > 2 THEN count_a ELSE 0 END AS a,
  CASE WHEN count_c > 2 THEN count_c ELSE 0 END AS c, CASE WHEN count_g > 2 THEN count_g ELSE 0 END AS g, CASE WHEN count_t > 2 THEN count_t ELSE 0 END AS t FROM pile WHERE depth >= 2) f),
good AS (SELECT q.*, r.samples_count FROM quiet q JOIN rel r USING (sample_name, species_id) WHERE q.depth >= 3 AND q.depth / r.mean_depth <= 3),
pooled AS (SELECT species_id, ref_id, ref_pos, ref_allele, count(*) AS count_samples, any_value(samples_count) AS samples_count, CAST(sum(count_a) AS BIGINT) AS rc_a, CAST(sum(count_c) AS BIGINT) AS rc_c,
  CAST(sum(count_g) AS BIGINT) AS rc_g, CAST(sum(count_t) AS BIGINT) AS rc_t, count(*) FILTER (count_a > 0) AS sc_a, count(*) FILTER (count_c > 0) AS sc_c, count(*) FILTER (count_g > 0) AS sc_g, count(*) FILTER (count_t > 0) AS sc_t
  FROM good GROUP BY 1, 2, 3, 4),
common AS (SELECT * FROM pooled WHERE count_samples / samples_count >= 0.6)"""
CALLED = MERGED + calls("common", "species_id, ref_id, ref_pos, ref_allele", "rc_", "(rc_a + rc_c + rc_g + rc_t)", 0.05) + f""",
pop AS (SELECT c.*, bs[1] AS major_allele, bs[least(2, len(bs))] AS minor_allele, ['mono', 'bi', 'tri', 'quad'][len(bs)] AS snp_type FROM common c JOIN calls USING (species_id, ref_id, ref_pos, ref_allele)),
feat AS (SELECT {', '.join(GENE)} FROM (SELECT id % {CONTIGS} AS c, id // {CONTIGS} AS j FROM range(0, {CONTIGS * 6}) r(id)) z),
code AS (SELECT * FROM (VALUES {', '.join(f"('{c}', '{a}')" for c, a in codon_table().items())}) t(codon, aa)),
base_at AS (SELECT DISTINCT 'k' || c AS contig, p, substr('{bindings.GENOME}', CAST((p - 1 + c * 3) % {len(bindings.GENOME)} + 1 AS INT), 1) AS b FROM (SELECT unnest(range(0, {CONTIGS})) AS c) x, (SELECT unnest(range(1, {CONTIG_LENGTH + 1})) AS p) y),
held AS (SELECT pop.*, f.gene_id, coalesce(f.gene_type, 'IGR') AS locus_type, f.strand, CASE WHEN f.strand = '+' THEN ref_pos - f.start_pos ELSE f.end_pos - ref_pos END AS wg, f.start_pos, f.end_pos
  FROM pop LEFT JOIN feat f ON f.contig_id = pop.ref_id AND pop.ref_pos BETWEEN f.start_pos AND f.end_pos),
cds AS (SELECT h.species_id, h.ref_id, h.ref_pos, h.strand, CAST(wg % 3 AS INT) AS wi, CAST(wg - wg % 3 AS INT) AS w0, h.start_pos, h.end_pos FROM held h WHERE locus_type = 'CDS'),
cod AS (SELECT c.*, string_agg(CASE WHEN strand = '+' THEN b.b ELSE translate(b.b, 'ACGT', 'TGCA') END, '' ORDER BY n) AS codon FROM cds c, (SELECT unnest([0, 1, 2]) AS n) k, base_at b
  WHERE b.contig = c.ref_id AND b.p = CASE WHEN strand = '+' THEN start_pos + w0 + n ELSE end_pos - w0 - n END GROUP BY ALL),
four AS (SELECT species_id, ref_id, ref_pos, al, (SELECT aa FROM code WHERE code.codon = substr(cod.codon, 1, wi) || CASE WHEN strand = '+' THEN al ELSE translate(al, 'ACGT', 'TGCA') END || substr(cod.codon, wi + 2, 3)) AS aa FROM cod, (SELECT unnest(['A', 'C', 'G', 'T']) AS al) a),
ann AS (SELECT species_id, ref_id, ref_pos, concat(5 - count(DISTINCT aa), 'D') AS site_type, string_agg(aa, ',' ORDER BY al) AS amino_acids FROM four GROUP BY 1, 2, 3)"""
MERGE = {"sample_counts": 2, "genome_depth": 1.0, "genome_coverage": 0.1, "site_depth": 3, "site_prev": 0.6, "snp_pooled_method": "abundance", "snp_type": ("any",), "locus_type": ("CDS", "IGR")}


def merged_snps(spark, sf_dir) -> workflows.Tables:
    """The tables of all samples are written once, as they would be, and read by the merge."""
    path = scratch(spark)
    for name, rows in snps(spark, sf_dir, stored=True).items():
        rows.write.parquet(f"{path}/{name}")
    sites, summaries = (spark.read.parquet(f"{path}/{name}") for name in ("pileup", "summary"))
    return workflows.merge_snps(long_pos(sites), summaries, gene_table(spark), gene_sequences(spark), **MERGE)


@query(CALLED + " SELECT h.* EXCLUDE (strand, wg, start_pos, end_pos), ann.site_type, ann.amino_acids FROM held h LEFT JOIN ann USING (species_id, ref_id, ref_pos) WHERE locus_type IN ('CDS', 'IGR')")
def merge_snps(spark, sf_dir):
    return merged_snps(spark, sf_dir)["info"]


@query(CALLED + f""",
every AS (SELECT h.species_id, h.ref_id, h.ref_pos, h.ref_allele, h.major_allele AS ma, h.minor_allele AS mi, rel.sample_name FROM held h JOIN rel USING (species_id) WHERE locus_type IN ('CDS', 'IGR')),
seen AS (SELECT e.*, coalesce({picked('ma')}, 0) AS x, CASE WHEN ma = mi THEN 0 ELSE coalesce({picked('mi')}, 0) END AS y FROM every e LEFT JOIN good USING (sample_name, species_id, ref_id, ref_pos, ref_allele))
SELECT sample_name, species_id, ref_id, ref_pos, ref_allele, x + y AS sample_depth, CASE WHEN x + y = 0 THEN CAST(-1 AS DOUBLE) ELSE y / (x + y) END AS sample_maf FROM seen""")
def merge_snps_freq(spark, sf_dir):
    return merged_snps(spark, sf_dir)["freq"]


@query(CALLED + f""",
every AS (SELECT h.species_id, h.ref_id, h.ref_pos, h.ref_allele, h.major_allele AS ma, h.minor_allele AS mi, rel.sample_name FROM held h JOIN rel USING (species_id) WHERE locus_type IN ('CDS', 'IGR')),
seen AS (SELECT e.*, coalesce({picked('ma')}, 0) AS x, CASE WHEN ma = mi THEN 0 ELSE coalesce({picked('mi')}, 0) END AS y FROM every e LEFT JOIN good USING (sample_name, species_id, ref_id, ref_pos, ref_allele))
SELECT sample_name, species_id, ref_id, ref_pos, ref_allele, x + y AS sample_depth, CASE WHEN x + y = 0 THEN CAST(-1 AS DOUBLE) ELSE y / (x + y) END AS sample_maf FROM seen""")
def merge_snps_bucketed(spark, sf_dir):
    """The same from a table of sites that is bucketed by site: pooling needs no shuffle."""
    found = snps(spark, sf_dir, stored=True)
    table = f"sites_{uuid.uuid4().hex}"
    writers.write_sites(found["pileup"], table, scratch(spark), buckets=8)
    return workflows.merge_snps(spark.table(table), found["summary"], gene_table(spark), gene_sequences(spark), **MERGE)["freq"]


def in_file_order(rows: DataFrame, value: str, *key: Column) -> DataFrame:
    """key and mean: values of a file's rows added up one by one in its order, so that the last bits of a mean do not hang on what Spark adds first. For keys of few rows each."""
    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"), F.col(value).alias("value"))
    listed = rows.select(*key, F.when(F.col(value).isNotNull(), place).alias("at")).groupBy(*[F.col(k) for k in rows.select(*key).columns]).agg(F.array_sort(F.collect_list("at")).alias("listed"))
    mean = F.try_divide(F.aggregate("listed", F.lit(0.0), lambda total, x: total + x["value"]), F.size("listed"))
    return listed.withColumn("mean", mean).drop("listed")


SAMPLE_SUMS = "SELECT l_partkey % 50 AS site, l_suppkey AS sample, CAST(sum(l_quantity) AS BIGINT) AS depth, avg(l_discount) AS freq FROM lineitem WHERE l_linenumber < 3 GROUP BY 1, 2"


@query(f"""WITH v AS ({SAMPLE_SUMS}), n AS (SELECT s_suppkey AS sample, row_number() OVER (ORDER BY s_suppkey) - 1 AS number FROM supplier)
SELECT CAST(x.site AS VARCHAR) AS site, concat('s', n.sample) AS sample_name, printf('%.3f', coalesce(v.freq, -1)) AS freq FROM (SELECT DISTINCT site FROM v) x CROSS JOIN n LEFT JOIN v ON v.site = x.site AND v.sample = n.sample""")
def write_matrix(spark, sf_dir):
    """A column a supplier: arrays filled up as they are written, read again cell by cell."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    long = in_file_order(read("lineitem").filter("l_linenumber < 3"), "l_discount", (F.col("l_partkey") % 50).alias("site"), F.concat(F.lit("s"), "l_suppkey").alias("sample_name")).withColumnRenamed("mean", "freq")
    numbers = ranked(read("supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("sample_name"), "s_suppkey"), [], ["s_suppkey"], "number").select("sample_name", "number")
    path = scratch(spark)
    writers.write_matrix(snv.sample_arrays(long, ["site"], "freq", numbers, -1.0), path, numbers)
    cells = F.split("value", "\t")
    lines = spark.read.text(path).select(cells.alias("cells")).filter(F.col("cells")[0] != "site")
    head = spark.read.text(path).filter(F.col("value").startswith("site")).select(cells.alias("names")).limit(1)
    each = lines.join(F.broadcast(head)).select(F.col("cells")[0].alias("site"), F.explode(F.arrays_zip(F.slice("names", 2, 1 << 30).alias("n"), F.slice("cells", 2, 1 << 30).alias("v"))).alias("x"))
    return each.select("site", F.col("x.n").alias("sample_name"), F.col("x.v").alias("freq"))


# ---------------------------------------------------------------- copy number

GENE_RULES = {**LIMITS, "aln_mapq": 0, "aln_baseq": 15}
#: Reads on genes: the contig stands for a gene of a genome, whose species the catalogue knows; contig 5 is of none.
GENE_READS = SINGLE.replace("AND mapping_quality >= 10 ", "") + """,
named AS (SELECT * REPLACE (concat('sp', c % 4) AS species_id, concat('G', c, '_1') AS ref_id) FROM kept WHERE c < 5),
rows_ AS (SELECT sample_name, species_id, ref_id AS cluster_id, c, count(*) AS aligned_reads, count(*) FILTER (keep) AS mapped_reads FROM named GROUP BY 1, 2, 3, 4),
deep AS (SELECT sample_name, species_id, ref_id AS cluster_id, CAST(sum(depth) AS BIGINT) AS total_depth, count(*) AS covered_bases FROM (SELECT n.sample_name, n.species_id, n.ref_id, rpos, count(*) AS depth FROM cols JOIN named n USING (o, c, k)
  WHERE n.keep AND qpos IS NOT NULL AND rpos IS NOT NULL AND qual >= 15 GROUP BY 1, 2, 3, 4) d GROUP BY 1, 2, 3),
gd AS (SELECT r.* EXCLUDE (c), d.total_depth, d.covered_bases, 300 + c * 50 AS gene_length, CASE WHEN c <> 4 THEN concat('B', c % 3) END AS marker_id, total_depth / (300 + c * 50) AS mean_depth FROM rows_ r JOIN deep d USING (sample_name, species_id, cluster_id)),
md AS (SELECT p.sample_name, p.species_id, median(coalesce(d.depth, 0)) AS marker_depth FROM (SELECT DISTINCT sample_name, species_id FROM gd) p CROSS JOIN (SELECT unnest(['B0', 'B1', 'B2']) AS marker_id) u
  LEFT JOIN (SELECT sample_name, species_id, marker_id, round(sum(mean_depth), 6) AS depth FROM gd WHERE marker_id IS NOT NULL GROUP BY 1, 2, 3) d ON d.sample_name = p.sample_name AND d.species_id = p.species_id AND d.marker_id = u.marker_id GROUP BY 1, 2),
copies AS (SELECT gd.*, md.marker_depth, CASE WHEN md.marker_depth > 0 THEN mean_depth / md.marker_depth ELSE 0 END AS copy_number FROM gd JOIN md USING (sample_name, species_id)),
sizes AS (SELECT concat('sp', c % 4) AS species_id, count(*) AS pangenome_size FROM (SELECT unnest(range(0, 6)) AS c) x GROUP BY 1),
gsum AS (SELECT *, covered_genes / pangenome_size AS fraction_covered FROM (SELECT sample_name, species_id, count(*) AS covered_genes, CAST(sum(aligned_reads) AS BIGINT) AS aligned_reads, CAST(sum(mapped_reads) AS BIGINT) AS mapped_reads, sum(mean_depth) / count(*) AS mean_depth
  FROM gd GROUP BY 1, 2) s JOIN sizes USING (species_id) JOIN md USING (sample_name, species_id))"""


def gene_result(spark, sf_dir) -> workflows.Tables:
    rows = reads(spark, sf_dir).drop("species_id").withColumn("ref_id", F.concat(F.lit("G"), F.substring("ref_id", 2, 3), F.lit("_1")))
    c = F.col("id")
    clusters = spark.range(CONTIGS).select(F.concat(F.lit("G"), c, F.lit("_1")).alias("cluster_id"), F.concat(F.lit("sp"), c % 4).alias("species_id"), (300 + c * 50).alias("gene_length"), F.when(c != 4, F.concat(F.lit("B"), c % 3)).alias("marker_id"))
    return workflows.run_genes(rows, toc(spark, sf_dir).filter("genome <> 'G5'"), clusters, **GENE_RULES)


@query(GENE_READS + " SELECT * REPLACE (round(mean_depth, 6) AS mean_depth, round(marker_depth, 6) AS marker_depth, round(copy_number, 6) AS copy_number) FROM copies")
def run_genes(spark, sf_dir):
    return rounded(gene_result(spark, sf_dir)["genes"], "mean_depth", "marker_depth", "copy_number")


@query(GENE_READS + " SELECT * REPLACE (round(mean_depth, 6) AS mean_depth, round(marker_depth, 6) AS marker_depth) FROM gsum")
def run_genes_summary(spark, sf_dir):
    return rounded(gene_result(spark, sf_dir)["summary"], "mean_depth", "marker_depth")


@query(GENE_READS + """, good AS (SELECT sample_name, species_id FROM gsum WHERE mean_depth >= 0.1),
outs AS (SELECT sample_name, species_id, concat('C', CAST(substr(cluster_id, 2, 1) AS INT) // 2) AS cluster_out, sum(copy_number) AS cn, round(sum(mean_depth), 6) AS depth, CAST(sum(mapped_reads) AS BIGINT) AS reads FROM copies SEMI JOIN good USING (sample_name, species_id) GROUP BY 1, 2, 3)
SELECT sample_name, species_id, cluster_out, round(cn, 6) AS copy_number, depth, reads, CAST(cn >= 0.35 AS INT) AS presabs FROM outs""")
def merge_genes(spark, sf_dir):
    found = gene_result(spark, sf_dir)
    c = F.col("id")
    mapping = spark.range(CONTIGS).select(F.concat(F.lit("G"), c, F.lit("_1")).alias("cluster_id"), F.concat(F.lit("C"), F.floor(c / 2)).alias("cluster_out"))
    return rounded(workflows.merge_genes(found["genes"], found["summary"], mapping, genome_depth=0.1), "copy_number", "depth")


# ---------------------------------------------------------------- database


@query(PAN + " SELECT a.gene_id, a.centroid_99, b.centroid_95, b.centroid_75 FROM g a JOIN g b ON b.gene_id = a.centroid_99")
def build_pangenome(spark, sf_dir):
    """Cluster records: all genes at the finest level, its centroids at the coarser ones."""
    g = genes(spark, sf_dir)
    kind = lambda c: F.when(F.col("gene_id") == F.col(c), "S").otherwise("H").alias("type")
    records = lambda rows, c: rows.select(kind(c), "gene_id", F.col(c).alias("centroid_id"))
    centres = g.join(g.select(F.col("centroid_99").alias("gene_id")).distinct(), "gene_id", "left_semi")
    return workflows.build_pangenome(records(g, "centroid_99"), {c: records(centres, c) for c in ("centroid_95", "centroid_75")})


@query(with_views("v_feat", "v_hits") + """ k AS (SELECT DISTINCT contig_id, 100000 + contig_id AS contig_length FROM v_feat WHERE contig_id < 15)
SELECT kind, f.gene_id, h.hit_id, contig_length FROM v_feat f JOIN k USING (contig_id) JOIN v_hits h ON f.contig_id = h.contig_id AND f.start_pos < h.end_pos AND h.start_pos < f.end_pos JOIN (SELECT unnest(['genomad_virus', 'resfinder']) AS kind) x ON (hit_id % 2 = 0) = (kind = 'resfinder')""")
def annotate_pangenome(spark, sf_dir):
    features, hits = bind(spark, sf_dir, "v_feat"), bind(spark, sf_dir, "v_hits")
    lengths = features.filter("contig_id < 15").select("contig_id", (100000 + F.col("contig_id")).alias("contig_length")).distinct()
    found = workflows.annotate_pangenome(features, lengths, {"genomad_virus": hits.filter("hit_id % 2 = 1"), "resfinder": hits.filter("hit_id % 2 = 0")})
    parts = [rows.select(F.lit(kind).alias("kind"), "gene_id", "hit_id", "contig_length") for kind, rows in found.items()]
    return parts[0].unionByName(parts[1])


FLAG_SQL = ", ".join(f"CAST(gene_id IN (SELECT concat('G', o_orderkey % 9, '_', o_orderkey) FROM orders WHERE o_orderkey % {m} = 0) AS INT) AS is_{n}" for n, m in (("phage", 5), ("plasmid", 7), ("amr", 11), ("me", 13)))


@query(VOTE + f""", flags AS (SELECT g.*, {FLAG_SQL} FROM g),
ratio AS (SELECT centroid_95, avg(is_phage) AS phage_ratio, avg(is_plasmid) AS plasmid_ratio, avg(is_amr) AS amr_ratio, avg(is_me) AS me_ratio FROM flags GROUP BY 1)
SELECT g.centroid_95, p.genome_counts, c.gene_counts, c.cluster_length, v.marker_density, v.marker_id, r.phage_ratio, r.plasmid_ratio, r.amr_ratio, r.me_ratio, CASE WHEN g.gene_length % 3 <> 0 THEN concat('C', g.gene_length % 7) END AS "COG_category"
FROM g JOIN {PREV} p USING (centroid_95) JOIN (SELECT centroid_95, count(*) AS gene_counts, max(gene_length) AS cluster_length FROM g GROUP BY 1) c USING (centroid_95) JOIN vote v USING (centroid_95) JOIN ratio r USING (centroid_95) WHERE g.gene_id = g.centroid_95""")
def enhance_pangenome(spark, sf_dir):
    hits = hit_genes(spark, sf_dir)
    annotated = {"genomad_virus": hits["phage"], "genomad_plasmid": hits["plasmid"], "mefinder": hits["amr"], "resfinder": hits["me"]}
    wide = workflows.enhance_pangenome(genes(spark, sf_dir), "centroid_95", annotated, orthologs(spark, sf_dir))
    return wide.select("centroid_95", "genome_counts", "gene_counts", "cluster_length", "marker_density", "marker_id", "phage_ratio", "plasmid_ratio", "amr_ratio", "me_ratio", "COG_category")


@query("WITH s AS (SELECT doc_id, regexp_replace(upper(text), '[^ACGTN]', '', 'g') AS sequence FROM documents), k AS (SELECT *, concat('GC_', doc_id % 7) AS genome FROM s WHERE length(sequence) >= 1000) SELECT genome, concat(genome, '_C', row_number() OVER (PARTITION BY genome ORDER BY doc_id), '_L', printf('%.1f', length(sequence) / 1000), 'k_H', right(md5(sequence), 6)) AS contig_id, sequence FROM k")
def import_genome(spark, sf_dir):
    rows = seqs(spark, sf_dir).select(F.concat(F.lit("GC_"), F.col("doc_id") % 7).alias("genome"), F.col("doc_id").alias("contig_no"), "sequence")
    return workflows.import_genome(rows)


@query(PROFILES + """, grid AS (SELECT sp.species_id, s.sample_name, coalesce(p.median_marker_coverage, 0) AS c
  FROM (SELECT DISTINCT species_id FROM profiles) sp CROSS JOIN (SELECT DISTINCT sample_name FROM profiles) s LEFT JOIN profiles p USING (species_id, sample_name))
SELECT species_id, count(*) FILTER (c >= 1) AS sample_counts FROM grid GROUP BY 1 HAVING count(*) FILTER (c >= 1) > 6""")
def species_to_build(spark, sf_dir):
    """Species that more than six samples have: the choice for an index."""
    merged = workflows.merge_species(profiles(spark, sf_dir))
    return workflows.species_to_build(merged, select_threshold=(6,)).select("species_id", "sample_counts")


CHUNKS = """WITH RECURSIVE c AS (SELECT concat('sp', o_orderkey % 40) AS species_id, o_orderkey AS contig_id, o_orderkey * 37 % 5000 + 1 AS length FROM orders),
w AS (SELECT 'run_snps' AS kind, species_id, contig_id, k * 1000 AS start, least(k * 1000 + 1000, length) AS stop, k = 0 AS counts_reads FROM c, range(0, 6) r(k) WHERE k * 1000 < length
  UNION ALL SELECT 'merge_snps', species_id, contig_id, k * 1000, CASE WHEN k = greatest(length // 1000, 1) - 1 THEN length ELSE k * 1000 + 1000 END, k = 0 FROM c, range(0, 6) r(k) WHERE k < greatest(length // 1000, 1)),
piece AS (SELECT kind, species_id, contig_id, stop - start AS length, row_number() OVER (PARTITION BY kind, species_id ORDER BY stop - start DESC, contig_id) AS pos, count(*) OVER (PARTITION BY kind, species_id) AS n FROM w WHERE stop - start < 1000),
step(kind, species_id, taken, high, low, room, chunk_id) AS (
  SELECT kind, species_id, CAST(1 AS BIGINT), CAST(2 AS BIGINT), n, 1000 - length, CAST(0 AS BIGINT) FROM piece WHERE pos = 1
  UNION ALL
  SELECT s.kind, s.species_id, CASE WHEN l.length <= room THEN low ELSE high END, CASE WHEN l.length <= room THEN high ELSE high + 1 END, CASE WHEN l.length <= room THEN low - 1 ELSE low END,
         CASE WHEN l.length <= room THEN room - l.length ELSE 1000 - h.length END, CASE WHEN l.length <= room THEN chunk_id ELSE chunk_id + 1 END
  FROM step s JOIN piece l ON l.kind = s.kind AND l.species_id = s.species_id AND l.pos = s.low JOIN piece h ON h.kind = s.kind AND h.species_id = s.species_id AND h.pos = s.high WHERE s.high <= s.low),
packed AS (SELECT p.kind, p.species_id, p.contig_id, s.chunk_id FROM piece p JOIN step s ON s.kind = p.kind AND s.species_id = p.species_id AND s.taken = p.pos),
full_ AS (SELECT *, row_number() OVER (PARTITION BY kind, species_id ORDER BY contig_id, start) - 1 AS chunk_id FROM w WHERE stop - start >= 1000),
many AS (SELECT species_id, sum(length // 1000) AS n FROM c GROUP BY 1)"""


@query(CHUNKS + """ SELECT kind, species_id, chunk_id, contig_id, start, stop AS "end", counts_reads, false AS pooled FROM full_
UNION ALL SELECT w.kind, w.species_id, CAST(p.chunk_id + m.n AS BIGINT), w.contig_id, w.start, w.stop, w.counts_reads, true FROM w JOIN packed p ON p.kind = w.kind AND p.contig_id = w.contig_id JOIN many m ON m.species_id = w.species_id WHERE w.stop - w.start < 1000""")
def compute_chunks(spark, sf_dir):
    """Both plans: full windows in order, behind them what is packed."""
    rows = contigs(spark, sf_dir).withColumn("species_id", F.concat(F.lit("sp"), F.col("contig_id") % 40))
    plan = lambda kind: workflows.compute_chunks(rows, kind, chunk_size=1000).select(F.lit(kind).alias("kind"), "species_id", "chunk_id", "contig_id", "start", "end", "counts_reads", "pooled")
    return plan("run_snps").union(plan("merge_snps"))


#: Genes with all six levels of clusters; each is nested in the next.
SIX = [f"concat('G', p_partkey // {k} * {k} % 9, '_', p_partkey // {k} * {k}) AS centroid_{x}" for x, k in ((99, 2), (95, 4), (90, 8), (85, 16), (80, 32), (75, 64))]
SIX_SQL = with_views("v_genes") + f"g AS (SELECT v.gene_id, gene_length, v.marker_id, regexp_replace(v.gene_id, '_[^_]*$', '') AS genome_id, {', '.join(SIX)} FROM v_genes v JOIN part ON p_partkey = CAST(regexp_extract(v.gene_id, '_([0-9]+)$', 1) AS BIGINT))"


def six_levels(spark, sf_dir) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("concat('G', p_partkey % 9, '_', p_partkey) AS gene_id", *[x.replace("//", "div") for x in SIX])
    return bind(spark, sf_dir, "v_genes").select("gene_id", "gene_length", "marker_id").join(part, "gene_id")


AUGMENTED = SIX_SQL + """, each AS (SELECT level, cluster AS centroid_id, gene_id, gene_length, marker_id, genome_id FROM (UNPIVOT g ON centroid_99, centroid_95, centroid_90, centroid_85, centroid_80, centroid_75 INTO NAME level VALUE cluster) u),
votes AS (SELECT level, centroid_id, marker_id, count(*) AS k FROM each WHERE marker_id IS NOT NULL GROUP BY 1, 2, 3),
top AS (SELECT level, centroid_id, max(k) AS k, arg_max(marker_id, k) AS marker_id, count(*) FILTER (k = m) AS ties FROM (SELECT *, max(k) OVER (PARTITION BY level, centroid_id) AS m FROM votes) v GROUP BY 1, 2),
info AS (SELECT level, centroid_id, count(DISTINCT genome_id) AS genome_counts, count(*) AS gene_counts, max(gene_length) AS cluster_length, count(DISTINCT genome_id) / (SELECT count(DISTINCT genome_id) FROM g) AS genome_prevalence FROM each GROUP BY 1, 2 HAVING bool_or(gene_id = centroid_id)),
clusters AS (SELECT info.*, CASE WHEN ties = 1 THEN k / gene_counts ELSE CAST(0 AS DOUBLE) END AS marker_density, CASE WHEN ties = 1 AND k / gene_counts > 0.5 THEN marker_id END AS marker_id FROM info LEFT JOIN top USING (level, centroid_id))"""


def augmented(spark, sf_dir) -> workflows.Tables:
    contigs_ = seqs(spark, sf_dir).select(F.concat(F.lit("G"), F.col("doc_id") % 9).alias("genome_id"), F.col("gene_id").alias("contig_id"), "sequence")
    return workflows.augment_pangenome(six_levels(spark, sf_dir), contigs_, "G3")


@query(AUGMENTED + " SELECT * FROM clusters")
def augment_pangenome(spark, sf_dir):
    """Clusters at six levels."""
    return augmented(spark, sf_dir)["clusters"]


@query(SIX_SQL + ", x AS (SELECT 1) SELECT DISTINCT 'stacked' AS part, centroid_75 AS id, genome_id AS of FROM g UNION ALL SELECT 'lifted', gene_id, centroid_99 FROM g WHERE genome_id = 'G3' UNION ALL SELECT 'parents', centroid_99, centroid_75 FROM g WHERE gene_id = centroid_99")
def augment_pangenome_parts(spark, sf_dir):
    """The other tables of the workflow: genomes of clusters, genes of the representative genome, parents of centroids."""
    t = augmented(spark, sf_dir)
    part = lambda name, key, of: t[name].select(F.lit(name).alias("part"), F.col(key).alias("id"), F.col(of).alias("of"))
    return part("stacked", "centroid_75", "genome_id").unionByName(part("lifted", "gene_id", "centroid_99")).unionByName(part("parents", "centroid_99", "centroid_75"))


PRUNED = AUGMENTED + """, c99 AS (SELECT g.centroid_99, g.centroid_95, g.centroid_75, c.cluster_length AS gene_length FROM g JOIN clusters c ON c.level = 'centroid_99' AND c.centroid_id = g.centroid_99 WHERE g.gene_id = g.centroid_99),
kept AS (SELECT c99.* FROM c99 JOIN (SELECT centroid_95, {how}(gene_length) AS parent FROM c99 GROUP BY 1) p USING (centroid_95) WHERE gene_length >= parent * {cutoff}),
coarse AS (SELECT centroid_id FROM clusters WHERE level = 'centroid_75' {alone})
SELECT centroid_99 AS gene_id, upper(concat('acgt', gene_length)) AS sequence FROM kept WHERE centroid_75 IN (SELECT centroid_id FROM coarse)"""
ALONE = "AND NOT (gene_counts = 1 AND genome_prevalence < 0.1 AND genome_counts = 1)"


def pruned(spark, sf_dir, **how) -> DataFrame:
    t = augmented(spark, sf_dir)
    level = lambda x: t["clusters"].filter(F.col("level") == x)
    clusters = t["parents"].join(level("centroid_99").select(F.col("centroid_id").alias("centroid_99"), F.col("cluster_length").alias("gene_length")), "centroid_99")
    bases = clusters.select(F.col("centroid_99").alias("gene_id"), F.concat(F.lit("acgt"), "gene_length").alias("sequence"))
    return workflows.prune_centroids(clusters, level("centroid_75").withColumnRenamed("centroid_id", "centroid_75"), bases, **how)


@query(PRUNED.format(how="max", cutoff=0.4, alone=""))
def prune_centroids(spark, sf_dir):
    return pruned(spark, sf_dir)


@query(PRUNED.format(how="median", cutoff=0.9, alone=ALONE))
def prune_centroids_without_singletons(spark, sf_dir):
    return pruned(spark, sf_dir, prune_method="median", prune_cutoff=0.9, remove_singletons=True)


@query(f"""WITH m AS (SELECT concat('G', p_partkey % 400) AS genome_id, concat('G', p_partkey % 400, '_', p_partkey) AS gene_id, 201 + p_size * 30 AS gene_length, concat('B', p_partkey % 15) AS marker_id, concat('acgt', p_partkey) AS bases FROM part), {TOC}
SELECT toc.species AS species_id, genome_id, gene_id, CAST(gene_length AS INT) AS gene_length, marker_id, upper(bases) AS sequence FROM m JOIN toc ON toc.genome = m.genome_id WHERE marker_id <> 'B3'""")
def build_markerdb(spark, sf_dir):
    """The marker genes of all genomes under their species, map and bases."""
    genes_ = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("concat('G', p_partkey % 400) AS genome_id", "concat('G', p_partkey % 400, '_', p_partkey) AS gene_id", "cast(201 + p_size * 30 AS int) AS gene_length", "concat('B', p_partkey % 15) AS marker_id", "concat('acgt', p_partkey) AS marker_gene")
    found = workflows.build_markerdb(genes_, toc(spark, sf_dir), markers=[f"B{k}" for k in range(15) if k != 3])
    return found["map"].join(found["sequences"], "gene_id").select("species_id", "genome_id", "gene_id", "gene_length", "marker_id", "sequence")


#: Species that are deep enough in their sample, by a profile of the reads.
PROFILE_SQL = "deep_enough AS (SELECT sample_name, species_id FROM reads GROUP BY 1, 2 HAVING count(*) > (SELECT count(*) FROM reads) / 6)"


@query(COLS_SQL + PROFILE_SQL + " SELECT sample_name, species_id, count(*) AS aligned_reads FROM reads JOIN deep_enough USING (sample_name, species_id) GROUP BY 1, 2")
def run_snps_chosen(spark, sf_dir):
    """Variants of the species alone that a profile puts above a threshold in their sample."""
    r = reads(spark, sf_dir)
    profile = r.groupBy("sample_name", "species_id").agg(F.count(F.lit(1)).alias("marker_read_counts"))
    least = r.count() / 6
    found = workflows.run_snps(r, bindings.genome(spark), profile=profile, select_by=["marker_read_counts"], select_threshold=[least], **SNPS)
    return found["summary"].select("sample_name", "species_id", "aligned_reads")


@query(PAN + """, m AS (SELECT gene_id, max(marker_id) AS marker_id FROM g WHERE marker_id IS NOT NULL GROUP BY 1)
SELECT a.gene_id, b.centroid_95 AS centroid_99, c.centroid_75, a.gene_length, coalesce(m.marker_id, '') AS marker_id FROM g a JOIN g b ON b.gene_id = a.centroid_99 JOIN g c ON c.gene_id = b.centroid_95 LEFT JOIN m ON m.gene_id = a.gene_id""")
def recluster_centroids(spark, sf_dir):
    """Centroids of the finest level clustered again: the next level takes its place."""
    g = genes(spark, sf_dir)
    members, again = g.select("gene_id", F.col("centroid_99").alias("centroid_id")), g.select("gene_id", F.col("centroid_95").alias("centroid_id"))
    return workflows.recluster_centroids(members, again, {"centroid_75": g.select("gene_id", F.col("centroid_75").alias("centroid_id"))}, g.select("gene_id", "gene_length"), g.filter("marker_id IS NOT NULL").select("gene_id", "marker_id"))


@query("WITH s AS (SELECT concat('g_', doc_id) AS gene_id, regexp_replace(upper(text), '[^ACGTN]', '', 'g') AS sequence FROM documents), h AS (SELECT concat('B', l_partkey % 40) AS marker_id, l_orderkey % 100 AS doc, l_discount / 10000 AS evalue, (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS row_no FROM lineitem), best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY marker_id ORDER BY evalue, row_no) AS k FROM h WHERE evalue <= 1e-5) x WHERE k = 1) SELECT s.gene_id, b.marker_id, CAST(length(s.sequence) AS INT) AS gene_length, s.sequence AS marker_gene FROM best b JOIN s ON s.gene_id = concat('g_', b.doc)")
def infer_markers(spark, sf_dir):
    hits = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("concat('B', l_partkey % 40) AS marker_id", "concat('g_', l_orderkey % 100) AS gene_id", "l_discount / 10000 AS evalue", "1.0 AS qcov", "1.0 AS tcov", "(l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS row_no")
    return workflows.infer_markers(hits, seqs(spark, sf_dir))

"""Queries of the workflows over the test tables, and for each the SQL that states its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import alleles, sequences
from ..operators import chunks, cnv, intervals, pangenome, pileup, readqc, selectors, snv, species
from .bindings import bind, with_views
from .registry import query, rounded

SAMPLES = [f"s{i}" for i in range(8)]
BASE_QUALITY = 22
KEY = ["species_id", "ref_id", "ref_pos", "ref_allele"]
RELEVANCE = {"genome_depth": 1.0, "genome_coverage": 0.1, "sample_counts": 2}

# ---------------------------------------------------------------- pileup and variants


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, "v_obs")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.pileup(obs(spark, sf_dir), base_quality=BASE_QUALITY)


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).groupBy("species_id").agg(F.max("ref_pos").alias("genome_length"))


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.summary(obs(spark, sf_dir), genomes(spark, sf_dir), base_quality=BASE_QUALITY)


def relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snv.relevant(summaries(spark, sf_dir), **RELEVANCE)


def good_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snv.site_filter(snv.noise_floor(sites(spark, sf_dir)), relevant(spark, sf_dir))


PILE = with_views("v_obs") + f"""
pile AS (SELECT sample_name, species_id, ref_id, ref_pos, ref_allele,
  count(*) FILTER (base = 'A') AS count_a, count(*) FILTER (base = 'C') AS count_c,
  count(*) FILTER (base = 'G') AS count_g, count(*) FILTER (base = 'T') AS count_t,
  count(*) FILTER (base IN ('A', 'C', 'G', 'T')) AS depth
  FROM v_obs WHERE base_qual >= {BASE_QUALITY} GROUP BY ALL)"""
SUMMARY = PILE + f""",
genome AS (SELECT species_id, max(ref_pos) AS genome_length FROM v_obs GROUP BY 1),
covered AS (SELECT sample_name, species_id, count(*) AS covered_bases, CAST(sum(depth) AS BIGINT) AS total_depth FROM pile WHERE depth > 0 GROUP BY 1, 2),
reads AS (SELECT sample_name, species_id, count(DISTINCT read_id) AS aligned_reads, count(DISTINCT CASE WHEN base_qual >= {BASE_QUALITY} THEN read_id END) AS mapped_reads FROM v_obs GROUP BY 1, 2),
summary AS (SELECT *, covered_bases / genome_length AS fraction_covered, total_depth / covered_bases AS mean_depth FROM covered JOIN reads USING (sample_name, species_id) JOIN genome USING (species_id))"""
RELEVANT = SUMMARY + """,
deep AS (SELECT * FROM summary WHERE mean_depth >= 1 AND fraction_covered >= 0.1),
rel AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY species_id) AS samples_count FROM deep) WHERE samples_count >= 2)"""
FLOOR = """,
quiet AS (SELECT sample_name, species_id, ref_id, ref_pos, ref_allele, a AS count_a, c AS count_c, g AS count_g, t AS count_t, a + c + g + t AS depth FROM (
  SELECT *, CASE WHEN count_a > 2 THEN count_a ELSE 0 END AS a, CASE WHEN count_c > 2 THEN count_c ELSE 0 END AS c,
         CASE WHEN count_g > 2 THEN count_g ELSE 0 END AS g, CASE WHEN count_t > 2 THEN count_t ELSE 0 END AS t FROM pile) f)"""
GOOD = RELEVANT + FLOOR + """,
good AS (SELECT q.*, r.mean_depth, r.samples_count FROM quiet q JOIN rel r USING (sample_name, species_id) WHERE q.depth >= 5 AND q.depth / r.mean_depth <= 3)"""
POOLED = GOOD + """,
pooled AS (SELECT species_id, ref_id, ref_pos, ref_allele, count(*) AS count_samples, any_value(samples_count) AS samples_count,
  CAST(sum(count_a) AS BIGINT) AS rc_a, CAST(sum(count_c) AS BIGINT) AS rc_c, CAST(sum(count_g) AS BIGINT) AS rc_g, CAST(sum(count_t) AS BIGINT) AS rc_t,
  count(*) FILTER (count_a > 0) AS sc_a, count(*) FILTER (count_c > 0) AS sc_c, count(*) FILTER (count_g > 0) AS sc_g, count(*) FILTER (count_t > 0) AS sc_t
  FROM good GROUP BY 1, 2, 3, 4)"""


def calls(source: str, keys: str, prefix: str, depth: str, maf: float) -> str:
    """SQL of the alleles that pass at each key: bases, in order."""
    columns = ", ".join(f"{prefix}{b}" for b in "acgt")
    return f""",
calls AS (SELECT {keys}, list(b ORDER BY n DESC, b) AS bs FROM (
  SELECT {keys}, unnest(['A', 'C', 'G', 'T']) AS b, unnest([{columns}]) AS n, {depth} AS d FROM {source}) u
  WHERE n >= 2 AND n / d >= {maf} GROUP BY {keys})"""


SNP = "['mono', 'bi', 'tri', 'quad'][len(bs)]"


def picked(base: str, prefix: str = "count_") -> str:
    return f"CASE {base} " + " ".join(f"WHEN '{b}' THEN {prefix}{b.lower()}" for b in "ACGT") + " END"


@query(PILE + " SELECT * FROM pile WHERE depth >= 2")
def pileup_basic(spark, sf_dir):
    return pileup.deep_sites(sites(spark, sf_dir), site_depth=2)


@query(SUMMARY + " SELECT * FROM summary")
def pileup_summary(spark, sf_dir):
    return summaries(spark, sf_dir)


@query(PILE + """ SELECT * FROM pile WHERE depth >= 2 AND NOT (
  (count_a > 0 AND count_a IN (count_c, count_g, count_t)) OR (count_c > 0 AND count_c IN (count_g, count_t)) OR (count_g > 0 AND count_g = count_t))""")
def pileup_unambiguous(spark, sf_dir):
    return pileup.deep_sites(sites(spark, sf_dir), site_depth=2, ignore_ambiguous=True)


ADVANCED = PILE + calls("pile", "sample_name, species_id, ref_id, ref_pos, ref_allele", "count_", "depth", 0.1) + f""",
adv AS (SELECT p.*, bs[1] AS major_allele, bs[least(2, len(bs))] AS minor_allele, CAST(len(bs) AS INT) AS allele_counts FROM pile p JOIN calls USING (sample_name, species_id, ref_id, ref_pos, ref_allele) WHERE depth >= 2)
SELECT *, {picked('major_allele')} / depth AS major_allele_freq, CASE WHEN major_allele = minor_allele THEN 0.0::DOUBLE ELSE {picked('minor_allele')} / depth END AS minor_allele_freq FROM adv"""


@query(ADVANCED)
def pileup_advanced(spark, sf_dir):
    return pileup.advanced(pileup.deep_sites(sites(spark, sf_dir), site_depth=2), snp_maf=0.1)


@query(RELEVANT + " SELECT sample_name, species_id, mean_depth, fraction_covered, samples_count FROM rel")
def species_relevance(spark, sf_dir):
    return relevant(spark, sf_dir).select("sample_name", "species_id", "mean_depth", "fraction_covered", "samples_count")


@query(PILE + FLOOR + " SELECT * FROM quiet")
def allele_noise_floor(spark, sf_dir):
    return snv.noise_floor(sites(spark, sf_dir))


@query(GOOD + " SELECT * FROM good")
def site_filter(spark, sf_dir):
    return good_sites(spark, sf_dir)


@query(POOLED + " SELECT * FROM pooled")
def pooled_counts(spark, sf_dir):
    return snv.pooled(good_sites(spark, sf_dir))


@query(POOLED + " SELECT * FROM pooled WHERE count_samples / samples_count >= 0.9")
def prevalence_common(spark, sf_dir):
    return snv.prevalent(snv.pooled(good_sites(spark, sf_dir)))


@query(POOLED + " SELECT * FROM pooled WHERE count_samples / samples_count <= 0.9")
def prevalence_rare(spark, sf_dir):
    return snv.prevalent(snv.pooled(good_sites(spark, sf_dir)), snv_type="rare")


def called(spark, sf_dir, keep_samples: bool = False, **how) -> DataFrame:
    return snv.population(snv.prevalent(snv.pooled(good_sites(spark, sf_dir), keep_samples=keep_samples)), **how)


KEYS = "species_id, ref_id, ref_pos, ref_allele"
COMMON = POOLED + ", common AS (SELECT * FROM pooled WHERE count_samples / samples_count >= 0.9)"
BY_SAMPLES = COMMON + calls("common", KEYS, "sc_", "count_samples", 0.05)
BY_READS = COMMON + calls("common", KEYS, "rc_", "(rc_a + rc_c + rc_g + rc_t)", 0.05)
SELECT_CALLS = f" SELECT c.*, bs[1] AS major_allele, bs[least(2, len(bs))] AS minor_allele, {SNP} AS snp_type FROM common c JOIN calls USING ({KEYS})"


@query(BY_SAMPLES + SELECT_CALLS + " WHERE len(bs) >= 2")
def pop_snps_prevalence(spark, sf_dir):
    return called(spark, sf_dir)


@query(BY_READS + SELECT_CALLS + " WHERE len(bs) >= 2")
def pop_snps_abundance(spark, sf_dir):
    return called(spark, sf_dir, method="abundance")


@query(BY_SAMPLES + SELECT_CALLS + " WHERE len(bs) = 3")
def snp_type_filter(spark, sf_dir):
    return called(spark, sf_dir, snp_types=("tri",))


@query(BY_SAMPLES.replace("/ d >= 0.05", "/ d >= 0.8") + SELECT_CALLS + " WHERE len(bs) = 1")
def mono_sites(spark, sf_dir):
    return called(spark, sf_dir, snp_maf=0.8, snp_types=("mono",))


FREQ = BY_SAMPLES + f""",
pop AS (SELECT {KEYS}, bs[1] AS ma, bs[least(2, len(bs))] AS mi FROM common JOIN calls USING ({KEYS}) WHERE len(bs) >= 2),
every AS (SELECT pop.*, rel.sample_name FROM pop JOIN rel USING (species_id)),
seen AS (SELECT e.*, coalesce({picked('ma')}, 0) AS x, coalesce({picked('mi')}, 0) AS y FROM every e LEFT JOIN good USING (sample_name, {KEYS})),
freq AS (SELECT sample_name, {KEYS}, x + y AS sample_depth, CASE WHEN x + y = 0 THEN CAST(-1 AS DOUBLE) ELSE y / (x + y) END AS sample_maf FROM seen)"""


def frequencies(spark, sf_dir) -> DataFrame:
    return snv.frequencies(called(spark, sf_dir, keep_samples=True), relevant(spark, sf_dir))


@query(FREQ + f" SELECT sample_name, {KEYS}, sample_depth, sample_maf FROM freq")
def looked_up_frequencies(spark, sf_dir):
    """The same from called sites and a table of all sites."""
    return snv.sample_frequencies(called(spark, sf_dir), good_sites(spark, sf_dir), relevant(spark, sf_dir))


@query(FREQ + f" SELECT sample_name, {KEYS}, sample_maf FROM freq")
def sample_maf_long(spark, sf_dir):
    return frequencies(spark, sf_dir).drop("sample_depth")


@query(FREQ + f" SELECT sample_name, {KEYS}, sample_depth FROM freq")
def sample_depth_long(spark, sf_dir):
    return frequencies(spark, sf_dir).drop("sample_maf")


def pivot_sql(source: str, keys: str, value: str, missing: str, names: list[str] = SAMPLES) -> str:
    return f" SELECT {keys}, " + ", ".join(f"coalesce(max({value}) FILTER (sample_name = '{n}'), {missing}) AS {n}" for n in names) + f" FROM {source} GROUP BY {keys}"


@query(FREQ + pivot_sql("freq", KEYS, "sample_maf", "CAST(-1 AS DOUBLE)"))
def maf_matrix(spark, sf_dir):
    return snv.matrix(frequencies(spark, sf_dir), KEY, "sample_name", "sample_maf", SAMPLES, -1.0)


@query(FREQ + pivot_sql("freq", KEYS, "sample_depth", "0"))
def depth_matrix(spark, sf_dir):
    return snv.matrix(frequencies(spark, sf_dir), KEY, "sample_name", "sample_depth", SAMPLES, 0)


# ---------------------------------------------------------------- species


def aln(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "v_aln")


def markers(spark, sf_dir) -> DataFrame:
    return aln(spark, sf_dir).select("species_id", "marker_id", (F.substring("marker_id", 2, 9).cast("int") * 30 + 900).alias("marker_length")).distinct()


def cutoffs(spark, sf_dir) -> DataFrame:
    return aln(spark, sf_dir).select("marker_id", (F.substring("marker_id", 2, 9).cast("int") % 4 + 92).cast("double").alias("marker_cutoff")).distinct()


def passed(spark, sf_dir) -> DataFrame:
    return species.passing_hits(aln(spark, sf_dir), cutoffs(spark, sf_dir), aln_cov=0.5)


HITS = with_views("v_aln") + """
passed AS (SELECT * FROM v_aln WHERE pid >= CAST(substr(marker_id, 2) AS INT) % 4 + 92 AND aln / qlen >= 0.5)"""
BEST = HITS + """,
best AS (SELECT *, count(*) OVER (PARTITION BY query) AS n_best FROM (SELECT *, rank() OVER (PARTITION BY query ORDER BY score DESC) AS r FROM passed) x WHERE r = 1)"""
UNIQUE = BEST + """,
uniq_all AS (SELECT species_id, marker_id, CAST(sum(aln) AS BIGINT) AS alnbps, count(*) AS reads FROM best WHERE n_best = 1 GROUP BY 1, 2),
uniq AS (SELECT * FROM uniq_all WHERE reads >= 2 AND species_id IN (SELECT species_id FROM uniq_all WHERE reads >= 2 GROUP BY 1 HAVING count(*) >= 2))"""
AMBI = UNIQUE + """,
genes AS (SELECT query, target, species_id, marker_id, arg_max(aln, aln_no) AS aln FROM best WHERE n_best > 1 GROUP BY 1, 2, 3, 4),
weighed AS (SELECT g.*, coalesce(u.reads, 0) AS w FROM genes g LEFT JOIN uniq u USING (species_id, marker_id)),
shares AS (SELECT *, CASE WHEN sum(w) OVER q > 0 THEN w / sum(w) OVER q ELSE 1 / count(*) OVER q END AS share FROM weighed WINDOW q AS (PARTITION BY query)),
ambi_all AS (SELECT species_id, marker_id, sum(share * aln) AS alnbps, sum(share) AS reads FROM shares GROUP BY 1, 2)"""
MATRIX = AMBI + """,
ambi AS (SELECT * FROM ambi_all WHERE round(reads, 6) >= 2 AND species_id IN (SELECT species_id FROM ambi_all WHERE round(reads, 6) >= 2 GROUP BY 1 HAVING count(*) >= 2)),
mk AS (SELECT DISTINCT species_id, marker_id, CAST(substr(marker_id, 2) AS INT) * 30 + 900 AS marker_length FROM v_aln),
mat AS (SELECT m.*, coalesce(u.reads, 0) AS uniq_reads, coalesce(u.alnbps, 0) AS uniq_alnbps, coalesce(a.reads, 0) AS ambi_reads, coalesce(a.alnbps, 0) AS ambi_alnbps,
  (coalesce(u.alnbps, 0) + coalesce(a.alnbps, 0)) / marker_length AS coverage
  FROM mk m LEFT JOIN uniq u USING (species_id, marker_id) LEFT JOIN ambi a USING (species_id, marker_id)
  WHERE species_id IN (SELECT species_id FROM uniq UNION SELECT species_id FROM ambi))"""
PROFILE = MATRIX + """,
prof AS (SELECT species_id, sum(uniq_reads + ambi_reads) AS n, median(coverage) AS med, sum(uniq_alnbps + ambi_alnbps) / sum(marker_length) AS cov, count(*) FILTER (uniq_reads > 0) / count(*) AS frac FROM mat GROUP BY 1)"""


@query(HITS + " SELECT * FROM passed")
def hit_filter(spark, sf_dir):
    return passed(spark, sf_dir)


def best(spark, sf_dir) -> DataFrame:
    return species.best_hits(passed(spark, sf_dir))


@query(BEST + " SELECT * EXCLUDE (r) FROM best")
def best_hits(spark, sf_dir):
    return best(spark, sf_dir)


@query(UNIQUE + " SELECT * FROM uniq_all")
def unique_counts(spark, sf_dir):
    return species.unique_counts(best(spark, sf_dir))


def supported(spark, sf_dir) -> DataFrame:
    return species.marker_support(species.unique_counts(best(spark, sf_dir)))


@query(UNIQUE + " SELECT * FROM uniq")
def marker_support(spark, sf_dir):
    return supported(spark, sf_dir)


def expected(spark, sf_dir) -> DataFrame:
    return species.ambiguous_expected(species.ambiguous_weights(best(spark, sf_dir), supported(spark, sf_dir)))


@query(AMBI + " SELECT species_id, marker_id, round(alnbps, 6) AS alnbps, round(reads, 6) AS reads FROM ambi_all")
def ambiguous_expected(spark, sf_dir):
    return rounded(expected(spark, sf_dir), "alnbps", "reads")


DRAWN = AMBI + """,
placed AS (SELECT *, sum(share) OVER (PARTITION BY query ORDER BY target ROWS UNBOUNDED PRECEDING) AS up_to, CAST('0x' || substr(md5(query), 1, 8) AS BIGINT) / 4294967296 AS u FROM shares)
SELECT query, target, species_id, marker_id, aln FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN up_to > u THEN 0 ELSE 1 END, target) AS k FROM placed) z WHERE k = 1"""


@query(DRAWN)
def ambiguous_drawn(spark, sf_dir):
    return species.drawn(species.ambiguous_weights(best(spark, sf_dir), supported(spark, sf_dir))).select("query", "target", "species_id", "marker_id", "aln")


def filled(spark, sf_dir) -> DataFrame:
    return species.support_matrix(best(spark, sf_dir), markers(spark, sf_dir))


@query(MATRIX + " SELECT * REPLACE (round(ambi_reads, 6) AS ambi_reads, round(ambi_alnbps, 6) AS ambi_alnbps, round(coverage, 6) AS coverage) FROM mat")
def marker_matrix(spark, sf_dir):
    return rounded(filled(spark, sf_dir), "ambi_reads", "ambi_alnbps", "coverage")


@query(PROFILE + """ SELECT species_id, round(n, 4) AS marker_read_counts, round(med, 6) AS median_marker_coverage, round(cov, 6) AS marker_coverage,
  round(cov / sum(cov) OVER (), 6) AS marker_relative_abundance, frac AS unique_fraction_covered FROM prof""")
def species_profile(spark, sf_dir):
    return rounded(rounded(species.species_profile(filled(spark, sf_dir)), "median_marker_coverage", "marker_coverage", "marker_relative_abundance"), "marker_read_counts", digits=4)


@query(PROFILE + " SELECT species_id, round(med, 6) AS median_marker_coverage FROM prof WHERE med > 2 AND frac > 0.2")
def species_select(spark, sf_dir):
    return rounded(species.select_species(species.species_profile(filled(spark, sf_dir)), {"median_marker_coverage": 2.0, "unique_fraction_covered": 0.2}).select("species_id", "median_marker_coverage"), "median_marker_coverage")


def profiles(spark, sf_dir) -> DataFrame:
    """Per-sample profiles: shares of depth stand for abundance; two samples lack some species."""
    rows = summaries(spark, sf_dir).filter(~(F.col("sample_name").isin("s1", "s2") & F.col("species_id").isin("sp1", "sp3")))
    total = rows.groupBy("sample_name").agg(F.sum("total_depth").alias("all_depth"))
    return rows.join(total, "sample_name").select("sample_name", "species_id", (F.col("total_depth") / F.col("all_depth")).alias("marker_relative_abundance"), F.col("mean_depth").alias("median_marker_coverage"))


PROFILES = SUMMARY + """,
profiles AS (SELECT sample_name, species_id, total_depth / sum(total_depth) OVER (PARTITION BY sample_name) AS marker_relative_abundance, mean_depth AS median_marker_coverage
  FROM summary WHERE NOT (sample_name IN ('s1', 's2') AND species_id IN ('sp1', 'sp3')))"""


@query(PROFILES + """, grid AS (SELECT sp.species_id, s.sample_name, coalesce(p.marker_relative_abundance, 0) AS a, coalesce(p.median_marker_coverage, 0) AS c
  FROM (SELECT DISTINCT species_id FROM profiles) sp CROSS JOIN (SELECT DISTINCT sample_name FROM profiles) s LEFT JOIN profiles p USING (species_id, sample_name))
SELECT species_id, round(median(a), 5) AS median_abundance, round(avg(a), 5) AS mean_abundance, round(median(c), 5) AS median_coverage, round(avg(c), 5) AS mean_coverage, count(*) FILTER (c >= 1) AS sample_counts FROM grid GROUP BY 1""")
def species_prevalence(spark, sf_dir):
    return rounded(species.merge_profiles(profiles(spark, sf_dir)), "median_abundance", "mean_abundance", "median_coverage", "mean_coverage", digits=5)


@query(PROFILES + pivot_sql("profiles", "species_id", "median_marker_coverage", "CAST(0 AS DOUBLE)"))
def species_matrix(spark, sf_dir):
    return snv.matrix(profiles(spark, sf_dir), ["species_id"], "sample_name", "median_marker_coverage", SAMPLES, 0.0)


# ---------------------------------------------------------------- copy number

GENE_OBS = ["concat('s', l_suppkey % 8) AS sample_name", "concat('sp', cast((l_partkey - l_partkey % 2) / 2 AS bigint) % 3) AS species_id", "l_partkey - l_partkey % 2 AS cluster_id", "l_orderkey AS read_id", "l_linenumber * 6 + 10 AS base_qual"]


def clusters(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "v_genes").groupBy(F.col("c99").alias("cluster_id")).agg(F.max("gene_length").alias("gene_length"), F.max("marker_id").alias("marker_id"))


def depths(spark, sf_dir) -> DataFrame:
    return cnv.gene_depth(spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*GENE_OBS), clusters(spark, sf_dir), base_quality=20)


GENES = with_views("v_genes") + f"""
gobs AS (SELECT {', '.join(GENE_OBS)} FROM lineitem),
clus AS (SELECT c99 AS cluster_id, max(gene_length) AS gene_length, max(marker_id) AS marker_id FROM v_genes GROUP BY 1),
gd AS (SELECT *, total_depth / gene_length AS mean_depth FROM (
  SELECT sample_name, species_id, cluster_id, count(DISTINCT read_id) AS aligned_reads, count(DISTINCT CASE WHEN base_qual >= 20 THEN read_id END) AS mapped_reads, count(*) FILTER (base_qual >= 20) AS total_depth
  FROM gobs GROUP BY 1, 2, 3) x JOIN clus USING (cluster_id) WHERE mapped_reads >= 1 AND total_depth > 0)"""
MARKER_DEPTH = GENES + """,
univ AS (SELECT DISTINCT marker_id FROM clus WHERE marker_id IS NOT NULL),
pairs AS (SELECT DISTINCT sample_name, species_id FROM gd),
md AS (SELECT p.sample_name, p.species_id, median(coalesce(d.depth, 0)) AS marker_depth FROM pairs p CROSS JOIN univ u
  LEFT JOIN (SELECT sample_name, species_id, marker_id, round(sum(mean_depth), 6) AS depth FROM gd WHERE marker_id IS NOT NULL GROUP BY 1, 2, 3) d ON d.sample_name = p.sample_name AND d.species_id = p.species_id AND d.marker_id = u.marker_id GROUP BY 1, 2)"""
COPIES = MARKER_DEPTH + """,
copies AS (SELECT gd.*, md.marker_depth, CASE WHEN md.marker_depth > 0 THEN mean_depth / md.marker_depth ELSE 0 END AS copy_number FROM gd JOIN md USING (sample_name, species_id))"""
SUMS = COPIES + """,
outs AS (SELECT DISTINCT c99 AS cluster_id, c75 AS cluster_out FROM v_genes),
sums AS (SELECT sample_name, species_id, cluster_out, round(sum(copy_number), 6) AS copy_number, round(sum(mean_depth), 6) AS depth, CAST(sum(mapped_reads) AS BIGINT) AS reads FROM copies JOIN outs USING (cluster_id) GROUP BY 1, 2, 3)"""


@query(GENES + " SELECT * FROM gd")
def gene_depth(spark, sf_dir):
    return depths(spark, sf_dir)


def median_depth(spark, sf_dir) -> DataFrame:
    return cnv.marker_depth(depths(spark, sf_dir), clusters(spark, sf_dir))


@query(MARKER_DEPTH + " SELECT sample_name, species_id, round(marker_depth, 6) AS marker_depth FROM md")
def marker_depth_median(spark, sf_dir):
    return rounded(median_depth(spark, sf_dir), "marker_depth")


def copies(spark, sf_dir) -> DataFrame:
    return cnv.copy_numbers(depths(spark, sf_dir), median_depth(spark, sf_dir))


@query(COPIES + " SELECT sample_name, species_id, cluster_id, round(copy_number, 6) AS copy_number FROM copies")
def copy_number(spark, sf_dir):
    return rounded(copies(spark, sf_dir).select("sample_name", "species_id", "cluster_id", "copy_number"), "copy_number")


@query(MARKER_DEPTH + """, sizes AS (SELECT concat('sp', cast(cluster_id / 2 AS bigint) % 3) AS species_id, count(*) AS pangenome_size FROM clus GROUP BY 1)
SELECT *, covered_genes / pangenome_size AS fraction_covered FROM (SELECT sample_name, species_id, count(*) AS covered_genes, CAST(sum(aligned_reads) AS BIGINT) AS aligned_reads, CAST(sum(mapped_reads) AS BIGINT) AS mapped_reads, round(sum(mean_depth) / count(*), 6) AS mean_depth FROM gd GROUP BY 1, 2) s
JOIN sizes USING (species_id) JOIN (SELECT sample_name, species_id, round(marker_depth, 6) AS marker_depth FROM md) m USING (sample_name, species_id)""")
def gene_summary(spark, sf_dir):
    sizes = clusters(spark, sf_dir).groupBy(F.concat(F.lit("sp"), (F.col("cluster_id") / 2).cast("long") % 3).alias("species_id")).agg(F.count(F.lit(1)).alias("pangenome_size"))
    return rounded(cnv.gene_summary(depths(spark, sf_dir), median_depth(spark, sf_dir), sizes), "mean_depth", "marker_depth")


def outs(spark, sf_dir) -> DataFrame:
    return bind(spark, sf_dir, "v_genes").select(F.col("c99").alias("cluster_id"), F.col("c75").alias("cluster_out")).distinct()


@query(COPIES + " SELECT sample_name, species_id, cluster_id, c75 AS cluster_out FROM copies JOIN (SELECT DISTINCT c99 AS cluster_id, c75 FROM v_genes) o USING (cluster_id)")
def cluster_remap(spark, sf_dir):
    return cnv.remap(copies(spark, sf_dir), outs(spark, sf_dir)).select("sample_name", "species_id", "cluster_id", "cluster_out")


def sums(spark, sf_dir) -> DataFrame:
    return rounded(cnv.cluster_sums(cnv.remap(copies(spark, sf_dir), outs(spark, sf_dir))), "copy_number", "depth")


@query(SUMS + pivot_sql("sums", "species_id, cluster_out", "copy_number", "CAST(0 AS DOUBLE)"))
def gene_matrix_copynum(spark, sf_dir):
    return snv.matrix(sums(spark, sf_dir), ["species_id", "cluster_out"], "sample_name", "copy_number", SAMPLES, 0.0)


@query(SUMS + pivot_sql("sums", "species_id, cluster_out", "depth", "CAST(0 AS DOUBLE)"))
def gene_matrix_depth(spark, sf_dir):
    return snv.matrix(sums(spark, sf_dir), ["species_id", "cluster_out"], "sample_name", "depth", SAMPLES, 0.0)


@query(SUMS + pivot_sql("sums", "species_id, cluster_out", "reads", "0"))
def gene_matrix_reads(spark, sf_dir):
    return snv.matrix(sums(spark, sf_dir), ["species_id", "cluster_out"], "sample_name", "reads", SAMPLES, 0)


@query(SUMS + " SELECT sample_name, species_id, cluster_out, CAST(copy_number >= 0.35 AS INT) AS presabs FROM sums")
def gene_presabs(spark, sf_dir):
    return cnv.presence(sums(spark, sf_dir)).select("sample_name", "species_id", "cluster_out", "presabs")


# ---------------------------------------------------------------- pangenome


def genes(spark, sf_dir) -> DataFrame:
    name = lambda c: F.concat(F.lit("G"), F.col(c) % 9, F.lit("_"), F.col(c))
    return bind(spark, sf_dir, "v_genes").select("gene_id", name("c99").alias("centroid_99"), name("c95").alias("centroid_95"), name("c75").alias("centroid_75"), "gene_length", "marker_id")


PAN = with_views("v_genes") + """
g AS (SELECT gene_id, concat('G', c99 % 9, '_', c99) AS centroid_99, concat('G', c95 % 9, '_', c95) AS centroid_95, concat('G', c75 % 9, '_', c75) AS centroid_75, gene_length, marker_id, regexp_replace(gene_id, '_[^_]*$', '') AS genome_id FROM v_genes)"""
VOTE = PAN + """,
n AS (SELECT centroid_95, marker_id, count(*) AS k FROM g WHERE marker_id IS NOT NULL GROUP BY 1, 2),
tops AS (SELECT centroid_95, max(k) AS k, count(*) FILTER (k = m) AS ties, arg_max(marker_id, k) AS marker_id FROM (SELECT *, max(k) OVER (PARTITION BY centroid_95) AS m FROM n) x GROUP BY 1),
dens AS (SELECT centroid_95, CASE WHEN t.ties = 1 THEN t.k / c.genes ELSE CAST(0 AS DOUBLE) END AS marker_density, t.marker_id AS top FROM (SELECT centroid_95, count(*) AS genes FROM g GROUP BY 1) c LEFT JOIN tops t USING (centroid_95)),
vote AS (SELECT centroid_95, marker_density, CASE WHEN marker_density > 0.5 THEN top END AS marker_id FROM dens)"""
PREV = "(SELECT centroid_95, count(DISTINCT genome_id) AS genome_counts, count(DISTINCT genome_id) / (SELECT count(DISTINCT genome_id) FROM g) AS genome_prevalence FROM g GROUP BY 1)"


@query(PAN + " SELECT gene_id, genome_id FROM g")
def genome_of_gene(spark, sf_dir):
    return genes(spark, sf_dir).select("gene_id", sequences.genome_of(F.col("gene_id")).alias("genome_id"))


@query(PAN + " SELECT a.gene_id, a.centroid_99, b.centroid_95, b.centroid_75 FROM g a JOIN g b ON b.gene_id = a.centroid_99")
def xref_clusters(spark, sf_dir):
    g = genes(spark, sf_dir)
    centres = g.join(g.select(F.col("centroid_99").alias("gene_id")).distinct(), "gene_id", "left_semi")
    coarser = {c: centres.select("gene_id", F.col(c).alias("centroid_id")) for c in ("centroid_95", "centroid_75")}
    return pangenome.xref_clusters(g.select("gene_id", "centroid_99"), coarser).select("gene_id", "centroid_99", "centroid_95", "centroid_75")


@query(PAN + f" SELECT * FROM {PREV} p")
def cluster_prevalence(spark, sf_dir):
    return pangenome.cluster_prevalence(genes(spark, sf_dir), "centroid_95")


@query(PAN + " SELECT centroid_95, count(*) AS gene_counts FROM g GROUP BY 1")
def cluster_counts(spark, sf_dir):
    return pangenome.cluster_counts(genes(spark, sf_dir), "centroid_95")


@query(PAN + " SELECT centroid_95, max(gene_length) AS cluster_length FROM g GROUP BY 1")
def cluster_length_max(spark, sf_dir):
    return pangenome.cluster_lengths(genes(spark, sf_dir), "centroid_95")


@query(PAN + " SELECT centroid_95, median(gene_length) AS cluster_length FROM g GROUP BY 1")
def cluster_length_median(spark, sf_dir):
    return pangenome.cluster_lengths(genes(spark, sf_dir), "centroid_95", "median")


@query(PAN + " SELECT centroid_95, round(avg(gene_length), 6) AS mean_length, median(gene_length) AS median_length, round(stddev_samp(gene_length), 6) AS std_length, min(gene_length) AS min_length, max(gene_length) AS max_length FROM g GROUP BY 1")
def length_stats(spark, sf_dir):
    return rounded(pangenome.length_stats(genes(spark, sf_dir), "centroid_95"), "mean_length", "std_length")


@query(VOTE + " SELECT * FROM vote")
def marker_vote(spark, sf_dir):
    return pangenome.marker_votes(genes(spark, sf_dir), "centroid_95")


@query(VOTE + f""" SELECT g.centroid_95, g.centroid_99, g.centroid_75, p.genome_counts, p.genome_prevalence, c.gene_counts, c.cluster_length, v.marker_density, v.marker_id
FROM g JOIN {PREV} p USING (centroid_95) JOIN (SELECT centroid_95, count(*) AS gene_counts, max(gene_length) AS cluster_length FROM g GROUP BY 1) c USING (centroid_95) JOIN vote v USING (centroid_95) WHERE g.gene_id = g.centroid_95""")
def cluster_info(spark, sf_dir):
    return pangenome.cluster_info(genes(spark, sf_dir), "centroid_95")


@query(PAN + " SELECT DISTINCT centroid_95, genome_id FROM g")
def stacked_matrix(spark, sf_dir):
    return pangenome.stacked_genomes(genes(spark, sf_dir), "centroid_95")


@query(PAN + " SELECT gene_id, centroid_95 FROM g WHERE genome_id = 'G3'")
def lift_to_genome(spark, sf_dir):
    return pangenome.lift_to_genome(genes(spark, sf_dir), "centroid_95", "G3")


def hit_genes(spark, sf_dir) -> dict[str, DataFrame]:
    """Genes with annotations of four kinds, by remainders of the order number."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_orderkey")
    return {n: o.filter(key % m == 0).select(F.concat(F.lit("G"), key % 9, F.lit("_"), key).alias("gene_id")) for n, m in (("phage", 5), ("plasmid", 7), ("amr", 11), ("me", 13))}


FLAGS = PAN + ", flags AS (SELECT g.*, " + ", ".join(f"CAST(gene_id IN (SELECT concat('G', o_orderkey % 9, '_', o_orderkey) FROM orders WHERE o_orderkey % {m} = 0) AS INT) AS gene_is_{n}" for n, m in (("phage", 5), ("plasmid", 7), ("amr", 11), ("me", 13))) + " FROM g)"


@query(FLAGS + " SELECT gene_id, gene_is_phage, gene_is_plasmid, gene_is_amr, gene_is_me FROM flags")
def annot_flags(spark, sf_dir):
    return pangenome.annotation_flags(genes(spark, sf_dir).select("gene_id"), hit_genes(spark, sf_dir))


@query(FLAGS + " SELECT centroid_95, avg(gene_is_phage) AS phage_ratio, avg(gene_is_plasmid) AS plasmid_ratio, avg(gene_is_amr) AS amr_ratio, avg(gene_is_me) AS me_ratio FROM flags GROUP BY 1")
def annot_ratio(spark, sf_dir):
    return pangenome.annotation_ratios(pangenome.annotation_flags(genes(spark, sf_dir), hit_genes(spark, sf_dir)), "centroid_95", ["phage", "plasmid", "amr", "me"])


def pruned(how: str):
    aggregate = {"max": "max", "median": "median", "mean": "avg"}[how]
    sql = PAN + f" SELECT gene_id, centroid_75 FROM (SELECT *, {aggregate}(gene_length) OVER (PARTITION BY centroid_75) AS l FROM g) x WHERE gene_length >= l * 0.4::DOUBLE"
    f = lambda spark, sf_dir: pangenome.prune_short(genes(spark, sf_dir), "centroid_75", how=how).select("gene_id", "centroid_75")
    f.__name__ = f"prune_short_{how}"
    query(sql)(f)


for how in pangenome.LENGTHS:
    pruned(how)


@query(PAN + """ SELECT * FROM (SELECT gene_id AS centroid, 1 + cast(gene_length % 4 > 0 AS INT) AS gene_counts, (gene_length % 3) / 20 AS genome_prevalence, 1 + cast(gene_length % 5 > 1 AS INT) AS genome_counts FROM g) x
WHERE NOT (gene_counts = 1 AND genome_prevalence < 0.1 AND genome_counts = 1)""")
def prune_singletons(spark, sf_dir):
    n = F.col("gene_length")
    rows = genes(spark, sf_dir).select(F.col("gene_id").alias("centroid"), (1 + (n % 4 > 0).cast("int")).alias("gene_counts"), ((n % 3) / 20).alias("genome_prevalence"), (1 + (n % 5 > 1).cast("int")).alias("genome_counts"))
    return pangenome.without_singletons(rows)


@query(PAN + " SELECT gene_id, centroid_95 FROM g WHERE centroid_95 NOT IN (SELECT DISTINCT centroid_95 FROM g WHERE gene_length % 7 = 0)")
def anti_ambiguous(spark, sf_dir):
    g = genes(spark, sf_dir)
    odd = g.filter("gene_length % 7 = 0").select("centroid_95").distinct()
    return g.join(odd, "centroid_95", "left_anti").select("gene_id", "centroid_95")


@query(PAN + " SELECT gene_id, CASE WHEN c95 % 3 = 0 THEN 'new_' || centroid_95 ELSE centroid_95 END AS centroid_id FROM g JOIN (SELECT gene_id, c95 FROM v_genes) v USING (gene_id)")
def replace_centroids(spark, sf_dir):
    raw = bind(spark, sf_dir, "v_genes").filter("c95 % 3 = 0").select(F.concat(F.lit("G"), F.col("c95") % 9, F.lit("_"), F.col("c95")).alias("centroid_id")).distinct()
    return pangenome.replace_centroids(genes(spark, sf_dir).select("gene_id", F.col("centroid_95").alias("centroid_id")), raw.withColumn("new_id", F.concat(F.lit("new_"), "centroid_id")))


# ---------------------------------------------------------------- sequences


def seqs(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.concat(F.lit("g_"), F.col("doc_id")).alias("gene_id"), "doc_id", F.regexp_replace(F.upper("text"), "[^ACGTN]", "").alias("sequence"))


SEQS = "WITH seqs AS (SELECT concat('g_', doc_id) AS gene_id, doc_id, regexp_replace(upper(text), '[^ACGTN]', '', 'g') AS sequence FROM documents)"


@query("WITH seqs AS (SELECT concat('g_', doc_id) AS gene_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') || CASE WHEN doc_id % 5 = 0 THEN 'N' ELSE '' END AS sequence FROM documents) SELECT gene_id, sequence, length(sequence) AS gene_length FROM seqs WHERE length(sequence) > 200 AND NOT regexp_matches(sequence, '[NX]')")
def clean_genes(spark, sf_dir):
    plain = seqs(spark, sf_dir).select("gene_id", F.concat(F.regexp_replace("sequence", "N", ""), F.when(F.col("doc_id") % 5 == 0, "N").otherwise("")).alias("sequence"))
    return pangenome.clean_genes(plain).select("gene_id", "sequence", F.col("gene_length").cast("long"))


@query(SEQS + " SELECT gene_id, reverse(translate(sequence, 'ACGT', 'TGCA')) AS revcomp FROM seqs")
def revcomp(spark, sf_dir):
    return seqs(spark, sf_dir).select("gene_id", sequences.reverse_complement(F.col("sequence")).alias("revcomp"))


@query(SEQS + " SELECT gene_id, CASE WHEN doc_id % 2 = 0 THEN substr(sequence, 11, 50) ELSE reverse(translate(substr(sequence, 11, 50), 'ACGT', 'TGCA')) END AS part FROM seqs")
def subsequence(spark, sf_dir):
    return seqs(spark, sf_dir).select("gene_id", sequences.subsequence(F.col("sequence"), F.lit(11), F.lit(60), F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-")).alias("part"))


#: Amino acids of the codons of table 11, bases in the order T, C, A, G, stops as _. Fixed values.
AMINO = "FFLLSSSSYY__CC_WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = f"code AS (SELECT substr('TCAG', k // 16 + 1, 1) || substr('TCAG', k // 4 % 4 + 1, 1) || substr('TCAG', k % 4 + 1, 1) AS codon, substr('{AMINO}', k + 1, 1) AS aa FROM (SELECT CAST(range AS INT) AS k FROM range(0, 64)) r)"


@query(SEQS + f""", n AS (SELECT gene_id, sequence, unnest(range(0, length(sequence) // 3)) AS k FROM seqs), c AS (SELECT gene_id, k, substr(sequence, CAST(k * 3 + 1 AS INT), 3) AS codon FROM n),
a AS (SELECT gene_id, k, CASE WHEN regexp_full_match(codon, '[ACGT]{{3}}') THEN substr('{AMINO}', 16 * (instr('TCAG', codon[1]) - 1) + 4 * (instr('TCAG', codon[2]) - 1) + instr('TCAG', codon[3]), 1) ELSE '?' END AS aa FROM c)
SELECT s.gene_id, coalesce(string_agg(aa, '' ORDER BY k), '') AS protein FROM seqs s LEFT JOIN a USING (gene_id) GROUP BY 1""")
def translate_codon(spark, sf_dir):
    """All codons of each sequence; ? where one has another letter."""
    amino = F.transform(F.regexp_extract_all("sequence", F.lit("(.{3})")), lambda c: F.coalesce(sequences.translate_codon(c), F.lit("?")))
    return seqs(spark, sf_dir).select("gene_id", F.array_join(amino, "").alias("protein"))


SHIFT = 4


@query(SEQS + f""", w AS (SELECT gene_id, sequence, unnest(range(1, greatest(length(sequence) - {SHIFT}, 0) + 1)) AS i FROM seqs),
d AS (SELECT gene_id, count(*) FILTER (NOT (substr(sequence, CAST(i AS INT), 1) = substr(sequence, CAST(i + {SHIFT} AS INT), 1) AND substr(sequence, CAST(i AS INT), 1) <> 'N')) AS distance FROM w GROUP BY 1)
SELECT seqs.gene_id, CAST(coalesce(distance, 0) AS INT) AS distance FROM seqs LEFT JOIN d USING (gene_id)""")
def hamming(spark, sf_dir):
    """Each whole sequence against itself, moved on by some bases."""
    n = F.greatest(F.length("sequence") - SHIFT, F.lit(0))
    rows = seqs(spark, sf_dir).select("gene_id", F.substring("sequence", F.lit(1), n).alias("a"), F.substring("sequence", F.lit(SHIFT + 1), n).alias("b"))
    return rows.select("gene_id", F.when(F.length("a") > 0, sequences.hamming(F.col("a"), F.col("b"))).otherwise(0).alias("distance"))


@query(SEQS + " SELECT concat('GC_', doc_id % 7) AS genome, concat(concat('GC_', doc_id % 7), '_C', row_number() OVER (PARTITION BY doc_id % 7 ORDER BY doc_id), '_L', printf('%.1f', length(sequence) / 1000), 'k_H', right(md5(sequence), 6)) AS contig FROM seqs WHERE length(sequence) >= 1000")
def contig_rename(spark, sf_dir):
    rows = pangenome.clean_contigs(seqs(spark, sf_dir)).withColumn("genome", F.concat(F.lit("GC_"), F.col("doc_id") % 7))
    return selectors.numbered(rows, ["genome"], ["doc_id"]).select("genome", sequences.contig_name(F.col("genome"), F.col("serial"), F.col("sequence")).alias("contig"))


@query("SELECT doc_id, regexp_matches(text, '[NXnx]') AS ambiguous FROM documents")
def ambiguous_flag(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", sequences.ambiguous(F.col("text")).alias("ambiguous"))


@query(PILE + " SELECT DISTINCT 'gnl|X|' || ref_id || '|' || ref_pos || '|' || ref_allele AS site_id, 'gnl|X|' || ref_id AS ref_id, ref_pos, ref_allele FROM pile")
def site_id_roundtrip(spark, sf_dir):
    ids = sites(spark, sf_dir).select(alleles.site_id(F.concat(F.lit("gnl|X|"), "ref_id"), F.col("ref_pos").cast("string"), F.col("ref_allele")).alias("site_id")).distinct()
    return ids.select("site_id", alleles.parse_site_id(F.col("site_id")).alias("s")).select("site_id", "s.*")


# ---------------------------------------------------------------- intervals


@query(with_views("v_feat", "v_hits") + " x AS (SELECT 1) SELECT f.*, h.hit_id, h.start_pos AS start_pos_hit, h.end_pos AS end_pos_hit FROM v_feat f JOIN v_hits h ON f.contig_id = h.contig_id AND f.start_pos < h.end_pos AND h.start_pos < f.end_pos")
def overlap_join(spark, sf_dir):
    return intervals.overlap_join(bind(spark, sf_dir, "v_feat"), bind(spark, sf_dir, "v_hits"))


TRIM = with_views("v_feat") + "trim AS (SELECT *, CASE WHEN start_pos <= lag(end_pos) OVER w THEN lag(end_pos) OVER w + 1 ELSE start_pos END AS trimmed_start FROM v_feat WINDOW w AS (PARTITION BY contig_id ORDER BY start_pos, gene_id))"


@query(TRIM + " SELECT * FROM trim")
def trim_overlaps(spark, sf_dir):
    return intervals.trim_overlaps(bind(spark, sf_dir, "v_feat"))


def positions(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select((F.col("o_custkey") % 20).alias("contig_id"), (F.col("o_orderkey") % 16000 + 1).alias("ref_pos")).distinct()


PLACED = TRIM + """, pos AS (SELECT DISTINCT o_custkey % 20 AS contig_id, o_orderkey % 16000 + 1 AS ref_pos FROM orders),
placed AS (SELECT p.contig_id, p.ref_pos, t.gene_id, t.start_pos, t.end_pos, t.strand, t.gene_type FROM pos p LEFT JOIN trim t ON t.contig_id = p.contig_id AND p.ref_pos BETWEEN t.trimmed_start AND t.end_pos)"""


@query(PLACED + " SELECT * FROM placed")
def site_in_gene(spark, sf_dir):
    return intervals.sites_in_genes(positions(spark, sf_dir), bind(spark, sf_dir, "v_feat"))


UNIT = "ACGTTGCAAGCTNCATGCCGATTTAGGCAC"
ANNOTATED = PLACED + f""", {CODONS},
sq AS (SELECT gene_id, substr(repeat('{UNIT}', 21), CAST(gene_id % 30 + 1 AS INT), 600) AS sequence FROM v_feat),
cod AS (SELECT *, substr(sequence, CAST(wg - wg % 3 + 1 AS INT), 3) AS codon, CAST(wg % 3 AS INT) AS wi FROM (SELECT p.*, sq.sequence, CASE WHEN strand = '+' THEN ref_pos - start_pos ELSE end_pos - ref_pos END AS wg FROM placed p LEFT JOIN sq USING (gene_id)) y),
four AS (SELECT contig_id, ref_pos, b, (SELECT aa FROM code WHERE code.codon = substr(c.codon, 1, wi) || CASE WHEN strand = '+' THEN b ELSE translate(b, 'ACGT', 'TGCA') END || substr(c.codon, wi + 2, 3)) AS aa
  FROM cod c, (SELECT unnest(['A', 'C', 'G', 'T']) AS b) bb WHERE gene_type = 'CDS' AND regexp_matches(c.codon, '^[ACGT][ACGT][ACGT]$')),
ann AS (SELECT contig_id, ref_pos, concat(5 - count(DISTINCT aa), 'D') AS site_type, string_agg(aa, ',' ORDER BY b) AS amino_acids FROM four GROUP BY 1, 2)
SELECT p.contig_id, p.ref_pos, p.gene_id, coalesce(p.gene_type, 'IGR') AS locus_type, ann.site_type, ann.amino_acids FROM placed p LEFT JOIN ann USING (contig_id, ref_pos)"""


@query(ANNOTATED)
def site_annotation(spark, sf_dir):
    features = bind(spark, sf_dir, "v_feat")
    sequence = F.substring(F.repeat(F.lit(UNIT), 21), (F.col("gene_id") % 30 + 1).cast("int"), F.lit(600))
    placed = intervals.sites_in_genes(positions(spark, sf_dir), features)
    return intervals.annotate_sites(placed, features.select("gene_id", sequence.alias("sequence"))).select("contig_id", "ref_pos", "gene_id", "locus_type", "site_type", "amino_acids")


# ---------------------------------------------------------------- selection, sets, plans, quality


@query("SELECT concat('GCF_', p_partkey) AS genome_id FROM part WHERE p_partkey % 7 = 3")
def id_slice_modulo(spark, sf_dir):
    ids = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.concat(F.lit("GCF_"), "p_partkey").alias("genome_id"))
    return ids.filter(selectors.id_slice(F.col("genome_id"), "3:7"))


@query(with_views("v_obs", "v_aln") + "x AS (SELECT 1) SELECT species_id FROM v_obs INTERSECT SELECT species_id FROM v_aln")
def species_intersect(spark, sf_dir):
    return obs(spark, sf_dir).select("species_id").intersect(aln(spark, sf_dir).select("species_id"))


@query("SELECT l_orderkey AS read_id, l_linenumber AS mate FROM lineitem WHERE l_linenumber = 1 UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber = 2")
def union_reads(spark, sf_dir):
    mate = lambda k: spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter(F.col("l_linenumber") == k).select(F.col("l_orderkey").alias("read_id"), F.col("l_linenumber").alias("mate"))
    return mate(1).unionByName(mate(2))


@query(with_views("v_aln") + "x AS (SELECT 1) SELECT DISTINCT species_id, marker_id FROM v_aln")
def distinct_pairs(spark, sf_dir):
    return aln(spark, sf_dir).select("species_id", "marker_id").distinct()


@query("SELECT p_partkey AS id FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def except_ids(spark, sf_dir):
    used = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_quantity > 45").select(F.col("l_partkey").alias("id"))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id")).join(used, "id", "left_anti")


HMM = ["concat('B', l_partkey % 40) AS marker_id", "l_orderkey AS gene_id", "l_discount / 10000 AS evalue", "l_quantity / 50 AS qcov", "l_tax * 10 AS tcov", "(l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS row_no"]


@query(f"WITH h AS (SELECT {', '.join(HMM)} FROM lineitem) SELECT marker_id, gene_id, evalue FROM (SELECT *, row_number() OVER (PARTITION BY marker_id ORDER BY evalue, row_no) AS k FROM h WHERE evalue <= 1e-5 AND least(qcov, tcov) >= 0.1) x WHERE k = 1")
def hmm_best(spark, sf_dir):
    hits = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*HMM)
    return pangenome.marker_hits(hits, coverage=0.1).select("marker_id", "gene_id", "evalue")


@query("SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS k FROM lineitem) x WHERE k = 1")
def first_per_key(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    return selectors.first_per_key(rows, ["l_orderkey"], "l_linenumber").select("l_orderkey", "l_partkey")


@query("SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) AS k FROM lineitem) x WHERE k = 1")
def last_per_key(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("l_partkey"))
    return selectors.last_per_key(rows, ["l_orderkey"], "l_linenumber").select("l_orderkey", "l_partkey")


def contigs(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("contig_id"), (F.col("o_orderkey") * 37 % 5000 + 1).alias("length"))


CONTIGS = "WITH c AS (SELECT o_orderkey AS contig_id, o_orderkey * 37 % 5000 + 1 AS length FROM orders)"


@query(CONTIGS + " SELECT contig_id, k * 1000 AS start, least(k * 1000 + 1000, length) AS \"end\", k * 1000 + 1000 > length AS pooled, k = 0 AS counts_reads FROM c, range(0, 6) r(k) WHERE k * 1000 < length")
def run_chunks(spark, sf_dir):
    return chunks.run_chunks(contigs(spark, sf_dir), chunk_size=1000)


@query(CONTIGS + " SELECT contig_id, k * 1000 AS start, CASE WHEN k = greatest(length // 1000, 1) - 1 THEN length ELSE k * 1000 + 1000 END AS \"end\" FROM c, range(0, 6) r(k) WHERE k < greatest(length // 1000, 1)")
def merge_chunks(spark, sf_dir):
    return chunks.merge_chunks(contigs(spark, sf_dir), chunk_size=1000)


PACKED = """WITH RECURSIVE piece AS (
  SELECT species_id, contig_id, length, row_number() OVER (PARTITION BY species_id ORDER BY length DESC, contig_id) AS pos, count(*) OVER (PARTITION BY species_id) AS n
  FROM (SELECT concat('sp', o_orderkey % 40) AS species_id, CAST(o_orderkey AS VARCHAR) AS contig_id, o_orderkey * 37 % 5000 + 1 AS length FROM orders) c WHERE length < 1000
), step(species_id, taken, high, low, room, chunk_id) AS (
  SELECT species_id, CAST(1 AS BIGINT), CAST(2 AS BIGINT), n, 1000 - length, CAST(0 AS BIGINT) FROM piece WHERE pos = 1
  UNION ALL
  SELECT s.species_id, CASE WHEN l.length <= room THEN low ELSE high END, CASE WHEN l.length <= room THEN high ELSE high + 1 END, CASE WHEN l.length <= room THEN low - 1 ELSE low END,
         CASE WHEN l.length <= room THEN room - l.length ELSE 1000 - h.length END, CASE WHEN l.length <= room THEN chunk_id ELSE chunk_id + 1 END
  FROM step s JOIN piece l ON l.species_id = s.species_id AND l.pos = s.low JOIN piece h ON h.species_id = s.species_id AND h.pos = s.high WHERE s.high <= s.low
)
SELECT p.species_id, p.contig_id, p.length, s.chunk_id FROM piece p JOIN step s ON s.species_id = p.species_id AND s.taken = p.pos"""


@query(PACKED)
def pack_contigs(spark, sf_dir):
    short = contigs(spark, sf_dir).filter("length < 1000").withColumn("species_id", F.concat(F.lit("sp"), F.col("contig_id") % 40)).withColumn("contig_id", F.col("contig_id").cast("string"))
    return chunks.pack_contigs(short, chunk_size=1000)


@query("SELECT c_custkey, CASE WHEN c_custkey <= 20 THEN 0 WHEN c_custkey <= 100 THEN 2000000 WHEN c_custkey <= 200 THEN 1000000 WHEN c_custkey <= 500 THEN 500000 WHEN c_custkey <= 800 THEN 200000 ELSE 100000 END AS chunk_size FROM customer")
def adaptive_chunk_size(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", chunks.adaptive_chunk_size(F.col("c_custkey"), default=1_000_000).alias("chunk_size"))


READ = [
    "l_orderkey * 10 + l_linenumber AS read_id", "l_linenumber = 7 AS is_secondary", "cast(l_quantity AS int) AS query_alignment_start", "150 - cast(l_discount * 100 AS int) AS query_alignment_end",
    "cast(l_tax * 100 AS int) AS nm", "array(l_linenumber * 6, 30, cast(l_quantity AS int)) AS query_qualities", "cast(l_partkey % 40 AS int) AS mapping_quality", "150 AS query_length",
]


@query("""WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS read_id, l_linenumber, 150 - cast(l_discount * 100 AS int) - cast(l_quantity AS int) AS alen, cast(l_tax * 100 AS int) AS nm, (l_linenumber * 6 + 30 + cast(l_quantity AS int)) / 3 AS q, l_partkey % 40 AS mapq FROM lineitem)
SELECT read_id FROM r WHERE l_linenumber <> 7 AND 100 * (alen - nm) / alen >= 94 AND q >= 20 AND mapq >= 10 AND alen / 150 >= 0.75""")
def keep_read(spark, sf_dir):
    reads = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*READ)
    return reads.filter(readqc.keep_read()).select("read_id")

"""Queries over gene info, markers, annotation and catalogues of genomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import alleles, sequences
from ..operators import chunks, intervals, pangenome, snv, species
from .bindings import bind
from .catalog import MATRIX, PAN, PILE, PLACED, SEQS, filled, genes, positions, seqs, sites
from .registry import query

# ---------------------------------------------------------------- markers

#: The marker map: a gene of a species may be a copy of a marker; four of five genes are in the sequence file.
MAP = ["concat('sp', p_partkey % 6) AS species_id", "concat('G', p_partkey % 9) AS genome_id", "concat('G', p_partkey % 9, '_', p_partkey) AS gene_id", "201 + p_size * 30 AS gene_length", "concat('B', p_partkey % 15) AS marker_id"]


def gene_map(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*MAP)


def gene_ids(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").filter("p_partkey % 5 <> 2").selectExpr("concat('G', p_partkey % 9, '_', p_partkey) AS gene_id")


MARKED = f"WITH m AS (SELECT {', '.join(MAP)} FROM part WHERE p_partkey % 5 <> 2)"


@query(MARKED + " SELECT * FROM m")
def marker_gene_map(spark, sf_dir):
    return species.markers_info(gene_map(spark, sf_dir), gene_ids(spark, sf_dir))[0]


@query(MARKED + " SELECT species_id, marker_id, CAST(sum(gene_length) AS BIGINT) AS marker_length, string_agg(gene_id, ',' ORDER BY gene_id) AS gene_ids FROM m GROUP BY 1, 2")
def markers_info(spark, sf_dir):
    return species.markers_info(gene_map(spark, sf_dir), gene_ids(spark, sf_dir))[1]


@query(MATRIX + " SELECT species_id, count(*) FILTER (uniq_reads > 0 OR ambi_reads > 0) AS total_covered, count(*) FILTER (uniq_reads > 0) AS unique_covered, count(*) FILTER (ambi_reads > 0) AS ambiguous_covered, count(*) AS total_marker_counts FROM mat GROUP BY 1")
def covered_markers(spark, sf_dir):
    return species.covered_markers(filled(spark, sf_dir))


HMM = ["concat('B', l_partkey % 40) AS marker_id", "l_orderkey % 100 AS doc", "l_discount / 10000 AS evalue", "l_quantity / 50 AS qcov", "l_tax * 10 AS tcov", "(l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS row_no"]


@query(SEQS + f""", h AS (SELECT {', '.join(HMM)} FROM lineitem),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY marker_id ORDER BY evalue, row_no) AS k FROM h WHERE evalue <= 1e-5 AND least(qcov, tcov) >= 0.1) x WHERE k = 1)
SELECT s.gene_id, CAST(length(s.sequence) AS INT) AS gene_length, b.marker_id, s.sequence AS marker_gene FROM best b JOIN seqs s ON s.gene_id = concat('g_', b.doc)""")
def marker_genes(spark, sf_dir):
    """Bases and map of the best hit of each marker."""
    hits = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*HMM).withColumn("gene_id", F.concat(F.lit("g_"), "doc"))
    best = pangenome.marker_hits(hits, coverage=0.1)
    return pangenome.marker_genes(best, seqs(spark, sf_dir).select("gene_id", F.lower("sequence").alias("sequence")))


# ---------------------------------------------------------------- gene info


@query(PAN + ", m AS (SELECT gene_id, max(marker_id) AS marker_id FROM g WHERE marker_id IS NOT NULL GROUP BY 1) SELECT g.gene_id, g.centroid_95, g.gene_length, coalesce(m.marker_id, '') AS marker_id FROM g LEFT JOIN m USING (gene_id)")
def gene_info(spark, sf_dir):
    g = genes(spark, sf_dir)
    return pangenome.gene_info(g.select("gene_id", "centroid_95"), g.select("gene_id", "gene_length"), g.filter("marker_id IS NOT NULL").select("gene_id", "marker_id"))


@query(PAN + " SELECT gene_id FROM g WHERE centroid_75 = 'G1_64' AND gene_id <> centroid_75")
def cluster_members(spark, sf_dir):
    return pangenome.members_of(genes(spark, sf_dir), "centroid_75", "G1_64").select("gene_id")


@query(SEQS + " SELECT gene_id, sequence FROM seqs WHERE doc_id % 4 = 1")
def member_sequences(spark, sf_dir):
    s = seqs(spark, sf_dir)
    return pangenome.sequences_of(s.select("gene_id", "sequence"), s.filter("doc_id % 4 = 1").select("gene_id"))


@query(PAN + " SELECT a.gene_id, b.centroid_95 AS centroid_id FROM g a JOIN g b ON b.gene_id = a.centroid_99")
def composed_clusters(spark, sf_dir):
    """Members under the centroids that another clustering gives their centroids."""
    g = genes(spark, sf_dir)
    return pangenome.composed(g.select("gene_id", F.col("centroid_99").alias("centroid_id")), g.select("gene_id", F.col("centroid_95").alias("centroid_id")))


@query(PAN + " SELECT CASE WHEN gene_length % 2 = 0 THEN 'orig_' || gene_id ELSE gene_id END AS gene_id, centroid_95 FROM g")
def original_names(spark, sf_dir):
    g = genes(spark, sf_dir)
    names = g.filter("gene_length % 2 = 0").select(F.col("gene_id").alias("short"), F.concat(F.lit("orig_"), "gene_id").alias("original"))
    return pangenome.original_names(g.select("gene_id", "centroid_95"), names, "gene_id")


#: A catalogue of genomes: those that orders name, in species by customer; the first of each species represents it.
TOC_ROWS = ["concat('G', o_orderkey % 400) AS genome", "concat('sp', o_orderkey % 400 % 4) AS species", "o_orderkey % 400 < 4 AS rep"]
TOC = f"toc AS (SELECT DISTINCT {', '.join(TOC_ROWS)} FROM orders)"


def toc(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(*TOC_ROWS).distinct().select("genome", "species", F.col("rep").cast("int").alias("genome_is_representative"))


@query(PAN + f", {TOC} SELECT g.gene_id, g.genome_id, toc.species AS species_id FROM g JOIN toc ON toc.genome = g.genome_id WHERE toc.species IN ('sp0', 'sp2')")
def genes_of_species(spark, sf_dir):
    """Genes of two species, by the genome in their id; genes of unknown genomes go."""
    wanted = spark.createDataFrame([("sp0",), ("sp2",)], "species_id string")
    return pangenome.species_of_genes(genes(spark, sf_dir).select("gene_id"), toc(spark, sf_dir), wanted).select("gene_id", "genome_id", "species_id")


@query(f"WITH {TOC} SELECT species, max(CASE WHEN rep THEN genome END) AS representative, count(*) AS genomes FROM toc GROUP BY 1")
def representatives(spark, sf_dir):
    return pangenome.representatives(toc(spark, sf_dir))


# ---------------------------------------------------------------- annotation


def orthologs(spark, sf_dir) -> DataFrame:
    """Functions of two thirds of the genes, some rows twice."""
    g = genes(spark, sf_dir).filter("gene_length % 3 <> 0")
    rows = g.select(F.col("gene_id").alias("query"), F.concat(F.lit("C"), F.col("gene_length") % 7).alias("COG_category"), *[F.lit("-").alias(c) for c in pangenome.ORTHOLOG_COLUMNS[1:]])
    return rows.unionByName(rows.filter("COG_category = 'C1'"))


@query(PAN + ", c AS (SELECT centroid_95, count(*) AS n FROM g GROUP BY 1) SELECT c.centroid_95, c.n, CASE WHEN g.gene_length % 3 <> 0 THEN concat('C', g.gene_length % 7) END AS COG_category FROM c LEFT JOIN g ON g.gene_id = c.centroid_95")
def cluster_functions(spark, sf_dir):
    clusters = genes(spark, sf_dir).groupBy("centroid_95").agg(F.count(F.lit(1)).alias("n"))
    return pangenome.with_orthologs(clusters, "centroid_95", orthologs(spark, sf_dir)).select("centroid_95", "n", "COG_category")


@query(PAN + " SELECT centroid_95, count(*) AS gene_counts, max(gene_length) AS cluster_length FROM g GROUP BY 1")
def one_to_one(spark, sf_dir):
    g = genes(spark, sf_dir)
    return pangenome.joined_one_to_one(pangenome.cluster_counts(g, "centroid_95"), pangenome.cluster_lengths(g, "centroid_95"), "centroid_95")


LENGTHS = "lens AS (SELECT p_partkey % 20 AS contig_id, max(p_size) * 1000 AS contig_length FROM part WHERE p_partkey % 20 < 15 GROUP BY 1)"


def contig_lengths(spark, sf_dir) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").filter("p_partkey % 20 < 15")
    return part.groupBy((F.col("p_partkey") % 20).alias("contig_id")).agg((F.max("p_size") * 1000).alias("contig_length"))


@query(f"WITH {LENGTHS} SELECT p_partkey AS gene_id, contig_id, contig_length FROM part JOIN lens ON lens.contig_id = p_partkey % 20")
def genes_on_contigs(spark, sf_dir):
    return pangenome.genes_on_contigs(bind(spark, sf_dir, "v_feat"), contig_lengths(spark, sf_dir)).select("gene_id", "contig_id", "contig_length")


@query(f"WITH {LENGTHS} SELECT p_partkey AS query, concat('C', p_size) AS COG_category, contig_id, contig_length FROM part JOIN lens ON lens.contig_id = p_partkey % 20 WHERE p_partkey % 2 = 0 AND p_partkey % 3 = 0")
def orthologs_on_contigs(spark, sf_dir):
    """Functions of centroids (even genes) with their place; every third gene has one."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    functions = part.filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("query"), F.concat(F.lit("C"), "p_size").alias("COG_category"))
    centroids = part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("centroid_99"))
    return pangenome.orthologs_on_contigs(functions, centroids, bind(spark, sf_dir, "v_feat"), contig_lengths(spark, sf_dir)).select("query", "COG_category", "contig_id", "contig_length")


KINDS = ("genomad_virus", "genomad_plasmid", "mefinder", "resfinder")


@query("SELECT o_orderkey AS hit, CASE o_orderkey % 4 WHEN 0 THEN 'gene_is_phage' WHEN 1 THEN 'gene_is_plasmid' WHEN 2 THEN 'gene_is_amr' ELSE 'gene_is_me' END AS name FROM orders")
def annotation_names(spark, sf_dir):
    """The column that each hit fills, by its kind."""
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    hits = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("hit"), kind.alias("kind"))
    name = F.create_map(*[F.lit(x) for k in KINDS for x in (k, pangenome.annotation_column(k))])
    return hits.select("hit", F.element_at(name, F.col("kind")).alias("name"))


# ---------------------------------------------------------------- sequences, sites, plans


@query(SEQS + " SELECT gene_id, length(sequence) AS length FROM seqs WHERE length(sequence) >= 1000")
def clean_contigs(spark, sf_dir):
    return pangenome.clean_contigs(seqs(spark, sf_dir)).select("gene_id", F.length("sequence").cast("long").alias("length"))


@query("SELECT doc_id, regexp_matches(text, '[NXnx]') AS odd FROM documents WHERE text IS NOT NULL")
def split_ambiguous(spark, sf_dir):
    """Both halves of the split, each with its mark."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text IS NOT NULL").select("doc_id", F.col("text").alias("sequence"))
    plain, odd = pangenome.split_ambiguous(rows)
    return plain.select("doc_id", F.lit(False).alias("odd")).union(odd.select("doc_id", F.lit(True)))


@query("SELECT doc_id, concat('GC', doc_id, '_', CASE WHEN doc_id % 2 = 0 THEN 'x' ELSE 'GC' END) AS name FROM documents")
def renamed_prefixes(spark, sf_dir):
    raw = F.concat(F.lit("gnl|Prokka|UHGGGC"), "doc_id", F.lit("_"), F.when(F.col("doc_id") % 2 == 0, "x").otherwise("UHGGGC"))
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", sequences.renamed_prefixes(raw).alias("name"))


@query(PILE + " SELECT sample_name, ref_id, ref_pos, concat(count_a, ',', count_c, ',', count_g, ',', count_t) AS acgt, count_c AS c, count_t AS t FROM pile")
def packed_counts(spark, sf_dir):
    rows = sites(spark, sf_dir).withColumn("acgt", alleles.packed_counts({b: F.col(f"count_{b.lower()}") for b in "ACGT"}))
    back = alleles.unpacked_counts(F.col("acgt"))
    return rows.select("sample_name", "ref_id", "ref_pos", "acgt", back["C"].alias("c"), back["T"].alias("t"))


@query("SELECT l_orderkey, string_agg(concat(l_linenumber, ':', q), ',' ORDER BY l_linenumber) AS by_key, concat('2:', coalesce(max(q) FILTER (l_linenumber = 2), -1), ',1:', coalesce(max(q) FILTER (l_linenumber = 1), -1)) AS reordered FROM (SELECT l_orderkey, l_linenumber, CAST(max(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2) x GROUP BY 1")
def ordered_maps(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("long").alias("q"))
    maps = rows.groupBy("l_orderkey").agg(F.map_from_entries(F.reverse(F.array_sort(F.collect_list(F.struct("l_linenumber", "q"))))).alias("m"))
    shown = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), F.coalesce(e["value"], F.lit(-1)).cast("string"))), ",")
    return maps.select("l_orderkey", shown(sequences.sorted_map(F.col("m"))).alias("by_key"), shown(sequences.reordered_map(F.col("m"), F.array(F.lit(2), F.lit(1)))).alias("reordered"))


@query("SELECT concat('sp', o_orderkey % 40) AS species_id, count(*) AS contigs, max(o_orderkey * 37 % 5000 + 1) AS max_contig_length, CAST(sum((o_orderkey * 37 % 5000 + 1) // 1000) AS BIGINT) AS full_chunks, count(*) FILTER ((o_orderkey * 37 % 5000 + 1) % 1000 > 0) AS pooled_pieces FROM orders GROUP BY 1")
def contig_summary(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.concat(F.lit("sp"), F.col("o_orderkey") % 40).alias("species_id"), (F.col("o_orderkey") * 37 % 5000 + 1).alias("length"))
    return chunks.contig_summary(rows, chunk_size=1000)


@query("SELECT species_id, (row_number() OVER (ORDER BY species_id) - 1) // 7 AS slice FROM (SELECT DISTINCT concat('sp', o_custkey % 60) AS species_id FROM orders) s")
def species_slices(spark, sf_dir):
    ids = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.concat(F.lit("sp"), F.col("o_custkey") % 60).alias("species_id")).distinct()
    return chunks.slices(ids, size=7)


@query(PLACED + " SELECT contig_id, ref_pos, coalesce(gene_type, 'IGR') AS locus_type FROM placed WHERE coalesce(gene_type, 'IGR') IN ('IGR', 'tRNA')")
def locus_filter(spark, sf_dir):
    placed = intervals.sites_in_genes(positions(spark, sf_dir), bind(spark, sf_dir, "v_feat"))
    return snv.of_locus(placed.withColumn("locus_type", F.coalesce("gene_type", F.lit("IGR"))), locus_types=("IGR", "tRNA")).select("contig_id", "ref_pos", "locus_type")

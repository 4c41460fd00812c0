"""Declared schemas of the tables that the workflows exchange, as DDL strings."""

from __future__ import annotations

# Column names and their order, as the file formats have them.
M8 = "query string, target string, pid double, aln int, mis double, gaps double, qstart double, qend double, tstart double, tend double, evalue double, score double"
MARKER_MAP = "species_id string, genome_id string, gene_id string, gene_length int, marker_id string"
MARKER_CUTOFFS = "marker_id string, marker_cutoff double"
GENE_LENGTHS = "gene_id string, genome_id string, gene_length int"
GENES_INFO = "gene_id string, centroid_99 string, centroid_95 string, centroid_90 string, centroid_85 string, centroid_80 string, centroid_75 string, gene_length int, marker_id string"
GENE_FEATURES = "gene_id string, contig_id string, start int, end int, strand string, gene_type string"
SPECIES_PROFILE = "species_id string, marker_read_counts int, median_marker_coverage double, marker_coverage double, marker_relative_abundance double, unique_fraction_covered double"
SNPS_SUMMARY = "species_id string, genome_length int, covered_bases int, total_depth int, aligned_reads int, mapped_reads int, fraction_covered double, mean_depth double"
PILEUP = "ref_id string, ref_pos int, ref_allele string, depth int, count_a int, count_c int, count_g int, count_t int"
PILEUP_ADVANCED = PILEUP + ", major_allele string, minor_allele string, major_allele_freq double, minor_allele_freq double, allele_counts int"
GENOMES = "genome string, species string, representative string, genome_is_representative int"
SAMPLES = "sample_name string, outdir string"
UCLUST = "type string, cluster_id string, size string, pid string, strand string, skip1 string, skip2 string, skip3 string, gene_id string, centroid_id string"
GFF = "seqid string, source string, type string, start int, end int, score string, strand string, phase string, attributes string"

PREDICTED_GENES = (
    "gene", "start", "end", "length", "strand", "gc_content", "genetic_code", "rbs_motif", "marker", "evalue", "bitscore", "uscg", "plasmid_hallmark", "virus_hallmark", "taxid",
    "taxname", "annotation_conjscan", "annotation_amr", "annotation_accessions", "annotation_description",
)

ORTHOLOGS = (
    "query", "seed_ortholog", "evalue", "score", "eggNOG_OGs", "max_annot_lvl", "COG_category", "Description", "Preferred_name", "GOs", "EC",
    "KEGG_ko", "KEGG_Pathway", "KEGG_Module", "KEGG_Reaction", "KEGG_rclass", "BRITE", "KEGG_TC", "CAZy", "BiGG_Reaction", "PFAMs",
)


def genes_depth(level: int) -> str:
    return f"cluster_{level}_id string, gene_length int, aligned_reads int, mapped_reads int, total_depth int, mean_depth double, copy_number double, genome_prevalence double, marker_id string"


def cluster_info(level: int) -> str:
    p = f"c{level}"
    return f"centroid_{level} string, {p}_genome_counts int, {p}_genome_prevalence double, {p}_gene_counts int, {p}_gene_length int, {p}_marker_density double, {p}_marker_id string"

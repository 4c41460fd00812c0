"""The workflows, from tables to tables, with the usual thresholds as defaults.

Every step is an operator of this package; samples and species are columns, so one call serves all
of them. Results are DataFrames by name, lazy but for what several steps need (hits of reads on
markers, places of chunks), which is written to scratch as the workflow is called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import contig_name
from ..sources import scratch
from . import chunks, cnv, coverage, intervals, pangenome, pileup, readqc, selectors, snv, species

Tables = dict[str, DataFrame]


def run_species(hits: DataFrame, gene_map: DataFrame, gene_ids: DataFrame, cutoffs: DataFrame | None, *, aln_mapid: float | None = None, aln_cov: float = 0.75, marker_reads: int = 2, marker_covered: int = 2) -> Tables:
    """Abundance of species in one sample, from hits of reads on marker genes.

    hits: query, aln_no, target (gene), pid, aln, qlen, score. gene_map: species_id, gene_id,
    gene_length, marker_id; gene_ids: the genes of the sequence file. cutoffs: marker_id,
    marker_cutoff, not needed if aln_mapid is given. Gives species and markers.
    """
    genes, lengths = species.markers_info(gene_map, gene_ids)
    located = hits.join(genes.select(F.col("gene_id").alias("target"), "species_id", "marker_id"), "target")
    best = species.best_hits(species.passing_hits(located, cutoffs, aln_mapid=aln_mapid, aln_cov=aln_cov))
    matrix = species.support_matrix(best, lengths, marker_reads=marker_reads, marker_covered=marker_covered)
    markers = matrix.withColumn("total_reads", F.col("uniq_reads") + F.col("ambi_reads")).withColumn("total_alnbps", F.col("uniq_alnbps") + F.col("ambi_alnbps"))
    return {"species": species.species_profile(matrix, covered=True), "markers": markers}


def merge_species(profiles: DataFrame, *, min_cov: float = 1.0) -> DataFrame:
    """Statistics of species over samples."""
    return species.merge_profiles(profiles, min_cov=min_cov)


def species_to_build(merged: DataFrame, *, select_by: Sequence[str] = ("sample_counts",), select_threshold: Sequence[float] = (2,), ids: Sequence[str] | None = None) -> DataFrame:
    """Species above every threshold, for which an index is worth building."""
    return species.select_species(merged, dict(zip(select_by, select_threshold, strict=True)), ids)


def chosen(reads: DataFrame, profile: DataFrame | None, select_by: Sequence[str], select_threshold: Sequence[float], ids: Sequence[str] | None) -> DataFrame:
    """Reads of the species that a profile (sample_name, species_id, ...) puts above every threshold in their sample, of the ids given; all without a profile."""
    if profile is None:
        return reads if ids is None else reads.filter(F.col("species_id").isin(list(ids)))
    above = species.above_thresholds(profile, dict(zip(select_by, select_threshold, strict=True)), ids)
    # A row a sample and species: reads are not shuffled to meet it.
    return reads.join(F.broadcast(above.select("sample_name", "species_id").distinct()), ["sample_name", "species_id"], "left_semi")


def run_snps(
    reads: DataFrame, genome: DataFrame, *, profile: DataFrame | None = None, select_by: Sequence[str] = ("median_marker_coverage",), select_threshold: Sequence[float] = (2.0,), species_ids: Sequence[str] | None = None,
    aln_mapid: float = 94.0, aln_mapq: int = 10, aln_readq: float = 20.0, aln_cov: float = 0.75, aln_baseq: int = 30,
    fragment_length: int = 1000, fragment_ratio: float = 3.0, paired_only: bool = False, analysis_ready: bool = False,
    site_depth: int = 2, ignore_ambiguous: bool = False, advanced: bool = False, snp_maf: float = 0.1, ordinal: str = "row_no", stored: bool = False,
) -> Tables:
    """Sites of samples and their summary, from alignments on representative genomes.

    reads: columns of readqc with sample_name and species_id; genome: species_id, ref_id, sequence.
    With a profile of the samples, only species above the thresholds in a sample count there.
    Reads that are ready for analysis are not filtered, yet secondary, failed and duplicate ones add
    no depth in any case; aligned_reads and mapped_reads have them. stored: sites are written to scratch
    once, for where both results are wanted. Gives pileup (deep enough sites; with calls if advanced) and summary (before that filter).
    """
    if paired_only and analysis_ready:
        raise ValueError("reads that are ready for analysis are not filtered by pairs")
    reads = chosen(reads, profile, select_by, select_threshold, species_ids)
    key = ["sample_name", "species_id"]
    aligned = reads.groupBy(*key).agg(F.count(F.lit(1)).alias("aligned_reads"))
    limits = {"aln_mapid": aln_mapid, "aln_mapq": aln_mapq, "aln_readq": aln_readq, "aln_cov": aln_cov}
    if paired_only:
        pairs = readqc.proper_pairs(reads, **limits, fragment_length=fragment_length, fragment_ratio=fragment_ratio, ordinal=ordinal)
        # A contig's pairs are all mapped reads of it; at sites the last pair of each name counts.
        kept, mapped = readqc.mates(readqc.last_pairs(pairs, ordinal=ordinal)), pairs.groupBy(*key).agg((2 * F.count(F.lit(1))).alias("mapped_reads"))
    else:
        kept = readqc.single_reads(reads, analysis_ready=analysis_ready, ordinal=ordinal, columns=(*coverage.OBSERVED, *readqc.UNCOUNTED), **limits)
        passing = reads if analysis_ready else reads.filter(readqc.keep_read(**limits))
        mapped = passing.groupBy(*key).agg(F.count(F.lit(1)).alias("mapped_reads"))
    covering = kept.filter(readqc.covering(kept))
    sites = pileup.with_reference(coverage.counted_sites(covering, base_quality=aln_baseq), genome)
    sites = scratch.kept(sites) if stored else sites
    lengths = genome.groupBy("species_id").agg(F.sum(F.length("sequence")).alias("genome_length"))
    covered = sites.groupBy(*key).agg(F.count(F.lit(1)).alias("covered_bases"), F.sum("depth").alias("total_depth"))
    summary = covered.join(aligned, key).join(mapped, key).join(lengths, "species_id")
    summary = summary.withColumn("fraction_covered", F.col("covered_bases") / F.col("genome_length")).withColumn("mean_depth", F.col("total_depth") / F.col("covered_bases"))
    deep = pileup.deep_sites(sites, site_depth=site_depth, ignore_ambiguous=ignore_ambiguous)
    return {"pileup": pileup.advanced(deep, snp_maf=snp_maf) if advanced else deep, "summary": summary}


def merge_snps(
    sites: DataFrame, summaries: DataFrame, features: DataFrame, sequences: DataFrame, *,
    sample_counts: int = 2, genome_depth: float = 5.0, genome_coverage: float = 0.4, site_depth: int = 5, site_ratio: float = 3.0, site_prev: float = 0.9,
    snv_type: str = "common", snp_pooled_method: str = "prevalence", snp_maf: float = 0.05, snp_type: Sequence[str] = ("bi", "tri", "quad"), locus_type: Sequence[str] = ("any",),
) -> Tables:
    """Variants of populations, from the sites and summaries of all samples.

    features: gene_id, contig_id, start_pos, end_pos, strand, gene_type; sequences: gene_id, sequence.
    Gives info (a row a site) and freq (a row a site and sample: depth and minor frequency).
    """
    samples = snv.relevant(summaries, genome_depth=genome_depth, genome_coverage=genome_coverage, sample_counts=sample_counts)
    good = snv.site_filter(snv.noise_floor(sites), samples, site_depth=site_depth, site_ratio=site_ratio)
    # What each sample has at a site stays with the pooled site: sites are brought together once, by site.
    called = snv.population(snv.prevalent(snv.pooled(good, keep_samples=True), snv_type=snv_type, site_prev=site_prev), method=snp_pooled_method, snp_maf=snp_maf, snp_types=snp_type)
    places = called.select(F.col("ref_id").alias("contig_id"), "ref_pos").distinct()
    annotated = intervals.annotate_sites(intervals.sites_in_genes(places, features), sequences).select(F.col("contig_id").alias("ref_id"), "ref_pos", "gene_id", "locus_type", "site_type", "amino_acids")
    info = snv.of_locus(called.join(annotated, ["ref_id", "ref_pos"]), locus_types=locus_type)
    return {"info": info.drop("samples"), "freq": snv.frequencies(info, samples)}


def run_genes(
    reads: DataFrame, toc: DataFrame, clusters: DataFrame, *, species_ids: DataFrame | None = None,
    profile: DataFrame | None = None, select_by: Sequence[str] = ("median_marker_coverage",), select_threshold: Sequence[float] = (2.0,),
    aln_mapid: float = 94.0, aln_mapq: int = 0, aln_readq: float = 20.0, aln_cov: float = 0.75, aln_baseq: int = 15, total_depth: int = 1,
) -> Tables:
    """Copy numbers of genes in samples, from alignments on pangenomes.

    reads: columns of readqc with sample_name, ref_id being a gene; toc: genome, species; clusters:
    cluster_id (gene), species_id, gene_length, marker_id. A profile chooses species as in run_snps. Gives genes and summary.
    """
    keep = readqc.keep_read(aln_mapid=aln_mapid, aln_mapq=aln_mapq, aln_readq=aln_readq, aln_cov=aln_cov)
    reads = reads.drop("species_id")
    # Reads are counted by gene first: the catalogue and the profile meet a row a sample and gene, not a read.
    counted = readqc.contig_reads(reads, keep)
    bases = pileup.explode_alignments(reads.filter(keep)).filter((F.col("base_qual") >= aln_baseq) & F.col("base").isin("A", "C", "G", "T"))
    key = ["sample_name", "ref_id"]
    depth = bases.groupBy(*key, "ref_pos").agg(F.count(F.lit(1)).alias("depth")).groupBy(*key).agg(F.sum("depth").alias("total_depth"), F.count(F.lit(1)).alias("covered_bases"))
    rows = counted.filter((F.col("aligned_reads") >= total_depth) & (F.col("mapped_reads") >= total_depth)).join(depth, key)
    named = pangenome.species_of_genes(rows.withColumn("gene_id", F.col("ref_id")), toc, species_ids).drop("genome_id", "gene_id")
    named = chosen(named, profile, select_by, select_threshold, None).withColumnRenamed("ref_id", "cluster_id")
    genes = named.join(clusters.drop("species_id"), "cluster_id").withColumn("mean_depth", F.col("total_depth") / F.col("gene_length"))
    markers = cnv.marker_depth(genes, clusters.select("marker_id").distinct())
    sizes = clusters.groupBy("species_id").agg(F.count(F.lit(1)).alias("pangenome_size"))
    return {"genes": cnv.copy_numbers(genes, markers), "summary": cnv.gene_summary(genes, markers, sizes)}


def merge_genes(genes: DataFrame, summaries: DataFrame, mapping: DataFrame, *, genome_depth: float = 1.0, sample_counts: int = 1, min_copy: float = 0.35) -> DataFrame:
    """Copy number, depth, reads and presence of output clusters in relevant samples. mapping: cluster_id, cluster_out."""
    samples = snv.relevant(summaries, genome_depth=genome_depth, genome_coverage=None, sample_counts=sample_counts)
    return cnv.presence(cnv.cluster_sums(cnv.remap(genes, mapping), samples), min_copy=min_copy)


def compute_chunks(contigs: DataFrame, kind: str, *, chunk_size: int, order: str = "contig_id") -> DataFrame:
    """The plan of chunks of contigs (species_id, contig_id, length): species_id, chunk_id, contig_id, start, end, counts_reads, pooled.

    For run_snps, tails and short contigs are packed together; for merge_snps, short contigs are, and a tail goes to the window before it.
    """
    return chunks.whole_plan(contigs, kind, chunk_size=chunk_size, order=order)


def recluster_centroids(members: DataFrame, centroids: DataFrame, coarser: dict[str, DataFrame], lengths: DataFrame, gene_map: DataFrame) -> DataFrame:
    """Gene info after a second clustering of the centroids: genes (gene_id, centroid_id) under the new centroids of theirs, with the coarser levels, length and marker."""
    first = pangenome.composed(members, centroids).withColumnRenamed("centroid_id", "centroid_99")
    return pangenome.gene_info(pangenome.xref_clusters(first, coarser), lengths, gene_map)


def import_genome(contigs: DataFrame, *, length: int = 1000) -> DataFrame:
    """Contigs (genome, contig_no, sequence) that are long enough, with the ids they get, numbered in order."""
    kept = selectors.numbered(pangenome.clean_contigs(contigs, length=length), ["genome"], ["contig_no"])
    return kept.select("genome", contig_name(F.col("genome"), F.col("serial"), F.col("sequence")).alias("contig_id"), F.upper("sequence").alias("sequence"))


def build_pangenome(clusters: DataFrame, coarser: dict[str, DataFrame]) -> DataFrame:
    """Genes with their centroids at every level, in order of gene: cluster records of all genes at 99, and of the centroids at coarser levels.

    A centroid outside its own cluster, or a gene in two, ends the job with an error.
    """
    checked = lambda records: pangenome.checked_centroids(pangenome.uclust_members(records))
    return pangenome.xref_clusters(checked(clusters).withColumnRenamed("centroid_id", "centroid_99"), {name: checked(records) for name, records in coarser.items()}).orderBy("gene_id")


#: Levels of clusters, finest first.
LEVELS = ("centroid_99", "centroid_95", "centroid_90", "centroid_85", "centroid_80", "centroid_75")


def augment_pangenome(genes: DataFrame, contigs: DataFrame, genome: str, *, levels: Sequence[str] = LEVELS) -> Tables:
    """What a pangenome's genes say of its clusters at every level, of its genomes and of its contigs.

    genes: gene_id, the levels, gene_length, marker_id; contigs: genome_id, contig_id, sequence; genome: the representative one.
    Gives clusters (level, centroid_id, counts, prevalence, length, marker), parents (the coarser centroids of the finest ones),
    contigs (genome_id, contig_id, contig_length), stacked (the genomes of each cluster at the coarsest level) and lifted (the
    genes of the representative genome with their finest centroid).
    """
    finest, coarsest = levels[0], levels[-1]
    return {
        "clusters": pangenome.cluster_levels(genes, levels),
        "parents": genes.filter(F.col("gene_id") == F.col(finest)).select(*levels),
        "contigs": contigs.select("genome_id", "contig_id", F.length("sequence").alias("contig_length")),
        "stacked": pangenome.stacked_genomes(genes, coarsest),
        "lifted": pangenome.lift_to_genome(genes, finest, genome),
    }


def prune_centroids(clusters: DataFrame, coarse: DataFrame, sequences: DataFrame, *, prune_method: str = "max", prune_cutoff: float = 0.4, remove_singletons: bool = False) -> DataFrame:
    """Sequences (gene_id, sequence, in capitals) of the centroids that are worth aligning reads to.

    clusters: centroid_99, centroid_95, centroid_75, gene_length; coarse: the clusters at 75 with gene_counts, genome_counts, genome_prevalence.
    """
    found = pangenome.pruned_centroids(clusters, coarse, how=prune_method, cutoff=prune_cutoff, remove_singletons=remove_singletons)
    return pangenome.sequences_of(sequences, found.select(F.col("centroid_99").alias("gene_id"))).select("gene_id", F.upper("sequence").alias("sequence"))


def annotate_pangenome(features: DataFrame, contig_lengths: DataFrame, annotations: Tables) -> Tables:
    """For each kind of annotation (contig_id, start_pos, end_pos, ...) the genes that it overlaps."""
    genes = pangenome.genes_on_contigs(features, contig_lengths)
    return {kind: intervals.overlap_join(genes, hits) for kind, hits in annotations.items()}


def enhance_pangenome(genes: DataFrame, level: str, annotated: Tables, orthologs: DataFrame) -> DataFrame:
    """Cluster info of a level with the share of members under each kind of annotation and the centroid's functions."""
    names = {pangenome.FLAG_OF[kind]: hits for kind, hits in annotated.items()}
    ratios = pangenome.annotation_ratios(pangenome.annotation_flags(genes, names), level, list(names))
    described = pangenome.with_orthologs(ratios, level, orthologs)
    return pangenome.joined_one_to_one(pangenome.cluster_info(genes, level), described, level)


def build_markerdb(genes: DataFrame, toc: DataFrame, *, markers: Sequence[str] | None = None) -> Tables:
    """The marker genes of all genomes (genome_id, gene_id, gene_length, marker_id, marker_gene) under their species: map and sequences.

    toc: genome, species; a genome that it lacks is left out. markers: the ids of the marker set, all if not given. A gene that stands twice ends the job with an error.
    """
    kept_ = genes if markers is None else genes.filter(F.col("marker_id").isin(list(markers)))
    species_of = toc.select(F.col("genome").alias("genome_id"), F.col("species").alias("species_id"))
    placed = pangenome.unique_keys(kept_.select("genome_id", "gene_id", "gene_length", "marker_id", "marker_gene"), "gene_id").join(species_of, "genome_id")
    return {"map": placed.select("species_id", "genome_id", "gene_id", "gene_length", "marker_id"), "sequences": placed.select("gene_id", F.upper("marker_gene").alias("sequence"))}


def infer_markers(hits: DataFrame, sequences: DataFrame, *, evalue: float = 1e-5, coverage: float = 0.0) -> DataFrame:
    """The marker genes of a genome: map and bases."""
    return pangenome.marker_genes(pangenome.marker_hits(hits, evalue=evalue, coverage=coverage), sequences)

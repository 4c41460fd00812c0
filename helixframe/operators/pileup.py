"""From observed bases to counts at every site, their summary, and calls in one sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alleles import BASES, call_alleles, count_of, unambiguous

SITE = ("sample_name", "species_id", "ref_id", "ref_pos", "ref_allele")
#: Bases of a contig that travel together when reference alleles are looked up.
BLOCK = 2048
COUNTS = tuple(f"count_{b.lower()}" for b in BASES)


def counts(prefix: str = "count_") -> dict[str, Column]:
    return {b: F.col(f"{prefix}{b.lower()}") for b in BASES}


def explode_alignments(reads: DataFrame) -> DataFrame:
    """Observed bases of reads: one row per aligned pair of query and reference position, gaps left out."""
    pair = F.explode("aligned_pairs")
    flat = reads.withColumn("pair", pair).filter(F.col("pair.qpos").isNotNull() & F.col("pair.rpos").isNotNull())
    return flat.select(
        *[c for c in ("sample_name", "species_id") if c in reads.columns],
        "ref_id",
        (F.col("pair.rpos") + 1).alias("ref_pos"),
        F.substring("query_sequence", F.col("pair.qpos") + 1, F.lit(1)).alias("base"),
        F.get("query_qualities", F.col("pair.qpos")).alias("base_qual"),
        F.col("query_name").alias("read_id"),
    )


def genome_blocks(genome: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """ref_id, block (from 0) and its bases, of contigs (ref_id, sequence); one pass over each sequence."""
    pieces = F.regexp_extract_all("sequence", F.lit(f".{{1,{block}}}"), F.lit(0))
    return genome.select("ref_id", F.posexplode(pieces).alias("block", "bases"))


def with_reference(sites: DataFrame, genome: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """Adds ref_allele to sites (ref_id, ref_pos from 1) from contigs (ref_id, sequence); sites beyond a contig are left out.

    Look alleles up after counting: a row is a site then, not an observed base. Only the block that
    a site lies in comes to it, so no row carries a contig and no contig is one key.
    """
    placed = sites.withColumn("block", F.floor((F.col("ref_pos") - 1) / block).cast("int"))
    allele = F.substring("bases", ((F.col("ref_pos") - 1) % block + 1).cast("int"), F.lit(1))
    return placed.join(genome_blocks(genome, block=block), ["ref_id", "block"]).withColumn("ref_allele", allele).filter("ref_allele <> ''").drop("block", "bases")


def region(rows: DataFrame, ref_id: str, start: int, end: int) -> DataFrame:
    """Rows of a contig within a slice that is 0-based and half open; ref_pos counts from 1. The conditions reach the scan."""
    return rows.filter((F.col("ref_id") == ref_id) & (F.col("ref_pos") > start) & (F.col("ref_pos") <= end))


def pileup(observed: DataFrame, *, base_quality: int = 30) -> DataFrame:
    """Counts of A, C, G, T and depth of every site; bases of lower quality and other letters add nothing.

    Where observed has no ref_allele yet, sites have none either (see with_reference).
    """
    good = observed.filter(F.col("base_qual") >= base_quality)
    each = [F.count_if(F.col("base") == b).alias(c) for b, c in zip(BASES, COUNTS, strict=True)]
    return good.groupBy(*[c for c in SITE if c in observed.columns]).agg(*each).withColumn("depth", sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0])))


def deep_sites(sites: DataFrame, *, site_depth: int = 2, ignore_ambiguous: bool = False) -> DataFrame:
    found = sites.filter(F.col("depth") >= site_depth)
    return found.filter(unambiguous(counts())) if ignore_ambiguous else found


def advanced(sites: DataFrame, *, snp_maf: float = 0.1) -> DataFrame:
    """Adds major and minor allele with their frequencies; sites where no allele passes are left out."""
    called = sites.withColumn("call", call_alleles(counts(), F.col("depth"), snp_maf)).filter("call.n > 0")
    major, minor = F.col("call.major"), F.col("call.minor")
    return (
        called.withColumn("major_allele", major)
        .withColumn("minor_allele", minor)
        .withColumn("major_allele_freq", count_of(major, counts()) / F.col("depth"))
        .withColumn("minor_allele_freq", F.when(major == minor, 0.0).otherwise(count_of(minor, counts()) / F.col("depth")))
        .withColumn("allele_counts", F.col("call.n"))
        .drop("call")
    )


def summary(observed: DataFrame, genomes: DataFrame, *, base_quality: int = 30) -> DataFrame:
    """Per sample and species: genome_length, covered_bases, total_depth, reads, fraction_covered, mean_depth.

    genomes: species_id, genome_length. One shuffle by site, then partial sums.
    """
    sites = pileup(observed, base_quality=base_quality).filter("depth > 0")
    covered = sites.groupBy("sample_name", "species_id").agg(F.count(F.lit(1)).alias("covered_bases"), F.sum("depth").alias("total_depth"))
    reads = observed.groupBy("sample_name", "species_id", "read_id").agg(F.max("base_qual").alias("best")).groupBy("sample_name", "species_id").agg(F.count(F.lit(1)).alias("aligned_reads"), F.count_if(F.col("best") >= base_quality).alias("mapped_reads"))
    both = covered.join(reads, ["sample_name", "species_id"]).join(genomes, "species_id")
    return both.withColumn("fraction_covered", F.col("covered_bases") / F.col("genome_length")).withColumn("mean_depth", F.col("total_depth") / F.col("covered_bases"))
